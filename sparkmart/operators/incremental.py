"""Incremental extraction by a date column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def since(df: DataFrame, date_column: str, first_date: date | str) -> DataFrame:
    """Rows on or after ``first_date``.

    A plain comparison with a literal, which Parquet, JDBC and partition pruning
    all take up at the source.
    """
    return df.filter(F.col(date_column) >= F.lit(str(first_date)))


def last_days(
    df: DataFrame, date_column: str, days: int = 30, as_of: date | str | None = None
) -> DataFrame:
    """Rows of the ``days`` days up to ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return df.filter(F.col(date_column) >= F.date_sub(today, days).cast("string"))


def not_loaded(
    incoming: DataFrame,
    target: DataFrame,
    date_column: str,
    key: str,
    newest: date | str | None = None,
) -> DataFrame:
    """Incoming rows on or after the target's newest date that it lacks.

    The lower bound is inclusive, so rows of the newest loaded day come again; they
    are told apart by key and date, as only that day of the target has to be read
    for. Rows without a date are always due, and known by their key in the same way.
    NULL equals NULL in both, so loading twice adds nothing. ``newest`` spares the look
    at all dates of the target, where a ledger has it.
    """
    last = F.lit(str(newest)) if newest is not None else target.agg(F.max(date_column)).scalar()
    day = F.col(date_column)
    due = incoming.filter((day >= last) | last.isNull() | day.isNull())
    # Names that no column of the incoming rows has.
    own_key, own_day = (f"{prefix}{''.join(incoming.columns)}" for prefix in ("key ", "day "))
    held = target.filter((day == last) | day.isNull()).select(
        F.col(key).alias(own_key), day.alias(own_day)
    )
    same = F.col(key).eqNullSafe(F.col(f"`{own_key}`")) & day.eqNullSafe(
        F.col(f"`{own_day}`")
    )
    return due.join(held, same, "left_anti")
