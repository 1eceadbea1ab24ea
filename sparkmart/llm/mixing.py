"""Mixing sources to target weights: raking, then sampling, in DataFrame operations.

Documents fall into cells of source, language and topic; a cell's weight starts as its
tokens. Iterative proportional fitting scales the cells to one marginal after another
until all are met to ``TOLERANCE``, so that the weights meet the target share of every
source, every language and every topic while the cells keep their proportions otherwise. A
document's chance is its cell's weight for each token, so that ``BUDGET`` of all tokens
are expected, and at most 1: what a full cell can't give, the open cells of the same
source, language and topic make up for, since the fitting counts a cell up to its tokens
only. A value with fewer tokens than its share of the budget is kept whole, and the
other values of its kind share the rest in proportion to their targets.

A target is either a share for each value, or a temperature t: shares in proportion to
tokens to the power t (1: as observed, 0: all alike).
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.tables import bounded, packed, stored

Target = float | Mapping[str, float]
TARGETS: dict[str, Target] = {"source": 0.7, "lang": 0.7, "topic": 1.0}
BUDGET = 0.8
#: Rounds of fitting in one plan; the cells are stored and the miss is measured after each.
ROUNDS = 8
#: The largest relative miss of a marginal at which fitting ends.
TOLERANCE = 1e-6
#: Targets contradict each other if the miss has not fallen by a twentieth in one of so
#: many plans in a row; the fitting has then come to its end.
PATIENCE = 5
SEED = "mix"
#: Cells that are fitted in one task.
LOCAL_CELLS = 100_000

# Phrases that mark licence text, and token counts that part texts by length.
LEGAL = ("Licensed under", "Released under", "All rights reserved", "Copyright")
SHORT, LONG = 100, 1000
_SPACE = r"[ \t\n\x0B\f\r]+"


def tokens_of(text: Column) -> Column:
    """The number of words between white space, 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")).cast(
        "bigint"
    )


def topic_of(text: Column, tokens: Column) -> Column:
    """A topic by what a text holds: legal, contact, table, or prose by its length."""
    body = F.coalesce(text, F.lit(""))
    legal = F.lit(False)
    for phrase in LEGAL:
        legal = legal | F.contains(body, F.lit(phrase))
    return (
        F.when(legal, "legal")
        .when(F.contains(body, F.lit("@")), "contact")
        .when(F.contains(body, F.lit(" | ")), "table")
        .when(tokens < SHORT, "short")
        .when(tokens > LONG, "long")
        .otherwise("prose")
    )


def _described(docs: DataFrame) -> DataFrame:
    """Documents with their cell (null: empty) and tokens, in columns named _mix_*."""
    body = docs.withColumn("_mix_tokens", tokens_of(F.col("text")))
    return body.withColumns(
        {
            "_mix_source": F.coalesce("source", F.lit("")),
            "_mix_lang": F.coalesce("lang", F.lit("")),
            "_mix_topic": topic_of(F.col("text"), F.col("_mix_tokens")),
        }
    )


def _part(target: Target, by: str, tokens: Column) -> Column:
    """What a value of ``by`` weighs among the others."""
    if isinstance(target, Mapping):
        given = F.create_map(*(F.lit(x) for item in target.items() for x in item))
        return F.coalesce(F.try_element_at(given, F.col(by)), F.lit(0.0)).cast("double")
    return F.pow(tokens.cast("double"), F.lit(float(target)))


def _share(cells: DataFrame, by: str, target: Target, budget: float | None) -> Column:
    """The target share of a cell's value of ``by``, among the values that have tokens.

    With a budget (in tokens): the tokens to be kept of it, at most those that it has.
    """
    values = cells.groupBy(by).agg(F.sum("tokens").alias("seen"), F.sum("room").alias("room"))
    values = values.withColumn("part", _part(target, by, F.col("seen")))
    whole = values.agg(F.sum("part")).first()[0] or 1.0
    inside = Window.partitionBy(by)
    share = _part(target, by, F.sum("tokens").over(inside)) / whole
    if budget is None:
        return share
    scale = _scale(values, F.col("part") / whole, F.col("room"), budget, budget)
    return F.least(F.sum("room").over(inside).cast("double"), share * scale)


def _factor(by: str, keys: list[str], budgeted: bool) -> tuple[Column, Column]:
    """What scales the cells of a value of ``by`` to its share, as two columns.

    The second is of ``factor``, the first. With a budget, cells count up to their room:
    the factor is the largest of those found if the cells above a rate were full.
    """
    inside = Window.partitionBy(by)
    share = F.col(f"share_{by}")
    if not budgeted:
        held = F.sum("weight").over(inside)
        return F.when(held > 0, share / held), F.col("factor")
    rate = F.try_divide(F.col("weight"), F.col("room"))
    upto = inside.orderBy(rate, *keys).rowsBetween(Window.unboundedPreceding, 0)
    open_ = F.sum("weight").over(upto)
    full = F.sum("room").over(inside) - F.sum("room").over(upto)
    return F.when(open_ > 0, (share - full) / open_), F.max("factor").over(inside)


def rake(
    cells: DataFrame,
    targets: Mapping[str, Target],
    rounds: int = ROUNDS,
    budget: float | None = None,
) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with a ``weight`` that meets the targets, and
    the ``miss``: by how much of itself a target share is missed at most.

    Weights are shares of all tokens. With a ``budget`` (a share of all tokens), they are
    tokens to be kept, at most those of the cell. Where targets can't all be met, the
    last one named is, and the others as nearly as the fitting gets; ``miss`` tells, and
    so does a warning. Up to ``LOCAL_CELLS`` cells are fitted in one task; more are shuffled for every
    marginal. ``rounds`` go into one plan. Each cell is one row, its names not null; cells
    without tokens get no weight; no cells give no rows.
    """
    few = cells.limit(LOCAL_CELLS + 1).count() <= LOCAL_CELLS
    # Cells of a value that explicit shares don't name have no room.
    named = reduce(
        Column.__and__,
        (_part(t, by, F.col("tokens")) > 0 for by, t in targets.items() if isinstance(t, Mapping)),
        F.lit(True),
    )
    roomy = cells.withColumn("room", F.when(named, F.col("tokens")).otherwise(0))
    goal = None
    if budget is not None:
        total, room = roomy.agg(F.sum("tokens"), F.sum("room")).first()
        goal = float(min(budget * (total or 0), room or 0))
    fitted = roomy.select(
        "*",
        F.col("tokens" if goal is None else "room").cast("double").alias("weight"),
        *(_share(roomy, by, t, goal).alias(f"share_{by}") for by, t in targets.items()),
    )
    best, idle = float("inf"), 0
    while True:
        fitted = fitted.coalesce(1) if few else fitted
        for _ in range(rounds):
            for by in targets:
                first, second = _factor(by, cells.columns, goal is not None)
                scaled = fitted.withColumn("factor", first).withColumn("factor", second)
                fitted = scaled.withColumn(
                    "weight", F.coalesce(F.col("weight") * F.col("factor"), F.lit(0.0))
                ).drop("factor")
        fitted = stored(fitted, "raked")
        weight = F.col("weight") if goal is None else F.least("weight", "room")
        miss = _miss(fitted.withColumn("weight", weight), list(targets))
        idle = idle + 1 if miss > 0.95 * best else 0
        best = min(best, miss)
        if miss <= TOLERANCE or idle == PATIENCE:
            break
    if miss > TOLERANCE:
        warnings.warn(f"targets can't all be met: a share is {miss:.2g} of itself off", stacklevel=2)
    return fitted.select(*cells.columns, weight.alias("weight"), F.lit(miss).alias("miss"))


def _miss(fitted: DataFrame, names: list[str]) -> float:
    """By how much of itself a target share is missed at most."""
    off = F.max(F.abs(F.col("held") / F.col("share") - 1)).alias("off")
    each = [
        fitted.groupBy(by)
        .agg(F.sum("weight").alias("held"), F.max(f"share_{by}").alias("share"))
        .where("share > 0")
        .agg(off)
        for by in names
    ]
    return (reduce(DataFrame.union, each).agg(F.max("off")).first()[0] or 0.0) if each else 0.0


def _scale(rows: DataFrame, weight: Column, size: Column, goal: float, scale: float) -> float:
    """The factor at which weights, each up to its size, sum up to ``goal``.

    It is raised from ``scale`` until no further row becomes full.
    """
    before = -1
    while True:
        full = weight * scale >= size
        count, kept, open_ = rows.agg(
            F.count(F.when(full, 1)),
            F.sum(F.when(full, size).otherwise(0)),
            F.sum(F.when(~full, weight).otherwise(0.0)),
        ).first()
        if not open_ or count == before:
            return scale
        before, scale = count, max(scale, (goal - kept) / open_)


def calibrated(
    docs: DataFrame,
    targets: Mapping[str, Target] = TARGETS,
    budget: float = BUDGET,
) -> DataFrame:
    """``docs`` with _mix_source, _mix_lang, _mix_topic, _mix_tokens, _mix_probability,
    _mix_kept and _mix_miss.

    ``docs`` has doc_id, text, source and lang; all its columns stay, but those of the names
    above. The choice goes by
    a hash of the id, so it is the same in every run; rows that share an id share it.

    ``_mix_miss``, the same in all rows, is by how much of itself a target is missed at
    most: up to ``TOLERANCE``, or more where targets contradict each other.

    * a null source, language or id counts as an empty one;
    * a text without words (null, empty, white space) has no tokens: never kept;
    * values that explicit shares don't name have a share of 0: never kept;
    * an empty table gives an empty result.
    """
    kinds = ("source", "lang", "topic", "tokens", "probability", "kept", "miss")
    described = _described(docs.drop(*(f"_mix_{k}" for k in kinds)))
    keys = ["source", "lang", "topic"]
    cells = stored(
        described.where("_mix_tokens > 0")
        .groupBy(*(F.col(f"_mix_{k}").alias(k) for k in keys))
        .agg(F.sum("_mix_tokens").alias("tokens")),
        "cells",
    )
    raked = rake(cells, targets, budget=budget)
    miss = raked.agg(F.max("miss")).first()[0] or 0.0
    chances = raked.select(
        *(F.col(k).alias(f"_mix_{k}") for k in keys),
        (F.col("weight") / F.col("tokens")).alias("_mix_chance"),
    )
    digits = F.substring(
        F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
        1,
        8,
    )
    place = F.conv(digits, 16, 10).cast("double") / float(1 << 32)
    joined = described.join(
        bounded(chances), [f"_mix_{k}" for k in keys], "left"
    )
    chance = F.when(
        F.col("_mix_tokens") > 0, F.coalesce("_mix_chance", F.lit(0.0))
    ).otherwise(0.0)
    return joined.select(
        *described.columns,
        chance.alias("_mix_probability"),
        (place < chance).alias("_mix_kept"),
        F.lit(miss).alias("_mix_miss"),
    )


def sample(
    docs: DataFrame, targets: Mapping[str, Target] = TARGETS, budget: float = BUDGET
) -> DataFrame:
    """The kept rows of ``docs``, with their ``probability`` (which replaces one there).

    All other columns stay, whatever their names. Nulls, empty texts, repeated rows and
    empty tables are treated as in :func:`calibrated`.
    """
    names = [c for c in docs.columns if c != "probability"]
    rows = docs.select(packed(docs, names), "doc_id", "text", "source", "lang")
    return (
        calibrated(rows, targets, budget)
        .where("_mix_kept")
        .select("row.*", F.col("_mix_probability").alias("probability"))
    )
