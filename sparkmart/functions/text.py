"""Whitespace, header and missing-value rules for text that came from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The texts pandas reads as missing by default.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip_all(column: Column) -> Column:
    """Strip every kind of whitespace from both ends (SQL TRIM only takes spaces)."""
    return F.btrim(column, F.lit(WHITESPACE))


def blank_missing(column: Column) -> Column:
    """NULL for the texts that stand for a missing value."""
    return F.when(~column.isin(*MISSING_TOKENS), column)


def header_name(name: str) -> str:
    """Column name in lower snake case: stripped, spaces and hyphens to ``_``."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalised_headers(names: Sequence[str]) -> list[str]:
    """Apply :func:`header_name` to all names; two names must not become one."""
    origin: dict[str, str] = {}
    for name in names:
        clean = header_name(name)
        if clean in origin:
            raise ValueError(
                f"columns {origin[clean]!r} and {name!r} both become {clean!r}"
            )
        origin[clean] = name
    return list(origin)


def file_headers(cells: Sequence[str | None]) -> list[str]:
    """Usable names for a header line: blanks are numbered, repeats get a suffix."""
    taken: set[str] = set()
    names = []
    for position, cell in enumerate(cells):
        base = cell if cell else f"Unnamed: {position}"
        name, repeat = base, 0
        while name in taken:
            repeat += 1
            name = f"{base}.{repeat}"
        taken.add(name)
        names.append(name)
    return names
