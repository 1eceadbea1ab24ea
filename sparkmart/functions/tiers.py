"""Threshold ladders as Spark SQL expressions."""

from __future__ import annotations


def ladder_sql(subject: str, ladder) -> str:
    """CASE expression giving the first label whose bound ``subject`` meets."""
    steps, rest = ladder
    arms = " ".join(f"when {subject} {bound} then '{label}'" for bound, label in steps)
    return f"case {arms} else '{rest}' end"
