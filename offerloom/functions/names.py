"""Column names that a frame does not have yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made from ``names`` (input may carry any extra columns)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
