"""Small helpers that several operators share: stored intermediate tables and
column-name hygiene."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.session import discard, stored

__all__ = ["discard", "fresh", "shielded", "stored"]


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """For each wanted helper name one that no column of the frame has
    (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        new = name
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out[name] = new
    return out


def shielded(df: DataFrame, needed: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator(df)`` with the columns of ``df`` as they are named and ordered
    there: all but the needed ones are out of the operator's way meanwhile."""
    hidden = {c: f"__carried{i}" for i, c in enumerate(df.columns) if c not in needed}
    out = operator(df.select(*[F.col(f"`{c}`").alias(hidden.get(c, c)) for c in df.columns]))
    return out.select(*[F.col(hidden.get(c, c)).alias(c) for c in df.columns])
