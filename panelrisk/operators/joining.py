"""Equi-joins of a large table with a lookup side of checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelrisk.storage import materialize_at, new_path, stored_bytes

BROADCAST_BYTES = 8 << 20  # Parquet bytes of a lookup side that is sent to every task


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    unique: bool = True,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``left`` with a lookup table whose keys must be unique.

    The lookup side is written once, then measured. Up to ``max_bytes`` it is
    broadcast and ``left`` is not shuffled. Above that both sides are shuffled once;
    a key that holds much of ``left`` is split by the adaptive skew join.
    """
    on = list(on)
    spark = left.sparkSession
    path = new_path(spark, "lookup")
    right = materialize_at(right, path)
    if unique:
        repeated = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1)
        if repeated.count():
            raise ValueError(f"join keys {on} are not unique")
    if stored_bytes(spark, path) <= max_bytes:
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)


def without_clashes(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Right side reduced to its keys and the columns the left side lacks."""
    return right.select(*on, *[c for c in right.columns if c not in left.columns])


def with_suffixes(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Rename value columns present on both sides."""
    clash = [c for c in right.columns if c in left.columns and c not in on]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in clash}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in clash}),
    )
