"""Bounded, repeatable samples of rows to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(divisor)


def sample_ids(rows: DataFrame, size: int, by: str | None = None) -> DataFrame:
    """At most ``size`` distinct ids (for each value of ``by``) in hash order.

    Ids and ``by`` only, so texts are not sorted; each task passes on at most
    ``size`` rows per value.
    """
    columns = ["doc_id"] + ([by] if by else [])
    found = rows.select(*columns).withColumn("_h", F.xxhash64("doc_id"))
    if by is None:
        return found.distinct().orderBy("_h", "doc_id").limit(size).drop("_h")
    window = Window.partitionBy(by).orderBy("_h", "doc_id")
    return found.withColumn("_r", F.row_number().over(window)).where(F.col("_r") <= size).drop("_r", "_h")
