"""Contiguous shards of near equal bytes from global prefix sums.

Rows are put in ``doc_id`` order by range partitions. Each partition gets the
bytes and rows of the partitions before it (one total per partition), so every
row knows the bytes in front of it. A row belongs to the shard that holds the
middle of its bytes; shards therefore differ by less than one row at each end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelrisk.operators.ordering import BLOCK, POSITION, ordered_blocks

ROW_BYTES = 16  # added to the text of each row


def shard_by_bytes(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document with its size, shard and gapless slot in the shard.

    Null text counts no bytes. Null keys come first; rows with the same key are
    ordered by checksum and size. An empty table gives no rows. Only ``key`` and
    ``text`` are read, so other columns cannot clash.
    """
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    blocks = ordered_blocks(narrow, ["doc_id", "text_crc32", "size"], "shards")
    in_order = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, whatever the number of documents
    totals = blocks.groupBy(BLOCK).agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    totals = totals.select(
        BLOCK,
        F.coalesce(F.sum("_bytes").over(in_order), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    within = Window.partitionBy(BLOCK).orderBy(POSITION)
    placed = (
        blocks.withColumn("_end", F.sum("size").over(within))
        .join(F.broadcast(totals), BLOCK)
        .withColumn("_row", F.col("_rows_before") + F.row_number().over(within) - 1)
        .withColumn("_middle", 2 * (F.col("_bytes_before") + F.col("_end")) - F.col("size"))
        .withColumn("shard", F.expr(f"least({shards - 1}, _middle * {shards} div (2 * _total))").cast("int"))
    )
    # at most one row per shard
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
