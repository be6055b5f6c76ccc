"""Positions, ranks and running counts over a whole table.

A window without a partition, or partitioned by a few years, would pull the
table into a few tasks. Here the rows are range-partitioned on a total order,
written once, and each block gets the count of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelrisk.functions.columns import finite, long_form
from panelrisk.operators.joining import lookup_join
from panelrisk.storage import materialize

BLOCK, POSITION, COUNT = "_block", "_position", "_n"
LOW_BITS = (1 << 33) - 1  # row part of monotonically_increasing_id


def ordered_blocks(df: DataFrame, order: Sequence[Column | str], label: str = "blocks") -> DataFrame:
    """Stored copy of ``df`` with its block and its 0-based place in the block.

    ``order`` should be a total order: only fully equal rows cannot be split, so
    a hot value of the first column spreads over several blocks.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(BLOCK, F.spark_partition_id())
        .withColumn(POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit(LOW_BITS)))
    )
    return materialize(placed, label)


def _rows_before() -> Window:
    return Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 0) -> DataFrame:
    """Dense row number in the given total order."""
    blocks = ordered_blocks(df, order, "number")
    # one row per block: at most spark.sql.shuffle.partitions rows
    offsets = (
        blocks.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
        .select(BLOCK, F.coalesce(F.sum("_rows").over(_rows_before()), F.lit(0)).alias("_before"))
    )
    return (
        blocks.join(F.broadcast(offsets), BLOCK)
        .withColumn(name, F.col("_before") + F.col(POSITION) + F.lit(start))
        .drop(BLOCK, POSITION, "_before")
    )


def dense_rank_rows(
    df: DataFrame, score: str, ties: Sequence[str], name: str, descending: bool = True
) -> DataFrame:
    """Dense rank of ``score`` over the whole table; null scores rank last.

    A score shared by many rows may span blocks; the step it causes is counted
    once, in the block where it starts.
    """
    key = F.col(score).desc_nulls_last() if descending else F.col(score).asc_nulls_last()
    blocks = ordered_blocks(df, [key, *ties], "rank")
    within = Window.partitionBy(BLOCK).orderBy(key)
    ranked = blocks.withColumn("_local", F.dense_rank().over(within))
    edge = F.struct(F.col(score).alias("v"))
    summary = blocks.groupBy(BLOCK).agg(
        F.min_by(edge, POSITION).alias("_first"),
        F.max_by(edge, POSITION).alias("_last"),
        (F.count_distinct(score) + F.max(F.col(score).isNull().cast("int"))).alias("_values"),
    )
    in_order = Window.orderBy(BLOCK)
    shared = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(in_order)), F.lit(False))
    # the first block has no neighbour before it
    shared = F.when(F.row_number().over(in_order) == 1, 0).otherwise(shared.cast("int"))
    offsets = summary.withColumn("_shared", shared).select(
        BLOCK,
        (F.coalesce(F.sum("_values").over(_rows_before()), F.lit(0))
         - F.sum("_shared").over(in_order)).alias("_before"),
    )
    return (
        ranked.join(F.broadcast(offsets), BLOCK)
        .withColumn(name, (F.col("_before") + F.col("_local")).cast("long"))
        .drop(BLOCK, POSITION, "_local", "_before")
    )


ACCURACY = 10_000   # a sketched quantile is off by at most 1/ACCURACY of the rows of its group
WHOLE = 4 * ACCURACY  # rows up to which a group is not narrowed
GRID = 256          # steps of a further narrowing
LIMIT = 1 << 22     # values of one group that are ordered in one task


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
    limit: int = LIMIT,
) -> DataFrame:
    """Exact quantiles per group with linear interpolation, nulls left out.

    Selection in place of sorting: one scan sketches every group and gives, for each
    wanted rank, an interval that must hold it; the next scan counts what lies between
    the intervals and, value by value, what lies inside. Only those few values are
    ordered. Where an interval would still hold too many, it is narrowed by further
    scans first. Equal values are one, so a hot value costs one row per task.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    by = keys or ["_all"]
    rows = rows if keys else rows.withColumn("_all", F.lit(0))
    bounds, largest = _sketched(rows, by, probs)
    held = largest * 6 * len(probs) / ACCURACY
    while largest > WHOLE and held > limit:
        bounds, held = _narrowed(rows, by, bounds, probs), held * 4 / GRID
    return _picked(rows, by, bounds, probs, names).select(*keys, *names)


def _sketched(rows: DataFrame, by: list[str], probs: Sequence[float]) -> tuple[DataFrame, int]:
    """(by, _size, _lo, _hi): an interval per wanted rank; and the size of the largest group."""
    reach = 2 / ACCURACY
    wanted = [max(p - reach, 0.0) for p in probs] + [min(p + reach, 1.0) for p in probs]
    found = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", F.array(*map(F.lit, wanted)), F.lit(ACCURACY)).alias("_q"))
    whole, k = F.col("_size") <= WHOLE, len(probs)

    def side(first: int, end: str, edge: float) -> Column:
        return F.array(*[F.when(whole | F.lit(wanted[first + i] == edge), F.col(end)).otherwise(F.col("_q")[first + i])
                         for i in range(k)])

    bounds = materialize(found.select(*by, "_size", side(0, "_min", 0.0).alias("_lo"), side(k, "_max", 1.0).alias("_hi")), "bounds")
    return bounds, bounds.agg(F.max("_size")).first()[0] or 0


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str], limit: int = LIMIT,
    moments: bool = False,
) -> DataFrame:
    """(indicator, names): exact quantiles of whole columns, as ``quantiles``, from two scans.

    The intervals of all columns come from one aggregate over the wide table and are
    literals of the second scan. ``moments`` adds n, mean, std, min and max, which the
    same aggregate gives. Columns without a value have no row.
    """
    reach = 2 / ACCURACY
    wanted = [max(p - reach, 0.0) for p in probs] + [min(p + reach, 1.0) for p in probs]
    number = {c: finite(F.col(c).cast("double")) for c in columns}
    row = df.agg(*[F.struct(
        F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        *([F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")] if moments else []),
        F.percentile_approx(v, F.array(*map(F.lit, wanted)), F.lit(ACCURACY)).alias("q")).alias(f"_{i}")
        for i, v in enumerate(number.values())]).first()
    found = {c: row[f"_{i}"] for i, c in enumerate(columns) if row[f"_{i}"]["n"]}
    known = None
    if moments:  # a row per column
        known = F.broadcast(df.sparkSession.createDataFrame(
            [(c, *[r[m] for m in ("n", "mean", "std", "min", "max")]) for c, r in found.items()],
            "indicator string, n long, mean double, std double, min double, max double"))
    if any(r["n"] > WHOLE and r["n"] * 6 * len(probs) / ACCURACY > limit for r in found.values()):
        out = quantiles(long_form(df, [], columns), ["indicator"], "value", probs, names, limit)
        return out.join(known, "indicator") if moments else out
    parts, k = [], len(probs)
    for c, r in found.items():
        q = [r["min"]] * k + [r["max"]] * k if r["n"] <= WHOLE else [
            r["min"] if i < k and w == 0.0 else r["max"] if i >= k and w == 1.0 else v
            for i, (w, v) in enumerate(zip(wanted, r["q"]))]
        inside = reduce(lambda a, b: a | b, [number[c].between(q[j], q[k + j]) for j in range(k)])
        gap = reduce(lambda a, b: a + b, [(number[c] > q[k + j]).cast("int") for j in range(k)])
        parts.append(F.struct(
            F.lit(c).alias("indicator"), number[c].alias("_v"), F.when(inside, number[c]).alias("_value"),
            F.when(~inside, gap).alias("_gap"), F.lit(r["n"]).alias("_size")))
    if not parts:
        out = df.sparkSession.createDataFrame([], "indicator string, " + ", ".join(f"{n} double" for n in names))
        return out.join(known, "indicator") if moments else out
    counted = df.select(F.inline(F.array(*parts))).where("_v is not null").groupBy("indicator", "_value", "_gap").agg(
        F.count(F.lit(1)).alias(COUNT), F.max("_v").alias("_at"), F.first("_size").alias("_size"))
    out = _at_ranks(counted, ["indicator"], probs, names)
    return out.join(known, "indicator") if moments else out


def _ranks(p: float) -> tuple[Column, Column]:
    place = F.lit(float(p)) * (F.col("_size") - 1)
    return F.floor(place), F.ceil(place)


def _narrowed(rows: DataFrame, by: list[str], bounds: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The same intervals after a sketch of what lies inside each of them."""
    joined = lookup_join(rows, bounds, by, unique=False)
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    parts = []
    for j in range(len(probs)):
        lo, hi = F.col("_lo")[j], F.col("_hi")[j]
        inside = F.col("_v").between(lo, hi)
        parts += [
            F.sum((F.col("_v") < lo).cast("long")).alias(f"_below_{j}"), F.sum(inside.cast("long")).alias(f"_in_{j}"),
            F.percentile_approx(F.when(inside, F.col("_v")), grid, F.lit(ACCURACY)).alias(f"_grid_{j}")]
    found = joined.groupBy(*by).agg(
        F.first("_size").alias("_size"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), *parts)
    lows, highs = [], []
    for j, p in enumerate(probs):
        first, last = ((r - F.col(f"_below_{j}")) / F.col(f"_in_{j}") for r in _ranks(p))
        down = F.floor((first - 2 / ACCURACY) * GRID).cast("int")
        up = F.ceil((last + 2 / ACCURACY) * GRID).cast("int") + 1
        few = F.col(f"_in_{j}") <= WHOLE
        lows.append(F.when(few | (down <= 0), F.col("_lo")[j]).otherwise(F.get(f"_grid_{j}", down)))
        highs.append(F.when(few | (up >= GRID), F.col("_hi")[j]).otherwise(F.get(f"_grid_{j}", up)))
    return materialize(found.select(*by, "_size", F.array(*lows).alias("_lo"), F.array(*highs).alias("_hi")), "bounds")


def _picked(
    rows: DataFrame, by: list[str], bounds: DataFrame, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """What lies inside the intervals, value by value, and how much lies between them."""
    joined = lookup_join(rows, bounds, by, unique=False)
    between = [F.col("_v").between(F.col("_lo")[j], F.col("_hi")[j]) for j in range(len(probs))]
    inside = reduce(lambda a, b: a | b, between)
    gap = reduce(lambda a, b: a + b, [(F.col("_v") > F.col("_hi")[j]).cast("int") for j in range(len(probs))])
    counted = joined.groupBy(*by, F.when(inside, F.col("_v")).alias("_value"), F.when(~inside, gap).alias("_gap")).agg(
        F.count(F.lit(1)).alias(COUNT), F.max("_v").alias("_at"), F.first("_size").alias("_size"))
    return _at_ranks(counted, by, probs, names)


def _at_ranks(counted: DataFrame, by: list[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Values at the wanted ranks, interpolated, from counts of values and gaps in the order of ``_at``."""
    # at most ``limit`` values of a group and one row for each gap
    running = Window.partitionBy(*by).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("_end", F.sum(COUNT).over(running)).withColumn("_start", F.col("_end") - F.col(COUNT))
    picks = []
    for p, name in zip(probs, names):
        for side, rank in zip(("lo", "hi"), _ranks(p)):
            hit = (F.col("_start") <= rank) & (rank < F.col("_end"))
            picks.append(F.max(F.when(hit, F.col("_value"))).alias(f"_{name}_{side}"))
    found = placed.groupBy(*by).agg(F.max("_size").alias("_size"), *picks)
    out = []
    for p, name in zip(probs, names):
        place = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return found.select(*by, *out)
