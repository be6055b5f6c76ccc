"""Describe, correlation, regression line, histogram, box-plot numbers, errors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.functions.columns import finite, half_even, long_form
from panelrisk.operators.joining import lookup_join
from panelrisk.operators.ordering import column_quantiles, quantiles
from panelrisk.storage import materialize

NOISE = 1e-12


def describe_long(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """One row per column: count, mean, sample sd, min, exact quartiles, max."""
    out = column_quantiles(df, columns, (0.25, 0.5, 0.75), ("q25", "q50", "q75"), moments=True)
    rounded = [half_even(c, digits).alias(c)
               for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return out.select("indicator", "n", *rounded)


def exec_summary(df: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """Mean, median, max and min per column."""
    out = column_quantiles(df, columns, (0.5,), ("median",), moments=True)
    return out.select(
        "indicator", *[half_even(c, digits).alias(c) for c in ("mean", "median", "max", "min")]
    )


SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def corr_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    """Long table (a, b, r, n) of the named pairs, each over the rows that have both.

    NaN and infinity count as missing; r is null if one side is constant. Pair sums
    come from six matrix products per partition and one small aggregate, whatever
    the number of pairs. Values are shifted by the column mean, so that squares do
    not cancel.
    """
    cols = sorted({c for p in pairs for c in p})
    at = {c: i for i, c in enumerate(cols)}
    rows = materialize(df.select(*[finite(F.col(c).cast("double")).alias(c) for c in cols]), "corr")
    means = rows.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols]).first()
    shift = np.array([means[c] for c in cols])
    left, right = [at[a] for a, _ in pairs], [at[b] for _, b in pairs]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(SUMS), len(left)))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - shift
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            k = known.astype(float)
            every = np.stack([k.T @ k, x.T @ k, k.T @ x, (x * x).T @ k, k.T @ (x * x), x.T @ x])
            total += every[:, left, right]
        yield pd.DataFrame(dict(zip(SUMS, total))).assign(pair=range(len(left)))

    schema = ", ".join(f"{c} double" for c in SUMS) + ", pair int"
    added = rows.mapInPandas(sums, schema).groupBy("pair").agg(
        *[F.sum(c).alias(c) for c in SUMS]
    )
    n = F.col("n")
    cxx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    cyy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    cxy = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    # what is left of a constant column is rounding noise
    varies = (cxx > F.col("sxx") * NOISE) & (cyy > F.col("syy") * NOISE)
    r = F.when(varies, cxy / F.sqrt(cxx * cyy))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    name = names[F.col("pair")]
    return added.select(
        name["a"].alias("a"), name["b"].alias("b"), half_even(r, digits).alias("r"),
        n.cast("long").alias("n"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Lower triangle of the Pearson matrix with pairwise deletion."""
    return corr_pairs(df, [(b, a) for a, b in combinations(columns, 2)], digits)


def corr_target(
    df: DataFrame, target: str, columns: Sequence[str], digits: int = 6
) -> DataFrame:
    """Correlation of each column with the target, ascending, null last."""
    pairs = [(c, target) for c in columns if c != target]
    return corr_pairs(df, pairs, digits).orderBy(F.asc_nulls_last("r"), "a")


def strength(r: Column, words: Sequence[tuple[float, str]], other: str) -> Column:
    out = F.when(r.isNull(), F.lit(None).cast("string"))
    for above, word in words:
        out = out.when(F.abs(r) > above, F.lit(word))
    return out.otherwise(F.lit(other))


def corr_strength(
    df: DataFrame, pairs: Sequence[tuple[str, str]],
    words: Sequence[tuple[float, str]], other: str,
) -> DataFrame:
    table = corr_pairs(df, pairs)
    return table.withColumn("forca", strength(F.col("r"), words, other))


def corr_findings(
    df: DataFrame, pairs: Sequence[tuple[str, str]], above: float, inverse: str, direct: str
) -> DataFrame:
    """Named pairs whose rounded r is beyond ``above``, with the direction in words."""
    table = corr_pairs(df, pairs, 2)
    return table.where(F.abs("r") > above).withColumn(
        "direcao", F.when(F.col("r") < -above, F.lit(inverse)).otherwise(F.lit(direct))
    )


def line_fit(df: DataFrame, x: str, y: str, min_points: int = 3) -> DataFrame:
    """One row: least-squares line, number of points, means and range of x."""
    a, b = F.col(x), F.col(y)
    both = df.where(a.isNotNull() & b.isNotNull())
    enough = F.count(F.lit(1)) >= min_points
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.when(enough, F.regr_slope(b, a)).alias("slope"),
        F.when(enough, F.regr_intercept(b, a)).alias("intercept"),
        F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"),
        F.min(a).alias("min_x"), F.max(a).alias("max_x"),
    )


def line_points(fit: DataFrame, points: int = 100) -> DataFrame:
    """Evenly spaced points of a fitted line."""
    step = F.col("step")
    at = F.col("min_x") + (F.col("max_x") - F.col("min_x")) * step / F.lit(float(points - 1))
    return (
        fit.where(F.col("slope").isNotNull())
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at)
        .withColumn("y", F.col("slope") * F.col("x") + F.col("intercept"))
    )


def trend_lines(
    df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 4, min_points: int = 3
) -> DataFrame:
    """Fitted line and mean reference lines of each (x, y) pair, in one scan."""

    def line(x: str, y: str) -> Column:
        a, b = F.col(x), F.col(y)
        n = F.regr_count(b, a)
        return F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), n.alias("n"),
            F.when(n >= min_points, F.regr_slope(b, a)).alias("slope"),
            F.when(n >= min_points, F.regr_intercept(b, a)).alias("intercept"),
            F.regr_avgx(b, a).alias("mean_x"), F.regr_avgy(b, a).alias("mean_y"),
        )

    table = df.agg(F.array(*[line(x, y) for x, y in pairs]).alias("p")).select(F.inline("p"))
    return round_columns(table, dict.fromkeys(("slope", "intercept", "mean_x", "mean_y"), digits))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 25) -> DataFrame:
    """Equal-width bins between min and max, with mean and median of the column.

    The last bin is closed on both sides. A constant column has one bin.
    """
    rows = long_form(df, [], columns).where(F.col("value").isNotNull())
    edges = column_quantiles(df, columns, (0.5,), ("median",), moments=True).drop("n", "std")
    # one row per named column
    placed = lookup_join(rows, edges, ["indicator"], unique=False)
    width = (F.col("max") - F.col("min")) / F.lit(float(bins))
    step = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("min"), width)), F.lit(0))
    bucket = F.least(step + 1, F.lit(bins))
    return (
        placed.withColumn("bin", bucket.cast("int"))
        .groupBy("indicator", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            half_even(F.first("mean"), 4).alias("mean"),
            half_even(F.first("median"), 4).alias("median"),
        )
    )


def box_numbers(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per group."""
    rows = materialize(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, value), "box")
    fences = _fences(rows, group, value, reach)
    joined = lookup_join(rows, fences, [group], unique=False)
    inside = F.col(value).between(F.col("fence_low"), F.col("fence_high"))
    return joined.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(q).alias(q) for q in ("q1", "q2", "q3")],
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"),
    )


def box_outliers(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Rows outside the fences of their group."""
    fences = _fences(df, group, value, reach)
    bounds = fences.select(group, "fence_low", "fence_high")
    joined = lookup_join(df.where(F.col(value).isNotNull()), bounds, [group])
    return joined.where(
        ~F.col(value).between(F.col("fence_low"), F.col("fence_high"))
    ).select(*df.columns)


def _fences(df: DataFrame, group: str, value: str, reach: float) -> DataFrame:
    known = df.where(F.col(group).isNotNull())
    quart = quantiles(known, [group], value, (0.25, 0.5, 0.75), ("q1", "q2", "q3"))
    spread = (F.col("q3") - F.col("q1")) * F.lit(reach)
    return quart.withColumns(
        {"fence_low": F.col("q1") - spread, "fence_high": F.col("q3") + spread}
    )


def regression_metrics(
    df: DataFrame, observed: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R2 per group of keys; R2 is null where the target is constant."""
    y, p = F.col(observed), F.col(predicted)
    both = df.where(y.isNotNull() & p.isNotNull())
    n = F.count(F.lit(1))
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * n
    return both.groupBy(*keys).agg(
        n.alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
    )


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: half_even(c, d) for c, d in digits.items()})


def residual_box(df: DataFrame, observed: str, predicted: str, group: str) -> DataFrame:
    """Box-plot numbers of predicted minus observed per model."""
    gap = df.withColumn("residual", F.col(predicted) - F.col(observed))
    return box_numbers(gap, group, "residual")
