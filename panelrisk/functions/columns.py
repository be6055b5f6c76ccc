"""Row-wise expressions: rounding, clipping, binning, composite scores."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.settings import MISSING_LABEL


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even, on the binary value."""
    scale = float(10**digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def finite(c: Column | str) -> Column:
    """NaN and infinities become null."""
    c = col_of(c)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit to a closed range; null stays null."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def to_number(c: Column | str) -> Column:
    """Text to double; text that is no finite number gives null."""
    return finite(F.trim(col_of(c)).try_cast("double"))


def period_of(year: Column | str, breaks: Sequence[tuple[int, str]], last: str) -> Column:
    """Label of the first break that is not below the year."""
    year = col_of(year)
    out = None
    for upper, label in breaks:
        test = year <= F.lit(upper)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.when(year.isNotNull(), F.lit(last))


def level_of(
    value: Column | str,
    cuts: Sequence[float],
    labels: Sequence[str],
    closed: str = "right",
    missing: str | None = MISSING_LABEL,
) -> Column:
    """Ordinal label from cut points; ``closed`` names the side a cut belongs to."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label more than cut points is needed")
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    value = col_of(value)
    out = F.when(value.isNull() | F.isnan(value), F.lit(missing))
    for cut, label in zip(cuts, labels):
        test = value <= F.lit(cut) if closed == "right" else value < F.lit(cut)
        out = out.when(test, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def weighted_index(
    weights: Mapping[str, float], columns: Iterable[str], digits: int
) -> Column:
    """Weighted mean over the components present in a row, limited to 0..100.

    A component that is null leaves both sums; a column that the table lacks is
    ignored; no component present gives null.
    """
    known = set(columns)
    parts = [(F.col(c), F.lit(float(w))) for c, w in weights.items() if c in known]
    if not parts:
        return F.lit(None).cast("double")
    zero = F.lit(0.0)
    total, weight = zero, zero
    for c, w in parts:
        total = total + F.coalesce(c * w, zero)
        weight = weight + F.when(c.isNotNull(), w).otherwise(zero)
    return half_even(clip(F.try_divide(total, weight), 0.0, 100.0), digits)


def threshold_level(
    value: Column | str, attention: Column | float, critical: Column | float, labels: Sequence[str]
) -> Column:
    """Three-way label from two inclusive limits; null stays null."""
    value = col_of(value)
    ok, warn, bad = labels
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value >= critical, F.lit(bad))
        .when(value >= attention, F.lit(warn))
        .otherwise(F.lit(ok))
    )


def change_direction(change: Column | str) -> Column:
    """A rise of a harmful rate is worse, anything else better."""
    change = col_of(change)
    return F.when(change > 0, F.lit("worse")).when(change.isNotNull(), F.lit("better"))


def columns_with_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def long_form(
    df: DataFrame, ids: Sequence[str], values: Sequence[str],
    name: str = "indicator", value: str = "value",
) -> DataFrame:
    """Wide to long in one projection, all values as double."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return wide.unpivot(list(ids), list(values), name, value)
