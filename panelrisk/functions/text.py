"""Number texts, joined from values that were rounded half-even first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from panelrisk.functions.columns import col_of, half_even


def fixed(c: Column | str, digits: int = 1) -> Column:
    return _number(c, digits, f"%.{digits}f")


def signed(c: Column | str, digits: int = 1) -> Column:
    return _number(c, digits, f"%+.{digits}f")


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(fixed(c, digits), F.lit("%"))


def points(c: Column | str, digits: int = 1) -> Column:
    """Signed difference in percentage points."""
    return F.concat(signed(c, digits), F.lit(" p.p."))


def _number(c: Column | str, digits: int, pattern: str) -> Column:
    c = col_of(c).cast("double")
    # -0.0 + 0.0 is 0.0, so "-0.0" is never printed; null stays null
    shown = half_even(c, digits) + F.lit(0.0)
    return F.when(c.isNotNull(), F.format_string(pattern, shown))


def key_values(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``a=1, b=2`` from the pairs whose value is present."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), v) for k, v in pairs])


def template(text: str, *values: Column) -> Column:
    """Fill ``%s`` places; ``%%`` is a literal percent sign."""
    return F.format_string(text, *values)
