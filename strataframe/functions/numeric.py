"""Numeric, NULL and sentinel expressions that are safe under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(col: Column) -> Column:
    """Casts first: ``isnan`` on text raises for a value that is no number."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def missing_to_zero(col: Column) -> Column:
    """NaN and NULL become 0."""
    return F.coalesce(nan_to_null(col), F.lit(0.0))


def safe_long(col: Column) -> Column:
    """Cast to long; NaN, text and overflow give NULL."""
    return nan_to_null(col).try_cast("long")


def sentinel_to_null(col: Column, *sentinels) -> Column:
    return F.when(~col.isin(*sentinels), col)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; a zero whole gives NULL."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def rounded_mean(col: Column, digits: int = 2) -> Column:
    return F.round(F.avg(col), digits)


def all_present(*names: str) -> Column:
    return reduce(and_, [F.col(n).isNotNull() for n in names])


def stable_unit(*parts, seed: int = 0) -> Column:
    """A reproducible number in (0, 1) from a row's key, independent of partitioning."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (draw + 0.5) / F.lit(float(2**48))


def stable_gaussian(*parts, seed: int = 0) -> Column:
    """A reproducible standard normal draw (Box-Muller on two keyed uniforms)."""
    radius = F.sqrt(-2.0 * F.ln(stable_unit(*parts, seed=2 * seed)))
    return radius * F.cos(2.0 * F.pi() * stable_unit(*parts, seed=2 * seed + 1))
