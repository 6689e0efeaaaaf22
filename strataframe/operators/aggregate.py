"""Profiles, quantiles, pivots and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.numeric import percent
from strataframe.session import broadcast_if_small, cut_lineage


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, one row each, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    long = counts.unpivot("_rows", df.columns, "column_name", "null_count")
    return long.select("column_name", "null_count", percent(F.col("null_count"), F.col("_rows")).alias("null_pct"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows and surplus copies, as one row.

    Equal rows meet by partial counts before the shuffle, so one heavily copied
    row costs no more than any other.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    col = F.col(column)
    return df.agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("stddev"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )


def approx_quantiles(df: DataFrame, column: str, probabilities, accuracy: int = 100, by=()) -> DataFrame:
    """Quantile sketch per group: bounded memory, merges map-side (error 1/accuracy)."""
    sketch = F.percentile_approx(column, [float(p) for p in probabilities], accuracy)
    return (
        df.groupBy(*by)
        .agg(sketch.alias("_q"))
        .select(*by, *[F.col("_q")[i].cast("double").alias(f"q{i}") for i in range(len(probabilities))])
    )


# bits of a double below those that the first and second count look at
_TOP, _MIDDLE = 40, 20


def ordered_bits(value: Column) -> Column:
    """A double as a whole number in the same order: sign, exponent and mantissa; equal values only are equal.

    Both zeros are 0, NaN comes last.  The exponent from the logarithm may be one off beside a power of
    two, which a comparison with that power mends; all other steps are exact.
    """
    size = F.abs(value)
    rough = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e)
    exact = F.when(size < power(rough), rough - 1).when((rough < 1023) & (size / power(rough) >= 2), rough + 1).otherwise(rough)
    exponent = F.greatest(exact, F.lit(-1022))
    fraction = size / power(exponent)  # below 1 for the smallest numbers only
    unit = F.lit(1 << 52)
    bits = F.when(fraction >= 1, (exponent + 1023) * unit + ((fraction - 1) * F.lit(float(1 << 52))).cast("long")).otherwise((fraction * F.lit(float(1 << 52))).cast("long"))
    whole = F.when(size == float("inf"), F.lit(2047) * unit).otherwise(bits)
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(value == 0, F.lit(0)).when(value > 0, whole).otherwise(-whole).cast("long")


def exact_quantiles(df: DataFrame, column: str, probabilities, by=()) -> DataFrame:
    """Exact interpolated quantiles by radix selection, without sorting or shuffling the values.

    A first scan counts the rows of each leading part of the values' ordered bits (sign, exponent and
    twelve bits of the mantissa); the counts say in which parts the wanted ranks lie.  A second scan
    counts the values of these parts only.  What is found is ranked by the middle bits and then by
    the last ones, so no window sees more than 2^20 counts beyond the first part's; both scans reduce
    map-side, and a long tail or a mass of equal values costs no more than others.
    Matches ``percentile`` / ``quantile_cont``.  Eager.  Result: ``by`` + q0, q1, ...
    """
    keys = list(by) or ["_all"]
    value = F.col(column).cast("double")
    whole = df if by else df.withColumn("_all", F.lit(0))
    base = whole.filter(F.col(column).isNotNull()).select(*keys, value.alias("_v"))
    base = base.select(*keys, "_v", ordered_bits(F.col("_v")).alias("_k"))
    top = F.shiftright("_k", _TOP).alias("_top")
    counts = cut_lineage(base.groupBy(*keys, top).agg(F.count(F.lit(1)).alias("_n")))

    position = F.col("_p") * (F.col("_total") - 1)
    asked = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("_p")) for i, p in enumerate(probabilities)])
    ranks = counts.groupBy(*keys).agg(F.sum("_n").alias("_total")).select(*keys, "_total", F.explode(asked).alias("_a")).select(*keys, "_total", "_a._i", "_a._p")
    ends = F.array(F.struct(F.lit(0).alias("_end"), (F.floor(position) + 1).alias("_rank")), F.struct(F.lit(1).alias("_end"), (F.ceil(position) + 1).alias("_rank")))
    wanted = ranks.select(*keys, "_i", (position - F.floor(position)).alias("_f"), F.explode(ends).alias("_e")).select(*keys, "_i", "_f", "_e._end", "_e._rank")

    parts = cut_lineage(_holding(counts, wanted, keys, "_top"))
    small = broadcast_if_small(parts.select(*keys, "_top").distinct())  # two parts per group and probability at most
    inside = join_same(base.withColumn("_top", F.shiftright("_k", _TOP)), small, [*keys, "_top"])
    middle = F.shiftright("_k", _MIDDLE).alias("_middle")
    values = cut_lineage(inside.groupBy(*keys, "_top", middle, "_k").agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_v")))
    per_middle = values.groupBy(*keys, "_top", "_middle").agg(F.sum("_n").alias("_n"))
    found = _holding(per_middle, parts, [*keys, "_top"], "_middle")
    found = _holding(values.select(*keys, "_top", "_middle", F.struct("_k", "_v").alias("_kv"), "_n"), found, [*keys, "_top", "_middle"], "_kv")
    pairs = found.groupBy(*keys, "_i").agg(*[F.max(F.when(F.col("_end") == e, F.col("_kv._v"))).alias(f"_v{e}") for e in (0, 1)], F.max("_f").alias("_f"))
    between = F.when(F.col("_v0") == F.col("_v1"), F.col("_v0")).otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_f"))
    return pairs.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, between)).alias(f"q{i}") for i in range(len(probabilities))])


def _holding(counts: DataFrame, wanted: DataFrame, keys, part: str) -> DataFrame:
    """For each wanted rank the part of its group that holds it, and the rank inside that part."""
    order = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.select(*keys, part, "_n", F.sum("_n").over(order).alias("_upto"))
    both = join_same(upto, wanted, keys)
    before = F.col("_upto") - F.col("_n")
    held = both.filter((F.col("_rank") > before) & (F.col("_rank") <= F.col("_upto")))
    return held.select(*keys, part, "_i", "_f", "_end", (F.col("_rank") - before).alias("_rank"))


def join_same(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL, keeping the left keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


def pivot_sum(df: DataFrame, keys, column: str, values, measure: str, fill: int | None = 0) -> DataFrame:
    """Long to wide with listed values (no extra job to discover them).  ``values`` maps value -> column name."""
    names = values if isinstance(values, dict) else {v: v for v in values}
    columns = []
    for value, name in names.items():
        total = F.sum(F.when(F.col(column) == value, F.col(measure)))
        columns.append((F.coalesce(total, F.lit(fill)) if fill is not None else total).alias(name))
    return df.groupBy(*keys).agg(*columns)


def share_of_total(df: DataFrame, measure: str, alias: str, digits: int = 2) -> DataFrame:
    """Percentage of the grand total through a scalar subquery (no single-partition window)."""
    total = df.select(F.sum(measure).cast("double")).scalar()
    return df.withColumn(alias, F.round(F.try_divide(F.col(measure).cast("double") * 100.0, total), digits))


def share_of_group(df: DataFrame, by, measure: str, alias: str, digits: int = 2) -> DataFrame:
    """Percentage of the group total; ``df`` is an aggregate already."""
    total = F.sum(measure).over(Window.partitionBy(*by))
    return df.withColumn(alias, percent(F.col(measure), total, digits))


def crude_rate(df: DataFrame, population: DataFrame, key: str, measure: str, per: int = 100_000, digits: int = 2) -> DataFrame:
    """Events per ``per`` inhabitants of each key."""
    totals = df.groupBy(key).agg(F.sum(measure).alias(measure))
    rate = F.round(F.try_divide(F.col(measure).cast("double") * per, F.col("poblacion").cast("double")), digits)
    return totals.join(population.select(key, "poblacion"), key).withColumn("tasa", rate)
