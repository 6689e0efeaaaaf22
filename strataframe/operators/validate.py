"""Code validation, quarantine, referential audits, completeness and load monitoring."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.numeric import percent
from strataframe.operators.aggregate import approx_quantiles, exact_quantiles
from strataframe.operators.reshape import stack_tables
from strataframe.spec import CodeCheck, RowRule


class Validated(NamedTuple):
    """Lazy results that share one flagged scan."""

    kept: DataFrame
    rejects: DataFrame
    report: DataFrame


def _look_up(df: DataFrame, column: str, catalogue: DataFrame, code: str, name: str) -> DataFrame:
    """Add ``name``: the code found for ``column`` or NULL.  Codes are distinct, so no row multiplies.

    One left join that reads the rows once.  It carries no hint: the planner broadcasts small
    catalogues by their size on disk or by the bytes shuffled, and splits hot keys otherwise.
    """
    codes = catalogue.select(F.col(code).alias(name)).filter(F.col(name).isNotNull()).distinct()
    return df.join(codes, F.col(column) == F.col(name), "left")


def validate_codes(df: DataFrame, column: str, catalogue: DataFrame, code: str = "code", critical: bool = False):
    """(kept, rejects) for one column.

    Critical: rows with an unknown or missing code are dropped, and a code listed
    twice does not multiply rows.  Otherwise the code becomes NULL.
    """
    flagged = _look_up(df, column, catalogue, code, "_found")
    found = F.col("_found").isNotNull()
    rejects = flagged.filter(~found).select(*df.columns)
    if critical:
        return flagged.filter(found).select(*df.columns), rejects
    return flagged.select(*[F.when(found, F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns]), rejects


def validate_all(df: DataFrame, checks: list[CodeCheck], catalogues: dict[str, DataFrame]) -> Validated:
    """All checks, in order, over one scan with one flag per check.

    A check only sees the rows that earlier critical checks let through, and its
    report counts those rows.
    """
    missing = [c.column for c in checks if c.column not in df.columns]
    if missing:
        raise ValueError(f"checks name columns that are not there: {missing}")
    flagged = df
    for i, check in enumerate(checks):
        flagged = _look_up(flagged, check.column, catalogues[check.catalogue], check.code, f"_code{i}")
    flagged = flagged.select(
        *[F.col(c) for c in df.columns], *[F.col(f"_code{i}").isNotNull().alias(f"_ok{i}") for i in range(len(checks))]
    )

    def reached(i: int) -> Column:
        gates = [F.col(f"_ok{j}") for j in range(i) if checks[j].critical]
        return reduce(and_, gates, F.lit(True))

    failed = [reached(i) & ~F.col(f"_ok{i}") for i in range(len(checks))]
    nulled = {c.column: F.col(f"_ok{i}") for i, c in enumerate(checks) if not c.critical}
    kept = flagged.filter(reached(len(checks))).select(
        *[F.when(nulled[c], F.col(c)).alias(c) if c in nulled else F.col(c) for c in df.columns]
    )
    names = F.array_compact(F.array(*[F.when(bad, F.lit(check.column)) for check, bad in zip(checks, failed)]))
    rejects = flagged.withColumn("rejected_by", F.explode(names)).select(*df.columns, "rejected_by")
    counts = flagged.agg(
        *[F.count_if(reached(i)).alias(f"_seen{i}") for i in range(len(checks))],
        *[F.count_if(bad).alias(f"_bad{i}") for i, bad in enumerate(failed)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.critical).alias("critical"),
            F.col(f"_seen{i}").alias("checked_rows"),
            F.col(f"_bad{i}").alias("invalid_count"),
            F.coalesce(percent(F.col(f"_bad{i}"), F.col(f"_seen{i}")), F.lit(0.0)).alias("invalid_pct"),
        )
        for i, check in enumerate(checks)
    ])
    return Validated(kept, rejects, counts.select(F.inline(lines)))


def outlier_bounds(df: DataFrame, column: str, exact: bool = False, factor: float = 1.5) -> DataFrame:
    """One row (low, high) from the interquartile range."""
    quantiles = exact_quantiles if exact else approx_quantiles
    q = quantiles(df, column, (0.25, 0.75))
    spread = (F.col("q1") - F.col("q0")) * factor
    return q.select((F.col("q0") - spread).alias("low"), (F.col("q1") + spread).alias("high"))


def remove_outliers(df: DataFrame, column: str, exact: bool = False, factor: float = 1.5) -> DataFrame:
    """Keep NULL and values inside the interquartile fence.

    The bounds are a scalar subquery: no value travels through user code, and the
    sketch (error 0.01) is the default because it has bounded memory.
    """
    bounds = outlier_bounds(df, column, exact, factor)
    fence = bounds.select(F.struct("low", "high")).scalar()
    col = F.col(column)
    return df.filter(col.isNull() | col.between(fence["low"], fence["high"]))


def with_reasons(df: DataFrame, rules: list[RowRule], column: str = "reasons") -> DataFrame:
    """Add the names of the violated rules, in rule order, joined by commas ('' when valid)."""
    failures = [F.when(~F.coalesce(F.expr(r.predicate), F.lit(False)), r.name) for r in rules]
    return df.withColumn(column, F.concat_ws(",", *failures))


def quarantine(df: DataFrame, rules: list[RowRule]) -> tuple[DataFrame, DataFrame]:
    """(valid, errors); errors carry ``reasons``."""
    judged = with_reasons(df, rules)
    return judged.filter("reasons = ''").drop("reasons"), judged.filter("reasons <> ''")


def orphan_rows(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with a key no dimension row has; ``missing`` names those keys in order."""
    joined = fact
    for i, (key, dim) in enumerate(dimensions.items()):
        side = dim.select(F.col(key).alias(f"_k{i}")).distinct()
        joined = joined.join(side, F.col(key) == F.col(f"_k{i}"), "left")
    absent = [F.col(f"_k{i}").isNull() for i in range(len(dimensions))]
    missing = F.concat_ws(",", *[F.when(a, key) for a, key in zip(absent, dimensions)])
    return joined.filter(reduce(or_, absent)).select(*fact.columns, missing.alias("missing"))


def part_whole(parts: dict[str, DataFrame], whole: DataFrame, source: str = "fuente") -> DataFrame:
    """Row counts of the parts against the rows of the whole that carry their tag."""
    counted = stack_tables([df.agg(F.count(F.lit(1)).alias("part_rows")).withColumn(source, F.lit(n)) for n, df in parts.items()])
    total = whole.groupBy(source).agg(F.count(F.lit(1)).alias("whole_rows"))
    both = counted.join(total, source, "full_outer").fillna(0, ["part_rows", "whole_rows"])
    return both.select(source, "part_rows", "whole_rows", (F.col("whole_rows") - F.col("part_rows")).alias("difference"))


def completeness(fact: DataFrame, keys, month_key: str, measure: str, raw: DataFrame, raw_value: str) -> DataFrame:
    """One row: rows, share of complete keys, months covered, NaN values repaired upstream."""
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    head = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        percent(F.count_if(complete), F.count(F.lit(1))).alias("complete_key_pct"),
        F.countDistinct(month_key).alias("months_with_data"),
        F.sum(measure).alias("total"),
    )
    repaired = raw.select(F.count_if(F.isnan(raw_value) | F.col(raw_value).isNull())).scalar()
    return head.withColumn("repaired_values", repaired)


def audit_presence(tables: dict[str, DataFrame], required=("bronze_loaded_at", "bronze_batch_id", "bronze_source")) -> DataFrame:
    """Per table: row count and whether the audit columns exist."""
    lines = []
    for name, df in tables.items():
        missing = [c for c in required if c not in df.columns]
        lines.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count",
                F.lit(not missing).alias("audited"), F.lit(",".join(missing)).alias("missing_columns"),
            )
        )
    return stack_tables(lines)


def load_monitor(df: DataFrame, loaded_at: str, batch: str) -> DataFrame:
    """Rows per load day and batch."""
    return df.groupBy(F.to_date(loaded_at).alias("load_date"), F.col(batch).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("new_rows")
    )


def load_alerts(monitor: DataFrame, fall: float = 0.5) -> DataFrame:
    """Every calendar day between first and last load, flagged when empty or sharply down.

    ``fall`` is the lost share against the previous day that raises an alert.
    The window runs over one row per calendar day.
    """
    daily = monitor.groupBy("load_date").agg(F.sum("new_rows").alias("new_rows"))
    span = daily.agg(F.min("load_date").alias("a"), F.max("load_date").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("load_date"))
    filled = calendar.join(daily, "load_date", "left").select("load_date", F.coalesce("new_rows", F.lit(0)).alias("new_rows"))
    before = F.lag("new_rows").over(Window.orderBy("load_date"))
    alert = (
        F.when(F.col("new_rows") == 0, "empty")
        .when(F.col("new_rows") < F.col("previous_rows") * (1.0 - fall), "fall")
        .otherwise("ok")
    )
    return filled.withColumn("previous_rows", before).withColumn("alert", alert)


def source_gap(fact: DataFrame, by, first: str, second: str, measure: str = "cantidad_fallecidos", source: str = "fuente") -> DataFrame:
    """Totals of two sources side by side with difference and percentage of the first."""
    tag = F.col(source)
    sums = fact.filter(tag.isin(first, second)).groupBy(*by).agg(
        F.coalesce(F.sum(F.when(tag == first, F.col(measure))), F.lit(0)).alias("first_total"),
        F.coalesce(F.sum(F.when(tag == second, F.col(measure))), F.lit(0)).alias("second_total"),
    )
    gap = F.col("second_total") - F.col("first_total")
    return sums.withColumn("difference", gap).withColumn("difference_pct", percent(gap, F.col("first_total")))


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: column count, row count and the column types."""
    return stack_tables([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("column_count"), "row_count",
            F.lit(", ".join(f"{n} {t}" for n, t in df.dtypes)).alias("column_types"),
        )
        for name, df in tables.items()
    ])
