"""Generalisation, suppression, noise and re-identification reports.

Suppression works on cells (one row per combination of published attributes).
However many raw rows share a key, a cell is one row, so the windows below see
at most as many rows per group as the published categories allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.functions.calendar import month_key_of
from strataframe.functions.classify import five_year_group
from strataframe.functions.numeric import percent, stable_gaussian
from strataframe.operators.aggregate import exact_quantiles, join_same
from strataframe.session import cut_lineage
from strataframe.sources.tables import literal_rows
from strataframe.spec import PrivacyPolicy

# Thresholds of the written policy.
MIN_CELL = 5
MIN_GROUP = 10
MIN_RARE_PER_YEAR = 10
MIN_INHABITANTS = 10_000
ADULT_AGE = 18
OTHERS = "Otros"

# The treated columns of the sensitive tables.
POLICIES = {
    "inacif_necropsias": PrivacyPolicy(
        "inacif_necropsias", "high", drop=("numero_correlativo", "dia"), age_groups=("edad",)
    ),
    "ine_deaths": PrivacyPolicy("ine_deaths", "high", drop=("diaocu",), age_groups=("edadif",)),
}


def policy_catalogue(spark: SparkSession, policies: dict[str, PrivacyPolicy] = POLICIES) -> DataFrame:
    """One row per table and treated column: sensitivity and action."""
    rows = []
    for p in policies.values():
        actions = [("drop", p.drop), ("month", p.months), ("age group", p.age_groups), ("national for minors", p.minors[1:2])]
        actions += [(f"{r.name}: {r.parent} below {r.minimum}", (r.detail,)) for r in p.rollups]
        actions += [(f"{p.places[1]} below {p.places[2]} inhabitants", p.places[:1])] if p.places else []
        actions += [(f"others below {p.others[1]}", p.others[:1])] if p.others else []
        rows += [(p.table, p.sensitivity, column, action) for action, columns in actions for column in columns]
    return literal_rows(spark, rows, "table_name string, sensitivity string, column_name string, action string")


def apply_policy(df: DataFrame, policy: PrivacyPolicy) -> DataFrame:
    """Drop identifiers, cut dates to months and ages to five-year groups."""
    safe = df.drop(*policy.drop)
    changes = {c: month_key_of(F.col(c)) for c in policy.months if c in safe.columns}
    changes |= {c: five_year_group(F.col(c).try_cast("int")) for c in policy.age_groups if c in safe.columns}
    return safe.withColumns(changes) if changes else safe


def cells(df: DataFrame, *keys: str, measure: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))


def merge_small_cells(table: DataFrame, within, category: str, measure: str = "n", minimum: int = MIN_CELL, others: str = OTHERS) -> DataFrame:
    """Cells below ``minimum`` move to one "others" cell of their group.

    When that cell would still be small, it is suppressed together with the next
    smallest cell, so that a published group total gives neither away.  Suppressed
    cells keep their row with a NULL measure and ``suppressed`` = true.  ``total_exposed`` marks
    a suppressed cell that is alone in its group: there the group total must stay unpublished.
    """
    small = F.col(measure) < minimum
    group = Window.partitionBy(*within)
    by_size = Window.partitionBy(*within, small).orderBy(measure, category)
    judged = table.withColumns({
        "_small": small,
        "_pool": F.coalesce(F.sum(F.when(small, F.col(measure))).over(group), F.lit(0)),
        "_rank": F.row_number().over(by_size),
    })
    exposed = (F.col("_pool") > 0) & (F.col("_pool") < minimum)
    hide = exposed & (F.col("_small") | (F.col("_rank") == 1))
    label = F.when(F.col("_small"), others).otherwise(F.col(category))
    judged = judged.select(*within, label.alias(category), measure, hide.alias("_hide"))
    merged = judged.groupBy(*within, category).agg(F.sum(measure).alias(measure), F.max("_hide").alias("suppressed"))
    alone = F.count(F.lit(1)).over(group) == 1
    return merged.withColumns({measure: F.when(~F.col("suppressed"), F.col(measure)), "total_exposed": F.col("suppressed") & alone})


def complementary_suppression(table: DataFrame, row: str, column: str, measure: str = "n", minimum: int = MIN_CELL) -> DataFrame:
    """Two-way table in which no suppressed cell follows from a row or column total.

    A line with exactly one hidden cell gets its smallest visible cell hidden as
    well, alternately for rows and columns, until no line is left (each pass hides
    at least one cell more, so this ends).  Eager: the state is checkpointed per
    pass.  ``total_exposed`` marks cells that are alone in a line: there the line
    total itself must stay unpublished.
    """
    state = cut_lineage(table.select(row, column, measure, (F.col(measure) < minimum).alias("_hidden")))
    while True:
        for line, other in ((row, column), (column, row)):
            state = _hide_next(state, line, other, measure)
        state = cut_lineage(state)
        exposed = [state.groupBy(line).agg(F.count_if("_hidden").alias("_h"), F.count(F.lit(1)).alias("_c")).filter("_h = 1 and _c > 1")
                   for line in (row, column)]
        if exposed[0].isEmpty() and exposed[1].isEmpty():
            break
    alone = (F.count(F.lit(1)).over(Window.partitionBy(row)) == 1) | (F.count(F.lit(1)).over(Window.partitionBy(column)) == 1)
    return state.select(
        row, column,
        F.when(~F.col("_hidden"), F.col(measure)).alias(measure),
        F.col("_hidden").alias("suppressed"),
        (F.col("_hidden") & alone).alias("total_exposed"),
    )


def _hide_next(state: DataFrame, line: str, other: str, measure: str) -> DataFrame:
    hidden = F.count_if("_hidden").over(Window.partitionBy(line))
    rank = F.row_number().over(Window.partitionBy(line, "_hidden").orderBy(measure, other))
    return (
        state.withColumns({"_h": hidden, "_r": rank})
        .withColumn("_hidden", F.col("_hidden") | ((F.col("_h") == 1) & (F.col("_r") == 1)))
        .drop("_h", "_r")
    )


def rare_to_parent(table: DataFrame, scope, detail: str, parent: str, measure: str = "n", minimum: int = MIN_RARE_PER_YEAR) -> DataFrame:
    """A detail with fewer than ``minimum`` events in its scope takes its parent's label."""
    keys = [c for c in table.columns if c not in (detail, parent, measure)]
    total = F.sum(measure).over(Window.partitionBy(*scope, detail))
    label = F.when(F.col("_t") < minimum, F.col(parent)).otherwise(F.col(detail))
    relabelled = table.withColumn("_t", total).withColumn(detail, label)
    return relabelled.groupBy(*keys, detail).agg(F.sum(measure).alias(measure))


def small_place_to_parent(table: DataFrame, population: DataFrame, place: str, parent: str, measure: str = "n", minimum: int = MIN_INHABITANTS) -> DataFrame:
    """Places below ``minimum`` inhabitants (or of unknown size) report under their parent."""
    people = population.select(place, "poblacion")
    keys = [c for c in table.columns if c not in (place, parent, measure)]
    big = F.coalesce(F.col("poblacion") >= minimum, F.lit(False))
    joined = table.join(people, place, "left").withColumn(place, F.when(big, F.col(place)).otherwise(F.col(parent)))
    return joined.groupBy(*keys, place).agg(F.sum(measure).alias(measure))


def minors_national(df: DataFrame, age: str, place: str, national_key: str) -> DataFrame:
    """Rows about minors lose their place; unknown ages are treated as minors."""
    adult = F.coalesce(F.col(age) >= ADULT_AGE, F.lit(False))
    return df.withColumn(place, F.when(adult, F.col(place)).otherwise(F.lit(national_key)))


def merge_to_parent(table: DataFrame, detail: str, parent: str, measure: str = "n", minimum: int = MIN_GROUP) -> DataFrame:
    """Groups below ``minimum`` are published under their parent category."""
    keys = [c for c in table.columns if c not in (detail, parent, measure)]
    label = F.when(F.col(measure) < minimum, F.col(parent)).otherwise(F.col(detail))
    return table.withColumn(detail, label).groupBy(*keys, detail).agg(F.sum(measure).alias(measure))


def add_noise(df: DataFrame, column: str, key, sigma: float, seed: int = 0) -> DataFrame:
    """Gaussian noise that depends on row key and seed only, never on partitioning."""
    parts = [F.col(k) for k in ([key] if isinstance(key, str) else key)]
    return df.withColumn(column, F.col(column) + F.lit(sigma) * stable_gaussian(*parts, seed=seed))


def k_anonymity(df: DataFrame, quasi_identifiers, k: int = MIN_CELL) -> DataFrame:
    """One row: classes, smallest class, rows and share in classes below k, unique rows."""
    sizes = cells(df, *quasi_identifiers, measure="_n")
    at_risk = F.coalesce(F.sum(F.when(F.col("_n") < k, F.col("_n"))), F.lit(0))
    return sizes.agg(
        F.count(F.lit(1)).alias("classes"),
        F.min("_n").alias("smallest_class"),
        F.sum("_n").alias("total_rows"),
        at_risk.alias("rows_at_risk"),
        percent(at_risk, F.sum("_n"), 4).alias("risk_pct"),
        F.count_if(F.col("_n") == 1).alias("unique_rows"),
    )


def release_statistics(df: DataFrame, by, measure: str, minimum: int = MIN_GROUP, digits: int = 2) -> DataFrame:
    """The statistics a release may contain, for groups of at least ``minimum`` rows only."""
    value = F.col(measure)
    stats = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.round(F.sum(value), digits).alias("total"),
        F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("stddev"),
        F.round(F.var_samp(value), digits).alias("variance"),
    ).filter(F.col("n") >= minimum)
    median = exact_quantiles(df, measure, (0.5,), by=by).withColumn("median", F.round("q0", digits))
    return join_same(stats, median.select(*by, "median"), by)
