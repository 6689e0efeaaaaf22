"""Unpivots, schema harmonisation, set operations and deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.calendar import MONTH_COLUMNS, first_of_month, month_number
from strataframe.operators.project import add_missing, cast_columns, rename_present


def harmonise(df: DataFrame, patch, types: dict[str, str]) -> DataFrame:
    """Bring one drifting table to the common schema: rename, constants, casts, missing columns, order."""
    fixed = rename_present(df, patch.rename)
    if patch.constants:
        fixed = fixed.withColumns({name: F.lit(value) for name, value in patch.constants.items()})
    fixed = add_missing(cast_columns(fixed, types), types)
    return fixed.select(*types)


def stack_tables(frames, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def months_to_rows(df: DataFrame, ids=("anio", "evento"), keep_missing: bool = False) -> DataFrame:
    """Twelve month columns to one row per month; months without data vanish unless kept."""
    long = df.unpivot(list(ids), list(MONTH_COLUMNS), "mes_nombre", "cantidad")
    if not keep_missing:
        long = long.filter(F.col("cantidad").isNotNull())
    long = long.withColumn("mes_numero", month_number(F.col("mes_nombre")))
    return long.withColumn("fecha", first_of_month(F.col("anio"), F.col("mes_numero")))


def stack_expression(columns, variable: str, value: str) -> str:
    """The ``stack`` generator call equivalent to an unpivot."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return f"stack({len(columns)}, {pairs}) as ({variable}, {value})"


def unpivot_by_stack(df: DataFrame, ids, columns, variable: str, value: str) -> DataFrame:
    return df.selectExpr(*ids, stack_expression(columns, variable, value))


def unpivot_by_sql(df: DataFrame, ids, columns, variable: str, value: str) -> DataFrame:
    """SQL UNPIVOT clause; drops NULL values."""
    names = ", ".join(f"`{c}`" for c in columns)
    keep = ", ".join([*ids, *columns])
    return df.sparkSession.sql(
        f"SELECT * FROM (SELECT {keep} FROM {{src}}) UNPIVOT ({value} FOR {variable} IN ({names}))", src=df
    )


def months_to_columns(df: DataFrame, ids=("anio", "evento"), measure: str = "cantidad") -> DataFrame:
    """Inverse of :func:`months_to_rows`; a month without rows is NULL."""
    sums = [F.sum(F.when(F.col("mes_numero") == i, F.col(measure))).alias(c) for i, c in enumerate(MONTH_COLUMNS, 1)]
    return df.groupBy(*ids).agg(*sums)


def overlap_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct values shared by each pair of one-column tables.

    Each table is reduced to its distinct values once; one shuffle by value then
    serves every pair.
    """
    names = list(tables)
    tagged = stack_tables(
        [df.toDF("_v").filter(F.col("_v").isNotNull()).distinct().withColumn("_t", F.lit(i)) for i, df in enumerate(tables.values())]
    )
    members = tagged.groupBy("_v").agg(*[F.max((F.col("_t") == i).cast("int")).alias(f"_m{i}") for i in range(len(names))])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    sums = members.agg(*[F.coalesce(F.sum(F.col(f"_m{i}") * F.col(f"_m{j}")), F.lit(0)).alias(f"p{i}_{j}") for i, j in pairs])
    rows = F.array(*[
        F.struct(F.lit(names[i]).alias("left_set"), F.lit(names[j]).alias("right_set"), F.col(f"p{i}_{j}").alias("shared"))
        for i, j in pairs
    ])
    return sums.select(F.inline(rows))


def first_by(df: DataFrame, key, order_by) -> DataFrame:
    """One row per key: the least by ``order_by`` then by all other columns.

    An aggregate, not a window: a key with very many copies is reduced map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    least = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_row")
    picked = df.groupBy(*keys).agg(least)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def merge_equivalent(df: DataFrame, keys: dict, measure: str) -> DataFrame:
    """Semantic duplicates: rows whose normalised keys agree become one, measures add up."""
    return df.groupBy(*[expr.alias(name) for name, expr in keys.items()]).agg(F.sum(measure).alias(measure))
