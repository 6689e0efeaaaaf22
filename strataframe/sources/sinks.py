"""Table writers, exports and post-load reconciliation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators.reshape import stack_tables

GOLD_TABLES = (
    "dim_tiempo", "dim_geografia", "dim_perfil", "dim_causa_muerte", "fact_mortalidad_unificada", "fact_contexto_renap",
)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full, idempotent refresh.  Rows are not sorted: a stored table gives no order anyway."""
    df.write.mode("overwrite").format(fmt).save(path)


def overwrite_table(df: DataFrame, name: str, comment: str | None = None, properties: dict | None = None) -> None:
    """Replace a catalogue table, its schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    describe_table(df.sparkSession, name, comment, properties)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet written with drifting schemas, read with the union of its columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Partitioned layout (by source file, by year ...).

    Rows are brought together by value, and the planner splits a value by its bytes: a value
    with a third of all rows is as many tasks' work as its size asks for.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def describe_table(spark: SparkSession, name: str, comment: str | None = None, properties: dict | None = None) -> None:
    if comment is not None:
        text = comment.replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def export_sorted_csv(df: DataFrame, path: str, *keys: str) -> None:
    """Header CSV in key order across part files.

    The other columns break ties and the row's place breaks the rest, so that the
    range sort can split a hot key and even a mass of equal rows.
    """
    rest = [c for c in df.columns if c not in keys]
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    ordered = placed.orderBy(*keys, *rest, "_place").drop("_place")
    ordered.write.mode("overwrite").option("header", True).csv(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table, one line each, for reconciliation after a load."""
    return stack_tables([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def write_gold(star, folder: str) -> None:
    """Store the six tables of a star below ``folder``; the fact by source, which most questions filter on.

    The tables do not depend on each other, so their jobs run side by side.
    """

    def store(name: str) -> None:
        writer = getattr(star, name).write.mode("overwrite")
        if name == "fact_mortalidad_unificada":
            writer = writer.partitionBy("fuente")
        writer.parquet(f"{folder}/{name}")

    with ThreadPoolExecutor(len(GOLD_TABLES)) as pool:
        list(pool.map(store, GOLD_TABLES))


def read_gold(spark: SparkSession, folder: str, schemas: dict | None = None):
    """The stored star.  Known schemas spare one inference job per table."""
    from strataframe.plans.star import Star

    tables = {}
    for name in GOLD_TABLES:
        reader = spark.read if schemas is None else spark.read.schema(schemas[name])
        tables[name] = reader.parquet(f"{folder}/{name}")
    return Star(**tables)
