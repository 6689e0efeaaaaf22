"""Catalogue tables, relational sources, table listings and generated rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataframe.spec import TableSpec


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A few in-memory rows as a local relation: no Python worker, and joins see its real size."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return spark.createDataFrame(pa.table({f.name: list(c) for f, c in zip(fields, columns)}), schema=fields)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def jdbc_options(url: str, table: str | None = None, query: str | None = None, driver: str | None = None,
                 partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 16,
                 fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of a parallel JDBC read.

    A partition column with bounds splits the read into ``partitions`` range
    queries; without one the whole table would come through a single task.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    if query is not None and partition_column is not None:
        # range predicates need a table expression
        table, query = f"({query}) AS src", None
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    options |= {"dbtable": table} if table is not None else {"query": query}
    if driver:
        options["driver"] = driver
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()


def base_tables_query(schema: str) -> str:
    """Subquery a relational source answers with its base tables."""
    quoted = schema.replace("'", "''")
    return (
        "SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{quoted}' AND table_type = 'BASE TABLE'"
    )


def read_first_available(*attempts) -> DataFrame:
    """The first source that resolves: e.g. a federated table, then JDBC."""
    problems = []
    for attempt in attempts:
        try:
            return attempt()
        except Exception as problem:  # whatever a connector raises, the next one gets its chance
            problems.append(f"{type(problem).__name__}: {problem}")
    raise RuntimeError("no source could be read:\n" + "\n".join(problems))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.catalog, ".".join(t.namespace or []), t.name, t.isTemporary) for t in spark.catalog.listTables(database)]
    return literal_rows(spark, rows, "catalog string, namespace string, name string, temporary boolean")


def list_databases(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, [(d.name,) for d in spark.catalog.listDatabases()], "name string")


def describe_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with comment, properties and columns, as the catalogue has them; reads no rows."""
    rows = []
    for t in spark.catalog.listTables(database):
        name = f"{database}.{t.name}"
        own = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        columns = ",".join(c.name for c in spark.catalog.listColumns(name))
        rows.append((t.name, t.description, ",".join(f"{k}={v}" for k, v in sorted(own.items()) if not k.startswith("transient")), columns))
    return literal_rows(spark, rows, "name string, comment string, properties string, columns string")


def column_catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: dataset, ordinal, name, type and comment.  Reads schemas, no rows."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for name, df in sorted(tables.items())
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return literal_rows(spark, rows, "dataset string, ordinal int, column_name string, data_type string, comment string")


def metadata_records(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    rows = [(i, s.name, s.format, s.owner, s.updated, s.rule, s.available) for i, s in enumerate(specs, start=1)]
    return literal_rows(
        spark, rows, "id int, name string, format string, owner string, updated string, rule string, available boolean"
    )


def month_rows(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Every year of the range with each of its twelve months: (anio, mes)."""
    twelve = F.sequence(F.lit(1).cast("long"), F.lit(12).cast("long"))
    return spark.range(first_year, last_year + 1).select(F.col("id").alias("anio"), F.explode(twelve).alias("mes"))
