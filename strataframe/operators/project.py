"""Audit columns, typed casts, schema repair and final projections."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that stay out of published tables.
TECHNICAL_COLUMNS = (
    "bronze_loaded_at", "bronze_batch_id", "bronze_source", "bronze_processing_date",
    "silver_processing_date", "silver_processed_at", "metadata_processed_at",
)


def new_batch_id() -> str:
    """One id per run; pass the same id to every table of that run."""
    return uuid.uuid4().hex


def with_audit(df: DataFrame, batch_id: str, source: str, loaded_at: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "bronze_loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
            "bronze_batch_id": F.lit(batch_id),
            "bronze_source": F.lit(source),
        }
    )


def with_processing_stamp(df: DataFrame, column: str = "silver_processing_date") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def without_technical(df: DataFrame, *extra: str) -> DataFrame:
    return df.drop(*TECHNICAL_COLUMNS, *extra)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the columns that exist; values that do not fit become NULL."""
    from strataframe.functions.numeric import nan_to_null

    kinds = dict(df.dtypes)
    whole = ("tinyint", "smallint", "int", "bigint", "byte", "short", "integer", "long")
    casts = {}
    for name, target in types.items():
        if name not in kinds:
            continue
        source = F.col(f"`{name}`")
        if kinds[name] in ("double", "float") and target in whole:
            source = nan_to_null(source)
        casts[name] = source.try_cast(target)
    return df.withColumns(casts) if casts else df


def add_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add each absent column as a typed NULL."""
    absent = {n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename what exists; absent columns are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def repair_header(df: DataFrame, names, types: dict[str, str], keep_header_row: bool = True) -> DataFrame:
    """Rename and retype a table whose first data row was taken for the header.

    ``keep_header_row`` gives that row back, rebuilt from the column names.
    Names are lower-cased text by then, so the row is only as good as they are.
    """
    fixed = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns[: len(names)]]).toDF(*names)
    if keep_header_row:
        row = [F.lit(c).alias(n) for c, n in zip(df.columns, names)]
        fixed = fixed.unionByName(df.sparkSession.range(1).select(*row))
    return cast_columns(fixed, types)
