"""Bronze layer: faithful, audited copies of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataframe.functions.naming import rename_all
from strataframe.operators.project import with_audit
from strataframe.sources.files import list_files, load_all, read_by_name
from strataframe.spec import SourceSpec


def ingest(spark: SparkSession, specs: list[SourceSpec], batch_id: str) -> dict[str, DataFrame]:
    """Every source with its audit columns, under its own name."""
    return {name: with_audit(df, batch_id, name) for name, df in load_all(spark, specs).items()}


def yearly_records(spark: SparkSession, folder: str, glob: str, schema: str | None = None) -> DataFrame:
    """Yearly files of one kind: storage-safe names, source file, load time.

    Files are united by column name: columns that only some years have are NULL elsewhere,
    whatever their order.  All columns are text unless ``schema`` types them by name.  An empty
    match is an error.
    """
    list_files(spark, folder, glob)
    named = read_by_name(spark, f"{folder.rstrip('/')}/{glob}")
    if schema:
        types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema).fields}
        named = named.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in named.columns])
    return rename_all(named, "storage").withColumn("bronze_processing_date", F.current_timestamp())
