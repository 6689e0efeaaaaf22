"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the operators rely on at scale.  Only runtime-settable SQL options,
# so they can be applied to a session somebody else has built.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs the following aggregate a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


_APPLIED = "strataframe.settings.applied"


def build_session(app_name: str = "strataframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the scale settings; cluster values come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    """Apply the scale settings to a running session."""
    if spark.conf.get(_APPLIED, None) != "true":
        for key, value in {**SCALE_SETTINGS, _APPLIED: "true"}.items():
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    on a cluster a missing setting is an error, since a machine-local folder
    would be lost with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="strataframe-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


_FOLDERS: ContextVar[list[str] | None] = ContextVar("strataframe_folders", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (noted := _FOLDERS.get()) is not None:
        noted.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies; a missing one is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Folders that ``scratch_path`` names inside the block go when it ends, also on failure."""
    noted: list[str] = []
    token = _FOLDERS.set(noted)
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        for path in noted:
            remove_folder(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of the executors that made them."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def is_small(df: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 << 20) -> bool:
    """Whether a table fits a broadcast.  Eager: one aggregate counts its rows and bytes.

    Arrays, maps and structs count with the length of their JSON text.  No limit is used: every
    task would fetch that many rows before a single task could stop.
    """
    size = F.lit(0)
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            width = F.octet_length(column)
        else:
            width = F.octet_length(F.to_json(F.struct(column))) if kind in ("array", "map", "struct") else F.lit(16)
        size = size + F.coalesce(width, F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring the table; otherwise leave the join to shuffle."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
