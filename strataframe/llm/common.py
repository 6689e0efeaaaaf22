"""What the operators share: tables, words of a text, staging."""

from __future__ import annotations

from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.session import apply_scale_settings, remove_folder, scratch_path

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_scale_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")  # long texts must not pile up in one batch
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPES: ContextVar[tuple[dict, ...]] = ContextVar("strataframe_scratch", default=())


class scratch:  # noqa: N801
    """What is staged inside lives no longer than this block, whether it ends well or not; ``keep`` hands a table on.

    Only for operators whose result reads nothing else that was staged inside.
    """

    def __enter__(self) -> scratch:
        self.own: dict[str, SparkSession] = {}
        self.token = _SCOPES.set((*_SCOPES.get(), self.own))
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        path = getattr(df, "_scratch_path", None)
        spark, outer = self.own.pop(path, None), _SCOPES.get()[:-1]
        if spark is not None and outer:
            outer[-1][path] = spark
        return df

    def __exit__(self, *_) -> None:
        _SCOPES.reset(self.token)
        for path, spark in self.own.items():
            remove_folder(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later passes neither repeat the work nor its choices."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    if scopes := _SCOPES.get():
        scopes[-1][path] = spark
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the shuffles below it serve nothing else
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held._scratch_path = path
    return held


def drop_staged(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more, so the shared folder holds only what is needed."""
    for df in tables:
        for scope in _SCOPES.get():
            scope.pop(df._scratch_path, None)
        remove_folder(df.sparkSession, df._scratch_path)


def content_key(*columns: str) -> Column:
    """A 128-bit fingerprint of a row's values, which tells null from empty; what depends on these alone is joined by it."""
    return F.md5(F.concat_ws("\x00", *[F.coalesce(F.concat(F.lit("="), F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]))


def words_of(text: Column) -> Column:
    """The words between ASCII white space, in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


class WordHashes(dict):
    """64-bit hashes of words; forgets them when it holds ``limit``, so a worker's memory stays bounded."""

    def __init__(self, limit: int = 200_000, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads small differences over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """A hash of every run of ``width`` hashes that lie ``step`` places apart."""
    n = len(words) - step * (width - 1)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mixed(out + words[i * step : i * step + n] + np.uint64(i + 1))
    return out


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""
