"""A folder whose loads are committed by one small file each, so that a load is there whole or not at all.

``data/batch=<name>`` holds a load's rows and ``ledger/<name>`` its single-row entry: the mark up to
which the source was read, the number of rows and the loads that it replaces.  Readers take the
loads that the ledger names.  A run that dies between data and entry leaves rows that nobody
reads, and its repetition overwrites them; a load that is already entered does nothing.

One writer at a time: the entry is renamed into place by Spark's committer, which file systems do
in one step, but two writers would not see each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataframe.operators.incremental import high_water_mark, rows_above
from strataframe.streaming.arrival import upsert_available

FIRST = "created"


class Entry(NamedTuple):
    """One load as the ledger has it."""

    place: int
    name: str
    mark: object
    rows: int
    replaces: list


class Ledger:
    """Loads of rows of one schema below ``root``; ``mark`` is the column whose greatest value a load remembers."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str, mark: str | None = None):
        self.spark, self.root, self.mark = spark, root.rstrip("/"), mark
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kind = self.schema[mark].dataType.simpleString() if mark else "string"
        self.entry_schema = f"place long, name string, mark {kind}, rows long, replaces array<string>"

    def create(self) -> Ledger:
        """An empty ledger; nothing happens if there is one."""
        try:
            self.entries()
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            self._enter(Entry(0, FIRST, None, 0, []))
        return self

    def entries(self) -> list[Entry]:
        """All loads in the order they were entered; one row per load comes to the driver."""
        found = self.spark.read.schema(self.entry_schema).parquet(f"{self.root}/ledger/*").orderBy("place").collect()
        return [Entry(*r) for r in found]

    def live(self) -> list[Entry]:
        """The loads that make up the table."""
        entries = self.entries()
        gone = {name for e in entries for name in e.replaces}
        return [e for e in entries if e.name not in gone and e.name != FIRST]

    def last_mark(self):
        """The greatest value that was committed, or None."""
        return max((e.mark for e in self.entries() if e.mark is not None), default=None)

    def read(self) -> DataFrame:
        """The rows of all live loads, with ``batch``, the place of their load."""
        live = self.live()
        if not live:
            return self.spark.createDataFrame([], self.schema).withColumn("batch", F.lit(0).cast("long"))
        reader = self.spark.read.schema(self.schema)
        parts = [reader.parquet(f"{self.root}/data/batch={e.name}").withColumn("batch", F.lit(e.place).cast("long")) for e in live]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def load(self, name: str, rows: DataFrame, replaces: tuple = ()) -> bool:
        """Write ``rows`` as load ``name`` and enter it; False if it is entered already.

        The mark is that of the rows as stored, or the one before if there are none.
        """
        entries = self.entries()
        if any(e.name == name for e in entries):
            return False
        self._store(name, rows)
        stored = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/batch={name}")
        before = self.last_mark() if self.mark else None
        mark = high_water_mark(stored, self.mark, before) if self.mark else None
        if before is not None and mark < before:
            mark = before
        self._enter(Entry(entries[-1].place + 1, name, mark, stored.count(), list(replaces)))
        return True

    def append_new(self, name: str, source: DataFrame) -> bool:
        """Load the rows of ``source`` past the committed mark.  The mark is a literal, so it prunes the scan."""
        return self.load(name, rows_above(source, self.mark, self.last_mark()))

    def _store(self, name: str, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/data/batch={name}")

    def _enter(self, entry: Entry) -> None:
        one = self.spark.createDataFrame([entry], self.entry_schema)
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/{entry.name}")


class UpsertLog:
    """Keyed rows kept as a ledger of changes: a load costs what changed, and the newest row of a key counts.

    Of equal ``newest_by`` the later load counts, inside a load the greater row.
    """

    def __init__(self, ledger: Ledger, key, newest_by: str):
        self.ledger, self.keys, self.newest_by = ledger, [key] if isinstance(key, str) else list(key), newest_by

    def current(self) -> DataFrame:
        """One row per key: an aggregate with map-side reduction over the live loads."""
        names = self.ledger.schema.names
        rest = [c for c in names if c not in (*self.keys, self.newest_by)]
        newest = F.max(F.struct(self.newest_by, "batch", *rest)).alias("_row")
        top = self.ledger.read().groupBy(*self.keys).agg(newest)
        return top.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in names])

    def upsert(self, name: str, rows: DataFrame) -> bool:
        return self.ledger.load(name, rows)

    def compact(self, name: str) -> bool:
        """Fold all live loads into one, which replaces them by its entry; a crash before leaves them as they are."""
        old = tuple(e.name for e in self.ledger.live())
        return self.ledger.load(name, self.current(), old) if len(old) > 1 else False


def upsert_stream(stream: DataFrame, log: UpsertLog, checkpoint: str, after: Callable[[str], None] | None = None) -> None:
    """Take every micro-batch that has arrived into ``log``, each once.

    A batch's name comes from the checkpoint folder and its number, so a batch that is replayed
    after a crash finds its entry and changes nothing.  A new stream needs a new checkpoint folder.
    """
    mark = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def take(batch: DataFrame, number: int) -> None:
        log.upsert(f"{mark}-{number}", batch)
        if after:
            after(f"{mark}-{number}")

    upsert_available(stream, checkpoint, take)
