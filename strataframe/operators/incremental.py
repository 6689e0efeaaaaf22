"""High-water marks, upserts, snapshot differences and dimension history."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, column: str, default=0):
    """The greatest value loaded so far (eager: one value), or ``default`` for an empty table."""
    value = target.agg(F.max(column)).first()[0]
    return default if value is None else value


def rows_above(source: DataFrame, column: str, mark) -> DataFrame:
    """Rows past the mark.  The mark is a literal, so it prunes files and row groups at the scan."""
    return source if mark is None else source.filter(F.col(column) > F.lit(mark))


def upsert(target: DataFrame, source: DataFrame, key, newest_by=None) -> DataFrame:
    """Matched rows replaced, unmatched rows inserted.  Write the result to a new path.

    ``newest_by`` keeps one source row per key (the greatest); without it the
    source must hold each key once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if newest_by is not None:
        rest = [c for c in source.columns if c not in keys]
        ordered = [newest_by, *[c for c in rest if c != newest_by]]
        top = source.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_row"))
        source = top.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns])
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Change feed between two snapshots: insert, update and delete rows (values after the change,
    for deletes before it).  Compares the values themselves, not a hash of them."""
    attributes = [c for c in new.columns if c != key]
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    changed = reduce(or_, [~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in attributes])
    kind = (
        F.when(F.col(f"a.{key}").isNull(), "insert")
        .when(F.col(f"b.{key}").isNull(), "delete")
        .when(changed, "update")
    )
    gone = F.col(f"b.{key}").isNull()
    values = [F.when(gone, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in new.columns]
    return joined.select(kind.alias("change_type"), *values).filter(F.col("change_type").isNotNull())


OPEN_END = "9999-12-31"


def open_history(snapshot: DataFrame, valid_from: str) -> DataFrame:
    """First version of every member."""
    return snapshot.withColumns(
        {"valid_from": F.lit(valid_from), "valid_to": F.lit(OPEN_END), "is_current": F.lit(True)}
    )


def apply_history(history: DataFrame, snapshot: DataFrame, key: str, as_of: str) -> DataFrame:
    """Type-2 history after a new catalogue snapshot.

    Changed members close their current version at ``as_of`` and open a new one;
    members missing from the snapshot close; closed versions are untouched.
    """
    attributes = [c for c in snapshot.columns if c != key]
    closed = history.filter(~F.col("is_current"))
    a, b = history.filter("is_current").alias("a"), snapshot.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    known, seen = F.col(f"a.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    changed = reduce(or_, [~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in attributes], F.lit(False))
    ends = known & (~seen | changed)
    starts = seen & (~known | changed)
    old_row = F.struct(
        F.col(f"a.{key}").alias(key),
        *[F.col(f"a.{c}").alias(c) for c in attributes],
        F.col("a.valid_from").alias("valid_from"),
        F.when(ends, F.lit(as_of)).otherwise(F.col("a.valid_to")).alias("valid_to"),
        (~ends).alias("is_current"),
    )
    new_row = F.struct(
        F.col(f"b.{key}").alias(key),
        *[F.col(f"b.{c}").alias(c) for c in attributes],
        F.lit(as_of).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    versions = F.filter(F.array(F.when(known, old_row), F.when(starts, new_row)), lambda v: v.isNotNull())
    rows = joined.select(F.explode(versions).alias("_v")).select("_v.*")
    return closed.select(*rows.columns).unionByName(rows)
