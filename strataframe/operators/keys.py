"""Surrogate keys and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.session import cut_lineage

UNKNOWN_KEY = -1


def dense_keys(df: DataFrame, columns, key: str, checkpoint: bool = True) -> DataFrame:
    """Distinct members numbered 1, 2, ... in sort order, without a single-task sort.

    A range sort spreads the members; each row knows its partition and its place
    in it, and only one count per partition is accumulated.  The sorted rows are
    checkpointed so that a re-run of a lost task cannot move them.
    """
    members = df.select(*columns).distinct().orderBy(*columns)
    placed = members.withColumn("_place", F.monotonically_increasing_id())
    if checkpoint:
        placed = cut_lineage(placed)
    # the id packs the partition number above 33 bits of row position
    placed = placed.withColumn("_part", F.shiftright("_place", 33)).withColumn("_row", F.col("_place") - F.shiftleft("_part", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row per sort partition
    return placed.join(F.broadcast(offsets), "_part").select(*columns, (F.col("_before") + F.col("_row") + 1).alias(key))


def hash_keys(df: DataFrame, columns, key: str, bits: int = 64, rounds: int = 32, room: int = 0) -> DataFrame:
    """Members with a hash of ``bits`` bits as key, no two with the same.

    Where members share a key the smallest keeps it, and only the others are hashed anew, until all
    differ.  A key depends on the set of members only, not on order or partitioning.  With ``room``
    the hash is as much wider as it takes to leave so many keys per member, so the rounds stay few
    however many members there are.  Eager: two aggregates of the members, and more only for those
    that collide.  What meets the members is measured before it is broadcast.
    """
    marks = [F.col(c).isNull() for c in columns]  # a hash skips nulls, so (null, x) would be (x, null)
    members = cut_lineage(df.select(*columns).distinct())
    count = members.count()
    if room:
        bits = max(bits, (room * count - 1).bit_length())
    if bits < 63 and count > 1 << bits:
        raise ValueError(f"{bits} bits do not tell the members apart")
    draw = lambda salt: F.pmod(F.xxhash64(*columns, *marks, F.lit(salt)), F.lit(1 << bits)).cast("long") if bits < 63 else F.xxhash64(*columns, *marks, F.lit(salt))
    settled, open_ = None, members.withColumn(key, draw(0))
    size = F.octet_length(F.to_json("_first"))
    for salt in range(1, rounds + 1):
        # a key that an earlier round gave away stays with its member
        ranked = open_.withColumn("_old", F.lit(1))
        if settled is not None:
            taken = settled.join(_side(open_.select(key).distinct(), count * 16), key, "left_semi")
            ranked = ranked.unionByName(taken.select(*columns, key, F.lit(0).alias("_old")))
        first = F.min(F.struct("_old", F.struct(*marks, *columns).alias("_m"))).alias("_first")
        clashes = cut_lineage(ranked.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), first).filter("_n > 1"))
        keys, several, width = clashes.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
        if not keys:
            return open_ if settled is None else settled.unionByName(open_)
        joined = open_.join(_side(clashes, width), key, "left")
        stays = F.col("_n").isNull() | ((F.col("_first._old") == 1) & (F.struct(*marks, *columns) == F.col("_first._m")))
        judged = cut_lineage(joined.select(*columns, key, stays.alias("_stays")))
        kept = judged.filter("_stays").select(*columns, key)
        settled = kept if settled is None else settled.unionByName(kept)
        open_ = cut_lineage(judged.filter(~F.col("_stays")).select(*columns).withColumn(key, draw(salt)))
        count = several - keys  # one member of each key stays
    raise ValueError(f"{bits} bits do not tell the members apart")


def _side(df: DataFrame, size: int) -> DataFrame:
    """A broadcast of few measured bytes; else both sides are sorted, whatever Spark takes their size to be."""
    return F.broadcast(df) if size <= 4 << 20 else df.hint("merge")


def lookup_key(df: DataFrame, members: DataFrame, on: dict[str, str], key: str, default: int = UNKNOWN_KEY) -> DataFrame:
    """Left lookup of a surrogate key; rows without a member get ``default``.  ``on``: fact column -> member column."""
    side = members.select(*[F.col(m).alias(f"_m_{m}") for m in on.values()], F.col(key).alias("_key"))
    condition = None
    for fact, member in on.items():
        test = df[fact] == side[f"_m_{member}"]
        condition = test if condition is None else condition & test
    joined = df.join(side, condition, "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(F.col("_key"), F.lit(default)).alias(key))
