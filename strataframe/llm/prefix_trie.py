"""Prefix trie of rebuilt conversations, from fingerprints that compose.

A turn has a fingerprint e, and the fingerprint of a sequence is its value as a polynomial:
f(s + turn) = f(s) * B + e modulo the prime 2^127 - 1.  Sequences under concatenation map to pairs
(f, B^length) that multiply, so the fingerprint of "head of the base, then own turns i..j" follows
from stored prefix fingerprints of the two conversations alone; no rebuilt text is put together.

Prefix fingerprints come from a range sort by conversation and place: each partition multiplies
its own rows, and what a partition carries over to the next is one pair.  So a conversation of any
length is many tasks' work.  The same scan adds up what lies below a node: a node's value stands at
its smallest member, sums run along that member's path from the end, and each node adds up its
members' sums.  No level-by-level loop is needed.

Equality is verified, not assumed: turns that share a fingerprint are compared by role and text,
and all members of a node must refer to one turn and one parent.  Should that ever fail, the work
is done again with another B and other turn fingerprints.

Turns are ordered by number, null first; turns of one number by role and then by fingerprint.
Null role or text is empty; repeated rows are repeated turns.  Rows without conv_id take no part.
``c % 5`` has the sign of c.  Texts of any length only pass through a hash.  An empty table gives
no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import staged

PRIME = 2**127 - 1
PIECE = 4_096  # ids of one piece of a list
LOW = (1 << 64) - 1


def _halves(value: int) -> tuple[int, int]:
    low = value & LOW
    return value >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high, low) -> int:
    return (int(high) << 64) | (int(low) & LOW)


def base_of(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"base {seed}".encode()).digest()[:15]) | 1


def segmented_scan(rows: DataFrame, key: str, order: list[str], values: list[str], start: tuple, step: Callable, join: Callable, name: str) -> DataFrame:
    """``rows`` with the integers ``values`` replaced by their running fold within ``key``, in ``order``.

    ``step(state, row)`` takes a row's values into a state, ``join`` puts two states together; both
    give as many integers as there are values, and ``join`` is associative.  Rows are sorted by
    range, so a key may spread over many partitions; one state per partition comes to the driver.
    Columns of ``rows`` hold no nulls.
    """
    spark, schema = rows.sparkSession, rows.schema
    sort = [key, *order]
    placed = rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumns({"_part": F.spark_partition_id(), "_at": F.lit(0).cast("long")})

    def replaced(frame: pd.DataFrame, states: list[tuple]) -> pd.DataFrame:
        return frame.assign(**{c: np.fromiter((s[i] for s in states), np.int64, len(states)) for i, c in enumerate(values)})

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, done = None, start, 0
        for frame in frames:
            states = []
            for own, *row in zip(frame[key].tolist(), *(frame[c].tolist() for c in values)):
                if own != current:
                    current, state = own, start
                state = step(state, row)
                states.append(state)
            yield replaced(frame, states).assign(_at=np.arange(done, done + len(frame)))
            done += len(frame)

    done = staged(placed.mapInPandas(local, placed.schema), name)
    edges = done.groupBy("_part", key).agg(F.max_by(F.struct(*values), "_at").alias("state"))
    spread = edges.groupBy(key).count().filter("count > 1").drop("count")  # at most one key per pair of neighbours
    carried: dict[tuple[int, int], tuple] = {}
    last, state = None, start
    for row in edges.join(F.broadcast(spread), key).orderBy(key, "_part").collect():
        if row[key] == last:
            carried[row["_part"], last] = state
            state = join(state, tuple(row.state))
        else:
            last, state = row[key], tuple(row.state)
    if not carried:
        return done.drop("_part", "_at")
    shared = spark.sparkContext.broadcast(carried)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            before = map(shared.value.get, zip(frame["_part"].tolist(), frame[key].tolist()))
            states = zip(*(frame[c].tolist() for c in values))
            yield replaced(frame, [join(b, s) if b else s for b, s in zip(before, states)])[schema.names]

    return done.mapInPandas(whole, schema)


def _fingerprints(turns: DataFrame, seed: int) -> DataFrame:
    """Prefix fingerprints (fa, fb) of all conversations at every place, turn fingerprints (ea, eb) and bytes."""
    base = base_of(seed)

    def step(state, row):
        return (state[0] + 1, *_halves((_whole(state[1], state[2]) * base + _whole(row[1], row[2])) % PRIME))

    def join(left, right):
        moved = _whole(left[1], left[2]) * pow(base, right[0], PRIME)
        return (left[0] + right[0], *_halves((moved + _whole(right[1], right[2])) % PRIME))

    rows = turns.select("conv_id", "known", "turn", "role", "ea", "eb", "n_bytes", F.lit(1).cast("long").alias("place"), F.col("ea").alias("fa"), F.col("eb").alias("fb"))
    scanned = segmented_scan(rows, "conv_id", ["known", "turn", "role", "ea", "eb"], ["place", "fa", "fb"], (0, 0, 0), step, join, "trie-turns")
    return scanned.drop("known", "turn", "role")


MEMBER = "conv_id long, depth long, fa long, fb long, pa long, pb long, ea long, eb long, n_bytes long, ends boolean"


def _members(turns: DataFrame, group: int, heads: int, seed: int) -> DataFrame:
    """A row for every conversation and every node on its path: the node's fingerprint, its parent's and its turn's."""
    base = base_of(seed)
    back = pow(base, -1, PRIME)
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h")
    at_cut = F.col("place") == F.col("h")
    own = turns.select("*", h)
    ends = own.groupBy("conv_id", "h").agg(F.max("place").alias("n"), F.max(F.when(at_cut, F.col("fa"))).alias("ca"), F.max(F.when(at_cut, F.col("fb"))).alias("cb"))
    first = turns.filter((F.col("place") < heads) & (F.col("conv_id") % group == 0))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "fa", "fb", "ea", "eb", "n_bytes"))).alias("head"))
    joined = ends.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    none = F.array().cast("array<struct<place:bigint,fa:bigint,fb:bigint,ea:bigint,eb:bigint,n_bytes:bigint>>")
    head = F.filter(F.coalesce("head", none), lambda t: t["place"] <= F.col("h"))
    info = staged(joined.withColumn("head", head).withColumn("m", F.size("head").cast("long")), "trie-conversations")

    zero = F.lit(0).cast("long")
    last = F.get("head", F.size("head") - 1)
    over = info.select("conv_id", "h", "n", "m", *[F.coalesce(c, zero).alias(k) for k, c in {"ca": F.col("ca"), "cb": F.col("cb"), "ba": last["fa"], "bb": last["fb"]}.items()])
    suffix = turns.join(over, "conv_id").filter("place > h")
    suffix = suffix.select("conv_id", (F.col("m") + F.col("place") - F.col("h")).alias("depth"), "fa", "fb", "ca", "cb", "ba", "bb", (F.col("place") - F.col("h")).alias("j"), "ea", "eb", "n_bytes", (F.col("place") == F.col("n")).alias("ends"))
    short = F.col("n") <= F.col("h")
    heads_ = info.select("conv_id", "m", short.alias("short"), F.explode("head").alias("t"))
    zeros = [zero.alias(c) for c in ("ca", "cb", "ba", "bb", "j")]
    prefix = heads_.select("conv_id", F.col("t.place").alias("depth"), "t.fa", "t.fb", *zeros, "t.ea", "t.eb", "t.n_bytes", (F.col("short") & (F.col("t.place") == F.col("m"))).alias("ends"))
    roots = info.select("conv_id", zero.alias("depth"), zero.alias("fa"), zero.alias("fb"), *zeros, zero.alias("ea"), zero.alias("eb"), zero.alias("n_bytes"), (short & (F.col("m") == 0)).alias("ends"))

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = [1]
        for frame in frames:
            out = []
            for fa, fb, ca, cb, ba, bb, j, ea, eb in zip(*(frame[c].tolist() for c in ("fa", "fb", "ca", "cb", "ba", "bb", "j", "ea", "eb"))):
                while len(powers) <= min(j, 1_024):
                    powers.append(powers[-1] * base % PRIME)
                power = powers[j] if j <= 1_024 else pow(base, j, PRIME)
                f = ((_whole(ba, bb) - _whole(ca, cb)) * power + _whole(fa, fb)) % PRIME
                out.append((*_halves(f), *_halves((f - _whole(ea, eb)) * back % PRIME)))
            made = np.array(out, np.int64).reshape(-1, 4)
            yield frame.assign(fa=made[:, 0], fb=made[:, 1], pa=made[:, 2], pb=made[:, 3])[[c.split()[0] for c in MEMBER.split(", ")]]

    return staged(suffix.unionByName(prefix).unionByName(roots).mapInPandas(compose, MEMBER), "trie-members")


NODE = ["depth", "fa", "fb"]


def _digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node, in order.  Sorted by range, joined in pieces, hashed piece by piece."""
    order = [*NODE, "conv_id"]
    ends = members.filter("ends").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, ids = frame[NODE].to_numpy(), frame["conv_id"].tolist()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            cuts = sorted({0, len(ids), *cuts.tolist(), *range(0, len(ids), PIECE)})
            starts = cuts[:-1]
            yield frame.iloc[starts].assign(text=[",".join(map(str, ids[a:b])) for a, b in zip(starts, cuts[1:])])

    joined = ends.mapInPandas(pieces, "depth long, fa long, fb long, conv_id long, text string")
    laid = joined.repartition(*NODE).sortWithinPartitions(*order)

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for frame in frames:
            out = []
            for *own, text in zip(*(frame[c].tolist() for c in [*NODE, "text"])):
                if own == current:
                    state.update(b"," + text.encode())
                else:
                    if current:
                        out.append((*current, state.hexdigest()))
                    current, state = own, hashlib.sha256(text.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if current:
            yield pd.DataFrame([(*current, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    return laid.mapInPandas(digest, "depth long, fa long, fb long, ends_sha256 string")


def _trie(turns: DataFrame, group: int, heads: int, seed: int) -> DataFrame | None:
    """The nodes, or None if fingerprints of different sequences met."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    half = lambda start, n: F.conv(F.substring("digest", start, n), 16, -10).cast("long")
    marked = turns.withColumn("digest", digest).withColumns({"ea": half(1, 15), "eb": half(17, 16), "n_bytes": F.octet_length("text").cast("long")})
    if not marked.select("ea", "eb", "role", "text").distinct().groupBy("ea", "eb").count().filter("count > 1").isEmpty():
        return None
    members = _members(_fingerprints(marked, seed), group, heads, seed)
    same = ["ea", "eb", "pa", "pb", "n_bytes"]
    nodes = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_most") for c in same],
    )
    children = lambda of: of.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = staged(nodes, "trie-nodes")
    if not nodes.filter(" or ".join(f"{c} <> {c}_most" for c in same)).isEmpty():
        return None
    nodes = staged(nodes.join(children(nodes), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).drop(*[f"{c}_most" for c in same]), "trie-children")

    # what a node adds to all nodes above it stands on the path of its smallest member
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"), (F.col("n_children") == 0).cast("long").alias("n_leaves"))
    values = ["saved_tokens", "n_leaves"]
    paths = members.select("conv_id", *NODE).join(own, ["conv_id", "depth"], "left")
    paths = paths.select("conv_id", (-F.col("depth")).alias("up"), "fa", "fb", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in values])
    add = lambda a, b: (a[0] + b[0], a[1] + b[1])
    sums = segmented_scan(paths, "conv_id", ["up"], values, (0, 0), add, add, "trie-paths")
    sums = sums.groupBy((-F.col("up")).alias("depth"), "fa", "fb").agg(*[F.sum(c).alias(c) for c in values])
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, NODE).join(_digests(members), NODE, "left").join(parents, ["depth", "pa", "pb"], "left")
    empty = hashlib.sha256().hexdigest()
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text).

    Conversation c is rebuilt as the first h turns of c - c % ``group`` and its own turns after its
    first h, h being crc32 of its id modulo ``heads``.  The smallest member, depth, the parent's
    smallest member, members, children, childless nodes below, bytes that sharing the subtree saves
    and the digest of the members that end here.
    """
    empty = F.lit("")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
    ).filter("conv_id is not null")
    for seed in range(8):
        trie = _trie(turns, group, heads, seed)
        if trie is not None:
            return trie
    raise ArithmeticError("fingerprints of different turns met under every seed")
