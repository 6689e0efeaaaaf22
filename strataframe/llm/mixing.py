"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources, ordered by code point with null last, weigh ``WEIGHTS`` in turn.  Together they are to
give as many words as the input has; a source gives at most ``MOST`` times its size and what it
cannot give is shared out again by weight.  Documents are cut into blocks of consecutive words.
A source's blocks, in a pseudo-random order that depends on the seed and their content only, are
drawn whole ``floor(target / size)`` times, and once more up to the block at which the words left
are reached.  These exact quotas are split among output shards by a tree: at each node the blocks
of the left half are a multivariate-hypergeometric draw from those of the node.  Each shard takes
its own stretch of every source's order, so draws are disjoint, and shuffles them locally.

Null and blank texts have no words and give nothing; equal rows are drawn alike but for ties,
which fall by row; an empty table gives an empty result; other columns are ignored.  Reruns agree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import SPACE, staged, words_of

WEIGHTS, MOST = (5, 2, 1), 3
BLOCK_WORDS = 64
MOST_BLOCKS = 500_000_000  # the hypergeometric draws take fewer than 10^9; blocks grow beyond
BUCKET_BITS, PER_BUCKET = 16, 1024


def targets(sizes: list[int]) -> list[float]:
    """Words that each source is to give; the sources come in their order."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    left, out = float(sum(sizes)), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        unit = left / sum(weights[i] for i in free)
        above = [i for i in free if weights[i] * unit > MOST * sizes[i]]
        for i in above or free:
            out[i] = float(MOST * sizes[i]) if above else weights[i] * unit
        if not above:
            break
        left -= sum(out[i] for i in above)
        free -= set(above)
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (column) for each shard (row), every shard getting its equal part of all."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])  # a node's draw depends on the node only
        left = rng.multivariate_hypergeometric(have, int(have.sum()) * (mid - lo) // (hi - lo), method="marginals")
        split(lo, mid, left)
        split(mid, hi, have - left)

    split(0, shards, np.array(quotas, np.int64))
    return out


def sized(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Documents with a row id, their words and a key from their content, and all of them as ``doc`` if ``whole``; staged, so ids stay."""
    content = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), content.alias("content"), *[F.struct(*docs.columns).alias("doc")] * whole)
    return staged(rows, "mixing-docs")


def mix(rows: DataFrame, shards: int = 64, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Draws of blocks (id, block, start, words, pass, shard, place) and the sources with their targets.

    ``rows`` comes from ``sized``.  Only one row per source and one number per source and shard
    pass through the driver.
    """
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.asc_nulls_last("source")).collect()
    goals = targets([r.source_size for r in found])
    width = max(BLOCK_WORDS, -(-MOST * sum(r.source_size for r in found) // MOST_BLOCKS))
    full = [min(MOST, int(t // r.source_size)) if r.source_size else 0 for t, r in zip(goals, found)]
    sources = spark.createDataFrame(
        [(i, r.source, r.source_size, t, k, t - k * r.source_size) for i, (r, t, k) in enumerate(zip(found, goals, full))],
        "number int, of_source string, source_size long, target double, full int, part double",
    )

    each = rows.filter("size > 0").join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("of_source"))).select("id", "content", "size", "number", "part")
    each = each.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {width}"))))
    key = F.xxhash64(F.lit(seed), "content", "block")
    blocks = each.select("id", "block", "number", "part", F.least(F.lit(width), F.expr(f"size - block * {width}")).alias("words"), key.alias("key"))
    counts = {r.number: r["count"] for r in blocks.groupBy("number").count().collect()}
    bits = max([0, *(min(BUCKET_BITS, (c // PER_BUCKET).bit_length()) for c in counts.values())])
    blocks = blocks.withColumn("bucket", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long"))

    # the place of a block in its source's order: the buckets before it, then its place in the bucket
    sums = blocks.groupBy("number", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"))
    inside = Window.partitionBy("number", "bucket").orderBy("key", "id", "block")
    placed = blocks.join(sums, ["number", "bucket"]).select(
        "id", "block", "number", "words", "key", (F.col("n0") + F.row_number().over(inside) - 1).alias("rank"),
        (F.col("w0") + F.sum("words").over(inside) - F.col("words") / 2 < F.col("part")).alias("again"),
    )
    placed = staged(placed, "mixing-blocks")
    parts = {r.number: r.n for r in placed.filter("again").groupBy("number").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = [full[i] * counts.get(i, 0) + parts.get(i, 0) for i in range(len(found))]
    cuts = np.cumsum(split_quotas(quotas, shards, seed), axis=0)[:-1]
    plan = spark.createDataFrame([(i, full[i], counts.get(i, 0), cuts[:, i].tolist()) for i in range(len(found))], "number int, full int, blocks long, cuts array<long>")
    passes = F.explode(F.sequence(F.lit(0), F.col("full") - F.when(F.col("again"), 0).otherwise(1)))
    drawn = placed.join(F.broadcast(plan), "number").filter("again or full > 0").select("*", passes.alias("pass"))
    drawn = drawn.withColumn("draw", F.col("pass") * F.col("blocks") + F.col("rank"))
    shard = F.size(F.filter("cuts", lambda c: c <= F.col("draw")))
    draws = drawn.select("id", "block", (F.col("block") * width).alias("start"), "words", "pass", (F.col("pass") < F.col("full")).alias("whole"), shard.alias("shard"), F.xxhash64(F.lit(seed), "key", "pass", "draw").alias("place"))
    return draws, sources


def mixed_sizes(docs: DataFrame, shards: int = 64, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    rows = sized(docs)
    draws, sources = mix(rows, shards, seed)
    taken = draws.groupBy("id").agg(F.sum("words").alias("taken"))
    out = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("of_source"))).join(taken, "id", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, shards: int = 64, seed: int = 0) -> DataFrame:
    """The mix itself: a row for every pass over a document, shard by shard and shuffled inside.

    A pass that takes only some blocks keeps these, in order, with the white space before each word.
    """
    rows = sized(docs, whole=True)
    draws, _ = mix(rows, shards, seed)
    taken = draws.groupBy("id", "pass", "whole").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("own"), F.min(F.struct("shard", "place")).alias("at"))
    pieces = F.regexp_extract_all("doc.text", F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    joined = rows.join(taken, "id").select("doc", "at", "own", "whole", F.when(~F.col("whole"), pieces).alias("pieces"))
    some = F.array_join(F.flatten(F.transform("own", lambda b: F.slice("pieces", (b["start"] + 1).cast("int"), b["words"].cast("int")))), "")
    placed = joined.select("doc", "at", F.when(F.col("whole"), F.col("doc.text")).otherwise(F.ltrim(some)).alias("new"))
    new = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    ordered = placed.repartitionById(shards, "at.shard").sortWithinPartitions("at")
    return ordered.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
