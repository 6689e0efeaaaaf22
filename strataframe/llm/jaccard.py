"""N-gram Jaccard join: size-aware, with subsets for small sets and inverted lists for large ones.

A document's set holds its distinct shingles of ``width`` words (four, if not told otherwise); sets
link from a similarity of ``percent`` (85).  Sets below a boundary are small: two of
them link only if they share a subset as large as the overlap that their sizes require, so all
such subsets are enumerated as keys.  Larger sets are found through inverted lists of the first
tokens of a global order, tokens that many sets hold last; a set also enters lists if it may link
with a larger one.  The boundary minimises the estimated number of keys and list entries read.

Equal sets are one class from the start.  In a list every class is tested against the list's
smallest member; classes joined by then are one group, and what is left to test are pairs of
different groups, where members of the list's largest group never meet each other.  Every pair
is verified on whole sets, so no link between different sets is lost and none is false.

Null or blank texts have empty sets and link with nothing; texts under ``width`` words have
one shingle.  Rows that share a doc_id are one document for the links; rows without doc_id are
returned without a component.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import WordHashes, drop_staged, mixed, scratch, staged, texts_of, window_hashes
from strataframe.llm.components import components
from strataframe.session import broadcast_if_small

WIDTH = 4  # words of a shingle, unless told otherwise
PERCENT = 85  # least similarity that links, unless told otherwise
# The global order of tokens: first those of the lowest part of the hash range, then the rest, last the
# hot ones, which at least so many sets hold; hot are at most so many, the most frequent.  Tokens are
# counted in the lowest part, and all tokens of sets below a size.  The order is no filter.
REGION = np.uint64(int(0.3 * 2**64))
WHOLE_BELOW = 256
HOT_COUNT, HOT_TOKENS = 16, 500_000
SMALLEST_LARGE = 40  # sets below this size may be enumerated
MAP_BITS = 512


def overlap(s: int, t: int, percent: int = PERCENT) -> int:
    """Least intersection of sets of these sizes that link."""
    return -(-percent * (s + t) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    """How many first tokens of a set must hold one that any linked set has among its own."""
    return n + (-percent * n // 100) + 1


@cache
def subset_sizes(n: int, boundary: int, percent: int = PERCENT) -> tuple[int, ...]:
    """Overlaps that a set of ``n`` needs with the small sets it may link with."""
    partners = range(max(1, -(-percent * n // 100)), min(boundary - 1, 100 * n // percent) + 1)
    return tuple(sorted({overlap(n, t, percent) for t in partners}))


def shingle_set(text: bytes, words: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    hashes = words.of(text.lower().split())
    return np.unique(window_hashes(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def parity(own: np.ndarray) -> np.ndarray:
    """A bit map in which every shingle flips a bit: two maps differ in no more bits than the sets in shingles."""
    counts = np.bincount((own >> np.uint64(7)).astype(np.int64) % MAP_BITS, minlength=MAP_BITS)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


def _describe(width: int):
    """Size, fingerprint and first tokens of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            n, prints, heads, maps = [], [], [], []
            for text in texts_of(batch):
                own = shingle_set(text, words, width)
                n.append(len(own))
                prints.append(xxhash.xxh3_128_digest(own.tobytes()))
                first = int(np.searchsorted(own, REGION)) if len(own) >= WHOLE_BELOW else len(own)
                heads.append(own[:first].tobytes())
                maps.append(parity(own))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(heads, pa.binary()), pa.array(maps, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "print", "head", "map"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sets = [shingle_set(text, words, width).view(np.int64) for text in texts_of(batch)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["v", "own"])

    return run


def _counted_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = np.frombuffer(b"".join(batch.column("head").to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(own)], names=["token"])


def first_tokens(own: np.ndarray, n: int, hot: np.ndarray, percent: int = PERCENT) -> np.ndarray | None:
    """The first tokens in the global order of a set of ``n`` of which ``own`` are known; None if these do not suffice."""
    at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
    last = hot[at] == own if len(hot) else np.zeros(len(own), bool)
    if len(own) < n and (~last).sum() < prefix(n, percent):
        return None
    return own[np.argsort(np.where(last, 2, own >= REGION), kind="stable")[: prefix(n, percent)]]


def _postings(boundary: int, hot, width: int, percent: int):
    """Keys of each set: its subsets if it is small, its first tokens if it may link with a large one.

    A set whose known tokens do not suffice gets one row without a key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, words = hot.value, WordHashes()
        for batch in batches:
            if "head" in batch.schema.names:
                known = [(n, np.frombuffer(head, np.uint64)) for n, head in zip(batch.column("n").to_pylist(), batch.column("head").to_pylist())]
            else:
                known = [(len(own), own) for own in (shingle_set(text, words, width) for text in texts_of(batch))]
            keys, sizes = [np.zeros(0, np.uint64)], []
            open_ = []
            for i, (n, own) in enumerate(known):
                found = []
                if n < boundary:
                    each = mixed(own)
                    total = each.sum(dtype=np.uint64)
                    for size in subset_sizes(n, boundary, percent):
                        without = np.array(list(combinations(range(n), n - size)), np.int64).reshape(comb(n, size), n - size)
                        found.append(mixed(total - each[without].sum(axis=1, dtype=np.uint64) + np.uint64(size)))
                if 100 * n >= percent * boundary:
                    first = first_tokens(own, n, late, percent)
                    if first is None:
                        open_.append(i)
                    else:
                        found.append(first)
                keys += found
                sizes.append(sum(map(len, found)))
            at = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), np.array(open_, np.int64)]).astype(np.int64)
            key = pa.concat_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.nulls(len(open_), pa.int64())])
            n = pa.array(np.array([n for n, _ in known], np.int64)[at] if len(at) else [], pa.int64())
            yield pa.RecordBatch.from_arrays([key, batch.column("v").take(pa.array(at)), n], names=["key", "v", "n"])

    return run


def choose_boundary(sizes: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """Boundary of the least estimated work; ``sizes`` maps set sizes to counts, sizes beyond the largest boundary summed up at it."""
    def work(x: int) -> float:
        small = sum(c * sum(comb(n, k) for k in subset_sizes(n, x, percent)) for n, c in sizes.items() if n < x)
        return small + sum(c * prefix(n, percent) * list_length for n, c in sizes.items() if 100 * n >= percent * x)

    return min(range(1, SMALLEST_LARGE + 1), key=lambda x: (work(x), x))


def _close(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _differing(a: str, b: str) -> Column:
    """In how many bits two maps differ."""
    return reduce(Column.__add__, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(MAP_BITS // 64)])


def _spare(n: Column, m: Column, percent: int) -> Column:
    """How many shingles linked sets of these sizes may not share."""
    return n + m - 2 * F.ceil(percent * (n + m) / (100 + percent))


def plausible(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose bit maps do not rule a link out."""
    of = lambda v, x: classes.select(F.col("v").alias(v), F.struct("n", "map").alias(x))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b")
    return both.filter(_differing("x.map", "y.map") <= _spare(F.col("x.n"), F.col("y.n"), percent)).select("a", "b")


def verified(docs: DataFrame, pairs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets link."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "jaccard-ids")
    sets = docs.select("doc_id", "text").join(broadcast_if_small(ids), "doc_id", "left_semi").mapInArrow(_sets(width), "v long, own array<long>")
    both = pairs.join(sets.select(F.col("v").alias("a"), F.col("own").alias("x")), "a").join(sets.select(F.col("v").alias("b"), F.col("own").alias("y")), "b")
    sized = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), F.size("x").alias("nx"), F.size("y").alias("ny"))
    return sized.filter(f"100 * i >= {percent} * (nx + ny - i)").select("a", "b").distinct()


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document; shingles of ``width`` words link from ``percent``."""
    with scratch() as held:
        return held.keep(_jaccard_components(docs, width, percent))


def _jaccard_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = staged(docs.mapInArrow(_describe(width), "doc_id long, n long, print binary, head binary, map array<long>"), "jaccard-sets")
    ids = staged(described.select("doc_id", "n", "print"), "jaccard-ids")
    first = staged(ids.filter("n > 0 and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("v")), "jaccard-first")
    reps = described.join(broadcast_if_small(first), "print").filter("doc_id = v")
    classes = staged(reps.select("v", "print", "n", "map").dropDuplicates(["v", "print"]), "jaccard-classes")

    tokens = reps.mapInArrow(_counted_tokens, "token long")
    hot = staged(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= HOT_COUNT), "jaccard-hot")
    last = hot.orderBy(F.desc("df"), "token").limit(HOT_TOKENS).select("token").toPandas()["token"]
    # mean length of the list that a token leads to, over one token in 64
    few = tokens.filter("pmod(token, 64) = 0").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    length = few.agg(F.try_divide(F.sum(F.col("df") * F.col("df")), F.sum("df"))).first()[0]
    sizes = {r[0]: r[1] for r in classes.groupBy(F.least("n", F.lit(4 * SMALLEST_LARGE))).count().collect()}
    boundary = choose_boundary(sizes, max(1.0, float(length or 1.0)), percent)
    emit = _postings(boundary, spark.sparkContext.broadcast(np.sort(last.to_numpy(np.int64).view(np.uint64))), width, percent)
    known = staged(reps.select("v", "n", "head").mapInArrow(emit, "key long, v long, n long"), "jaccard-postings")
    drop_staged(described)
    open_ = staged(known.filter("key is null").select("v").distinct(), "jaccard-open")  # sets made of hot tokens for the most part
    whole = docs.select(F.col("doc_id").alias("v"), "text").join(broadcast_if_small(open_), "v", "left_semi")
    postings = known.filter("key is not null").union(whole.mapInArrow(emit, "key long, v long, n long"))
    lists = postings.groupBy("key").agg(F.min("v").alias("pivot"), F.max("v").alias("_last"), F.min_by("n", "v").alias("pivot_n")).filter("pivot < _last").drop("_last")
    shared = staged(postings.join(staged(lists, "jaccard-pivots"), "key").distinct(), "jaccard-lists")
    drop_staged(known)

    near = shared.filter(f"v > pivot and {_close('n', 'pivot_n', percent)}").select(F.col("pivot").alias("a"), F.col("v").alias("b")).distinct()
    links = staged(verified(docs, staged(plausible(near, classes, percent), "jaccard-pairs"), width, percent), "jaccard-links")
    groups = components(links)
    members = shared.join(groups, "v", "left").select("key", "v", "n", "pivot", F.coalesce("component", "v").alias("g"))
    members = staged(members, "jaccard-members")
    largest = members.groupBy("key", "g").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.max_by("g", F.struct("m", "g")).alias("top"), F.count(F.lit(1)).alias("kinds"))
    mixed_lists = members.join(largest.filter("kinds > 1"), "key").filter("v <> pivot").join(classes.select("v", "map"), "v")
    mixed_lists = staged(mixed_lists.select("key", "v", "n", "g", "map", (F.col("g") != F.col("top")).alias("other")), "jaccard-mixed")
    rest = mixed_lists.filter("other").select("key", F.col("v").alias("x"), F.col("n").alias("nx"), F.col("g").alias("gx"), F.col("map").alias("mx"))
    may_link = _differing("map", "mx") <= _spare(F.col("n"), F.col("nx"), percent)
    further = mixed_lists.join(rest, "key").filter(F.expr(f"g <> gx and {_close('n', 'nx', percent)}") & may_link)
    further = further.select(F.least("v", "x").alias("a"), F.greatest("v", "x").alias("b")).distinct()
    more = staged(verified(docs, staged(further, "jaccard-pairs"), width, percent), "jaccard-links")
    groups = staged(components(links.union(more)), "jaccard-groups")

    smallest = first.join(groups, "v", "left").select("print", F.coalesce("component", "v").alias("c"))
    result = ids.select("doc_id", F.col("n").alias("n_shingles"), "print").join(smallest, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return staged(result.select("doc_id", "n_shingles", component.alias("component_id")), "jaccard-result")
