"""Hard negatives: other-label rows whose score with the anchor is just below a positive's.

Scores are exact integers from float32 products: components are reduced modulo a few primes, one
float32 matrix product per prime gives the score's residue without rounding (sums stay below
2^24), and Chinese remaindering gives back the signed score.  As many primes are taken as the
largest possible score of a block asks for.

Blocks of anchors meet blocks of rows, twice: first for the positives of each anchor, then for
the rows whose scores lie in the window below each positive.  A block hands on what may be among
the first ``k`` only, so equal vectors or a label that a third of all rows bear need no more.

Rows with a null label, a null vector or null or non-finite components and rows without vec_id
take no part.  Equal rows count once; a vec_id with several vectors or labels stands for as many
rows, none of them "other" for an anchor of that id.  Vectors of different lengths have no score;
empty vectors score 0 with each other.  Equal scores go to the smaller vec_id; with fewer rows all
are returned.  A window under a negative score is empty.  An empty table gives no rows; other
columns are ignored.  Scores of 2^53 and more are an error.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import staged
from strataframe.llm.vectors import QUERY_BLOCK, ROW_BLOCK, TILE, blocks, first_places, grid, in_block, integer_rows, matrix

PRIMES = (251, 241, 239, 233, 229, 227, 223)
EXACT = 2**24  # float32 sums of integers are exact below
NONE = np.iinfo(np.int64).min


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """The residues nearest to zero, as float32."""
    r = np.mod(x, prime)
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def primes_for(a: np.ndarray, b: np.ndarray) -> tuple[int, ...]:
    """Primes whose product exceeds twice the largest score that rows of ``a`` and ``b`` can have."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    size, taken = 1, 0
    while size <= 2 * most:
        if taken == len(PRIMES) or most >= 2**53:
            raise OverflowError("scores of 2^53 or more")
        size, taken = size * PRIMES[taken], taken + 1
    return PRIMES[:taken]


def product_modulo(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """Residues in [0, prime) of all inner products of two float32 matrices of residues."""
    step = EXACT // (prime // 2) ** 2
    total = np.zeros((len(a), len(b)), np.int64)
    for i in range(0, a.shape[1], step):
        total += (a[:, i : i + step] @ b[:, i : i + step].T).astype(np.int64)
    return np.mod(total, prime)


def signed(parts: list[np.ndarray], primes: tuple[int, ...], shape: tuple[int, int]) -> np.ndarray:
    """The integers nearest to zero with these residues: digits in mixed radix, one prime after another."""
    value, radix = np.zeros(shape, np.int64), 1
    for part, prime in zip(parts, primes):
        digit = np.mod((part - value) * pow(radix, -1, prime), prime)
        value, radix = value + digit * radix, radix * prime
    return np.where(value > radix // 2, value - radix, value)


class Scores:
    """Exact scores of tiles of anchors with the rows of one block."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.anchors, self.rows = anchors, rows
        self.primes = primes_for(anchors, rows)
        self.parts = [residues(rows, p) for p in self.primes]

    def of(self, a: int, b: int) -> np.ndarray:
        some = self.anchors[a:b]
        parts = [product_modulo(residues(some, p), own, p) for p, own in zip(self.primes, self.parts)]
        return signed(parts, self.primes, (len(some), len(self.rows)))


def _tiles(anchors: pd.DataFrame, rows: pd.DataFrame):
    scores = Scores(matrix(anchors["v"]), matrix(rows["v"]))
    for a in range(0, len(anchors), TILE):
        yield anchors.iloc[a : a + TILE], scores.of(a, a + TILE)


def _positives(k: int, anchors: pd.DataFrame, rows: pd.DataFrame):
    """The best ``k`` rows of a block with an anchor's label."""
    rows = rows.sort_values("vec_id", kind="stable")
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for some, score in _tiles(anchors, rows):
        own = (labels == some["label"].to_numpy()[:, None]) & (ids != some["vec_id"].to_numpy()[:, None])
        score = np.where(own, score, NONE)
        r, c = first_places(score, k)
        r, c = r[own[r, c]], c[own[r, c]]
        yield pd.DataFrame({"anchor": some["anchor"].to_numpy()[r], "vec_id": ids[c], "score": score[r, c]})


def _negatives(k: int, low: int, high: int, anchors: pd.DataFrame, rows: pd.DataFrame):
    """The best ``k`` rows of a block with another label, in the window of each positive."""
    rows = rows.sort_values("vec_id", kind="stable")
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for some, score in _tiles(anchors, rows):
        other = labels != some["label"].to_numpy()[:, None]
        for place in range(1, int(some["positives"].map(len).max()) + 1):
            at = np.nonzero(some["positives"].map(len).to_numpy() >= place)[0]
            top = [int(x[place - 1]) for x in some["positives"].iloc[at]]
            least = np.array([-(-low * x // 100) for x in top])[:, None]
            most = np.array([high * x // 100 for x in top])[:, None]
            fits = other[at] & (score[at] >= least) & (score[at] <= most)
            held = np.where(fits, score[at], NONE)
            r, c = first_places(held, k)
            r, c = r[fits[r, c]], c[fits[r, c]]
            yield pd.DataFrame({"anchor": some["anchor"].to_numpy()[at][r], "place": place, "vec_id": ids[c], "score": held[r, c]})


def _first(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn(name, place).filter(F.col(name) <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = 256, positives: int = 5, k: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores: for each anchor and positive the ``k`` best rows
    of other labels whose scores lie between the two percentages of the positive's score.

    ``is_anchor`` picks anchors by vec_id; ``label`` is the label that counts, from the columns of ``vectors``.
    """
    labelled = integer_rows(vectors, scale, label.cast("long").alias("label")).filter("label is not null")
    rows = staged(labelled.withColumn("anchor", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "negatives-rows")
    anchors = rows.filter(is_anchor)
    row_blocks, anchor_blocks = blocks(rows.count(), ROW_BLOCK), blocks(anchors.count(), QUERY_BLOCK)
    held = rows.drop("anchor").withColumn("row_block", in_block(F.xxhash64("vec_id", "label", "v"), row_blocks))
    anchors = anchors.withColumn("query_block", in_block(F.xxhash64("anchor"), anchor_blocks))

    found = grid(anchors, held, partial(_positives, positives), "anchor long, vec_id long, score long", anchor_blocks, row_blocks)
    best = staged(_first(found, ["anchor"], positives, "place"), "negatives-positives")
    tops = best.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("positives"))
    asked = staged(anchors.join(tops, "anchor"), "negatives-asked")
    found = grid(asked, held, partial(_negatives, k, *window), "anchor long, place int, vec_id long, score long", anchor_blocks, row_blocks)
    chosen = _first(found, ["anchor", "place"], k, "rank").select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select("anchor", "place", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(named, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
