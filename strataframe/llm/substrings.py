"""Substring dedup: seed on winnowed anchors, extend both ways, keep maximal repeats.

A window is ``LENGTH`` consecutive words.  In each window the least hash among its shorter runs
of ``SEED`` words is its anchor, so equal windows have equal anchors.  Documents are joined on
their anchors; an anchor that starts in one document only can lie in no repeat.  Seeds that are
left are extended both ways: every window around a shared anchor is compared by a 128-bit hash of
its whole word sequence, from two independent hashes of every word, with the smallest document
that holds it.  Windows that start in a smaller
document make up the maximal repeats, and their words go.  Work is linear in the words near
shared anchors whatever the size of a group; equal documents are one from the start.

Windows are judged on the input.  Null or blank texts have no words; texts shorter than a window
keep all; documents without doc_id are compared with none; rows that share a doc_id do not remove
each other's words.  Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import WordHashes, drop_staged, staged, texts_of, window_hashes

LENGTH, SEED = 50, 20
SPAN = LENGTH - SEED + 1  # seeds in a window


def tens(words: np.ndarray) -> np.ndarray:
    """Hashes of ten consecutive words, of which those of seeds and windows are made."""
    return window_hashes(words, 10)


def anchors(ten: np.ndarray) -> np.ndarray:
    """For each window its anchor, the least hash of the seeds in it."""
    least = window_hashes(ten, SEED // 10, 10)
    width = 1
    while width < SPAN:  # the least of a run from two overlapping halves
        step = min(width, SPAN - width)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        width += step
    return least


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, fingerprint of their sequence, digest of the words as they are, and the anchors of each text."""
    words = WordHashes()
    for batch in batches:
        counts, prints, kept, found = [], [], [], []
        for text in texts_of(batch):
            own = text.split()
            joined = b" ".join(own)
            counts.append(len(own))
            prints.append(xxhash.xxh3_128_digest(joined))
            kept.append(sha256(joined).hexdigest())
            found.append(np.unique(anchors(tens(words.of(own)))).view(np.int64))
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(kept, pa.string()), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "print", "sha", "anchors"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each document whose anchor is shared."""
    words, again = WordHashes(), WordHashes(seed=1)
    for batch in batches:
        rows, places = [], [np.zeros(0, np.int64)]
        hashes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for i, (text, shared) in enumerate(zip(texts_of(batch), batch.column("anchors"))):
            own = text.split()
            ten = tens(words.of(own))
            keep = np.nonzero(np.isin(anchors(ten), np.array(shared.as_py(), np.int64).view(np.uint64)))[0]
            for found, of in zip(hashes, (ten, tens(again.of(own)))):
                found.append(window_hashes(of, LENGTH // 10, 10)[keep])
            places.append(keep)
            rows += [i] * len(keep)
        own = batch.select(["id", "doc_id"]).take(pa.array(rows, pa.int32()))
        both = [pa.array(np.concatenate(h).view(np.int64)) for h in hashes]
        yield pa.RecordBatch.from_arrays([*own.columns, *both, pa.array(np.concatenate(places))], names=["id", "doc_id", "window", "second", "at"])


def covered(starts: list[int], n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    at = np.unique(np.array(starts, np.int64))
    np.add.at(edges, at, 1)
    np.add.at(edges, np.minimum(at + LENGTH, n), -1)
    return np.cumsum(edges)[:n] > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words left of documents that lose some."""
    for batch in batches:
        counts, kept = [], []
        for text, starts in zip(texts_of(batch), batch.column("starts")):
            own = text.split()
            gone = covered(starts.as_py(), len(own))
            counts.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(own, gone.tolist()) if not g).decode())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(kept, pa.string())], names=["id", "lost", "left_text"])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, the digest of the words left and, for texts cut in part, those words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = docs.mapInArrow(_describe, "doc_id long, n long, print binary, sha string, anchors array<long>")
    described = staged(described.withColumn("id", F.monotonically_increasing_id()), "substrings-docs")
    usable = described.filter(f"n >= {LENGTH} and doc_id is not null")
    first = staged(usable.groupBy("print").agg(F.min("doc_id").alias("first"), F.min_by("id", "doc_id").alias("id")), "substrings-first")

    # a document with a smaller equal one loses every word; it seeds nothing that the smaller one does not
    seeds = usable.join(first.select("id"), "id", "left_semi").select("id", "doc_id", "print", F.explode("anchors").alias("anchor"))
    # written first: a join of two plain shuffles can split an anchor or a window that very many documents hold
    shared = seeds.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    shared = staged(shared, "substrings-shared")
    per_doc = seeds.join(shared, "anchor").groupBy("id").agg(F.first("doc_id").alias("doc_id"), F.first("print").alias("print"), F.collect_list("anchor").alias("anchors"))
    near = docs.join(per_doc, "doc_id").mapInArrow(_same_text, "doc_id long, text string, id long, anchors array<long>")
    near = staged(near, "substrings-near")

    windows = near.mapInArrow(_windows, "id long, doc_id long, window long, second long, at long")
    earlier = windows.groupBy("window", "second").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("window", "second", "lo")
    earlier = staged(earlier, "substrings-windows")
    repeats = windows.join(earlier, ["window", "second"]).filter("lo < doc_id").groupBy("id").agg(F.collect_list("at").alias("starts"))
    cut = near.select("id", "text").join(repeats, "id").mapInArrow(_cut, "id long, lost long, left_text string")
    cut = staged(cut.dropDuplicates(["id"]), "substrings-cut")  # rows may repeat

    # rows of the same doc_id and words share the cut of the one that was looked at
    cut = first.join(cut, "id").select("print", "first", "lost", "left_text")
    rows = described.join(first.select("print", "first"), "print", "left").join(cut, ["print", "first"], "left")
    whole = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    removed = F.when(whole, F.col("n")).otherwise(F.coalesce("lost", F.lit(0)))
    left = F.when(whole, F.lit("")).otherwise(F.col("left_text"))
    result = rows.select(
        "doc_id", F.col("n").alias("n_words"), F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(removed).cast("long").alias("n_removed"),
        F.when(F.col("doc_id").isNull() | left.isNull(), F.col("sha")).otherwise(F.sha2(left, 256)).alias("kept_sha256"), left.alias("left_text"),
    )
    result = staged(result, "substrings-result")
    drop_staged(described, first, near, shared, earlier)
    return result


def _same_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose words are those that the anchors were taken from: a doc_id may stand for several texts."""
    for batch in batches:
        same = [xxhash.xxh3_128_digest(b" ".join(t.split())) == p.as_py() for t, p in zip(texts_of(batch), batch.column("print"))]
        yield batch.filter(pa.array(same, pa.bool_())).select(["doc_id", "text", "id", "anchors"])
