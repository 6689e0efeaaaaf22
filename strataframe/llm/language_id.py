"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of words with a start and an end, up to ``ORDER``
characters.  N-grams are counted over all documents to learn from, none is left out; continuation
counts follow from the distinct n-grams of the next order, discounts from the n-grams that come
once and twice.  Counts and probabilities are tables with one row per n-gram of any document and a
value for each language, filled order by order.  A word's log probability is the sum over its
n-grams; that of a text is the sum over its words, of which the commonest are looked up inside
tasks and the others are joined, in ``PASSES`` shares one after another.  A text's cross-entropy
under a language is the mean over the characters of its words; the lowest wins.  The score is the
posterior at the temperature that fits the documents learned from best; ``rejected`` marks texts
whose cross-entropy lies far above that of its language's documents, given its length.

Null texts and texts without a letter are ``und`` with score 0; all of a text is read; documents
without language or doc_id are not learned from; with nothing to learn from every text is
``und``.  Repeated rows count as often as they stand; an empty table gives an empty result;
columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import drop_staged, staged

ORDER, BITS = 5, 12
LETTERS = 1 << BITS  # letters of higher code points share the last quarter
COMMON, COMMON_CHARS = 50_000, 64  # words looked up inside tasks and their length; all others are joined, with the same result
UNIT = 1e8  # log probabilities are summed as whole numbers of this fraction, so no order of rows changes a sum
TEMPERATURES = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
PASSES = 2  # joins by word and n-gram take the words in so many shares, so only one share's rows lie in shuffles at once


@lru_cache(maxsize=1)
def letter_ids() -> np.ndarray:
    """Number of each letter by code point; 0 for everything else, 1 is the end of a word."""
    points = np.arange(0x110000)
    letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    low = np.where(points < 3072, points, 3072 + points % 1023)
    return np.where(letters, low, 0).astype(np.int64)


def grams(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the letters and word ends of tokens, and the number of the token of each."""
    points = np.frombuffer(("\n".join(tokens.tolist()) + "\n").lower().encode("utf-32-le"), np.uint32)
    ids = letter_ids()[points]
    gap = ids == 0
    places = np.arange(len(ids))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(gap, places, -1))[:-1]])
    inside = places - last - 1  # letters of the word before this place
    use = np.nonzero(~gap | (inside > 0))[0]
    packed = np.where(gap, 1, ids)[use]
    for back in range(1, ORDER):
        packed = packed | np.where(inside[use] >= back, ids[np.maximum(use - back, 0)], 0) << (BITS * back)
    return packed, np.cumsum(points == 10)[use] - (points == 10)[use]


@lru_cache(maxsize=1)
def is_letter() -> np.ndarray:
    return letter_ids() > 0


def letter_words(text: str) -> list[str]:
    """The runs of letters of a text, in small letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    return str(np.where(is_letter()[points], points, np.uint32(32)), "utf-32-le").split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts by language within a batch; without a language the words are only to be scored."""
    for batch in batches:
        found: dict[str | None, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            found[lang].update(letter_words(text.as_py() or ""))
        for lang, own in found.items():
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array(own.values(), pa.int64())], names=["lang", "word", "n"])


def _language_grams(langs: list[str]):
    """N-gram counts by language from word counts; words without a language count 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: i for i, lang in enumerate(langs)}
        for batch in batches:
            words, own = np.array(batch.column("word").to_pylist(), object), np.array([number.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            n = np.where(own >= 0, batch.column("n").to_numpy(zero_copy_only=False), 0)
            for i in np.unique(own):
                found, of = grams(words[own == i])
                keys, at = np.unique(found, return_inverse=True)
                sums = np.zeros(len(keys), np.int64)
                np.add.at(sums, at, n[own == i][of])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), i)), pa.array(keys), pa.array(sums)], names=["lang", "gram", "n"])

    return run


def _word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found, of = grams(np.array(batch.column("word").to_pylist(), object))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of)), pa.array(found)], names=["id", "gram"])


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in a sorted array, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class KneserNey:
    """The model of one language in memory, to check the tables against: per order the n-grams with log probabilities, and contexts with back-off weights."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        levels = {ORDER: (keys, counts.astype(float))}
        for k in range(ORDER - 1, 0, -1):  # how many characters stand before each shorter n-gram
            shorter, n = np.unique(levels[k + 1][0] & ((1 << BITS * k) - 1), return_counts=True)
            levels[k] = (shorter, n.astype(float))
        self.keys, self.logs, self.contexts, self.weights = {}, {}, {}, {}
        lower = np.array([1.0 / LETTERS])
        for k in range(1, ORDER + 1):
            own, n = levels[k]
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.75
            contexts, at, kinds = np.unique(own >> BITS, return_inverse=True, return_counts=True)
            total = np.bincount(at, n)
            weight = discount * kinds / total
            below = lower[find(levels[k - 1][0], own & ((1 << BITS * (k - 1)) - 1))[0]] if k > 1 else lower[0]
            lower = np.maximum(n - discount, 0) / total[at] + weight[at] * below
            self.keys[k], self.logs[k], self.contexts[k], self.weights[k] = own, np.log(lower), contexts, np.log(weight)

    def log(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log probability of the last character of each n-gram of this order."""
        out, open_ = np.zeros(len(keys)), np.arange(len(keys))
        for k in range(order, 0, -1):
            own = keys[open_] & ((1 << BITS * k) - 1)
            at, known = find(self.keys[k], own)
            out[open_[known]] += self.logs[k][at[known]]
            open_, own = open_[~known], own[~known]
            at, known = find(self.contexts[k], own >> BITS)
            out[open_[known]] += self.weights[k][at[known]]
        out[open_] -= np.log(LETTERS)
        return out


def probabilities(counts: DataFrame, size: int) -> DataFrame:
    """gram and the probability of its last character under every language (``p``), from counts ``n0``, ``n1`` ... by language.

    An n-gram's context and its shorter n-gram are each shared by no more rows than there are letters.
    """
    ns = [f"n{i}" for i in range(size)]
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # how many characters stand before each shorter n-gram
        shorter = F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("gram")
        levels[k] = staged(levels[k + 1].groupBy(shorter).agg(*[F.sum((F.col(n) > 0).cast("long")).alias(n) for n in ns]), "language-counts")
    out = None
    for k in range(1, ORDER + 1):
        how_many = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
        sums = [f(F.col(n)).alias(f"{n}_{j}") for n in ns for j, f in enumerate((lambda n: how_many(n == 1), lambda n: how_many(n == 2), how_many, lambda n: how_many(n > 0)))]
        known = levels[k].agg(*sums).first()  # one row of four numbers per language
        below = [F.lit(1.0 / LETTERS)] * size
        same = Window.partitionBy(F.shiftright("gram", BITS))
        values = []
        rows = levels[k]
        if out is not None:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1))
            rows = rows.withColumns({x: f(F.col(n)).over(same) for n in ns for x, f in ((f"{n}_total", F.sum), (f"{n}_kinds", lambda c: F.sum((c > 0).cast("long"))))})
            rows = rows.withColumn("shorter", shorter).join(out.select(F.col("gram").alias("shorter"), "p"), "shorter")
            below = [F.get("p", F.lit(i)) for i in range(size)]
        for n, p in zip(ns, below):
            once, twice = known[f"{n}_0"], known[f"{n}_1"]
            discount = once / (once + 2 * twice) if once and twice else 0.75
            total, kinds = (F.lit(known[f"{n}_2"]), F.lit(known[f"{n}_3"])) if out is None else (F.col(f"{n}_total"), F.col(f"{n}_kinds"))
            seen = (F.greatest(F.col(n) - F.lit(discount), F.lit(0.0)) + F.lit(discount) * kinds * p) / total
            values.append(F.when(total > 0, seen).otherwise(p))
        before, out = out, staged(rows.select("gram", F.array(*values).alias("p")), "language-probabilities")
        drop_staged(levels[k], *[before] * (before is not None))  # an order needs the one below only
    return out


def share_of(word: str) -> Column:
    """The share, from 0, in which a word is scored."""
    return F.pmod(F.xxhash64(word), F.lit(PASSES))


def word_scores(docs: DataFrame) -> tuple[list[str], list[DataFrame]]:
    """The languages, sorted, and each word of any document with its count, characters and log probability under every language, share by share.

    The languages are learned from the documents that are ``learned`` and have a language.
    """
    rows = docs.select("text", F.when(F.col("learned"), F.col("lang")).alias("lang"))
    counts = staged(rows.mapInArrow(_count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    langs = sorted(r.lang for r in counts.filter("lang is not null").select("lang").distinct().collect())
    if not langs:
        return [], []
    per_language = [F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(langs))]
    grams_ = staged(counts.mapInArrow(_language_grams(langs), "lang long, gram long, n long").groupBy("gram").agg(*per_language), "language-grams")
    p = probabilities(grams_, len(langs))

    words = staged(counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("id", F.monotonically_increasing_id()), "language-vocabulary")
    whole = [F.sum(F.round(F.log(F.get("p", F.lit(i))) * UNIT).cast("long")).alias(f"s{i}") for i in range(len(langs))]
    scores = []
    for i in range(PASSES):
        share = words.filter(share_of("word") == i)
        scored = share.mapInArrow(_word_grams, "id long, gram long").join(p, "gram").groupBy("id").agg(F.count(F.lit(1)).alias("chars"), *whole)
        rows = share.join(scored, "id").select("word", "n", "chars", F.array(*[f"s{i}" for i in range(len(langs))]).alias("logs"))
        scores.append(staged(rows, "language-scores"))
    drop_staged(counts, p, words)
    return langs, scores


def _known_words(common, size: int):
    """Characters and log probabilities of the common words of each document, and its other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, lengths, logs = common.value
        for batch in batches:
            chars, sums, rest, times = [], [], [], []
            for text in batch.column("text"):
                own = Counter(letter_words(text.as_py() or ""))
                at = np.fromiter((places.get(w, -1) for w in own), np.int64, len(own))
                n = np.fromiter(own.values(), np.int64, len(own))
                here = at >= 0
                chars.append(int(n[here] @ lengths[at[here]]))
                sums.append((n[here] @ logs[at[here]]).tolist())
                rest.append([w for w, known in zip(own, here) if not known])
                times.append(n[~here])
            kept = batch.select(["id", "doc_id", "lang", "held_out", "learned"])
            columns = [pa.array(chars, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, "chars", "logs", "rest", "times"])

    return run


def commonest(scores: DataFrame) -> DataFrame:
    """The words to look up inside tasks: all above the least count, in steps of a sixteenth of a power of two, that leaves at most ``COMMON``."""
    short = scores.filter(F.length("word") <= COMMON_CHARS)
    step = F.floor(F.log2("n") * 16)
    steps = short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()  # some hundred at most
    least, total = None, 0
    for row in steps:
        total += row.words
        if total > COMMON:
            break
        least = row.step
    return short.filter(step >= least) if least is not None else short.limit(0)


def entropies(docs: DataFrame, scores: list[DataFrame], size: int) -> DataFrame:
    """The documents with their characters and cross-entropy under every language, null without characters."""
    common = commonest(reduce(DataFrame.unionAll, scores)).collect()
    held = ({r.word: i for i, r in enumerate(common)}, np.array([r.chars for r in common], np.int64), np.array([r.logs for r in common], np.int64).reshape(-1, size))
    kind = f"id long, doc_id {dict(docs.dtypes)['doc_id']}, lang string, held_out boolean, learned boolean, chars long, logs array<long>, rest array<string>, times array<long>"
    parts = docs.withColumn("id", F.monotonically_increasing_id()).mapInArrow(_known_words(docs.sparkSession.sparkContext.broadcast(held), size), kind)
    parts = staged(parts, "language-parts")
    each = parts.select("id", F.explode(F.arrays_zip("rest", "times")).alias("e")).select("id", F.col("e.rest").alias("word"), F.col("e.times").alias("times"))
    own = [F.sum(F.col("times") * F.get("logs", F.lit(i))).alias(f"r{i}") for i in range(size)]
    others = []
    for i, share in enumerate(scores):
        found = each.filter(share_of("word") == i).join(share.select("word", "chars", "logs"), "word")
        others.append(staged(found.groupBy("id").agg(F.sum(F.col("times") * F.col("chars")).alias("more"), *own), "language-others"))
        drop_staged(share)
    other = reduce(DataFrame.unionAll, others).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("more", *[f"r{i}" for i in range(size)])])
    both = parts.drop("rest", "times").join(other, "id", "left")
    chars = F.col("chars") + F.coalesce("more", F.lit(0))
    means = [-(F.get("logs", F.lit(i)) + F.coalesce(f"r{i}", F.lit(0))) / (UNIT * chars) for i in range(size)]
    out = both.select("doc_id", "lang", "held_out", "learned", chars.alias("chars"), F.when(chars > 0, F.array(*means)).alias("entropy"))
    out = staged(out, "language-entropies")
    drop_staged(parts, *others)
    return out


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected and cross-entropy of every document.

    Documents are held out of learning when crc32 of their doc_id is divisible by 5.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    docs = docs.select("doc_id", "text", "lang", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.coalesce(fold != 0, F.lit(False)).alias("learned"))
    langs, scores = word_scores(docs)
    if not langs:
        return docs.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("cross_entropy"))
    scored = entropies(docs, scores, len(langs))

    names = F.array(*[F.lit(x) for x in langs])
    best = F.array_min("entropy")
    guess = F.get(names, F.array_position("entropy", best).cast("int") - 1)
    rows = scored.withColumns({"best": best, "guess": guess})
    own = rows.filter("learned and chars > 0").withColumn("true_entropy", F.get("entropy", F.array_position(names, F.col("lang")).cast("int") - 1))
    # temperature of the posterior, and spread of the cross-entropy of right texts by length
    odds = lambda t: F.aggregate("entropy", F.lit(0.0), lambda s, h: s + F.exp(-t * (h - F.col("best"))))
    loss = [F.avg(F.log(odds(F.lit(t))) + t * (F.col("true_entropy") - F.col("best"))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    losses = own.filter("true_entropy is not null").agg(*loss).first()
    temperature = min(zip(TEMPERATURES, losses), key=lambda x: (x[1] is None, x[1]))[0]
    right = own.filter("guess = lang").groupBy("guess").agg(F.avg("best").alias("mean"), F.coalesce(F.stddev("best"), F.lit(0.0)).alias("sd"), F.avg("chars").alias("usual"))
    limits = {r["guess"]: (r["mean"], r["sd"], r["usual"]) for r in right.collect()}  # one row per language
    table = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.array(*[F.lit(float(y)) for y in v]))]) if limits else F.lit(None).cast("map<string,array<double>>")
    limit = F.element_at(table, F.col("guess"))
    wide = F.greatest(F.lit(1.0), F.sqrt(F.get(limit, F.lit(2)) / F.col("chars")))
    rejected = F.col("best") > F.get(limit, F.lit(0)) + 4 * wide * (F.get(limit, F.lit(1)) + 0.05)
    none = F.col("chars") == 0
    return rows.select(
        "doc_id", "held_out", F.when(none, F.lit("und")).otherwise(F.col("guess")).alias("lang_pred"),
        F.when(none, F.lit(0.0)).otherwise(F.round(1.0 / odds(F.lit(temperature)), 6)).alias("score"),
        F.when(none, F.lit(True)).otherwise(F.coalesce(rejected, F.lit(False))).alias("rejected"), F.col("best").alias("cross_entropy"),
    )
