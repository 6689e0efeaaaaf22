"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are runs of letters, digits and a few marks that stand after an assignment to a name
such as token or password (with any run of blanks around the sign), have the form of a known key
anywhere in the text, or are long mixes of letters and digits.
Features are the length, character classes, how likely the character transitions are in ordinary
words (learned from all documents), how much of the candidate common words of the corpus cover,
the source as path, and the words next to it.  A forest is trained on labelled findings: a table
given by the caller or, without one, findings made from the corpus, where random keys put in the
place of ordinary words after an assignment and keys of a known form put anywhere are secrets and
the corpus's own words, numbers and identifiers found elsewhere are not.

Texts are scanned whole, every candidate is judged.  Null and blank texts have none; rows without
doc_id are scanned alike; repeated rows give repeated findings; no candidates give an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import content_key, scratch, staged, texts_of
from strataframe.session import broadcast_if_small

# fixed values: names that secrets are assigned to, words that mark samples, paths of samples, forms of known keys
NAMES = re.compile(rb"(?i)token|secret|passw|pwd|credential|auth|(api|access|private|encryption|signing)[_-]?key|^key$")
SAMPLES = re.compile(rb"(?i)example|sample|dummy|test|your|placeholder|changeme|xxx|fake|none|null|todo")
SAMPLE_PATHS = re.compile(r"(?i)test|example|fixture|sample|mock|doc")
KNOWN = re.compile(
    rb"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36}(?![0-9A-Za-z])|xox[abprs]-[0-9A-Za-z-]{10,}|sk_(?:live|test)_[0-9A-Za-z]{16,}"
    rb"|eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+){0,2}"
)

OPERATOR = re.compile(rb"[:=]")
NAME_BEFORE = re.compile(rb"([A-Za-z0-9_-]{2,40})[\"']?\s{0,3}$")
VALUE_AFTER = re.compile(rb">?(?:[ \t]*|\s{0,3})[\"']?([^\s\"'<>`,;|]{6,})")
ASSIGNED = re.compile(rb"[:=]>?(?:[ \t]*|\s{0,3})[\"']?$")
LONG = re.compile(rb"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9@])")
KEY_MARK = re.compile(rb"-----(BEGIN|END) [A-Z ]*PRIVATE KEY-----")
WORD = re.compile(rb"[a-z]{3,12}$")
HEX = re.compile(rb"[0-9a-fA-F]+$")

FEATURES = [
    "length", "digits", "capitals", "small", "marks", "hex", "variety", "entropy", "transition", "class_changes", "dictionary",
    "known_form", "sample_word", "named", "assigned", "quoted", "sample_near", "sample_path",
]
# bounds of the labelled sample that the forest is trained on; documents beyond the length serve no training
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_FINDINGS = 1000, 20_000, 12_000
# a common word stands in so many documents at least, and in this share of those of a source, on average over the sources
COMMON_DOCS, COMMON_SHARE, SHARE_UNIT = 3, 0.0005, 10**9


def name_end(text: bytes, at: int) -> int:
    """Where the name before a sign ends: before any run of blanks, and the colon of ``:=``."""
    at -= text[at - 1 : at] == b":"
    while at and text[at - 1] in b" \t":
        at -= 1
    return at


def key_blocks(text: bytes) -> Iterator[tuple[int, int]]:
    """From each mark that begins a key to the next that ends one; one pass, however many marks have no other."""
    start = None
    for m in KEY_MARK.finditer(text):
        if m[1] == b"END" and start is not None:
            yield start, m.end()
            start = None
        elif m[1] == b"BEGIN" and start is None:
            start = m.start()


def characters(text: bytes) -> np.ndarray:
    """How many code points begin before each byte, and before the end."""
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])


def spans(text: bytes) -> list[tuple[int, int, bytes]]:
    """Start, end and the name assigned to (empty if none) of every candidate, in order, not overlapping."""
    found = [(start, end, b"private key") for start, end in key_blocks(text)]
    for m in OPERATOR.finditer(text):
        name = NAME_BEFORE.search(text, max(0, (end := name_end(text, m.start())) - 48), end)
        if name and NAMES.search(name[1]) and (value := VALUE_AFTER.match(text, m.end())):
            found.append((*value.span(1), name[1]))
    known = [m.span() for m in KNOWN.finditer(text)]
    found += [(*k, b"") for k in known]
    at = 0
    for m in LONG.finditer(text):
        start = m.start()
        while at < len(known) and known[at][1] <= start:
            at += 1
        cuts = []  # known keys are candidates of their own, what stands beside them may be another
        for k in range(at, len(known)):
            if known[k][0] >= m.end():
                break
            cuts.append(known[k])
        for first, last in [*cuts, (m.end(), m.end())]:
            own = text[start:first]
            if len(own) >= 16 and (any(c in b"0123456789" for c in own) and not own.isdigit() or not own.islower() and not own.isupper() and len(own) >= 24):
                found.append((start, first, b""))
            start = max(start, last)
    out: list[tuple[int, int, bytes]] = []
    for start, end, name in sorted(found, key=lambda s: (s[0], not s[2], -s[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end, name))
    return out


def coverage(own: bytes, dictionary: frozenset[bytes]) -> float:
    """Share of the letters that common words cover, longest first from the left."""
    low, at, hit = own.lower(), 0, 0
    while at < len(low):
        size = next((k for k in range(min(12, len(low) - at), 2, -1) if low[at : at + k] in dictionary), 0)
        hit += size
        at += size or 1
    return hit / max(1, len(low))


def features(text: bytes, start: int, end: int, name: bytes, source: str, transitions: np.ndarray, dictionary: frozenset[bytes]) -> list[float]:
    own, n = text[start:end], end - start
    codes = np.frombuffer(own, np.uint8)
    kinds = np.array([bytes([c]).isdigit() + 2 * bytes([c]).isupper() + 4 * bytes([c]).islower() for c in own])
    counts = np.array(list(Counter(own).values()))
    before, after = text[max(0, start - 40) : start], text[end : end + 20]
    return [
        math.log(n), float((kinds == 1).mean()), float((kinds == 2).mean()), float((kinds == 4).mean()), float((kinds == 0).mean()),
        float(bool(HEX.match(own))), len(counts) / min(n, 64), float(-(counts / n * np.log2(counts / n)).sum()),
        float(transitions[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0, float((kinds[1:] != kinds[:-1]).mean()) if n > 1 else 0.0,
        coverage(own, dictionary), float(bool(KNOWN.search(own) or name == b"private key")), float(bool(SAMPLES.search(own))),
        float(bool(NAMES.search(name))), float(bool(ASSIGNED.search(before))), float(before[-1:] in (b'"', b"'") and bool(before)),
        float(bool(SAMPLES.search(before)) or bool(SAMPLES.search(after))), float(bool(SAMPLE_PATHS.search(source))),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of adjacent bytes, and by source of documents (key "") and of those that hold each word."""
    for batch in batches:
        pairs, words = np.zeros(65536, np.int64), Counter()
        for text, source in zip(texts_of(batch), batch.column("source").to_pylist()):
            codes = np.frombuffer(text, np.uint8).astype(np.int64)
            pairs += np.bincount(codes[:-1] * 256 + codes[1:], minlength=65536) if len(codes) > 1 else 0
            words[source, ""] += 1
            words.update((source, w.decode()) for w in set(text.lower().split()) if WORD.match(w))
        at = np.nonzero(pairs)[0]
        sources = [None] * len(at) + [source for source, _ in words]
        keys = [f"{k}" for k in at] + [w for _, w in words]
        yield pa.RecordBatch.from_arrays([pa.array(sources, pa.string()), pa.array(keys, pa.string()), pa.array([*pairs[at].tolist(), *words.values()], pa.int64())], names=["source", "key", "n"])


def statistics(docs: DataFrame) -> tuple[np.ndarray, frozenset[bytes]]:
    """Log probabilities of byte transitions and the common words, over all documents; both of bounded size.

    A word is common by the share of documents that hold it, the mean over the sources, so that no source
    rules; as many words as documents hold different ones on average, over ``COMMON_SHARE``, is the most there can be.
    """
    rows = docs.select("text", F.coalesce("source", F.lit("")).alias("source"))
    counts = staged(rows.mapInArrow(_statistics, "source string, key string, n long").groupBy("source", "key").agg(F.sum("n").alias("n")), "secret-statistics")
    table = np.full((256, 256), 0.5)
    for key, n in counts.filter("source is null").select("key", "n").collect():
        table[int(key) // 256, int(key) % 256] += n
    sizes = counts.filter("source is not null and key = ''").select("source", F.col("n").alias("docs"))
    words = counts.filter("source is not null and key <> ''").join(sizes, "source").groupBy("key")
    share = F.expr(f"sum(n * {SHARE_UNIT} div docs)")  # whole numbers: no order of rows changes a sum
    words = words.agg(F.sum("n").alias("n"), share.alias("share"))
    words = words.filter((F.col("n") >= COMMON_DOCS) & (F.col("share") >= int(COMMON_SHARE * SHARE_UNIT) * sizes.count())).select("key").collect()
    return np.log(table / table.sum(axis=1, keepdims=True)), frozenset(r.key.encode() for r in words)


def find(docs: DataFrame, *carry: str, known) -> DataFrame:
    """Every candidate of every document with its place in code points and its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transitions, dictionary = known.value
        for batch in batches:
            at, rows = [], []
            sources = batch.column("source").to_pylist()
            for i, text in enumerate(texts_of(batch)):
                own = spans(text)
                place = characters(text) if own else None
                for start, end, name in own:
                    at.append(i)
                    rows.append((int(place[start]), int(place[end]), name.decode().lower(), features(text, start, end, name, sources[i] or "", transitions, dictionary)))
            kept = batch.select(list(carry)).take(pa.array(at, pa.int32()))
            found = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *found], names=[*carry, "start", "end", "name", "features"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, *[c for c in ("text", "source") if c not in carry]).mapInArrow(run, f"{kinds}, start long, end long, name string, features array<double>")


def planted(texts: list[str], sources: list[str], rng: Random) -> list[tuple[bytes, int, int, bytes, str, float]]:
    """Labelled findings: secrets and look-alikes put between the words of real texts, and what stands there anyway."""
    names = ["token", "secret", "password", "api_key", "API_KEY", "auth_token", "TOKEN", "client_secret", "access_key", "pwd"]
    forms = [' = "{}"', "={}", ": {}", " = '{}'", ': "{}"', '        = "{}"', ":            {}", "\t\t=\t{}"]
    places = ["{}", '"{}"', "GITHUB_PAT={}", "STRIPE={}", "https://host/?k={}", "id: {}", "({})", "https://host/v1/{}/x"]  # of known keys
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    low, hexa, wide = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    out = []
    for text, source in zip(texts, sources):
        words = text.split(" ")
        some = [w for w in words if w.isalpha()] or ["word"]
        key = rng.choice([draw(hexa, rng.choice([24, 32, 40, 40, 64])), draw(wide, rng.randint(16, 48)), draw(wide + "!$%", rng.randint(8, 16)), draw(wide + "+/", 40), "AKIA" + draw(wide[:26] + wide[-10:], 16), "ghp_" + draw(wide, 36)])
        key = key.upper() if rng.random() < 0.15 else key
        form = rng.choice(["AKIA" + draw(wide[:26] + wide[-10:], 16), "ghp_" + draw(wide, 36), "sk_live_" + draw(wide, rng.randint(16, 32)), "xoxb-" + draw("0123456789", 11) + "-" + draw(wide, 24), "eyJ" + draw(wide, 30) + "." + draw(wide, 40)])
        value, named = [
            *[(key, rng.choice(names))] * 5,
            (rng.choice(["changeme", "your_token_here", "xxxxxxxxxxxx", "placeholder", "example-secret", "none-set", "${API_KEY}"]), rng.choice(names)),
            ("".join(rng.sample(some, min(3, len(some)))), rng.choice(names)),
            ("_".join(rng.choice(some).lower() for _ in range(3)) + draw("0123456789", 2), rng.choice(names + ["", ""])),
            (rng.choice(some) * 2 + draw("0123456789", 3), ""), (draw(hexa, rng.choice([32, 40, 64])), rng.choice(["commit", "sha256", "digest", "revision", ""])),
            (f"{draw(hexa, 8)}-{draw(hexa, 4)}-{draw(hexa, 4)}-{draw(hexa, 4)}-{draw(hexa, 12)}", rng.choice(["", "id", "request"])),
            (draw("0123456789", rng.randint(16, 24)) + draw(low, 1), ""), ("/".join(rng.choice(some) for _ in range(4)) + "/v2", ""),
            (form, ""), (form, rng.choice(names)),
        ][rng.randrange(15)]
        secret = value == form or value == key and bool(named)
        shown = (named + rng.choice(forms).format(value)) if named else rng.choice(places).format(value) if value == form else value
        place = rng.randint(0, len(words))
        start = len(" ".join(words[:place]).encode()) + (place > 0) + len(shown[: shown.rindex(value)].encode())
        whole = " ".join([*words[:place], shown, *words[place:]]).encode()
        for a, b, name in spans(whole):
            if a < start + len(value) and b > start:
                out.append((whole, a, b, name, source, float(secret)))
            elif not NAMES.search(name) and not KNOWN.search(whole[a:b]):
                out.append((whole, a, b, name, source, 0.0))
    return out


def train(findings: DataFrame, trees: int = 40, seed: int = 0) -> RandomForestClassificationModel:
    """A forest from labelled findings (features, label)."""
    points = findings.select(array_to_vector("features").alias("vector"), "label")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=8, minInstancesPerNode=2, seed=seed, maxMemoryInMB=512)
    return forest.fit(points)


def labelled(docs: DataFrame, known, seed: int = 0) -> DataFrame:
    """Findings for training from at most ``SAMPLE_DOCS`` documents, those whose texts hash lowest."""
    usable = docs.filter(F.length("text").between(1, SAMPLE_CHARS))
    low = usable.select("text", F.coalesce("source", F.lit("")).alias("source"), F.xxhash64("text").alias("h"))
    last = low.select("h").orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]  # hashes alone first: texts are large
    rows = low.filter(F.col("h") <= F.lit(last)).orderBy("h", "source", "text").limit(SAMPLE_DOCS).collect()
    transitions, dictionary = known.value
    times = max(4, -(-4 * SAMPLE_DOCS // max(1, len(rows))))  # few documents are used more often
    found = planted([r.text for r in rows] * times, [r.source for r in rows] * times, Random(seed))[:SAMPLE_FINDINGS]
    found = found or planted(["a text of plain words"] * SAMPLE_DOCS, [""] * SAMPLE_DOCS, Random(seed))
    data = [(features(*f[:5], transitions, dictionary), f[5]) for f in found]
    return docs.sparkSession.createDataFrame(data, "features array<double>, label double").coalesce(1)


def scan(docs: DataFrame, *carry: str, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``carry``, start, end, name, score and verdict of every candidate of every document."""
    known = docs.sparkSession.sparkContext.broadcast(statistics(docs))
    model = train(findings if findings is not None else labelled(docs, known))
    found = find(docs, *carry, known=known).withColumn("vector", array_to_vector("features"))
    score = F.round(F.get(vector_to_array("probability"), F.lit(1)), 6)
    scored = model.transform(found).select(*carry, "start", "end", "name", score.alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= threshold)


MARK = "[SECRET]"


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by a mark; n_chars follows the text."""
    key = content_key("source", "text")  # a verdict depends on these alone, so copies share theirs
    with scratch() as held:
        found = scan(docs.select(key.alias("key"), "text", "source"), "key").filter("is_secret")
        secrets = held.keep(staged(found.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cuts")), "secret-cuts"))
    # one piece before each secret and one after the last
    cut = F.aggregate(
        "cuts", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.substring("text", (s["at"] + 1).cast("int"), (c["start"] - s["at"]).cast("int")), F.lit(MARK)).alias("out"), c["end"].alias("at")
        ),
    )
    marked = docs.select(key.alias("key"), F.struct(*docs.columns).alias("doc"), "text").join(broadcast_if_small(secrets), "key", "left")
    marked = marked.withColumn("state", F.when(F.col("cuts").isNotNull(), cut))
    text = F.coalesce(F.concat("state.out", F.substring("text", (F.col("state.at") + 1).cast("int"), F.lit(2147483647))), F.col("text"))
    new = {"text": text, "n_chars": F.when(F.col("cuts").isNull(), F.col("doc.n_chars")).otherwise(F.length(text).cast("long"))}
    return marked.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
