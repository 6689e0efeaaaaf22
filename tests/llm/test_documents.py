"""Operators over documents: edge cases, and brute force on a small table."""

import random
from array import array
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import groupby
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strataframe.llm import bpe, common, jaccard, language_id, licenses, mixing, quality, secret_scan, substrings
from strataframe.session import shared_dir

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, words long, id string, n string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
RUN = " ".join(f"w{i}" for i in range(60))
EDGES = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "a"), (4, "one two", "en", "a"), (5, "one two", "en", "a"), (5, "one two", "en", "a"),
    (6, LONG, "en", "b"), (7, LONG + " end", None, None), (None, "a text without a number that is long enough to count", "en", "b"),
    (8, RUN, "fr", "b"), (9, "before " + RUN + " after", "fr", "b"), (10, "éà   x\x0by", "fr", "\x00"), (11, "All Rights Reserved. CC BY", "en", "a"),
    (12, 'token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"', "en", "a"),
]


def brute_jaccard(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders, common = defaultdict(list), Counter()
    for i in sorted(sets):
        for s in sets[i]:
            common.update((j, i) for j in holders[s])
            holders[s].append(i)
    for (a, b), n in common.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def brute_substrings(rows):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        out[i] = (len(w), len(gone), sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, None, None, "x", "y") for r in EDGES], COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def small():
    return duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_quality_counts_against_brute_force(spark, documents, small, edges):
    for frame, rows in ((documents, [(r[0], r[1]) for r in small]), (edges.filter("doc_id is not null"), [(r[0], r[1]) for r in EDGES if r[0] is not None])):
        got = {r.doc_id: r for r in quality.base_rules(frame, "doc_id").collect()}
        for i, text in rows:
            text = text or ""
            w = text.encode().split()
            seen, covered = Counter(zip(w, w[1:], w[2:])), set()
            for k in range(len(w) - 2):
                if seen[tuple(w[k : k + 3])] > 1:
                    covered.update((k, k + 1, k + 2))
            lines = [x for x in text.split("\n") if x.encode().split()]
            want = (len(w), len(b"".join(w).decode()), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))
            r = got[i]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_keeps_good_rejects_junk(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.quality_rules(docs, "doc_id").join(labels, "doc_id").filter("not base_failed").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in judged}
    assert counts.get((1, False), 0) == 0
    assert counts.get((0, False), 0) > 20 * counts.get((0, True), 0)


def test_quality_edges(edges, empty):
    out = quality.quality_rules(edges, "doc_id").collect()
    assert len(out) == len(EDGES)
    assert not any(r.kept and r.base_failed for r in out)
    assert quality.quality_rules(empty, "doc_id").count() == 0


def test_jaccard_brute_force(spark, documents, small):
    want = brute_jaccard([r[:2] for r in small])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(documents).collect()} == want


def test_jaccard_small_sets_and_groups(spark):
    rng = random.Random(3)
    rows = []
    for group in range(12):
        base = [f"g{group}x{k}" for k in range(rng.choice([2, 3, 4, 6, 9, 12, 20, 30, 45, 80, 120]))]
        for _ in range(9):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(["z", "y", f"u{rng.randrange(99)}"])
            rows.append((len(rows), " ".join(words + ["tail"] * rng.randint(0, 1))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame).collect()} == brute_jaccard(rows)


def test_jaccard_bounds():
    for s in range(1, 130):
        for t in range(s, 130):
            need = jaccard.overlap(s, t)
            assert all((100 * o >= 85 * (s + t - o)) == (o >= need) for o in range(s + 1))
            if need <= s:
                assert jaccard.prefix(s) >= s - need + 1
                assert t > 39 or need in jaccard.subset_sizes(s, 40) and need in jaccard.subset_sizes(t, 40)


def test_jaccard_edges(edges, empty):
    out = jaccard.jaccard_components(edges).collect()
    assert len(out) == len(EDGES)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[4] == (1, 4) and by_id[5] == (1, 4) and by_id[7][1] == 6 and by_id[None][1] is None
    assert jaccard.jaccard_components(empty).count() == 0


def test_substrings_brute_force(documents, small):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_dedup(documents).collect()}
    assert got == brute_substrings([r[:2] for r in small])


def test_substrings_edges(edges, empty):
    out = substrings.substring_dedup(edges).collect()
    assert len(out) == len(EDGES)
    want = brute_substrings([r[:2] for r in EDGES if r[0] is not None])
    for r in out:
        assert r.doc_id is None or (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
    assert substrings.substring_dedup(empty).count() == 0


def test_substrings_same_id_other_text(spark):
    rows = [(1, RUN), (2, RUN + " tail"), (2, "head " + RUN), (2, "head " + RUN)]
    out = substrings.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in out) == [(1, 60, 0), (2, 61, 60), (2, 61, 60), (2, 61, 60)]


def encoder():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return bpe.Encoder(file.read(), public_tokenizers.PATTERN)


def test_bpe_equals_the_library():
    own = encoder()
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["", " ", "a" * 5000, "  x", "x  ", " \n x", "don't 're", "<|endoftext|>"]
    for _ in range(3000):
        letters = rng.choice(["ab ", "the \n", "éèa \t", "日本 🙂", "a\x1c\x85  ", "012 ,.", "AbC'sd "])
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))))
    for text in texts:
        ids = own.encode(text)
        assert ids == array("I", other.encode_ordinary(text)).tobytes()
        assert own.decode(ids) == text.encode()


def test_bpe_adjacency_is_what_merges_leave():
    own, rng = encoder(), random.Random(1)
    tokens = list(own.ranks.values())
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens[:2000])
        assert own.compatible(a, b) == (bpe.merged(own.bytes_of[a] + own.bytes_of[b], own.ranks) == [a, b])


def test_bpe_edges(edges, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    out = bpe.encode_documents(edges, "doc_id", vocabulary=path, pattern=pattern).collect()
    texts = Counter((r[0], (r[1] or "").encode()) for r in EDGES)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in out) == texts
    assert bpe.encode_documents(empty, "doc_id", vocabulary=path, pattern=pattern).count() == 0


def test_mixing_targets():
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    assert mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    sizes = [1, 1000, 5, 300, 0, 70]
    goal = mixing.targets(sizes)
    assert sum(goal) == pytest.approx(sum(sizes)) and all(g <= 3 * s + 1e-9 for g, s in zip(goal, sizes))
    quotas = mixing.split_quotas([1000, 1, 0, 77], 7, 1)
    assert quotas.sum(axis=0).tolist() == [1000, 1, 0, 77]
    assert quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= 2


def test_mixing(documents, edges, empty):
    out = mixing.mixed_sizes(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    again = mixing.mixed_sizes(documents.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    taken, target = Counter(), {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS for s in target)
    got = mixing.mixed_sizes(edges).collect()
    assert len(got) == len(EDGES) and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mixed_sizes(empty).count() == 0


def test_mixed_text_is_what_was_taken(documents, empty):
    words = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(F.size(mixing.words_of(F.col("text")))).alias("n")).collect()}
    sizes = mixing.mixed_sizes(documents).join(documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("n"))
    mixed = mixing.mixed_documents(documents)
    assert words(mixed) == {r.source: r.n for r in sizes.collect()}
    assert mixed.columns == documents.columns and mixed.filter("n_chars <> length(text)").count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_secrets(documents, edges, empty, spark):
    out = secret_scan.scan(edges, "doc_id").collect()
    assert [(r.doc_id, r.start, r.end, r.is_secret) for r in out if r.doc_id == 12] == [(12, 9, 49, True)]
    clean = secret_scan.redacted(documents)
    assert clean.count() == documents.count() and clean.columns == documents.columns
    assert clean.filter("lower(text) rlike 'token = \"[0-9a-f]{40}'").count() == 0
    assert documents.filter("not lower(text) rlike 'token = '").exceptAll(clean).count() == 0
    assert secret_scan.scan(empty, "doc_id").count() == 0


def test_secret_forest_on_held_out_findings(documents):
    known = documents.sparkSession.sparkContext.broadcast(secret_scan.statistics(documents))
    model = secret_scan.train(secret_scan.labelled(documents, known, seed=1))
    held = model.transform(secret_scan.labelled(documents, known, seed=2).withColumn("vector", secret_scan.array_to_vector("features")))
    right = held.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.95


def test_secret_look_alikes():
    text = b"commit 1c2d3e4f5a6b7c8d9e0f1a2b3c4d5e6f7a8b9c0d sha token: changeme, mail a1234567890123456789@example.com 12345678901234567890"
    found = [text[a:b] for a, b, _ in secret_scan.spans(text)]
    assert b"changeme" in found and not any(b"example.com" in f or f.isdigit() for f in found)


def test_licenses(spark, edges, empty):
    rows = [
        (1, "x\nLicensed under the Apache License, Version 2.0."), (2, "Licensed under CC BY-NC 4.0."), (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "RELEASED under the MIT License! All rights reserved"), (5, "the apache tribe has a license, version unknown"), (6, "cc by cc by ALL RIGHTS RESERVED"),
        (7, "worK licensed under the mitK license"),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    assert [got[i].labels for i in range(1, 8)] == ["apache-2.0", "cc-by,cc-by-nc-4.0", "gpl,gpl-3.0", "mit,reserved", "", "cc-by,reserved", ""]
    assert (got[6].n_words, got[6].n_base, got[6].first_word, got[6].last_word, got[6].base_labels) == (7, 3, 0, 4, "cc-by,reserved")
    assert got[5].score == 0.0 and got[1].score == 1.0 and got[5].first_word is None
    out = {r.doc_id: r for r in licenses.license_scan(edges, "doc_id").collect()}
    assert out[1].n_words == 0 and out[11].base_labels == "cc-by,reserved"
    assert licenses.license_scan(empty, "doc_id").count() == 0


def test_language(spark, edges, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97
    got = {r.doc_id: r for r in language_id.identify(edges).collect()}
    assert got[1].lang_pred == "und" and got[1].score == 0.0 and got[3].lang_pred == "und"
    assert {r.lang_pred for r in got.values()} <= {"en", "fr", "und"} and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(empty).count() == 0


def test_kneser_ney_sums_to_one():
    import numpy as np

    tokens = np.array(["banana", "bandana", "nab", "an"], object)
    found, of = language_id.grams(tokens)
    keys, n = np.unique(found, return_counts=True)
    model = language_id.KneserNey(keys, n)
    for context in ([], ["a"], ["b", "a"], ["a", "n"], ["q"]):
        packed = 0
        for c in context:
            packed = packed << language_id.BITS | int(language_id.letter_ids()[ord(c)])
        every = np.arange(language_id.LETTERS) | packed << language_id.BITS
        assert np.exp(model.log(every, len(context) + 1)).sum() == pytest.approx(1.0, abs=1e-6)


def test_language_counts_every_gram(spark):
    """More than 100,000 different 5-grams of a language, compared with models in memory that hold all of them."""
    rng = random.Random(5)
    rows = []
    for i in range(240):
        lang = ("aa", "bb")[i % 2]
        letters = "abcdefghijklmnopqrstuvwxyz" if lang == "aa" else "klmnopqrstuvwxyz\u4e00\u4e01\u4e02"
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(300)]
        rows.append((i, " ".join(words) + " Common, words! x\u00b2y", lang))
    rows += [(1000, "zzqqj \u0416\u0416", None), (1001, "  12 ", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    models = {}
    for lang in ("aa", "bb"):
        texts = [t for i, t, x in rows if x == lang and not got[i].held_out]
        keys, n = np.unique(language_id.grams(np.array([w for t in texts for w in t.split()], object))[0], return_counts=True)
        models[lang] = language_id.KneserNey(keys, n)
    assert len(models["aa"].keys[language_id.ORDER]) > 100_000
    for i, text, _ in rows:
        found, _of = language_id.grams(np.array(text.split(), object))
        if not len(found):
            assert got[i].lang_pred == "und" and got[i].cross_entropy is None
            continue
        want = {lang: -m.log(found, language_id.ORDER).mean() for lang, m in models.items()}
        assert got[i].lang_pred == min(want, key=want.get)
        assert got[i].cross_entropy == pytest.approx(min(want.values()), abs=1e-6)


def test_language_disk(spark, monkeypatch):
    """Words that are nearly all different: the shuffles of one step and all staged tables beside them, against the texts."""
    rng = random.Random(7)
    syllables = [a + b for a in "bdfgklmnpr" for b in "aeou"]
    rows = [(i, " ".join("".join(rng.choice(syllables[i % 2 :: 2]) for _ in range(5)) for _ in range(200)), ("aa", "bb")[i % 2]) for i in range(300)]
    monkeypatch.setattr(language_id, "COMMON", 100)
    monkeypatch.setattr(common, "SHUFFLE_CLEANUP", "strataframe.test.shuffles.stay")
    shuffles = [str(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    stored = [shared_dir(spark)]
    size = lambda folders: sum(f.stat().st_size for x in folders for f in Path(x).rglob("*") if f.suffix in (".data", ".parquet"))
    start, disk = size(stored), []

    def measured(df, name):
        before = size(shuffles)
        held = common.staged(df, name)
        disk.append(size(shuffles) - before + size(stored) - start)
        return held

    monkeypatch.setattr(language_id, "staged", measured)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 300 and all(r.lang_pred == rows[r.doc_id][2] for r in got)
    assert max(disk) < 13 * sum(len(text) for _, text, _ in rows)  # 19.1 times with all words in one pass


def test_letter_words():
    """Runs of letters at every place where a text may break, against a test of each character."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for text in ("", " 1_", "x\u00b2y \u0130 \u03a3\u03a3\u0345\u2167z", "a" + "b".join(points) + "".join(points)):
        want = ["".join(run) for letters, run in groupby(text.lower(), str.isalpha) if letters]
        assert list(language_id.letter_words(text)) == want


def test_jaccard_width_and_percent(spark):
    rng = random.Random(8)
    rows = []
    for size in (2, 5, 9, 14, 25, 40, 90, 300):
        base = [f"s{size}w{k}" for k in range(size)]
        for extra in (0, 0.05, 0.18, 0.2, 0.22, 0.25, 0.4):
            words = base + [f"n{rng.randrange(10**9)}" for _ in range(round(extra * size))]
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "z"
            rows.append((len(rows), " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {}
    for width, percent in ((5, 80), (3, 60)):
        sets = {i: frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) for i, w in ((i, t.split()) for i, t in rows)}
        up = dict(zip(sets, sets))
        for a in sets:
            for b in range(a):
                n = len(sets[a] & sets[b])
                if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = up[a], up[b]
                    up = {i: min(x, y) if g in (x, y) else g for i, g in up.items()}
        out[width] = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame, width, percent).collect()}
        assert out[width] == {i: (len(sets[i]), up[i]) for i in sets}
    assert len({c for _, c in out[5].values()}) < len({r.component_id for r in jaccard.jaccard_components(frame).collect()})


GITHUB, AWS, STRIPE = "ghp_" + "aB3dE5gH7j" * 3 + "kL9mN1", "AKIA" + "Q7XK2ZP9LM4RT8VW", "sk_" + "live_" + "4eC39HqLyjWDarjtT1zdp7dc"


@pytest.mark.parametrize("text, secret", [
    ('db_password            = "S3cretPass!"', "S3cretPass!"), ("password:          S3cretPass!", "S3cretPass!"), ("api_key\t\t\t\t:=\t\t\t\tS3cretPass!", "S3cretPass!"),
    (f"GITHUB_PAT={GITHUB}", GITHUB), (f"STRIPE={STRIPE}", STRIPE), (f"https://host/path?k={AWS}&x=1", AWS), (f"https://host/{GITHUB}/x", GITHUB),
    (f"see user@{AWS}.", AWS), (f"key {AWS}/wJalrXUtnFEMI9K7MDENGabPxRfiCY", AWS), (f"key {AWS}/wJalrXUtnFEMI9K7MDENGabPxRfiCY", "/wJalrXUtnFEMI9K7MDENGabPxRfiCY"),
])
def test_secret_candidates_anywhere(text, secret):
    whole = text.encode()
    assert secret.encode() in [whole[a:b] for a, b, _ in secret_scan.spans(whole)]


def test_bare_and_aligned_secrets_are_found(spark, documents):
    texts = [f"GITHUB_PAT={GITHUB}", f"we saw {AWS} there", f"https://host/path?k={AWS}&x=1", f"STRIPE={STRIPE}", f'api_key            = "{GITHUB}"']
    docs = documents.select("doc_id", "text", "source").union(spark.createDataFrame([(10**6 + i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    found = secret_scan.scan(docs, "doc_id").filter("doc_id >= 1000000 and is_secret")
    assert {r.doc_id - 10**6 for r in found.collect()} == set(range(len(texts)))


def test_secret_dictionary_of_all_documents(spark):
    rows = [(f"common{chr(97 + i % 26)} rarely" if i < 3 else f"common{chr(97 + i % 26)} filler", ("a", "b", None)[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, source string")
    (pairs, words), (pairs_of_small, of_small) = (secret_scan.statistics(docs.repartition(n)) for n in (1, 40))
    assert words == of_small and (pairs == pairs_of_small).all() and b"rarely" in words and b"filler" in words and b"commona" in words
    own = b"9" * 450 + b"filler" * 20
    got = secret_scan.features(own, 0, len(own), b"", "", pairs, words)
    assert got[secret_scan.FEATURES.index("dictionary")] == pytest.approx(120 / 570)


def brute_licenses(text, templates):
    import re

    words = [w for w in re.split(licenses.NOT_WORD, (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    found, base = set(), []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    for t in templates:
        own = t.text.split()
        keys = [(next(i for i in range(len(own)) if own[i : i + len(p.split())] == p.split()), p.split()) for p in t.phrases]
        for start in range(-len(own), len(words)):
            if all(start + first >= 0 and words[start + first : start + first + len(p)] == p for first, p in keys):
                found.add(t.label)
    return len(words), len(base), ",".join(sorted({x for _, x in base})), ",".join(sorted(found | {x for _, x in base}))


MENTIONS = ["MIT License", "Apache License, Version 2.0", "CC0 1.0", "Mozilla Public License 2.0", "CC BY-SA 4.0", "SPDX-License-Identifier: GPL-3.0", "any later version", "Eclipse Public License", None, "", " . "]


def test_license_labels_by_brute_force(spark, sf_dir):
    """Every key phrase alone is labelled, and no label of a row depends on the other rows."""
    phrases = [p for t in licenses.TEMPLATES for p in t.phrases]
    own = [*MENTIONS, *phrases, " ".join(phrases), "license mit", "x " * 50 + "cc by 4 0 cc by nc 4 0", *[t.text.upper() for t in licenses.TEMPLATES]]
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    common = ["cc by sa 4 0 license mit version universal domain dedication mozilla public boost"] * 300
    for texts in (own, own + docs, own + common):
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, words string, hits int")
        got = {r.doc_id: (r.n_words, r.n_base, r.base_labels, r.labels) for r in licenses.license_scan(df, "doc_id").collect()}
        assert got == {i: brute_licenses(t, licenses.TEMPLATES) for i, t in enumerate(texts)}
    assert all("mit" in brute_licenses(t, licenses.TEMPLATES)[3] for t in MENTIONS[:1])


def test_license_templates_are_an_argument(spark):
    own = (licenses.Template("word", "solo", ("solo",)), licenses.Template("pair", "one two three four", ("one two", "four")))
    df = spark.createDataFrame([(0, "solo"), (1, "one two 3 four"), (2, "one two three"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(df, "doc_id", templates=own).collect()}
    assert got == {0: ("word", 1.0), 1: ("pair", 0.75), 2: ("", 0.0), 3: ("", 0.0)}


def test_quality_groups_lean_on_their_language(spark):
    """Moments of a group, its language and all rows are mixed by size; no number of rows switches."""
    names = ["n", *[f"s{i}" for i in range(quality.D)], *[f"p{i}{j}" for i, j in quality.PAIRS]]
    sums = {"*": [1000.0] + [3000.0] * 20, "=en": [400.0] + [800.0] * 20, "=de": [1.0] + [9.0] * 20, "=en\x00=web": [390.0] + [780.0] * 20, "=en\x00-": [10.0] + [100.0] * 20, "=de\x00=web": [1.0] + [9.0] * 20}
    table = spark.createDataFrame([(k, *v) for k, v in sums.items()], "key string, " + ", ".join(f"{c} double" for c in names))
    got = {r.key: (r.n, r.s0, r.p44) for r in quality._mixed_down(table).collect()}
    p = quality.PRIOR_ROWS
    en = 800 + p * 3.0
    assert got["*"] == (1000, 3000, 3000) and got["=en"] == (400 + p, en, en) and np.isclose(got["=de"][1], 9 + p * 3.0)
    assert np.isclose(got["=en\x00=web"][1], 780 + p * en / (400 + p)) and np.isclose(got["=en\x00-"][1], 100 + p * en / (400 + p))
    assert np.isclose(got["=de\x00=web"][1] / got["=de\x00=web"][0], 3, atol=0.1) and len(got) == 6


def test_encoder_forgets_words_that_stand_once():
    own = encoder()
    once = [own.encode(f"a zq{i}x zebra") for i in range(2_000)]
    assert "zebra" in own.words and len(own.words) < 50
    assert once == [own.encode(f"a zq{i}x zebra") for i in range(2_000)]
