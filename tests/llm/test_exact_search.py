"""Exact top-k, hard negatives and the prefix trie against brute force, with nulls, ties, copies and empty tables."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataframe.llm import hard_negatives as hn
from strataframe.llm import prefix_trie as pt
from strataframe.llm import va_file, vectors
from strataframe.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, rank int, query_id string, v string, class int, score double"
EXTRA = (7, "x", "y", 3, 1.5)


def made(seed=0):
    """Copies of one vector, ties, a zero vector, repeated rows, ids with two vectors, unusable rows, other lengths."""
    rng = np.random.default_rng(seed)
    out = [(i, [round(float(x), 2) for x in rng.normal(0, 0.1, 6)], int(rng.integers(0, 3))) for i in range(160)]
    out += [(i, [0.5, -0.25, 0.125, 0.0, 0.3, 0.1], 1) for i in range(200, 300)]
    out += [(i, [0.0] * 6, 2) for i in range(300, 306)]
    out += [(i, [float(i % 3), 1.0], i % 2) for i in range(400, 430)] + [(500, [], 0), (600, [], 0)]
    out += [out[0], out[0], (20, [0.4] * 6, 1), (40, [0.9] + [0.0] * 5, 0), (41, out[41][1], 2)]
    out += [(700, None, 1), (None, [0.1] * 6, 1), (720, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (740, [float("nan")] * 6, 1), (760, [math.inf] * 6, 0), (100, [0.2] * 6, None)]
    return [(*r, *EXTRA) for r in out]


def usable(table, scale):
    out = set()
    for i, v, label, *_ in table:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.add((i, label, tuple(math.floor(float(np.float32(x)) * scale) for x in v)))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.fixture
def small_blocks(monkeypatch):
    for module in (vectors, va_file, hn):
        for name, size in (("QUERY_BLOCK", 8), ("ROW_BLOCK", 64), ("TILE", 5)):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, size)


@pytest.mark.parametrize("cells", [3, 64])
def test_top_products(spark, small_blocks, monkeypatch, cells):
    monkeypatch.setattr(va_file, "CELLS", cells)
    table = made()
    found = va_file.top_products(spark.createDataFrame(table, VECTORS), F.col("vec_id") % 20 == 0, k=7)
    own = {(i, v) for i, _, v in usable(table, 64)}
    best = defaultdict(dict)
    for q, a in own:
        for i, b in own:
            if q % 20 == 0 and i != q and len(a) == len(b):
                best[q][i] = max(best[q].get(i, -(2**62)), dot(a, b))
    want = [(q, n + 1, i, s) for q, scores in best.items() for n, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:7])]
    assert rows(found) == sorted(want, key=repr)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, low = rng.integers(-9, 9, (5, 4)), rng.integers(-9, 5, (7, 4))
    high = low + rng.integers(0, 4, (7, 4))
    x = rng.integers(low, high + 1)
    lower, upper = va_file.bounds(q, low, high)
    assert (lower <= q @ x.T).all() and (q @ x.T <= upper).all()
    lower, upper = va_file.bounds(q, x, x)
    assert (lower == upper).all()


def test_residue_products():
    rng = np.random.default_rng(2)
    for most, d in ((3, 5), (200, 64), (20_000, 1_500), (500_000, 40)):
        a, b = rng.integers(-most, most + 1, (4, d)), rng.integers(-most, most + 1, (9, d))
        a[0], b[0] = most, -most
        assert (hn.Scores(a, b).of(0, 4) == a @ b.T).all()
    with pytest.raises(OverflowError):
        hn.Scores(np.full((1, 2), 2**27), np.full((1, 2), 2**27))


def test_hard_negatives(spark, small_blocks):
    table = made(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hn.hard_negatives(spark.createDataFrame(table, VECTORS), F.col("vec_id") % 20 == 0, label)
    own = {(i, (x + 1) % 10 if i % 7 == 0 else x, v) for i, x, v in usable(table, 256) if x is not None}
    want = []
    for a, mine, v in own:
        if a % 20:
            continue
        scored = [(-dot(v, w), i, x) for i, x, w in own if len(v) == len(w)]
        for p, positive, _ in sorted(s for s in scored if s[2] == mine and s[1] != a)[:5]:
            fits = sorted(s for s in scored if s[2] != mine and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            want += [(a, positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(fits)]
    assert want and rows(found) == sorted(want, key=repr)


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, place int, n_convs int"


def brute_trie(table):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in table:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"0:{len(role)}:{role}{text}".encode()).hexdigest()
            low = int(mark[16:32], 16)
            turns[c].append((turn is not None, turn or 0, role, int(mark[:15], 16), low - (low >> 63 << 64), text))
    turns = {c: [(t[2], t[5]) for t in sorted(own)] for c, own in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    out, inner = [], {n[:-1] for n in members if n}
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if n not in inner]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), sum(len(n) == len(node) + 1 for n in below), len(leaves), saved, digest))
    return sorted(out, key=repr)


def conversations():
    table = []
    for c in range(-12, 60):
        if c % 7 != 3:  # some bases are missing
            table += [(c, t, "user" if t % 2 else None, f"é{c % 5 if t > 2 else 'same'} {t % 3}") for t in range(abs(c) % 12)]
    table += [(100 + 5 * i, t, "user", "copy " * t) for i in range(40) for t in range(11)]
    table += [(1_000, t, "user", "long " + str(t)) for t in range(300)]
    table += [(2_000, None, "b", "x"), (2_000, None, "a", None), (2_000, 3, "a", "y"), (2_000, 3, "a", "z"), (2_000, 3, "a", "z"), (2_001, -5, "a", "z" * 20_000)]
    table += [(None, 1, "user", "nobody"), (None, None, None, None)]
    return [(*r, "d", 1, 2) for r in table]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_prefix_trie(spark, monkeypatch, partitions):
    monkeypatch.setattr(pt, "PIECE", 7)
    table = conversations()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the long conversation spreads over partitions
    try:
        assert rows(pt.prefix_trie(spark.createDataFrame(table, CONVERSATIONS))) == brute_trie(table)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trie_notices_equal_fingerprints(spark, monkeypatch):
    real = pt.base_of
    monkeypatch.setattr(pt, "base_of", lambda seed: 1 if seed == 0 else real(seed))  # sums: the order of turns is lost
    table = [(c, t, "user", text, "", 0, 0) for c, own in ((5, "ab"), (10, "ba"), (15, "ab")) for t, text in enumerate(own)]
    assert rows(pt.prefix_trie(spark.createDataFrame(table, CONVERSATIONS))) == brute_trie(table)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_exact_top_k", "op13_hard_negatives"])
def test_empty(spark, tmp_path, name):
    for table, schema in (("embeddings", VECTORS), ("conversations", CONVERSATIONS)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert rows(QUERIES[name](spark, str(tmp_path))) == []
