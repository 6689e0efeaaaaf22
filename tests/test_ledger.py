"""Loads committed by their ledger entry, upserts by micro-batch, keys without collisions, exact quantiles by radix."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataframe.operators import aggregate as ag
from strataframe.operators.keys import hash_keys
from strataframe.sources.ledger import Ledger, UpsertLog, upsert_stream
from strataframe.streaming.arrival import arriving_files
from strataframe.workload import quality_queries

SCHEMA = "id long, v string"


def test_marks_and_repeated_loads(spark, tmp_path):
    loads = Ledger(spark, str(tmp_path / "t"), SCHEMA, "id").create()
    assert loads.read().columns == ["id", "v", "batch"] and loads.read().isEmpty() and loads.last_mark() is None
    source = spark.createDataFrame([(i, f"v{i}") for i in range(10)], SCHEMA)
    assert loads.append_new("a", source.filter("id < 4")) and loads.last_mark() == 3
    assert loads.append_new("b", source) and loads.last_mark() == 9
    assert not loads.append_new("b", source.withColumn("id", F.col("id") + 100))
    assert loads.append_new("c", source) and loads.last_mark() == 9  # nothing new
    assert Ledger(spark, str(tmp_path / "t"), SCHEMA, "id").create().last_mark() == 9
    assert rows(loads.read()) == sorted([(i, f"v{i}", 1 if i < 4 else 2) for i in range(10)], key=repr)
    assert [(e.name, e.rows) for e in loads.live()] == [("a", 4), ("b", 6), ("c", 0)]


def test_a_crash_before_the_entry_repeats_safely(spark, tmp_path, monkeypatch):
    loads = Ledger(spark, str(tmp_path / "t"), SCHEMA, "id").create()
    loads.append_new("a", spark.createDataFrame([(1, "x")], SCHEMA))
    more = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], SCHEMA)

    def dies(self, entry):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Ledger, "_enter", dies)
        with pytest.raises(OSError):
            loads.append_new("b", more)
    assert rows(loads.read().drop("batch")) == [(1, "x")] and loads.last_mark() == 1
    assert loads.append_new("b", more)
    assert rows(loads.read().drop("batch")) == [(1, "x"), (2, "y"), (3, "z")]


def test_upserts_of_a_stream(spark, tmp_path):
    schema = "k long, at long, v string"
    landing, batches = tmp_path / "in", []

    def land(name, table):
        spark.createDataFrame(table, schema).coalesce(1).write.parquet(str(landing / name))

    log = UpsertLog(Ledger(spark, str(tmp_path / "log"), schema).create(), "k", "at")
    run = lambda after=None: upsert_stream(arriving_files(spark, str(landing / "*"), schema, max_files=1), log, str(tmp_path / "check"), after)
    land("one", [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    run(batches.append)
    land("two", [(1, 2, "c"), (3, 1, "d"), (2, 0, "late")])

    def dies(name):
        raise RuntimeError("after the entry, before the checkpoint")

    with pytest.raises(Exception, match="after the entry"):
        run(dies)
    want = [(1, 2, "c"), (2, 1, "b"), (3, 1, "d"), (None, 1, "n")]
    assert rows(log.current()) == sorted(want, key=repr)
    run(batches.append)  # the batch is replayed, its entry is there
    assert rows(log.current()) == sorted(want, key=repr) and len(log.ledger.live()) == 2
    assert log.compact("c1") and not log.compact("c2")
    land("three", [(3, 1, "same time, later load")])
    run()
    assert rows(log.current()) == sorted([*want[:2], (3, 1, "same time, later load"), want[3]], key=repr)
    assert [e.name for e in log.ledger.live()][0] == "c1" and len(log.ledger.live()) == 2


@pytest.mark.parametrize("bits", [4, 6, 64])
def test_hash_keys_differ(spark, bits):
    table = [(a, b) for a in (None, "x", "y") for b in (None, "x", "y", "z")] * 2
    found = hash_keys(spark.createDataFrame(table, "a string, b string").repartition(5), ["a", "b"], "key", bits=bits).collect()
    assert {(r.a, r.b) for r in found} == set(table) and len({r.key for r in found}) == len(found) == 12
    again = hash_keys(spark.createDataFrame(table[::-1], "a string, b string").repartition(2), ["a", "b"], "key", bits=bits).collect()
    assert {(r.a, r.b): r.key for r in found} == {(r.a, r.b): r.key for r in again}


def test_too_few_bits(spark):
    with pytest.raises(ValueError, match="3 bits"):
        hash_keys(spark.range(9).select(F.col("id").alias("a")), ["a"], "key", bits=3, rounds=6)


def test_hash_keys_leave_room(spark):
    """More members than keys of the bits asked for: the hash gets wider, and few rounds suffice."""
    members = spark.range(9).select(F.col("id").alias("a"))
    found = hash_keys(members, ["a"], "key", bits=3, rounds=6, room=8).collect()
    assert sorted(r.a for r in found) == list(range(9)) and len({r.key for r in found}) == 9 and max(r.key for r in found) < 128
    narrow = {r.a: r.key for r in hash_keys(members, ["a"], "key", bits=9).collect()}
    assert {r.a: r.key for r in hash_keys(members, ["a"], "key", bits=9, room=8).collect()} == narrow


def test_surrogate_hash_keys_above_their_bits(spark, tmp_path, monkeypatch):
    """What the query asks for holds although its bits hold no key for every member."""
    monkeypatch.setattr(quality_queries, "hash_keys", lambda *a, bits, **k: hash_keys(*a, bits=4, **k))
    spark.range(100).selectExpr("id as o_orderkey", "id % 40 as o_custkey", "concat('P', id % 3) as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    found = quality_queries.surrogate_hash_keys(spark, str(tmp_path)).collect()
    assert all(r.members == r.distinct_keys for r in found) and sum(r.members for r in found) == found[0].all_keys == 100


def test_bits_are_in_order(spark):
    draw = random.Random(2)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 1.0, math.nextafter(1, 2), math.nextafter(1, 0), math.nan]
    values += [s * math.nextafter(2.0**e, d) for e in range(-1070, 1023, 37) for d in (0, math.inf) for s in (1, -1)] + [2.0**e for e in range(-1074, 1024)]
    values += [draw.uniform(-1, 1) * 10.0 ** draw.randint(-300, 300) for _ in range(2_000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ag.ordered_bits(F.col("v")).alias("k")).collect()
    known = sorted((r for r in got if not math.isnan(r.v)), key=lambda r: r.v)
    assert all((a.k < b.k) if a.v < b.v else a.k == b.k for a, b in zip(known, known[1:]))
    assert [r.k for r in got if math.isnan(r.v)] == [2**63 - 1]


def test_quantiles_of_long_tails_and_masses(spark):
    rng = np.random.default_rng(8)
    groups = {
        "tail": np.exp(rng.normal(0, 12, 4_001)), "mass": np.array([3.5] * 3_000 + [1e300, -1e300, 0.0, -2.5]), "near": 1e9 + rng.integers(0, 3_000, 5_000) / 7,
        "one": np.array([42.0]), "two": np.array([-1.0, 5.0]), "signs": rng.normal(0, 1, 999),
    }
    table = [(k, float(v)) for k, own in groups.items() for v in own] + [("none", None), (None, 7.0)]
    df = spark.createDataFrame(table, "g string, v double").repartition(6)
    parts = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    found = {r.g: list(r)[1:] for r in ag.exact_quantiles(df, "v", parts, by=["g"]).collect()}
    assert set(found) == {*groups, None} and found[None] == [7.0] * len(parts)
    for k, own in groups.items():
        assert np.allclose(found[k], np.quantile(own, parts), rtol=1e-12, atol=0), k
    whole = [v for _, v in table if v is not None]
    assert np.allclose(list(ag.exact_quantiles(df, "v", parts).first()), np.quantile(whole, parts), rtol=1e-12, atol=0)
