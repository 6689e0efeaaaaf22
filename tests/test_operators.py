"""Validation, quantiles, privacy, keys and incremental operators against brute force."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataframe.operators import aggregate as ag
from strataframe.operators import incremental as inc
from strataframe.operators import privacy as pv
from strataframe.operators import project as pj
from strataframe.operators import validate as dq
from strataframe.operators.keys import dense_keys
from strataframe.operators.reshape import first_by, stack_tables
from strataframe.session import broadcast_if_small
from strataframe.sources.tables import literal_rows
from strataframe.spec import CodeCheck, PrivacyPolicy, RowRule


def ints(spark, values, name="x"):
    return literal_rows(spark, [(v,) for v in values], f"{name} long")


def test_validate_codes(spark):
    df, dim = ints(spark, [1, 2, 7, None]), ints(spark, [1, 2, 2], "code")
    kept, rejects = dq.validate_codes(df, "x", dim, critical=True)
    assert rows(kept) == [(1,), (2,)] and rows(rejects) == [(7,), (None,)]
    softened, _ = dq.validate_codes(df, "x", dim)
    assert rows(softened) == [(1,), (2,), (None,), (None,)]


def test_validate_all_is_the_same_in_one_pass(spark):
    df = literal_rows(spark, [(1, 1), (2, 9), (9, 1), (None, None), (2, 2)], "a long, b long")
    dims = {"a": ints(spark, [1, 2], "code"), "b": ints(spark, [1, 2, 2], "code")}
    result = dq.validate_all(df, [CodeCheck("a", "a", critical=True), CodeCheck("b", "b")], dims)
    assert rows(result.kept) == [(1, 1), (2, 2), (2, None)]
    assert rows(result.rejects) == [(2, 9, "b"), (9, 1, "a"), (None, None, "a")]
    assert [tuple(r) for r in result.report.collect()] == [(1, "a", True, 5, 2, 40.0), (2, "b", False, 3, 1, 33.33)]


@pytest.mark.parametrize("catalogues", [1, 2, 4])
def test_validation_reads_the_rows_once(spark, catalogues):
    """However many catalogues are too large to broadcast, the records are one scan, and the rows are the same."""
    df = ints(spark, [1] * 50 + [2, 7, None, None])
    dims = {f"c{i}": ints(spark, [1, 2, 2], "code") for i in range(catalogues)}
    checks = [CodeCheck("x", name, critical=True) for name in dims]
    small = [rows(part) for part in dq.validate_all(df, checks, dims)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = dq.validate_all(df, checks, dims)
        assert [rows(part) for part in large] == small
        plan = large.kept._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == catalogues and plan.count("LocalRelation") == 1 + catalogues
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_check_of_a_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="not there"):
        dq.validate_all(ints(spark, [1]), [CodeCheck("y", "c")], {"c": ints(spark, [1], "code")})


def test_small_tables_are_measured_with_their_arrays(spark):
    from strataframe.session import is_small

    wide = spark.range(2000).select(F.sequence(F.lit(0), F.lit(4000)).alias("a"))
    assert not is_small(wide, max_bytes=16 << 20) and is_small(spark.range(1000))


def test_months_out_of_range_have_no_key(spark):
    from strataframe.functions.calendar import month_key_from_parts

    df = literal_rows(spark, [(2020, 3), (2020, 120), (2020, 0), (None, 3), (2020, None)], "y int, m int")
    assert [r[0] for r in df.select(month_key_from_parts(F.col("y"), F.col("m"))).collect()] == ["2020-03", None, None, None, None]


def test_outliers(spark):
    df = ints(spark, [*range(1, 101), 1000, None])
    for exact in (True, False):
        kept = dq.remove_outliers(df, "x", exact=exact)
        assert kept.count() == 101 and kept.filter("x = 1000").isEmpty()


def test_quarantine(spark):
    valid, errors = dq.quarantine(ints(spark, [1, 13, None]), [RowRule("month", "x between 1 and 12"), RowRule("small", "x < 5")])
    assert rows(valid) == [(1,)] and rows(errors) == [(13, "month,small"), (None, "month,small")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles(spark, seed):
    rng = np.random.default_rng(seed)
    # one group holds most rows, most of them one value
    data = [("hot", 5.0)] * 400 + [("hot", float(v)) for v in rng.integers(0, 40, 300)] + [("b", float(v)) for v in rng.normal(size=57)] + [("c", 1.0), (None, 2.0), (None, 4.0), ("c", None)]
    df = literal_rows(spark, data, "g string, v double").repartition(5)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {r[0]: list(r)[1:] for r in ag.exact_quantiles(df, "v", probabilities, by=["g"]).collect()}
    for group in ("hot", "b", "c", None):
        values = [v for g, v in data if g == group and v is not None]
        assert np.allclose(got[group], np.quantile(values, probabilities))
    overall = ag.exact_quantiles(df, "v", probabilities).first()
    assert np.allclose(list(overall), np.quantile([v for _, v in data if v is not None], probabilities))


def test_profiles(spark):
    df = literal_rows(spark, [(1, None), (1, None), (2, "a")], "x int, y string")
    assert rows(ag.null_profile(df)) == [("x", 0, 0.0), ("y", 2, 66.67)]
    assert rows(ag.duplicate_profile(df)) == [(3, 2, 1)]


def test_first_by_is_total(spark):
    df = literal_rows(spark, [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("m", None, "q")], "k string, o int, v string")
    assert rows(first_by(df, "k", ["o"])) == [("k", 1, "a"), ("m", None, "q")]


def test_dense_keys(spark):
    values = random.Random(5).sample(range(10_000), 700)
    got = dict(rows(dense_keys(ints(spark, values + values[:50]).repartition(6), ["x"], "key")))
    assert got == {v: i for i, v in enumerate(sorted(values), 1)}


def test_small_cells(spark):
    merged = pv.merge_small_cells(literal_rows(spark, [("g", "a", 3), ("g", "b", 4), ("g", "c", 5), ("g", "d", 20)], "g string, c string, n long"), ["g"], "c")
    assert rows(merged) == [("g", "Otros", 7, False, False), ("g", "c", 5, False, False), ("g", "d", 20, False, False)]
    hidden = pv.merge_small_cells(literal_rows(spark, [("g", "a", 4), ("g", "d", 20)], "g string, c string, n long"), ["g"], "c")
    assert rows(hidden) == [("g", "Otros", None, True, False), ("g", "d", None, True, False)]
    alone = pv.merge_small_cells(literal_rows(spark, [("g", "a", 2), ("g", "d", 1)], "g string, c string, n long"), ["g"], "c")
    assert rows(alone) == [("g", "Otros", None, True, True)]


@pytest.mark.parametrize("seed", range(4))
def test_complementary_suppression_leaves_no_single_gap(spark, seed):
    rng = random.Random(seed)
    data = [(f"r{i}", f"c{j}", rng.choice([1, 3, 5, 6, 8, 13, 40])) for i in range(7) for j in range(6) if rng.random() < 0.8]
    out = pv.complementary_suppression(literal_rows(spark, data, "r string, c string, n long"), "r", "c").collect()
    assert len(out) == len(data)
    assert all(x.n is None or x.n >= 5 for x in out)
    for line in ("r", "c"):
        for value in {x[line] for x in out}:
            cells = [x for x in out if x[line] == value]
            assert sum(x.suppressed for x in cells) != 1 or len(cells) == 1 and cells[0].total_exposed


def test_policy(spark):
    df = literal_rows(spark, [("x1", 7, "43 años")], "numero_correlativo string, dia int, edad string")
    safe = pv.apply_policy(df.withColumn("edad", F.lit("43")), pv.POLICIES["inacif_necropsias"])
    assert rows(safe) == [("40-44",)]
    assert ("ine_deaths", "high", "diaocu", "drop") in rows(pv.policy_catalogue(spark))
    dated = literal_rows(spark, [("2020-05-17",)], "d string").withColumn("d", F.col("d").cast("date"))
    assert rows(pv.apply_policy(dated, PrivacyPolicy("t", months=("d",)))) == [("2020-05",)]


def test_upsert_and_diff(spark):
    target = literal_rows(spark, [(1, "a"), (2, "b")], "id int, v string")
    source = literal_rows(spark, [(2, "c"), (3, "d")], "id int, v string")
    assert rows(inc.upsert(target, source, "id")) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(inc.snapshot_diff(target, source, "id")) == [("delete", 1, "a"), ("insert", 3, "d"), ("update", 2, "c")]
    assert inc.high_water_mark(target, "id") == 2 and inc.high_water_mark(target.limit(0), "id") == 0
    assert rows(inc.rows_above(source, "id", 2)) == [(3, "d")]


def test_history_over_three_snapshots(spark):
    snap = lambda *r: literal_rows(spark, list(r), "id int, v string")
    history = inc.open_history(snap((1, "a"), (2, "b")), "2020-01-01")
    history = inc.apply_history(history, snap((1, "a"), (2, "c"), (3, "d")), "id", "2021-01-01")
    history = inc.apply_history(history, snap((2, "c"), (3, "e")), "id", "2022-01-01")
    end = inc.OPEN_END
    assert rows(history) == [
        (1, "a", "2020-01-01", "2022-01-01", False), (2, "b", "2020-01-01", "2021-01-01", False), (2, "c", "2021-01-01", end, True),
        (3, "d", "2021-01-01", "2022-01-01", False), (3, "e", "2022-01-01", end, True),
    ]


def test_header_repair_and_casts(spark):
    lost = literal_rows(spark, [("CG02", "x", "2001")], "`cg0280` string, `leprosy` string, `2000` string")
    fixed = pj.repair_header(lost, ["code", "name", "year"], {"year": "int"})
    assert rows(fixed) == [("CG02", "x", 2001), ("cg0280", "leprosy", 2000)]
    assert rows(pj.repair_header(lost, ["code", "name", "year"], {"year": "int"}, keep_header_row=False)) == [("CG02", "x", 2001)]


def test_union_with_missing_columns(spark):
    both = stack_tables([ints(spark, [1], "a"), literal_rows(spark, [(2, "z")], "a long, b string")], allow_missing=True)
    assert rows(both) == [(1, None), (2, "z")]
