"""The compiled policy, bounds of hidden cells and differences of two releases."""

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataframe.operators import release as rl
from strataframe.operators.privacy import complementary_suppression, policy_catalogue
from strataframe.spec import PrivacyPolicy, Rollup
from strataframe.workload.privacy_queries import suppress_complementary

POLICY = PrivacyPolicy(
    "t", "high", drop=("id",), age_groups=("age",), publish=("place", "cause", "age"), minors=("age", "place", "all"), places=("place", "area", 100), others=("cause", 3),
    rollups=(Rollup("group", "place", "area", 3), Rollup("rare", "cause", "chapter", 2, ("area",))),
)


def test_order_of_a_compiled_policy():
    assert [(s.name, s.level) for s in rl.compile_policy(POLICY)] == [
        ("minors", "row"), ("generalise", "row"), ("rare", "cell"), ("places", "cell"), ("group", "cell"), ("others", "cell"),
    ]
    with pytest.raises(ValueError, match="unpublished"):
        PrivacyPolicy("t", publish=("a",), others=("b", 3))
    with pytest.raises(ValueError, match="dropped"):
        PrivacyPolicy("t", publish=("a",), drop=("a",))
    with pytest.raises(ValueError, match="names of their own"):
        rl.compile_policy(PrivacyPolicy("t", publish=("a",), rollups=(Rollup("x", "a", "b", 1), Rollup("x", "a", "c", 1))))


def test_every_rule_shows(spark):
    people = [(1, "A", "X", "c1", "k", 40)] * 5 + [(2, "A", "X", "c2", "k", 40)] * 4 + [(3, "B", "X", "c1", "k", 41)] * 3  # B is small
    people += [(4, "C", "Y", "c1", "k", 10)] * 4 + [(5, "C", "Y", "c1", "k", None)] * 3  # minors and unknown ages
    people += [(6, "C", "Y", "c9", "z", 40), (7, "C", "Y", "c1", "k", 44), (8, "C", "Y", "c1", "k", 42)]  # a rare cause, a small group
    df = spark.createDataFrame(people, "id int, place string, area string, cause string, chapter string, age int")
    sizes = spark.createDataFrame([("A", 500.0), ("B", 50.0), ("C", 100.0)], "place string, poblacion double")
    with pytest.raises(ValueError, match="population"):
        rl.release(df, POLICY)
    assert rows(rl.release(df, POLICY, sizes)) == sorted([
        ("A", "c1", "40-44", 5, False, False, ""), ("A", "c2", "40-44", 4, False, False, ""), ("X", "c1", "40-44", 3, False, False, "places"),
        ("Y", "Otros", "40-44", 3, False, False, "group,others,rare"), ("all", "c1", "10-14", 4, False, False, "minors"), ("all", "c1", None, 3, False, False, "minors"),
    ], key=repr)
    assert policy_catalogue(spark, {"t": POLICY}).count() == 7
    stats = PrivacyPolicy("t", publish=("place",), minors=("age", "place", "all"), statistics=("id", 5))
    assert {r.place: r.n for r in rl.released_statistics(df, stats, ["place"]).collect()} == {"A": 9, "all": 7}


def test_hidden_bounds(spark):
    """Intervals hold every table that the margins allow, and end where none is left."""
    cells = {("r1", "a"): 2, ("r1", "b"): 3, ("r1", "c"): 9, ("r2", "a"): 1, ("r2", "b"): 4, ("r2", "c"): 7, ("r3", "a"): 8, ("r3", "b"): 2, ("r3", "c"): 6, ("r4", "a"): 0, ("r4", "c"): 5}
    hidden = [k for k in cells if k in {("r1", "a"), ("r1", "b"), ("r2", "a"), ("r2", "b"), ("r4", "a")}]
    table = spark.createDataFrame([(*k, n, k in hidden) for k, n in cells.items()], "r string, c string, n long, suppressed boolean")
    found = {(x.r, x.c): (x.low, x.high, x.derivable) for x in rl.hidden_bounds(table, "r", "c").collect()}
    assert set(found) == set(hidden)
    rest = {line: sum(cells[k] for k in hidden if line in k) for line in ("r1", "r2", "r4", "a", "b")}
    allowed = [dict(zip(hidden, v)) for v in itertools.product(range(10), repeat=len(hidden)) if all(sum(x for k, x in zip(hidden, v) if line in k) == n for line, n in rest.items())]
    for k in hidden:
        low, high = min(t[k] for t in allowed), max(t[k] for t in allowed)
        assert found[k][0] <= low and high <= found[k][1]
    assert found[("r4", "a")] == (0, 0, True)
    safe = complementary_suppression(table.drop("suppressed"), "r", "c").select("r", "c", "suppressed")
    assert rl.hidden_bounds(table.drop("suppressed").join(safe, ["r", "c"]), "r", "c").filter("n < low or n > high").isEmpty()


def test_differences_of_releases(spark):
    old = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", None), ("e", 20), ("g", 3), (None, 8)], "k string, n int")
    new = spark.createDataFrame([("a", 10), ("b", 12), ("c", 30), ("d", 9), ("f", 3), ("e", None), ("h", 7), (None, 9)], "k string, n int")
    found = {r.k: (r.difference, r.published, r.status) for r in rl.withheld_differences(old, new, ["k"]).collect()}
    assert found == {
        "a": (0, 10, "same"), "b": (2, 10, "withheld"), "c": (20, 30, "released"), "d": (None, 9, "suppressed"), "e": (None, None, "suppressed"),
        "f": (3, None, "withheld"), "g": (-3, 3, "withheld"), "h": (7, 7, "released"), None: (1, 8, "withheld"),
    }
    assert rl.withheld_differences(old.filter(F.lit(False)), new.filter(F.lit(False)), ["k"]).isEmpty()


def test_suppressed_cells_of_all_orders(spark, tmp_path):
    """A row per month and group: P-0 and P-1 have one small cell each, so the next larger cell of both goes too."""
    counts = {("1995-01", 0): 3, ("1995-01", 1): 2, ("1995-02", 0): 6, ("1995-02", 1): 7, ("1995-02", 2): 9, ("1995-03", 0): 8, ("1995-03", 1): 8, ("1995-03", 2): 8, ("1995-03", 90): 5}
    spark.createDataFrame([(c + 97 * i, f"{m}-0{1 + i % 9}") for (m, c), n in counts.items() for i in range(n)], "o_custkey long, day string").selectExpr(
        "o_custkey", "cast(day as timestamp) as o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    found = {(r.month, int(r.people[2:])): (r.n, r.suppressed, r.total_exposed) for r in suppress_complementary(spark, str(tmp_path)).collect()}
    gone = {("1995-01", 0), ("1995-01", 1), ("1995-02", 0), ("1995-02", 1)}
    assert found == {k: (None if k in gone else n, k in gone, False) for k, n in counts.items()}
