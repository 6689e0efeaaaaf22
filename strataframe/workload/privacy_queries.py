"""Privacy operators over customers, orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.operators import privacy as pv
from strataframe.operators.release import hidden_bounds, release, withheld_differences
from strataframe.spec import PrivacyPolicy, Rollup
from strataframe.workload.adapters import table
from strataframe.workload.oracle import pct, rounded, with_star
from strataframe.workload.registry import query

POLICY = PrivacyPolicy("lineitem", "high", drop=("l_orderkey", "l_partkey", "l_suppkey"), months=("l_shipdate",), age_groups=("l_quantity",))


@query(
    "generalise",
    "SELECT strftime(l_shipdate, '%Y-%m') AS l_shipdate, (CAST(l_quantity AS INTEGER) // 5 * 5) || '-' || (CAST(l_quantity AS INTEGER) // 5 * 5 + 4) AS l_quantity, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3",
)
def generalise(spark, sf_dir):
    """Identifiers dropped, days cut to months, exact numbers to groups of five."""
    safe = pv.apply_policy(table(spark, sf_dir, "lineitem"), POLICY)
    return pv.cells(safe, "l_shipdate", "l_quantity", "l_returnflag")


def _placed(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.concat(F.lit("N-"), (F.col("o_custkey") % 25).cast("string")).alias("place"),
        F.concat(F.lit("P-"), (F.col("o_custkey") % 40).cast("string")).alias("people"), F.col("o_orderpriority").alias("priority"),
    )


_MONTH_PLACE = "cells AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, 'N-' || (o_custkey % 25) AS place, count(*) AS n FROM orders GROUP BY 1, 2)"


@query(
    "suppress_small",
    with_star(
        "SELECT month, place, CASE WHEN NOT bool_or(hide) THEN CAST(sum(n) AS BIGINT) END AS n, bool_or(hide) AS suppressed, bool_or(hide) AND count(*) OVER (PARTITION BY month) = 1 AS total_exposed FROM labelled GROUP BY 1, 2",
        _MONTH_PLACE,
        """judged AS (SELECT *, n < 5 AS small, coalesce(sum(CASE WHEN n < 5 THEN n END) OVER (PARTITION BY month), 0) AS pool,
          row_number() OVER (PARTITION BY month, n < 5 ORDER BY n, place) AS r FROM cells)""",
        """labelled AS (SELECT month, CASE WHEN small THEN 'Otros' ELSE place END AS place, n, pool > 0 AND pool < 5 AND (small OR r = 1) AS hide FROM judged)""",
    ),
)
def suppress_small(spark, sf_dir):
    return pv.merge_small_cells(pv.cells(_placed(spark, sf_dir), "month", "place"), ["month"], "place")


def _two_way(spark, sf_dir):
    """Every order in a table of years by 97 groups of customers, whose cells are small by nature."""
    rows = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("month"), F.concat(F.lit("P-"), (F.col("o_custkey") % 97).cast("string")).alias("people")
    )
    return pv.cells(rows, "month", "people")


_TWO_WAY = "t AS (SELECT strftime(o_orderdate, '%Y') AS month, 'P-' || (o_custkey % 97) AS people, count(*) AS n FROM orders GROUP BY 1, 2)"
HIDE_BELOW = 30


_SUPPRESSED = f"""WITH RECURSIVE t AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, 'P-' || (o_custkey % 97) AS people, count(*) AS n FROM orders GROUP BY 1, 2),
  s AS (SELECT 0 AS pass, month, people, n, n < {pv.MIN_CELL} AS hidden, true AS more FROM t
    UNION ALL
    SELECT pass + 1, month, people, n, hidden OR (h = 1 AND r = 1), bool_or((hidden OR (h = 1 AND r = 1)) <> was) OVER () FROM (
      SELECT *, count(*) FILTER (hidden) OVER (PARTITION BY people) AS h, row_number() OVER (PARTITION BY people, hidden ORDER BY n, month NULLS FIRST) AS r FROM (
        SELECT pass, month, people, n, hidden AS was, hidden OR (h = 1 AND r = 1) AS hidden FROM (
          SELECT *, count(*) FILTER (hidden) OVER (PARTITION BY month) AS h, row_number() OVER (PARTITION BY month, hidden ORDER BY n, people NULLS FIRST) AS r FROM s WHERE more))))
  SELECT month, people, CASE WHEN NOT hidden THEN n END AS n, hidden AS suppressed,
    hidden AND (count(*) OVER (PARTITION BY month) = 1 OR count(*) OVER (PARTITION BY people) = 1) AS total_exposed FROM s WHERE NOT more"""


@query("suppress_complementary", _SUPPRESSED)
def suppress_complementary(spark, sf_dir):
    """Every cell of all orders by month and 97 groups of customers, after as many passes as it takes."""
    rows = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.concat(F.lit("P-"), (F.col("o_custkey") % 97).cast("string")).alias("people")
    )
    return pv.complementary_suppression(pv.cells(rows, "month", "people"), "month", "people")


@query(
    "suppression_certificate",
    f"""WITH {_TWO_WAY} SELECT count(*) FILTER (n < {HIDE_BELOW}) AS small, count(*) FILTER (n < {HIDE_BELOW}) AS small_hidden, 0 AS outside, 0 AS derivable FROM t""",
)
def suppression_certificate(spark, sf_dir):
    """What margins give away about the hidden cells: every interval holds the true count and none is a single value."""
    own = _two_way(spark, sf_dir)
    held = pv.complementary_suppression(own, "month", "people", minimum=HIDE_BELOW).select("month", "people", "suppressed")
    bounds = hidden_bounds(own.join(held, ["month", "people"]), "month", "people")
    return bounds.agg(
        F.lit(own.filter(F.col("n") < HIDE_BELOW).count()).alias("small"), F.count_if(F.col("n") < HIDE_BELOW).alias("small_hidden"),
        F.count_if((F.col("n") < F.col("low")) | (F.col("n") > F.col("high"))).cast("int").alias("outside"), F.count_if("derivable").cast("int").alias("derivable"),
    )


@query(
    "rare_to_parent",
    """WITH c AS (SELECT year(o_orderdate) AS year, o_custkey % 5 AS place, CAST(floor(sqrt(o_orderkey % 400)) AS INTEGER) AS code, count(*) AS n FROM orders GROUP BY 1, 2, 3)
    SELECT CAST(year AS INTEGER) AS year, place, CASE WHEN n < 10 THEN 'chapter ' || (code // 10) ELSE 'code ' || code END AS code, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2, 3""",
)
def rare_to_parent(spark, sf_dir):
    code = F.floor(F.sqrt(F.col("o_orderkey") % 400)).cast("int")
    rows = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 5).alias("place"),
        F.concat(F.lit("code "), code.cast("string")).alias("code"), F.concat(F.lit("chapter "), F.floor(code / 10).cast("string")).alias("chapter"),
    )
    return pv.rare_to_parent(pv.cells(rows, "year", "place", "code", "chapter"), ["year", "place"], "code", "chapter")


def _by_nation(spark, sf_dir):
    """Orders with nation and region names."""
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"))


_NATIONS = "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_PEOPLE = "(SELECT c_nationkey AS pk, count(*) AS people FROM customer GROUP BY 1)"


RELEASE = PrivacyPolicy(
    "orders", "high", drop=("o_orderkey",), months=("fecha",), age_groups=("edad",), publish=("fecha", "municipio", "causa", "edad"),
    minors=("edad", "municipio", "NA"), places=("municipio", "departamento", 10_000), others=("causa", 5),
    rollups=(Rollup("rare cause", "causa", "capitulo", 10, ("substring(fecha, 1, 4)", "departamento")), Rollup("small group", "municipio", "departamento", 10)),
)


def _records(spark, sf_dir):
    k = F.col("o_orderkey")
    code = F.when(k % 97 == 0, 1).when(k % 5 == 0, 2).otherwise(3 + k % 2)
    return _by_nation(spark, sf_dir).select(
        "o_orderkey", F.col("o_orderdate").alias("fecha"), F.when(k % 31 != 0, 15 + k % 10).alias("edad"), F.col("n_name").alias("municipio"), F.col("r_name").alias("departamento"),
        F.concat(F.lit("code "), code.cast("string")).alias("causa"), F.concat(F.lit("chapter "), F.floor(code / 3).cast("string")).alias("capitulo"),
    )


def _inhabitants(spark, sf_dir):
    """Customers of each nation, scaled so that the average nation has 10,000 inhabitants."""
    customers = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("municipio"))
    counts = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n")).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return counts.select("municipio", (F.col("_n") * 25 * 10_000 / customers.select(F.count(F.lit(1))).scalar()).alias("poblacion"))


def _release_sql() -> str:
    keys = "fecha, municipio, causa, edad"
    return f"""WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS fecha, CASE WHEN o_orderkey % 31 <> 0 AND 15 + o_orderkey % 10 >= 18 THEN n_name ELSE 'NA' END AS municipio,
      CASE WHEN o_orderkey % 31 <> 0 AND 15 + o_orderkey % 10 >= 18 THEN r_name ELSE 'NA' END AS departamento, CASE WHEN o_orderkey % 31 <> 0 THEN CASE WHEN o_orderkey % 10 < 5 THEN '15-19' ELSE '20-24' END END AS edad,
      CASE WHEN o_orderkey % 97 = 0 THEN 1 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 3 + o_orderkey % 2 END AS code, o_orderkey % 31 = 0 OR o_orderkey % 10 < 3 AS minor {_NATIONS}),
    c1 AS (SELECT *, count(*) OVER (PARTITION BY substr(fecha, 1, 4), departamento, code) < 10 AS rare FROM r),
    big AS (SELECT n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(*) * 25 >= (SELECT count(*) FROM customer)),
    c2 AS (SELECT *, CASE WHEN rare THEN 'chapter ' || (code // 3) ELSE 'code ' || code END AS causa, NOT minor AND municipio NOT IN (SELECT name FROM big) AS tiny FROM c1),
    c3 AS (SELECT * REPLACE (CASE WHEN tiny THEN departamento ELSE municipio END AS municipio) FROM c2),
    c4 AS (SELECT *, municipio <> departamento AND count(*) OVER (PARTITION BY {keys}) < 10 AS few FROM c3),
    c5 AS (SELECT * REPLACE (CASE WHEN few THEN departamento ELSE municipio END AS municipio) FROM c4),
    w AS (SELECT {keys}, count(*) AS n, bool_or(rare) AS rare, bool_or(tiny) AS tiny, bool_or(few) AS few, bool_or(minor) AS minor FROM c5 GROUP BY ALL),
    j AS (SELECT *, n < 5 AS small, coalesce(sum(n) FILTER (n < 5) OVER (PARTITION BY fecha, municipio, edad), 0) AS pool, row_number() OVER (PARTITION BY fecha, municipio, edad, n < 5 ORDER BY n, causa) AS place FROM w),
    p AS (SELECT fecha, municipio, edad, CASE WHEN small THEN 'Otros' ELSE causa END AS causa, CAST(sum(n) AS BIGINT) AS n, bool_or(pool > 0 AND pool < 5 AND (small OR place = 1)) AS suppressed,
      bool_or(rare) AS rare, bool_or(tiny) AS tiny, bool_or(few) AS few, bool_or(minor) AS minor, bool_or(small) AS small FROM j GROUP BY ALL)
    SELECT {keys}, CASE WHEN NOT suppressed THEN n END AS n, suppressed, suppressed AND count(*) OVER (PARTITION BY fecha, municipio, edad) = 1 AS total_exposed,
      concat_ws(',', CASE WHEN minor THEN 'minors' END, CASE WHEN small OR suppressed THEN 'others' END, CASE WHEN tiny THEN 'places' END, CASE WHEN rare THEN 'rare cause' END, CASE WHEN few THEN 'small group' END) AS rules FROM p"""


@query("privacy_release", _release_sql())
def privacy_release(spark, sf_dir):
    """Orders as records of people: the whole policy compiled and applied, with the rules that touched each cell."""
    return release(_records(spark, sf_dir), RELEASE, _inhabitants(spark, sf_dir))


@query(
    "release_difference",
    """WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, 'N-' || (o_custkey % 25) AS place, nullif(count(*) FILTER (o_orderkey % 41 > 1 AND (o_custkey % 25 > 1 OR o_orderkey % 2 = 0)), 0) AS a, count(*) AS b FROM orders GROUP BY 1, 2),
    s AS (SELECT month, place, CASE WHEN a >= 5 THEN a END AS earlier_n, CASE WHEN b >= 5 THEN b END AS n, a < 5 OR b < 5 AS secret, b - coalesce(a, 0) AS gap FROM c)
    SELECT month, place, earlier_n, n, CASE WHEN NOT coalesce(secret, false) THEN gap END AS difference, CASE WHEN NOT coalesce(secret, false) AND gap > 0 AND gap < 5 THEN earlier_n ELSE n END AS published,
    CASE WHEN coalesce(secret, false) THEN 'suppressed' WHEN gap = 0 THEN 'same' WHEN gap < 5 THEN 'withheld' ELSE 'released' END AS status FROM s""",
)
def release_difference(spark, sf_dir):
    """A release of most orders and one of all: cells that the difference of both would open keep their earlier value."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.concat(F.lit("N-"), (F.col("o_custkey") % 25).cast("string")).alias("place"))
    shown = lambda df: pv.cells(df, "month", "place").withColumn("n", F.when(F.col("n") >= pv.MIN_CELL, F.col("n")))
    return withheld_differences(shown(rows.filter("o_orderkey % 41 > 1 and (o_custkey % 25 > 1 or o_orderkey % 2 = 0)")), shown(rows), ["month", "place"])


@query(
    "small_place_rollup",
    f"""SELECT priority, CASE WHEN people * 25 * 10000 >= total * 10000 THEN n_name ELSE r_name END AS place, count(*) AS n FROM
    (SELECT o_orderpriority AS priority, n_name, r_name, c_nationkey {_NATIONS}) JOIN {_PEOPLE} ON pk = c_nationkey, (SELECT count(*) AS total FROM customer) GROUP BY 1, 2""",
)
def small_place_rollup(spark, sf_dir):
    """Nations with fewer customers than the average, scaled to 10,000, report under their region."""
    customers = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("place"))
    total = customers.select(F.count(F.lit(1))).scalar()
    people = (
        customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("_n")).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("place", (F.col("_n") * 25 * 10_000 / total).alias("poblacion"))
    )
    rows = _by_nation(spark, sf_dir).select(F.col("o_orderpriority").alias("priority"), F.col("n_name").alias("place"), F.col("r_name").alias("parent"))
    return pv.small_place_to_parent(pv.cells(rows, "priority", "place", "parent"), people, "place", "parent")


@query(
    "minors_national",
    f"SELECT CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 90 >= 18 THEN n_name ELSE 'NA' END AS place, count(*) AS n {_NATIONS} GROUP BY 1",
)
def minors_national(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = _by_nation(spark, sf_dir).select(F.col("n_name").alias("place"), F.when(k % 31 != 0, k % 90).alias("age"))
    return pv.cells(pv.minors_national(rows, "age", "place", "NA"), "place")


@query(
    "merge_to_parent",
    f"""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name, r_name, count(*) AS n {_NATIONS} GROUP BY 1, 2, 3)
    SELECT month, CASE WHEN n < 10 THEN r_name ELSE n_name END AS place, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2""",
)
def merge_to_parent(spark, sf_dir):
    rows = _by_nation(spark, sf_dir).select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("n_name").alias("place"), F.col("r_name").alias("parent"))
    return pv.merge_to_parent(pv.cells(rows, "month", "place", "parent"), "place", "parent")


@query(
    "k_anonymity",
    f"""WITH c AS (SELECT year(o_orderdate) AS y, n_name, c_mktsegment, count(*) AS n {_NATIONS} GROUP BY 1, 2, 3)
    SELECT count(*) AS classes, min(n) AS smallest_class, CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (n < 5), 0) AS BIGINT) AS rows_at_risk,
    {pct('(coalesce(sum(n) FILTER (n < 5), 0))', 'sum(n)', 4)} AS risk_pct, count(*) FILTER (n = 1) AS unique_rows FROM c""",
)
def k_anonymity(spark, sf_dir):
    rows = _by_nation(spark, sf_dir).withColumn("year", F.year("o_orderdate"))
    return pv.k_anonymity(rows, ["year", "n_name", "c_mktsegment"])


@query(
    "release_statistics",
    f"""SELECT month, priority, count(v) AS n, CAST(sum(v) AS BIGINT) AS total, {rounded('avg(v)', 2)} AS mean, {rounded('stddev_samp(v)', 2)} AS stddev, {rounded('var_samp(v)', 2)} AS variance,
    {rounded('quantile_cont(v, 0.5)', 2)} AS median FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS priority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS v FROM orders)
    GROUP BY 1, 2 HAVING count(v) >= 10""",
)
def release_statistics(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("priority"), F.floor(F.col("o_totalprice") / 1000).alias("v")
    )
    return pv.release_statistics(rows, ["month", "priority"], "v")


def _unit(seed: int) -> str:
    return f"((CAST('0x' || substr(md5(c_custkey || '|{seed}'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"


@query(
    "noise",
    f"SELECT c_custkey, {rounded(f'c_acctbal + 50.0::DOUBLE * sqrt(-2.0::DOUBLE * ln({_unit(14)})) * cos(2.0::DOUBLE * pi() * {_unit(15)})', 3)} AS c_acctbal FROM customer",
)
def noise(spark, sf_dir):
    noisy = pv.add_noise(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 50.0, seed=7)
    return noisy.withColumn("c_acctbal", F.round("c_acctbal", 3))
