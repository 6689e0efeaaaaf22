"""Incremental loads, history, streaming, stored tables and models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strataframe.operators import incremental as inc
from strataframe.operators.reshape import stack_tables
from strataframe.plans import modelling as ml
from strataframe.plans.linear import fitted
from strataframe.session import cut_lineage, scratch_path
from strataframe.sources import files, sinks
from strataframe.sources.ledger import Ledger, UpsertLog, upsert_stream
from strataframe.sources.tables import literal_rows
from strataframe.streaming.arrival import arriving_files, ingest_available
from strataframe.workload import adapters as ad
from strataframe.workload.adapters import table
from strataframe.workload.oracle import CAUSE, CONTEXT, FACT, FACT_A, PLACE, PROFILE, TIME, rounded, with_star
from strataframe.workload.registry import query

# --- incremental loads ------------------------------------------------------


def _cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


@query(
    "incremental_by_id",
    "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderkey % 97 = 0) GROUP BY 1",
)
def incremental_by_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    loaded = orders.filter((F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderkey") % 97 == 0))
    fresh = inc.rows_above(orders, "o_orderkey", inc.high_water_mark(loaded, "o_orderkey"))
    return fresh.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("checksum"))


@query("incremental_by_time", "SELECT event_type, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events WHERE day(ts) <= 20) GROUP BY 1")
def incremental_by_time(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    mark = inc.high_water_mark(events.filter(F.dayofmonth("ts") <= 20), "ts", default=None)
    return inc.rows_above(events, "ts", mark).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_BASE = "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"


def _base(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), _cents("o_totalprice").alias("cents"))


@query(
    "upsert",
    f"""SELECT status, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM (
    SELECT id, CASE WHEN id % 2 = 0 THEN 'U' ELSE status END AS status, CASE WHEN id % 2 = 0 THEN cents + 2 ELSE cents END AS cents FROM ({_BASE}) WHERE id % 3 <> 0 OR id % 2 = 0) GROUP BY 1""",
)
def upsert(spark, sf_dir):
    """Source rows come twice; the later version of each wins."""
    base = _base(spark, sf_dir)
    changed = base.filter("id % 2 = 0").withColumn("status", F.lit("U"))
    source = changed.withColumn("cents", F.col("cents") + 1).unionByName(changed.withColumn("cents", F.col("cents") + 2))
    merged = inc.upsert(base.filter("id % 3 <> 0"), source, "id", newest_by="cents")
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query(
    "snapshot_diff",
    f"""SELECT CASE WHEN id % 5 = 0 THEN 'insert' WHEN id % 7 = 0 THEN 'delete' ELSE 'update' END AS change_type, id,
    CASE WHEN id % 7 <> 0 AND id % 11 = 0 THEN 'X' ELSE status END AS status, cents FROM ({_BASE})
    WHERE (id % 5 = 0) <> (id % 7 = 0) OR (id % 5 <> 0 AND id % 7 <> 0 AND id % 11 = 0)""",
)
def snapshot_diff(spark, sf_dir):
    base = _base(spark, sf_dir)
    new = base.filter("id % 7 <> 0").withColumn("status", F.when(F.col("id") % 11 == 0, "X").otherwise(F.col("status")))
    return inc.snapshot_diff(base.filter("id % 5 <> 0"), new, "id")


@query(
    "dimension_history",
    """WITH b AS (SELECT c_custkey AS id, c_mktsegment AS segment FROM customer), o AS (SELECT * FROM b WHERE id % 13 <> 0), n AS (SELECT id, CASE WHEN id % 10 = 0 THEN 'MOVED' ELSE segment END AS segment FROM b WHERE id % 17 <> 0)
    SELECT o.id, o.segment, '1995-01-01' AS valid_from, CASE WHEN n.id IS NULL OR n.segment <> o.segment THEN '1998-01-01' ELSE '9999-12-31' END AS valid_to,
    NOT (n.id IS NULL OR n.segment <> o.segment) AS is_current FROM o LEFT JOIN n ON o.id = n.id
    UNION ALL SELECT n.id, n.segment, '1998-01-01', '9999-12-31', true FROM n LEFT JOIN o ON o.id = n.id WHERE o.id IS NULL OR n.segment <> o.segment""",
)
def dimension_history(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    first = inc.open_history(base.filter("id % 13 <> 0"), "1995-01-01")
    moved = base.filter("id % 17 <> 0").withColumn("segment", F.when(F.col("id") % 10 == 0, "MOVED").otherwise(F.col("segment")))
    return inc.apply_history(first, moved, "id", "1998-01-01")


# --- files and streams ------------------------------------------------------


@query("stream_ingest", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1", folders=True)
def stream_ingest(spark, sf_dir):
    """The events file as an arriving file; a second run over the same checkpoint adds nothing."""
    schema = table(spark, sf_dir, "events").schema
    target, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "events-checkpoint")
    for _ in range(2):
        ingest_available(arriving_files(spark, sf_dir, schema, glob="events.parquet"), target, checkpoint)
    return spark.read.schema(schema).parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query(
    "stream_upsert",
    """SELECT event_type, count(*) AS users, CAST(sum(event_id) AS BIGINT) AS checksum FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) GROUP BY 1""",
    folders=True,
)
def stream_upsert(spark, sf_dir):
    """The newest event of every user, by micro-batches of arriving files; replayed batches and a compaction change nothing."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    landing, root = scratch_path(spark, "events-landing"), scratch_path(spark, "events-upserts")
    events.repartition(4, "event_id").write.parquet(landing)
    log = UpsertLog(Ledger(spark, f"{root}/log", events.schema).create(), "user_id", "ts")
    arriving = arriving_files(spark, landing, events.schema, max_files=1)
    upsert_stream(arriving, log, f"{root}/checkpoint")
    batches = [e.name for e in log.ledger.live()]
    log.upsert(batches[0], events.withColumn("event_type", F.lit("replayed")))
    upsert_stream(arriving_files(spark, landing, events.schema, max_files=1), log, f"{root}/checkpoint")
    log.compact("folded")
    return log.current().groupBy("event_type").agg(F.count(F.lit(1)).alias("users"), F.sum("event_id").alias("checksum"))


@query("csv_roundtrip", "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum FROM orders GROUP BY 1", folders=True)
def csv_roundtrip(spark, sf_dir):
    """Sorted header CSV, read back with a schema and its source file."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = scratch_path(spark, "orders-csv")
    sinks.export_sorted_csv(rows, target, "o_orderkey")
    back = files.with_source_file(files.read_csv(spark, target, "o_orderkey long, o_orderstatus string, o_totalprice double", drop_malformed=True))
    return back.filter("source_file like 'part-%'").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("checksum"))


@query("ragged_roundtrip", "SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS checksum FROM customer GROUP BY 1", folders=True)
def ragged_roundtrip(spark, sf_dir):
    """Customers written as CSV lines with a phantom last field and a preamble in every file."""
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit(', "')), "c_mktsegment", F.lit(""))
    target = scratch_path(spark, "customers-ragged")

    def with_preamble(batches):
        import pandas as pd

        yield pd.DataFrame({"line": ["Title of the table", "c_custkey,c_name,c_mktsegment"]})
        yield from batches

    table(spark, sf_dir, "customer").select(line.alias("line")).mapInPandas(with_preamble, "line string").write.text(target)
    back = files.read_ragged_csv(spark, target, skip=1)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey").try_cast("long")).alias("checksum"))


@query("partitioned_table", "SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1", folders=True)
def partitioned_table(spark, sf_dir):
    """Stored by year; the reader prunes to two partitions."""
    target = scratch_path(spark, "orders-by-year")
    rows = table(spark, sf_dir, "orders").withColumn("anio", F.year("o_orderdate"))
    sinks.overwrite_partitioned(rows, target, "anio")
    back = spark.read.schema(rows.schema).parquet(target).filter(F.col("anio").isin(1997, 1998))
    return back.groupBy("anio").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"))


@query(
    "gold_tables",
    with_star(
        """SELECT 'dim_tiempo' AS table_name, count(*) AS row_count FROM dim_t UNION ALL SELECT 'dim_geografia', count(*) FROM dim_g UNION ALL SELECT 'dim_perfil', count(*) FROM dim_p
        UNION ALL SELECT 'dim_causa_muerte', count(*) FROM dim_c UNION ALL SELECT 'fact_mortalidad_unificada', count(*) FROM fact UNION ALL SELECT 'fact_contexto_renap', count(*) FROM ctx""",
        TIME, PLACE, PROFILE, CAUSE, FACT, CONTEXT,
    ),
)
def gold_tables(spark, sf_dir):
    """A full refresh of the six gold tables, counted after the load."""
    return sinks.row_counts(ad.refresh(spark, sf_dir)._asdict())


# --- models -----------------------------------------------------------------

_FEATURES_A = FACT_A + ", " + ", ".join((CONTEXT, TIME, PLACE, PROFILE, CAUSE)) + """, feats AS (
  SELECT f.id_tiempo_mes, f.id_geografia, f.id_perfil, f.id_causa, p.sexo, p.rango_edad, c.categoria_general, g.nombre_departamento, t.anio, t.mes,
    CAST(c.es_covid AS INTEGER) AS es_covid_int, coalesce(r.cantidad, 0) AS total_defunciones_renap, f.cantidad_fallecidos
  FROM fact_a f JOIN dim_t t USING (id_tiempo_mes) JOIN dim_g g USING (id_geografia) JOIN dim_p p USING (id_perfil) JOIN dim_c c USING (id_causa)
  LEFT JOIN (SELECT id_tiempo_mes, cantidad FROM ctx WHERE tipo_evento = 'Defunciones') r USING (id_tiempo_mes))"""
_SIN, _COS = rounded("sin(mes * (2.0 * pi() / 12.0))", 6), rounded("cos(mes * (2.0 * pi() / 12.0))", 6)


def _rounded_season(df):
    return df.withColumns({"mes_sin": F.round("mes_sin", 6), "mes_cos": F.round("mes_cos", 6)})


def _features_a(spark, sf_dir):
    return ml.granular_features(ad.star(spark, sf_dir), "A")


def _features_b(spark, sf_dir):
    return ml.monthly_features(ad.star(spark, sf_dir), ad.EVENT_COLUMNS, base_year=1995)


@query("features_granular", with_star(f"SELECT *, {_SIN} AS mes_sin, {_COS} AS mes_cos FROM feats", _FEATURES_A))
def features_granular(spark, sf_dir):
    return _rounded_season(_features_a(spark, sf_dir))


_PIVOT = ", ".join(f"CAST(coalesce(sum(CASE WHEN tipo_evento = '{k}' THEN cantidad END), 0) AS BIGINT) AS {v}" for k, v in {**ad.EVENT_COLUMNS, "Defunciones": "total_defunciones"}.items())
_FEATURES_B = CONTEXT + f""", wide AS (SELECT id_tiempo_mes, CAST(substr(id_tiempo_mes, 6, 2) AS INTEGER) AS mes, CAST(substr(id_tiempo_mes, 1, 4) AS INTEGER) - 1995 AS anio_desde_inicio, {_PIVOT} FROM ctx GROUP BY 1, 2, 3)"""


@query("features_monthly", with_star(f"SELECT * EXCLUDE (mes), {_SIN} AS mes_sin, {_COS} AS mes_cos FROM wide WHERE total_defunciones > 0", _FEATURES_B))
def features_monthly(spark, sf_dir):
    return _rounded_season(_features_b(spark, sf_dir))


@query(
    "train_test_split",
    with_star(
        "SELECT u < 0.8 AS train, count(*) AS n FROM (SELECT (CAST('0x' || substr(md5(id_tiempo_mes || '|42'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u FROM wide WHERE total_defunciones > 0) GROUP BY 1",
        _FEATURES_B,
    ),
)
def train_test_split(spark, sf_dir):
    train, test = ml.split(_features_b(spark, sf_dir), "id_tiempo_mes")
    both = train.select(F.lit(True).alias("train")).unionByName(test.select(F.lit(False).alias("train")))
    return both.groupBy("train").agg(F.count(F.lit(1)).alias("n"))


MONTHLY = (*ad.EVENT_COLUMNS.values(), "mes_sin", "mes_cos", "anio_desde_inicio")


def _draw(*keys: str) -> str:
    text = " || '|' || ".join([f"CAST({k} AS VARCHAR)" for k in keys] + ["'42'"])
    return f"(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE < 0.8"


def _solved(rows: str, key, numeric, target: str, categorical=(), sweeps: int = 3_000) -> str:
    """CTEs that fit both models in SQL: products of scaled features, elimination for ridge, coordinate descent for lasso."""
    season = {"mes_sin": "sin(mes * (2.0 * pi() / 12.0))", "mes_cos": "cos(mes * (2.0 * pi() / 12.0))"}
    own = "[" + ", ".join(f"CAST({season.get(c, c)} AS DOUBLE)" for c in numeric) + "]"
    hot = [f"list_transform((SELECT list_sort(list(DISTINCT {c})) FROM drawn WHERE train), lambda l: CASE WHEN {c} = l THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)" for c in categorical]
    x = f"list_concat({own}, {', '.join(hot)})" if hot else own
    return f"""drawn AS (SELECT *, {_draw(*key)} AS train, row_number() OVER () AS rn FROM {rows}),
    xs AS (SELECT rn, train, CAST({target} AS DOUBLE) AS y, {x} AS x FROM drawn),
    long AS (SELECT rn, train, y, unnest(generate_series(1, len(x))) AS i, unnest(x) AS v FROM xs),
    st AS (SELECT i, avg(v) AS m, stddev_samp(v) AS s FROM long WHERE train GROUP BY 1),
    ym AS (SELECT avg(y) AS y0, count(*) AS n FROM xs WHERE train),
    z AS (SELECT rn, train, y, i, CASE WHEN s > 1e-12 THEN (v - m) / s ELSE 0.0::DOUBLE END AS z FROM long JOIN st USING (i)),
    gram AS (SELECT a.i, b.i AS j, sum(a.z * b.z) AS g FROM z a JOIN z b USING (rn) WHERE a.train GROUP BY 1, 2),
    crossed AS (SELECT i, sum(z * (y - y0)) AS c FROM z, ym WHERE train GROUP BY 1),
    lines AS (SELECT i, list(g ORDER BY j) AS g FROM gram GROUP BY 1),
    held AS (SELECT list(g ORDER BY i) AS g, (SELECT list(c ORDER BY i) FROM crossed) AS c, count(*) AS d, (SELECT n FROM ym) AS n FROM lines),
    gauss AS (SELECT 1 AS k, d, list_transform(g, lambda r, i: list_append(list_transform(r, lambda v, j: v + CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), c[i])) AS a FROM held
      UNION ALL SELECT k + 1, d, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k]) ELSE list_transform(r, lambda v, j: v - r[k] * a[k][j] / a[k][k]) END) FROM gauss WHERE k <= d),
    descent AS (SELECT 0 AS k, g, c, d, n, list_transform(c, lambda v: 0.0::DOUBLE) AS b FROM held
      UNION ALL SELECT k + 1, g, c, d, n, list_transform(b, lambda v, i: CASE WHEN i <> k % d + 1 THEN v WHEN g[i][i] < 1e-9 THEN 0.0::DOUBLE ELSE
        sign(c[i] - list_inner_product(g[i], b) + g[i][i] * v) * greatest(abs(c[i] - list_inner_product(g[i], b) + g[i][i] * v) - n, 0) / g[i][i] END) FROM descent WHERE k < d * {sweeps}),
    beta AS (SELECT 'ridge' AS model, list_transform(a, lambda r: r[d + 1]) AS b FROM gauss WHERE k = d + 1 UNION ALL SELECT 'lasso', b FROM descent WHERE k = d * {sweeps}),
    scored AS (SELECT model, rn, any_value(y) AS y, any_value(y0) + sum(z * b[i]) AS p FROM z, ym, beta WHERE NOT train GROUP BY 1, 2)"""


_METRICS = f"SELECT model, count(*) AS n, {rounded('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS r2, {rounded('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse, {rounded('avg(abs(y - p))', 4)} AS mae FROM scored GROUP BY 1"
_KEYS_A = list(ad.gold.FACT_KEYS)
_MODEL_B = _solved("(SELECT * FROM wide WHERE total_defunciones > 0)", ["id_tiempo_mes"], MONTHLY, "total_defunciones")
_MODEL_A = _solved("feats", _KEYS_A, ml.GRANULAR_NUMERIC, "cantidad_fallecidos", ml.DESCRIPTORS, sweeps=300)


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _fit_both(features, key, numeric, target, categorical=()):
    train, test = ml.split(cut_lineage(features), key)
    return fitted(train, numeric, target, categorical), test


def _model_rows(features, key, numeric, target, categorical=()):
    lines, test = _fit_both(features, key, numeric, target, categorical)
    return stack_tables([ml.metrics(line.predict(test), target).withColumn("model", F.lit(kind)) for kind, line in lines.items()])


@query("model_monthly", _recursive(with_star(_METRICS, _FEATURES_B, _MODEL_B)))
def model_monthly(spark, sf_dir):
    """Ridge and lasso on monthly totals: test-set metrics."""
    return _model_rows(_features_b(spark, sf_dir), "id_tiempo_mes", MONTHLY, "total_defunciones")


@query("model_granular", _recursive(with_star(_METRICS, _FEATURES_A, _MODEL_A)))
def model_granular(spark, sf_dir):
    """Ridge and lasso on fact cells with one-hot descriptors: test-set metrics."""
    return _model_rows(_features_a(spark, sf_dir), _KEYS_A, ml.GRANULAR_NUMERIC, "cantidad_fallecidos", ml.DESCRIPTORS)


_NAMES_B = "[" + ", ".join(f"'{c}'" for c in MONTHLY) + "]"


@query(
    "coefficient_ranking",
    _recursive(with_star(
        f"""SELECT feature, {rounded('c', 3)} AS coefficient, CASE WHEN c > 0 THEN 'up' WHEN c < 0 THEN 'down' ELSE 'none' END AS effect
        FROM (SELECT unnest({_NAMES_B}) AS feature, unnest(b) AS c FROM beta WHERE model = 'lasso') ORDER BY abs(c) DESC, feature LIMIT 10""",
        _FEATURES_B, _MODEL_B,
    )),
)
def coefficient_ranking(spark, sf_dir):
    """The lasso's features by the size of their coefficients."""
    lines, _ = _fit_both(_features_b(spark, sf_dir), "id_tiempo_mes", MONTHLY, "total_defunciones")
    return ml.coefficients(lines["lasso"], spark).withColumn("coefficient", F.round("coefficient", 3))


@query(
    "lasso_certificate",
    _recursive(with_star(f"SELECT unnest({_NAMES_B}) AS feature, unnest(list_transform(b, lambda v: v <> 0)) AS active, true AS holds FROM beta WHERE model = 'lasso'", _FEATURES_B, _MODEL_B)),
)
def lasso_certificate(spark, sf_dir):
    """Per feature whether the lasso's optimality condition holds, from the residuals of the rows themselves."""
    train, _ = ml.split(cut_lineage(_features_b(spark, sf_dir)), "id_tiempo_mes")
    line = fitted(train, MONTHLY, "total_defunciones")["lasso"]
    m, scored = line.moments, line.predict(train)
    rest = F.col("total_defunciones") - F.col("prediction")
    slopes = scored.agg(*[F.avg((F.col(c) - F.lit(float(m.mean[i]))) / F.lit(float(m.scale[i]) or 1.0) * rest).alias(c) for i, c in enumerate(MONTHLY)])
    each = slopes.unpivot([], list(MONTHLY), "feature", "slope")
    sign = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(MONTHLY) for x in (c, float(np.sign(line.coefficients[i])))]), F.col("feature"))
    holds = F.when(sign != 0, F.abs(F.col("slope") - sign) < 1e-6).otherwise(F.abs("slope") < 1 + 1e-6)
    return each.select("feature", (sign != 0).alias("active"), holds.alias("holds"))


_LINE_A = """line_a AS (SELECT id_tiempo_mes, cantidad_fallecidos AS y, i + s * total_defunciones_renap AS p FROM feats,
  (SELECT regr_slope(cantidad_fallecidos, total_defunciones_renap) AS s, regr_intercept(cantidad_fallecidos, total_defunciones_renap) AS i FROM feats))"""
_LINE_B = """line_b AS (SELECT id_tiempo_mes, total_defunciones AS y, i + s * renap_nacimientos AS p FROM wide,
  (SELECT regr_slope(total_defunciones, renap_nacimientos) AS s, regr_intercept(total_defunciones, renap_nacimientos) AS i FROM wide WHERE total_defunciones > 0) WHERE total_defunciones > 0)"""
_WIDE_ONLY = _FEATURES_B[len(CONTEXT) + 2:]


def _line_a(spark, sf_dir):
    return ml.simple_fit(cut_lineage(_features_a(spark, sf_dir)), "total_defunciones_renap", "cantidad_fallecidos")


def _line_b(spark, sf_dir):
    return ml.simple_fit(_features_b(spark, sf_dir), "renap_nacimientos", "total_defunciones")


# one scaled feature has a closed form: z has mean 0 and sample deviation 1, so its squares sum to n - 1
_PENALISED = """moments AS (SELECT count(*) AS n, avg(total_defunciones) AS mean, sum((renap_nacimientos - m) / s * (total_defunciones - t)) AS zy FROM
  (SELECT *, avg(renap_nacimientos) OVER () AS m, stddev_samp(renap_nacimientos) OVER () AS s, avg(total_defunciones) OVER () AS t FROM wide WHERE total_defunciones > 0))"""


@query(
    "penalised_line",
    with_star(
        f"""SELECT 'ridge' AS model, {rounded('zy / (n - 1 + 1.0)', 3)} AS coefficient, {rounded('mean', 3)} AS intercept FROM moments
        UNION ALL SELECT 'lasso', {rounded('sign(zy) * greatest(abs(zy) / n - 1.0, 0) / ((n - 1) / CAST(n AS DOUBLE))', 3)}, {rounded('mean', 3)} FROM moments""",
        _FEATURES_B, _PENALISED,
    ),
)
def penalised_line(spark, sf_dir):
    """Ridge and lasso of one scaled feature, whose coefficients SQL can state."""
    rows, out = cut_lineage(_features_b(spark, sf_dir)), []
    for kind in ("ridge", "lasso"):
        line = ml.fit(rows, ["renap_nacimientos"], "total_defunciones", kind).regression
        out.append((kind, round(float(line.coefficients[0]), 3), round(float(line.intercept), 3)))
    return literal_rows(spark, out, "model string, coefficient double, intercept double")


@query(
    "model_metrics",
    with_star(
        f"SELECT count(*) AS n, {rounded('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS r2, {rounded('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse, {rounded('avg(abs(y - p))', 4)} AS mae FROM line_b",
        _FEATURES_B, _LINE_B,
    ),
)
def model_metrics(spark, sf_dir):
    """Metrics of a closed-form line, so that the formulas can be checked."""
    return ml.metrics(_line_b(spark, sf_dir), "total_defunciones")


@query(
    "model_consistency",
    with_star(
        f"""SELECT count(*) AS months, {rounded('avg(a - b)', 2)} AS mean_difference, {rounded('avg(a - b) * 100.0 / avg(b)', 2)} AS difference_pct, {rounded('corr(a, b)', 4)} AS correlation
        FROM (SELECT id_tiempo_mes, sum(p) AS a FROM line_a GROUP BY 1) JOIN (SELECT id_tiempo_mes, sum(p) AS b FROM line_b GROUP BY 1) USING (id_tiempo_mes)""",
        _FEATURES_A, _WIDE_ONLY, _LINE_A, _LINE_B,
    ),
)
def model_consistency(spark, sf_dir):
    return ml.consistency(_line_a(spark, sf_dir), _line_b(spark, sf_dir))


@query(
    "actual_vs_predicted",
    with_star(f"SELECT id_tiempo_mes, CAST(sum(y) AS BIGINT) AS actual, {rounded('sum(p)', 3)} AS predicted FROM line_b GROUP BY 1", _FEATURES_B, _LINE_B),
)
def actual_vs_predicted(spark, sf_dir):
    return ml.monthly_series(_line_b(spark, sf_dir), "total_defunciones").withColumn("predicted", F.round("predicted", 3))


_RESIDUAL = """res AS (SELECT l_returnflag, l_extendedprice - (i + s * l_quantity) AS r FROM lineitem,
  (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem))"""


def _residuals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    return ml.residuals(ml.simple_fit(rows, "l_quantity", "l_extendedprice"), "l_extendedprice")


@query("residual_band", with_star("SELECT l_returnflag, abs(r) <= (SELECT stddev_samp(r) FROM res) AS in_band, count(*) AS n FROM res GROUP BY 1, 2", _RESIDUAL))
def residual_band(spark, sf_dir):
    return _residuals(spark, sf_dir).groupBy("l_returnflag", "in_band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "residual_histogram",
    with_star(
        f"""SELECT CAST(CASE WHEN r < -60000 THEN 0 WHEN r >= 60000 THEN 25 ELSE floor((r + 60000) / 5000) + 1 END AS BIGINT) AS bin, count(*) AS n,
        {rounded('count(*) / (sum(count(*)) OVER () * 5000.0)', 6)} AS density FROM res GROUP BY 1""",
        _RESIDUAL,
    ),
)
def residual_histogram(spark, sf_dir):
    return ml.histogram(_residuals(spark, sf_dir), "residual", -60000, 60000, 24)
