"""Cleaning, validation, profiles, quarantine, monitoring, text and reshape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions import calendar as cal
from strataframe.functions import text as tx
from strataframe.functions.classify import SEX_SHORT, icd_chapter, relabel
from strataframe.functions.numeric import safe_long
from strataframe.operators import aggregate as ag
from strataframe.operators import validate as dq
from strataframe.operators.filters import non_negative, require
from strataframe.operators.keys import dense_keys, hash_keys, lookup_key
from strataframe.operators.project import new_batch_id, with_audit, without_technical
from strataframe.operators.reshape import first_by, merge_equivalent, overlap_counts, stack_tables
from strataframe.plans import silver
from strataframe.plans.star import necropsy_fact
from strataframe.session import cut_lineage
from strataframe.sources.sinks import row_counts
from strataframe.spec import CodeCheck, RowRule
from strataframe.workload.adapters import parts_with_cause, table
from strataframe.workload.oracle import PARTS, RECORDS, pct, rounded, with_star
from strataframe.workload.registry import query

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# --- cleaning ---------------------------------------------------------------


@query(
    "clean_records",
    """SELECT c_custkey AS cust, coalesce(CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END, 99) AS escodif, CAST(c_custkey % 50 AS INTEGER) AS ciuodif,
    CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 100 - 5 AS INTEGER) END AS edadif, c_mktsegment AS caudef
    FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 100 >= 5""",
)
def clean_records(spark, sf_dir):
    """Names, sentinels in both directions, trimmed upper-case text, negative ages dropped."""
    k = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(
        k.alias("Cust"), F.when(k % 11 != 0, F.col("c_nationkey")).alias("Escodif"), (k % 50).cast("int").alias("Ciuodif"),
        F.when(k % 7 == 0, 999).otherwise((k % 100).cast("int") - 5).alias("Edadif"),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("Caudef"),
    )
    return silver.clean_deaths(raw, drop_negative_ages=True)


@query(
    "clean_duplicates",
    "SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS checksum FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def clean_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("checksum"))


@query(
    "typed_casts",
    """SELECT count(*) AS n, count(v) AS whole, CAST(sum(v) AS BIGINT) AS total, count(d) AS dates FROM (
      SELECT CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 1000 END AS v,
      CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS d FROM orders)""",
)
def typed_casts(spark, sf_dir):
    """NaN and text that is no number or date become NULL instead of failing."""
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        F.when(k % 13 == 0, F.lit("NaN")).when(k % 5 == 0, "n/d").otherwise((k % 1000).cast("string")).alias("v"),
        F.when(k % 3 == 0, "31/13/1999").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
    )
    cast = raw.select(safe_long(F.col("v")).alias("v"), cal.safe_date(F.col("d")).alias("d"))
    return cast.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("whole"), F.sum("v").alias("total"), F.count("d").alias("dates"))


@query(
    "iqr_outliers",
    f"""WITH v AS (SELECT CASE WHEN l_orderkey % 1000 = 0 THEN 1000000.0 WHEN l_orderkey % 37 <> 0 THEN l_extendedprice END AS x FROM lineitem),
    q AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM v)
    SELECT count(*) AS kept_rows, count(x) AS kept_values, {rounded('max(x)', 4)} AS greatest FROM v, q WHERE x IS NULL OR x BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""",
)
def iqr_outliers(spark, sf_dir):
    k = F.col("l_orderkey")
    value = F.when(k % 1000 == 0, 1000000.0).when(k % 37 != 0, F.col("l_extendedprice"))
    kept = dq.remove_outliers(table(spark, sf_dir, "lineitem").select(value.alias("x")), "x", exact=True)
    return kept.agg(F.count(F.lit(1)).alias("kept_rows"), F.count("x").alias("kept_values"), F.round(F.max("x"), 4).alias("greatest"))


@query("iqr_outliers_sketch", "SELECT count(*) AS total, true AS low_quarter, true AS high_quarter, true AS bounds_follow FROM lineitem")
def iqr_outliers_sketch(spark, sf_dir):
    """The default form: bounds from a quantile sketch, checked by the ranks that its quarters have."""
    lines = table(spark, sf_dir, "lineitem")
    quarters = ag.approx_quantiles(lines, "l_extendedprice", (0.25, 0.75)).select(F.struct("q0", "q1")).scalar()
    bounds = dq.outlier_bounds(lines, "l_extendedprice").select(F.struct("low", "high")).scalar()
    value, total = F.col("l_extendedprice"), F.count(F.lit(1))
    # a quarter's rank is off by no more than 1 of 100
    near = lambda q, p: (F.count_if(value < quarters[q]) <= (p + 0.01) * total) & (F.count_if(value <= quarters[q]) >= (p - 0.01) * total)
    spread = F.lit(1.5) * (quarters["q1"] - quarters["q0"])
    follow = (F.abs(F.max(bounds["low"] - (quarters["q0"] - spread))) < 1e-6) & (F.abs(F.max(bounds["high"] - (quarters["q1"] + spread))) < 1e-6)
    return lines.agg(total.alias("total"), near("q0", 0.25).alias("low_quarter"), near("q1", 0.75).alias("high_quarter"), follow.alias("bounds_follow"))


@query(
    "exact_quantiles",
    "SELECT l_returnflag, " + ", ".join(f"{rounded(f'quantile_cont(l_extendedprice, {p})', 4)} AS q{i}" for i, p in enumerate((0.1, 0.5, 0.9))) + " FROM lineitem GROUP BY 1",
)
def exact_quantiles(spark, sf_dir):
    q = ag.exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.1, 0.5, 0.9), by=["l_returnflag"])
    return q.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("q0", "q1", "q2")])


@query(
    "describe_numeric",
    f"SELECT count(l_quantity) AS count, {rounded('avg(l_quantity)', 6)} AS mean, {rounded('stddev_samp(l_quantity)', 6)} AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem",
)
def describe_numeric(spark, sf_dir):
    d = ag.describe_numeric(table(spark, sf_dir, "lineitem"), "l_quantity")
    return d.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query(
    "icd_catalogue",
    """SELECT causa, min(descripcion) AS descripcion, min(lower(regexp_replace(regexp_replace(descripcion, '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+', '_', 'g'))) AS descripcion_snake_case,
    'Centroamérica' AS pais_origen FROM (SELECT upper(p_brand) AS causa, 'Cólera, ' || p_name || ' (' || p_type || ')' AS descripcion FROM part) GROUP BY 1""",
)
def icd_catalogue(spark, sf_dir):
    code = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_brand")).otherwise(F.col("p_brand"))
    text = F.concat(F.lit('"Cólera, '), F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(')"'))
    raw = table(spark, sf_dir, "part").select(code.alias("CAUSA"), text.alias("DESCRIP"))
    return silver.clean_icd_catalogue(raw, "Centroamérica")


@query(
    "icd_chapters",
    with_star(
        """SELECT CASE WHEN s IS NULL OR NOT regexp_matches(s, '^[A-Z][0-9][0-9A-Z]$') THEN NULL WHEN s < 'C00' THEN 'I' WHEN s < 'D50' THEN 'II' WHEN s >= 'I00' AND s < 'J00' THEN 'IX'
        WHEN s >= 'J00' AND s < 'K00' THEN 'X' WHEN s >= 'V00' AND s < 'Z00' THEN 'XX' ELSE 'other' END AS chapter, count(*) AS n
        FROM (SELECT upper(substr(trim(caudef), 1, 3)) AS s FROM parts) GROUP BY 1""",
        PARTS,
    ),
)
def icd_chapters(spark, sf_dir):
    return parts_with_cause(spark, sf_dir).groupBy(icd_chapter(F.col("caudef")).alias("chapter")).agg(F.count(F.lit(1)).alias("n"))


_SLUG = "lower(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9{extra}\\s]', '', 'g'), '\\s+', '_', 'g'))"


@query(
    "text_slugs",
    f"SELECT doc_id, md5({_SLUG.format(extra='')}) AS plain, md5({_SLUG.format(extra='áéíóúÁÉÍÓÚñÑ')}) AS accented, length({_SLUG.format(extra='')}) AS size FROM documents",
)
def text_slugs(spark, sf_dir):
    """Both slug forms over whole document texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", tx.slug(F.col("text")).alias("_s"), tx.slug(F.col("text"), True).alias("_a"))
    return docs.select("doc_id", F.md5("_s").alias("plain"), F.md5("_a").alias("accented"), F.length("_s").cast("long").alias("size"))


@query(
    "text_fields",
    """SELECT page_id, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS name, regexp_replace(regexp_extract(url, '([^/?#]*)([?#].*)?$', 1), '\\.[^.]*$', '') AS stem,
    TRY_CAST(nullif(regexp_extract(url, '\\d+', 0), '') AS INTEGER) AS number, TRY_CAST(nullif(regexp_extract(url, '\\d{4}', 0), '') AS INTEGER) AS year,
    trim(regexp_replace('"' || url || '"', '^"|"$', '', 'g')) AS bare, regexp_replace('[' || url || ']', '[\\[\\]]', '', 'g') AS open FROM pages""",
)
def text_fields(spark, sf_dir):
    url = F.col("url")
    name = tx.base_name(url)
    return table(spark, sf_dir, "pages").select(
        "page_id", name.alias("name"), tx.without_extension(name).alias("stem"), tx.first_number(url).alias("number"), tx.year_in_name(url).alias("year"),
        tx.unquote(F.concat(F.lit('"'), url, F.lit('"'))).alias("bare"), tx.strip_brackets(F.concat(F.lit("["), url, F.lit("]"))).alias("open"),
    )


@query(
    "null_semantics",
    """SELECT concat_ws('-', a, b) AS skipping, a || '-' || b AS propagating, lpad(CAST(k AS VARCHAR), 2, '0') AS padded, count(*) AS n FROM (
    SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS b, o_orderkey % 7 AS k FROM orders) GROUP BY 1, 2, 3""",
)
def null_semantics(spark, sf_dir):
    """concat passes NULL on, concat_ws skips it."""
    k = F.col("o_orderkey")
    a, b = F.when(k % 3 != 0, F.col("o_orderpriority")), F.when(k % 4 != 0, F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(
        F.concat_ws("-", a, b).alias("skipping"), F.concat(a, F.lit("-"), b).alias("propagating"), tx.zero_padded(k % 7).alias("padded")
    )
    return rows.groupBy("skipping", "propagating", "padded").agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_attributes",
    """SELECT strftime(d, '%Y-%m-%d') AS fecha, CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, CAST(quarter(d) AS INTEGER) AS trimestre,
    CAST(isodow(d) AS INTEGER) AS dia_semana, strftime(d, '%Y-%m') AS anio_mes, count(*) AS n FROM (SELECT l_shipdate AS d FROM lineitem) GROUP BY ALL""",
)
def date_attributes(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    return days.withColumns(cal.date_attributes(F.col("_d"))).withColumn("fecha", F.date_format("_d", "yyyy-MM-dd")).drop("_d")


@query(
    "daily_events",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2",
)
def daily_events(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")
    )


@query(
    "grouped_summaries",
    with_star("SELECT sexo, depocu, anoreg, count(*) AS total FROM records GROUP BY 1, 2, 3", RECORDS),
)
def grouped_summaries(spark, sf_dir):
    from strataframe.workload.adapters import death_records

    records = silver.clean_deaths(death_records(spark, sf_dir))
    return records.groupBy("sexo", "depocu", "anoreg").agg(F.count(F.lit(1)).alias("total"))


# --- validation -------------------------------------------------------------

_CODED = """coded AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN -1 WHEN o_orderkey % 19 <> 0 THEN o_custkey END AS cust,
  CASE WHEN o_orderkey % 5 = 0 THEN '9-BAD' ELSE o_orderpriority END AS prio, o_orderstatus AS status, CAST(o_custkey % 30 AS INTEGER) AS place FROM orders)"""
_FLAGS = _CODED + """, flags AS (SELECT *, coalesce(cust IN (SELECT c_custkey FROM customer), false) AS ok1,
  coalesce(prio IN (SELECT o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'), false) AS ok2,
  status <> 'P' AS ok3, coalesce(place IN (SELECT n_nationkey FROM nation), false) AS ok4 FROM coded)"""

CHECKED = [
    CodeCheck("cust", "customers", critical=True),
    CodeCheck("prio", "priorities"),
    CodeCheck("status", "statuses", critical=True),
    CodeCheck("place", "places"),
]


def _coded(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), F.when(k % 17 == 0, -1).when(k % 19 != 0, F.col("o_custkey")).alias("cust"),
        F.when(k % 5 == 0, "9-BAD").otherwise(F.col("o_orderpriority")).alias("prio"), F.col("o_orderstatus").alias("status"),
        (F.col("o_custkey") % 30).cast("int").alias("place"),
    )


def _validated(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    catalogues = {
        "customers": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code")),
        "priorities": orders.filter("o_orderpriority <> '5-LOW'").select(F.col("o_orderpriority").alias("code")),
        "statuses": orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderstatus").alias("code")),
        "places": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code")),
    }
    return dq.validate_all(_coded(spark, sf_dir), CHECKED, catalogues)


@query(
    "validate_kept",
    with_star("SELECT k, cust, CASE WHEN ok2 THEN prio END AS prio, status, CASE WHEN ok4 THEN place END AS place FROM flags WHERE ok1 AND ok3", _FLAGS),
)
def validate_kept(spark, sf_dir):
    return _validated(spark, sf_dir).kept


@query(
    "validate_rejects",
    with_star(
        """SELECT k, cust, prio, status, place, 'cust' AS rejected_by FROM flags WHERE NOT ok1
        UNION ALL SELECT k, cust, prio, status, place, 'prio' FROM flags WHERE ok1 AND NOT ok2
        UNION ALL SELECT k, cust, prio, status, place, 'status' FROM flags WHERE ok1 AND NOT ok3
        UNION ALL SELECT k, cust, prio, status, place, 'place' FROM flags WHERE ok1 AND ok3 AND NOT ok4""",
        _FLAGS,
    ),
)
def validate_rejects(spark, sf_dir):
    return _validated(spark, sf_dir).rejects


def _line(i: int, name: str, critical: str, seen: str, ok: str) -> str:
    return f"SELECT {i} AS position, '{name}' AS column_name, {critical} AS critical, count(*) AS checked_rows, count(*) FILTER (NOT {ok}) AS invalid_count, {pct(f'(count(*) FILTER (NOT {ok}))', 'count(*)')} AS invalid_pct FROM flags WHERE {seen}"


@query(
    "validate_report",
    with_star(
        " UNION ALL ".join([
            _line(1, "cust", "true", "true", "ok1"), _line(2, "prio", "false", "ok1", "ok2"),
            _line(3, "status", "true", "ok1", "ok3"), _line(4, "place", "false", "ok1 AND ok3", "ok4"),
        ]),
        _FLAGS,
    ),
)
def validate_report(spark, sf_dir):
    return _validated(spark, sf_dir).report


@query("validate_critical", with_star("SELECT k, cust, prio, status, place FROM flags WHERE ok1", _FLAGS))
def validate_critical(spark, sf_dir):
    return dq.validate_codes(_coded(spark, sf_dir), "cust", table(spark, sf_dir, "customer"), "c_custkey", critical=True)[0]


@query("validate_nullify", with_star("SELECT k, cust, prio, status, CASE WHEN ok4 THEN place END AS place FROM flags", _FLAGS))
def validate_nullify(spark, sf_dir):
    return dq.validate_codes(_coded(spark, sf_dir), "place", table(spark, sf_dir, "nation"), "n_nationkey")[0]


RULES = [
    RowRule("quantity", "l_quantity between 2 and 49"),
    RowRule("day", "day(l_shipdate) between 1 and 28"),
    RowRule("discount", "nullif(l_discount, 0.0) <= 0.09"),
]


@query(
    "quarantine",
    """SELECT concat_ws(',', CASE WHEN NOT l_quantity BETWEEN 2 AND 49 THEN 'quantity' END, CASE WHEN day(l_shipdate) > 28 THEN 'day' END,
    CASE WHEN NOT coalesce(nullif(l_discount, 0.0) <= 0.09, false) THEN 'discount' END) AS reasons, count(*) AS n FROM lineitem GROUP BY 1""",
)
def quarantine(spark, sf_dir):
    valid, errors = dq.quarantine(table(spark, sf_dir, "lineitem"), RULES)
    both = stack_tables([valid.select(F.lit("").alias("reasons")), errors.select("reasons")])
    return both.groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mandatory_keys",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND (o_orderkey % 23 = 0 OR o_orderkey % 29 - 3 >= 0) GROUP BY 1",
)
def mandatory_keys(spark, sf_dir):
    """Rows without a mandatory key go; negative measures go; missing measures stay."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.when(k % 17 != 0, k).alias("a"), F.when(k % 19 != 0, k).alias("b"), F.when(k % 23 != 0, k % 29 - 3).alias("v")
    )
    return require(rows, "a", "b").filter(non_negative("v")).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "null_profile",
    "SELECT column_name, n AS null_count, " + pct("n", "(SELECT count(*) FROM customer)") + " AS null_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (c_custkey % {m} = 0) AS n FROM customer" for c, m in (("c_name", 3), ("c_nationkey", 7), ("c_mktsegment", 50))
    )
    + " UNION ALL SELECT 'c_custkey', 0)",
)
def null_profile(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", *[F.when(k % m != 0, F.col(c)).alias(c) for c, m in (("c_name", 3), ("c_nationkey", 7), ("c_mktsegment", 50))]
    )
    return ag.null_profile(rows)


@query(
    "duplicate_profile",
    """SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def duplicate_profile(spark, sf_dir):
    return ag.duplicate_profile(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


_TYPE = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"


def _profile(name: str) -> str:
    columns = f"(SELECT column_name || ' ' || {_TYPE} AS c, row_number() OVER () AS place FROM (DESCRIBE {name}))"
    return (
        f"SELECT '{name}' AS table_name, CAST((SELECT count(*) FROM {columns}) AS INTEGER) AS column_count, "
        f"(SELECT count(*) FROM {name}) AS row_count, (SELECT string_agg(c, ', ' ORDER BY place) FROM {columns}) AS column_types"
    )


@query("table_profiles", " UNION ALL ".join(_profile(t) for t in TABLES))
def table_profiles(spark, sf_dir):
    return dq.profile_tables({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "audit_presence",
    """SELECT 'audited' AS table_name, count(*) AS row_count, true AS audited, '' AS missing_columns FROM orders
    UNION ALL SELECT 'published', count(*), false, 'bronze_loaded_at,bronze_batch_id,bronze_source' FROM orders""",
)
def audit_presence(spark, sf_dir):
    audited = with_audit(table(spark, sf_dir, "orders"), new_batch_id(), "orders")
    return dq.audit_presence({"audited": audited, "published": without_technical(audited)})


@query(
    "distinct_values", "SELECT DISTINCT l_shipdate IS NULL AS missing, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem"
)
def distinct_values(spark, sf_dir):
    months = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    return ag.distinct_values(months, "month").withColumn("missing", F.col("month").isNull())


_SETS = {"orders": "SELECT o_custkey AS v FROM orders", "customers": "SELECT c_custkey AS v FROM customer", "suppliers": "SELECT s_suppkey AS v FROM supplier", "users": "SELECT user_id AS v FROM events"}
_PAIRS = [(a, b) for i, a in enumerate(_SETS) for b in list(_SETS)[i + 1:]]


@query(
    "set_overlap",
    " UNION ALL ".join(f"SELECT '{a}' AS left_set, '{b}' AS right_set, count(*) AS shared FROM ({_SETS[a]} INTERSECT {_SETS[b]})" for a, b in _PAIRS),
)
def set_overlap(spark, sf_dir):
    return overlap_counts({
        "orders": table(spark, sf_dir, "orders").select("o_custkey"), "customers": table(spark, sf_dir, "customer").select("c_custkey"),
        "suppliers": table(spark, sf_dir, "supplier").select("s_suppkey"), "users": table(spark, sf_dir, "events").select("user_id"),
    })


@query(
    "first_by_key",
    """SELECT o_custkey, first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS o_orderkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day FROM orders GROUP BY 1""",
)
def first_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_day"))
    return first_by(rows, "o_custkey", ["first_day"])


@query(
    "semantic_duplicates",
    "SELECT upper(trim(p_type)) AS kind, CASE p_size % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'TODOS' END AS sex, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1, 2",
)
def semantic_duplicates(spark, sf_dir):
    """Records that differ in spelling only become one, measures add up."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        F.when(k % 2 == 0, F.lower(F.concat(F.lit(" "), "p_type"))).otherwise(F.col("p_type")).alias("kind"),
        F.when(F.col("p_size") % 3 == 0, "Male").when(F.col("p_size") % 3 == 1, "Female").otherwise("All").alias("sex"),
        F.col("p_size").alias("size"),
    )
    return merge_equivalent(rows, {"kind": tx.clean_upper(F.col("kind")), "sex": relabel(F.col("sex"), SEX_SHORT)}, "size")


# --- enrichment -------------------------------------------------------------

_AGE = "CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey % 95 AS INTEGER) END"
_NECRO = f"""necro AS (SELECT o_orderkey AS id, o_custkey, o_orderkey % 7 AS cause, {_AGE} AS age,
  strftime(o_orderdate, '%Y-%m') AS anio_mes, o_orderstatus FROM orders)"""


def _necropsies(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"), F.col("o_custkey").alias("municipio_id"), (k % 7).cast("int").alias("causa_muerte_id"),
        F.when(k % 31 == 0, "NI").otherwise(F.concat((k % 95).cast("string"), F.lit(" años"))).alias("edad"),
        F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("sexo"), F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"),
    )


@query(
    "snowflake_enrich",
    with_star(
        """SELECT n_name AS departamento_nombre, r_name AS causa_muerte_nombre, CASE WHEN age < 18 THEN 'Menor' WHEN age < 60 THEN 'Adulto' ELSE 'Adulto Mayor' END AS grupo_etario,
        (age // 5 * 5) || '-' || (age // 5 * 5 + 4) AS grupo_quinquenal, coalesce(age >= 60, false) AS es_adulto_mayor, count(*) AS n
        FROM necro LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON cause = r_regionkey GROUP BY ALL""",
        _NECRO,
    ),
)
def snowflake_enrich(spark, sf_dir):
    towns = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.col("c_nationkey").alias("departamento_id"))
    places = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nombre"))
    causes = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("nombre"))
    rich = silver.enrich_necropsies(_necropsies(spark, sf_dir), towns, places, causes)
    return rich.groupBy("departamento_nombre", "causa_muerte_nombre", "grupo_etario", "grupo_quinquenal", "es_adulto_mayor").agg(F.count(F.lit(1)).alias("n"))


@query(
    "necropsy_fact",
    with_star(
        """SELECT id AS necropsia_id, dense_rank() OVER (ORDER BY o_custkey) AS municipio_key, CASE WHEN cause < 5 THEN cause + 1 ELSE -1 END AS causa_muerte_key,
        o_orderstatus AS sexo, age AS edad, coalesce(age >= 60, false) AS es_adulto_mayor, (age // 5 * 5) || '-' || (age // 5 * 5 + 4) AS grupo_etario, anio_mes FROM necro""",
        _NECRO,
    ),
)
def necropsy_fact_rows(spark, sf_dir):
    records = _necropsies(spark, sf_dir)
    towns = dense_keys(records, ["municipio_id"], "municipio_key")
    causes = dense_keys(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("causa_id")), ["causa_id"], "causa_muerte_key")
    return necropsy_fact(records, towns, causes)


@query(
    "surrogate_keys",
    "SELECT c_nationkey, c_mktsegment, dense_rank() OVER (ORDER BY c_nationkey, c_mktsegment) AS member_key FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)",
)
def surrogate_keys(spark, sf_dir):
    return dense_keys(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "member_key")


@query(
    "surrogate_hash_keys",
    """WITH m AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) SELECT o_orderpriority, count(*) AS members, count(*) AS distinct_keys, CAST(sum(o_custkey) AS BIGINT) AS checksum,
    (SELECT count(*) FROM m) AS all_keys FROM m GROUP BY 1""",
)
def surrogate_hash_keys(spark, sf_dir):
    """Keys of 20 bits, more above 2^17 members, so that many members collide at first; every member has a key of its own in the end."""
    keyed = cut_lineage(hash_keys(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "member_key", bits=20, room=8))
    every = keyed.select(F.countDistinct("member_key")).scalar()
    own = keyed.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("member_key").alias("distinct_keys"), F.sum("o_custkey").alias("checksum"))
    return own.withColumn("all_keys", every)


@query(
    "surrogate_lookup",
    """SELECT member_key, count(*) AS n FROM (SELECT coalesce(k, -1) AS member_key FROM customer LEFT JOIN (
    SELECT s, dense_rank() OVER (ORDER BY s) AS k FROM (SELECT DISTINCT c_mktsegment AS s FROM customer WHERE c_mktsegment <> 'BUILDING')) ON c_mktsegment = s) GROUP BY 1""",
)
def surrogate_lookup(spark, sf_dir):
    people = table(spark, sf_dir, "customer")
    members = dense_keys(people.filter("c_mktsegment <> 'BUILDING'"), ["c_mktsegment"], "member_key")
    return lookup_key(people, members, {"c_mktsegment": "c_mktsegment"}, "member_key").groupBy("member_key").agg(F.count(F.lit(1)).alias("n"))


# --- monitoring -------------------------------------------------------------


@query("load_monitor", "SELECT strftime(ts, '%Y-%m-%d') AS load_date, event_type AS batch_id, count(*) AS new_rows FROM events GROUP BY 1, 2")
def load_monitor(spark, sf_dir):
    return dq.load_monitor(table(spark, sf_dir, "events"), "ts", "event_type").withColumn("load_date", F.date_format("load_date", "yyyy-MM-dd"))


@query(
    "load_alerts",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE day(ts) <> 10 AND (day(ts) <> 20 OR user_id % 5 = 0) GROUP BY 1),
    c AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
    f AS (SELECT c.day, coalesce(n, 0) AS n FROM c LEFT JOIN d ON c.day = d.day)
    SELECT strftime(day, '%Y-%m-%d') AS load_date, n AS new_rows, p AS previous_rows, CASE WHEN n = 0 THEN 'empty' WHEN n < p * 0.5 THEN 'fall' ELSE 'ok' END AS alert
    FROM (SELECT day, n, lag(n) OVER (ORDER BY day) AS p FROM f)""",
)
def load_alerts(spark, sf_dir):
    """Alerts over event loads from which one day is missing and one is thinned."""
    day = F.dayofmonth("ts")
    loads = table(spark, sf_dir, "events").filter((day != 10) & ((day != 20) | (F.col("user_id") % 5 == 0)))
    return dq.load_alerts(dq.load_monitor(loads, "ts", "event_type")).withColumn("load_date", F.date_format("load_date", "yyyy-MM-dd"))


# --- indicator tables -------------------------------------------------------

_IND = """SELECT l_returnflag AS indicator_code, l_linestatus AS indicator_name, CAST(year(l_shipdate) AS INTEGER) AS year,
  CASE l_linenumber % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'TODOS' ELSE 'Unknown' END AS sex, 'All' AS age_group, CAST(l_quantity AS INTEGER) - 3 AS number,
  'Costa Rica' AS pais, 'CRI' AS codigo_pais, 'CR' AS fuente FROM lineitem"""


@query("indicator_tables", f"SELECT DISTINCT * FROM ({_IND}) WHERE number >= 0")
def indicator_tables(spark, sf_dir):
    """Three tables of one layout with text years, label variants, negative counts and duplicates."""
    n = F.col("l_linenumber") % 4
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("indicator_code"), F.col("l_linestatus").alias("indicator_name"), F.date_format("l_shipdate", "yyyy").alias("year"),
        F.when(n == 0, "Male").when(n == 1, "Female").when(n == 2, "All").otherwise("Unknown").alias("sex"),
        F.lit("[All]").alias("age_group"), (F.col("l_quantity") - 3).alias("number"),
    )
    parts = [raw.filter("indicator_code = 'A'"), raw.filter("indicator_code = 'N'"), raw.filter("indicator_code not in ('A', 'N')")]
    return silver.consolidate_indicators(parts, "Costa Rica", "CRI", "CR")
