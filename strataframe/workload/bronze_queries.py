"""Files as they arrive, the silver records with all their checks, and options of earlier questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions.naming import drop_matching, rename_all
from strataframe.operators import validate as dq
from strataframe.operators.filters import where_present
from strataframe.operators.project import repair_header
from strataframe.plans import bronze, silver
from strataframe.session import cut_lineage, scratch_path
from strataframe.sources import files, sinks
from strataframe.sources.ledger import Ledger
from strataframe.sources.tables import column_catalogue, describe_tables, list_tables, metadata_records, read_table
from strataframe.spec import RowRule, SourceSpec, TableSpec
from strataframe.workload.adapters import table
from strataframe.workload.oracle import pct
from strataframe.workload.registry import query

# --- files ------------------------------------------------------------------


@query(
    "yearly_union",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum, CAST(sum(o_custkey) AS BIGINT) AS customers,
    count(CASE WHEN year(o_orderdate) % 2 = 1 THEN 1 END) AS with_priority FROM orders GROUP BY 1""",
    folders=True,
)
def yearly_union(spark, sf_dir):
    """Yearly files whose columns differ in order and number, united by name."""
    orders, folder = table(spark, sf_dir, "orders"), scratch_path(spark, "orders-yearly")
    odd = F.year("o_orderdate") % 2 == 1
    writer = lambda df: df.write.mode("append").option("header", True).csv(folder)
    writer(orders.filter(~odd).select("o_orderkey", "o_orderstatus", "o_custkey"))
    writer(orders.filter(odd).select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey"))
    back = bronze.yearly_records(spark, folder, "part-*.csv", "o_orderkey long, o_custkey long")
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("checksum"), F.sum("o_custkey").alias("customers"), F.count("o_orderpriority").alias("with_priority")
    )


def _ragged(spark, sf_dir) -> files.Ragged:
    """Customers as ragged files: BOM, preamble, quoted line ends and quotes, phantom fields, overlong records."""
    k, folder = F.col("c_custkey"), scratch_path(spark, "customers-ragged")
    name = F.concat(F.lit('"'), "c_name", F.when(k % 3 == 0, F.lit('\n""second"" line')).otherwise(F.lit(", ")), F.lit('"'))
    end = F.when(k % 10 == 3, F.lit(",one,two")).when(k % 10 == 4, F.lit(",filled")).when(k % 10 == 5, F.lit(",")).otherwise(F.lit(""))
    data = table(spark, sf_dir, "customer").select((k % 7).alias("part"), k.alias("place"), F.concat(F.concat_ws(",", k.cast("string"), name, "c_mktsegment"), end).alias("line"))
    heads = spark.range(7).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit(-2).cast("long").alias("place"), F.lit('﻿Title with a " quote').alias("line")),
        F.struct(F.lit(-1).cast("long").alias("place"), F.lit("c_custkey,c_name,c_mktsegment").alias("line")),
    ))).select("part", "col.*")
    data.union(heads).repartition(7, "part").sortWithinPartitions("part", "place").select("part", "line").write.partitionBy("part").text(folder)
    return files.read_ragged(spark, folder, skip=1)


@query(
    "ragged_full",
    """SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS checksum, count(CASE WHEN c_custkey % 3 = 0 THEN 1 END) AS two_lines
    FROM customer WHERE c_custkey % 10 <> 3 GROUP BY 1""",
    folders=True,
)
def ragged_full(spark, sf_dir):
    two = F.col("c_name").endswith('\n"second" line')
    return _ragged(spark, sf_dir).rows.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey").try_cast("long")).alias("checksum"), F.count_if(two).alias("two_lines")
    )


@query("ragged_rejects", "SELECT 'overlong' AS reason, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS checksum FROM customer WHERE c_custkey % 10 = 3", folders=True)
def ragged_rejects(spark, sf_dir):
    key = F.substring_index("record", ",", 1).try_cast("long")
    return _ragged(spark, sf_dir).rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("checksum"))


@query(
    "ragged_stray_quote",
    """SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS checksum, count(CASE WHEN c_custkey % 5 = 0 THEN 1 END) AS stray,
    count(CASE WHEN c_custkey % 5 = 1 THEN 1 END) AS two_lines, count(CASE WHEN c_custkey % 5 IN (0, 1) THEN 1 END) AS quotes FROM customer GROUP BY 1""",
    folders=True,
)
def ragged_stray_quote(spark, sf_dir):
    """Customers as lines in which a quote stands inside a field, a quoted name spans lines, or the last quote of a file is never closed."""
    k, folder = F.col("c_custkey"), scratch_path(spark, "customers-stray")
    name = F.when(k % 5 == 0, F.concat(F.substring("c_name", 1, 3), F.lit('" pipe'))).when(k % 5 == 1, F.concat(F.lit('"'), "c_name", F.lit(',\n""x"" y"'))).otherwise(F.col("c_name"))
    data = table(spark, sf_dir, "customer").select((k % 7).alias("part"), k.alias("place"), F.concat_ws(",", k.cast("string"), name, "c_mktsegment", F.lit("5 m")).alias("line"))
    ends = spark.range(7).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("place"), F.lit("c_custkey,c_name,c_mktsegment,size").alias("line")),
        F.struct(F.lit(2**62).alias("place"), F.lit('-1,none,,"5 m').alias("line")),
    ))).select("part", "col.*")
    data.union(ends).repartition(7, "part").sortWithinPartitions("part", "place").select("part", "line").write.partitionBy("part").text(folder)
    back = files.read_ragged_csv(spark, folder).filter("c_custkey <> '-1'")
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey").try_cast("long")).alias("checksum"), F.count_if(F.col("c_name") == 'Cus" pipe').alias("stray"),
        F.count_if(F.col("c_name").endswith(',\n"x" y')).alias("two_lines"), F.count_if(F.col("c_name").contains('"')).alias("quotes"),
    )


@query(
    "source_list",
    """SELECT 'source_' || (c_custkey % 24 // 4) AS source_name, count(*) AS n, count(DISTINCT c_custkey % 24) AS files, CAST(sum(c_custkey) AS BIGINT) AS checksum,
    count(CASE WHEN c_custkey % 3 <> 1 THEN c_name END) AS names, count(CASE WHEN c_custkey % 3 = 2 THEN 1 END) AS segments FROM customer WHERE c_custkey % 3 = 1 OR c_custkey % 7 > 0 GROUP BY 1""",
    folders=True,
)
def source_list(spark, sf_dir):
    """24 files of three layouts, half of them below a title, as six sources read together."""
    k, root = F.col("c_custkey"), scratch_path(spark, "customers-list")
    people = table(spark, sf_dir, "customer").withColumns({"file": k % 24, "source": F.floor(k % 24 / 4), "layout": k % 3})
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit(', x"'))
    line = F.when(F.col("layout") == 0, F.concat_ws(",", k.cast("string"), name)).when(F.col("layout") == 1, k.cast("string")).otherwise(F.concat_ws(",", "c_mktsegment", k.cast("string"), name))
    heads = F.when(F.col("layout") == 0, "c_custkey,c_name").when(F.col("layout") == 1, "c_custkey").otherwise("c_mktsegment,c_custkey,c_name")
    files_ = people.select("file", "source", "layout").distinct()
    titles = files_.filter("source >= 3").select("source", "file", F.lit(-2).cast("long").alias("at"), F.lit('A "title').alias("line"))
    headers = files_.select("source", "file", F.lit(-1).cast("long").alias("at"), heads.alias("line"))
    rows = people.select("source", "file", k.alias("at"), line.alias("line")).union(headers).union(titles)
    rows.repartition(24, "source", "file").sortWithinPartitions("source", "file", "at").select("source", "file", "line").write.partitionBy("source", "file").text(root)
    specs = [SourceSpec(f"source_{i}", f"{root}/source={i}/file=*", "ragged_csv", skip_rows=int(i >= 3)) for i in range(6)]
    united = files.read_sources(spark, specs).withColumn("c_custkey", F.col("c_custkey").try_cast("long"))
    kept = where_present(united, "c_name", F.col("c_name").isNull() | (F.col("c_custkey") % 7 > 0))
    return kept.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.col("c_custkey") % 24).alias("files"), F.sum("c_custkey").alias("checksum"),
        F.count("c_name").alias("names"), F.count("c_mktsegment").alias("segments"),
    )


@query(
    "lost_header",
    "SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS checksum, min(c_name) AS first_name FROM customer GROUP BY 1",
)
def lost_header(spark, sf_dir):
    """Customers whose first row was taken for the header: it comes back as a row, and names and types are set."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    first = people.orderBy("c_custkey").first()
    taken = people.filter(F.col("c_custkey") > first.c_custkey).toDF(*map(str, first))
    whole = repair_header(taken, ["c_custkey", "c_name", "c_mktsegment"], {"c_custkey": "bigint"})
    return whole.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("checksum"), F.min("c_name").alias("first_name"))


@query("column_hygiene", "SELECT o_orderstatus AS order_status__a_b_, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum, 'n_orders,order_key,order_status__a_b_' AS names FROM orders GROUP BY 1")
def column_hygiene(spark, sf_dir):
    """Names with punctuation made plain, columns dropped by name and by pattern."""
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order-Key"), F.col("o_orderstatus").alias("Order.Status (a/b)"), F.lit(1).alias("N Orders"),
        F.col("o_orderdate").alias("^<!___Copyright_9"), F.col("o_custkey").alias("unused"),
    )
    plain = rename_all(drop_matching(raw, "unused", pattern=r"copyright"), "punctuation")
    return plain.groupBy("order_status__a_b_").agg(F.sum("n_orders").alias("n"), F.sum("order_key").alias("checksum"), F.lit(",".join(sorted(plain.columns))).alias("names"))


@query(
    "metadata_catalogue",
    """SELECT t.name, t.owner, t.available, n FROM (VALUES ('orders', 'sales', true), ('customer', 'sales', true), ('lineitem', 'stock', false)) t(name, owner, available)
    JOIN (SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem) USING (name)""",
)
def metadata_catalogue(spark, sf_dir):
    """Catalogue records of three tables beside the rows they hold."""
    specs = [TableSpec("orders", "parquet", "sales", "2020-01-01", "daily"), TableSpec("customer", "parquet", "sales", "2020-01-01", "daily"), TableSpec("lineitem", "parquet", "stock", "2020-01-01", "daily", False)]
    counts = sinks.row_counts({s.name: table(spark, sf_dir, s.name) for s in specs})
    return metadata_records(spark, specs).join(counts, F.col("name") == F.col("table_name")).select("name", "owner", "available", F.col("row_count").alias("n"))


@query(
    "catalogue_roundtrip",
    """SELECT 'orders_by_status' AS name, 'orders, ''by'' status' AS comment, 'o_orderstatus,n,checksum' AS columns, o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum, true AS owner_known, 0 AS left_behind FROM orders GROUP BY o_orderstatus""",
    folders=True,
)
def catalogue_roundtrip(spark, sf_dir):
    """A catalogue table replaced with another schema, described, read back and dropped with its database."""
    orders, folder = table(spark, sf_dir, "orders"), scratch_path(spark, "catalogue")
    database = "db_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    try:
        name = f"{database}.orders_by_status"
        sinks.overwrite_table(orders.select("o_orderkey", "o_custkey"), name, "first")
        by_status = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("checksum"))
        sinks.overwrite_table(by_status, name, "orders, 'by' status", {"owner_team": "sales"})
        known = describe_tables(spark, database).first()
        seen = {"name": known.name, "comment": known.comment, "columns": known.columns, "owner_known": "owner_team=sales" in known.properties}
        rows = cut_lineage(read_table(spark, name).withColumns({c: F.lit(v) for c, v in seen.items()}))
        sinks.drop_table(spark, name)
        left = list_tables(spark, database).filter("not temporary").count()
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return rows.withColumn("left_behind", F.lit(left).cast("int"))


@query("schema_merge", "SELECT count(*) AS n, count(CASE WHEN o_orderkey % 2 = 1 THEN 1 END) AS with_status, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders", folders=True)
def schema_merge(spark, sf_dir):
    """Two appends with different columns, read with the union of both."""
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "orders-merged")
    sinks.append(orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), path)
    sinks.append(orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey"), path)
    return sinks.read_merged(spark, path).agg(F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("with_status"), F.sum("o_custkey").alias("customers"))


@query(
    "append_after_mark",
    """WITH m AS (SELECT max(o_orderkey) AS mark FROM orders WHERE o_orderkey % 5 < 3 AND o_orderkey < (SELECT avg(o_orderkey) FROM orders))
    SELECT CASE WHEN o_orderkey <= mark THEN 1 ELSE 2 END AS batch, o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS checksum FROM orders, m WHERE o_orderkey > mark OR o_orderkey % 5 < 3 GROUP BY 1, 2""",
    folders=True,
)
def append_after_mark(spark, sf_dir):
    """A first load, the rows past its committed mark, and a run that finds nothing more."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    loads = Ledger(spark, scratch_path(spark, "orders-loads"), orders.schema, "o_orderkey").create()
    early = orders.filter("o_orderkey % 5 < 3").filter(F.col("o_orderkey") < orders.select(F.avg("o_orderkey")).scalar())
    for name, source in (("first", early), ("second", orders), ("second", orders), ("third", orders)):
        loads.append_new(name, source)
    return loads.read().groupBy(F.col("batch").cast("int").alias("batch"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("checksum"))


@query(
    "column_catalogue",
    """SELECT table_name AS dataset, CAST(count(*) AS BIGINT) AS columns, string_agg(column_name, ',' ORDER BY ordinal_position) AS names
    FROM (SELECT 'orders' AS table_name, column_name, row_number() OVER () AS ordinal_position FROM (DESCRIBE orders)
    UNION ALL SELECT 'customer', column_name, row_number() OVER () FROM (DESCRIBE customer)) GROUP BY 1""",
)
def column_catalogues(spark, sf_dir):
    listed = column_catalogue({name: table(spark, sf_dir, name) for name in ("orders", "customer")})
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))), lambda c: c["column_name"]), ",")
    return listed.groupBy("dataset").agg(F.count(F.lit(1)).alias("columns"), names.alias("names"))


# --- rules ------------------------------------------------------------------

RANGES = [RowRule("month", "mes between 1 and 12"), RowRule("day", "dia between 1 and 31"), RowRule("age", "edad between 0 and 120")]


@query(
    "range_rules",
    """SELECT concat_ws(',', CASE WHEN NOT coalesce(mes BETWEEN 1 AND 12, false) THEN 'month' END, CASE WHEN NOT coalesce(dia BETWEEN 1 AND 31, false) THEN 'day' END,
    CASE WHEN NOT coalesce(edad BETWEEN 0 AND 120, false) THEN 'age' END) AS reasons, count(*) AS n FROM
    (SELECT l_orderkey % 14 AS mes, CASE WHEN l_partkey % 11 > 0 THEN l_partkey % 33 END AS dia, l_suppkey % 130 - 4 AS edad FROM lineitem) GROUP BY 1""",
)
def range_rules(spark, sf_dir):
    """Months, days and ages out of range, with the rules they break."""
    part = F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 14).alias("mes"), F.when(part % 11 > 0, part % 33).alias("dia"), (F.col("l_suppkey") % 130 - 4).alias("edad")
    )
    return dq.with_reasons(rows, RANGES).groupBy("reasons").agg(F.count(F.lit(1)).alias("n"))


@query(
    "summary_sets",
    """SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS anio, o_orderpriority, count(*) AS n FROM orders
    GROUP BY GROUPING SETS ((o_orderstatus, anio), (anio, o_orderpriority), ())""",
)
def summary_sets(spark, sf_dir):
    """Several groupings in one pass."""
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", F.year("o_orderdate").alias("anio"), "o_orderpriority")
    sets = [["o_orderstatus", "anio"], ["anio", "o_orderpriority"], []]
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], "o_orderstatus", "anio", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# --- silver records with all checks -------------------------------------------

# column of the records -> its expression; catalogue -> its codes
_FIELDS = {
    "asist": "l_linenumber", "cerdef": "(l_orderkey + l_linenumber) % 26", "ocur": "CASE WHEN l_orderkey % 23 <> 0 THEN l_suppkey END",
    "depreg": "l_partkey % 26", "depocu": "l_suppkey % 25", "dredif": "l_partkey % 30", "mupreg": "l_suppkey",
    "mupocu": "l_suppkey + CASE WHEN l_orderkey % 31 = 0 THEN 1000000 ELSE 0 END", "mredif": "l_partkey",
    "escodif": "CASE WHEN l_orderkey % 7 <> 0 THEN l_partkey % 60 END", "ecidif": "l_linenumber % 9", "ciuodif": "CASE WHEN l_orderkey % 5 <> 0 THEN l_partkey % 55 END",
    "pnadif": "l_suppkey", "nacdif": "l_partkey", "predif": "l_orderkey", "perdif": "l_linenumber",
    "edadif": "CASE WHEN l_partkey % 29 = 0 THEN 999 WHEN l_orderkey % 1000 = 0 THEN 5000 ELSE CAST(l_quantity AS INT) * 2 END", "caudef": "l_returnflag",
}
_CODES = {
    "asistencia_recibida": ("nation", "n_nationkey", "n_nationkey < 6"), "certificador": ("nation", "n_nationkey", "true"), "sitio_ocurrencia": ("supplier", "s_suppkey", "true"),
    "departamentos": ("nation", "n_nationkey", "true"), "municipios": ("supplier", "s_suppkey", "true"), "escolaridad": ("part", "p_size", "true"),
    "estado_civil": ("nation", "n_nationkey", "n_nationkey < 7"), "ocupaciones": ("part", "p_size", "true"), "paises": ("customer", "c_custkey", "true"),
    "periodo_edad": ("region", "r_regionkey", "true"),
}


def _silver(spark, sf_dir) -> dq.Validated:
    records = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(c) for c, e in _FIELDS.items()])
    catalogues = {name: table(spark, sf_dir, t).filter(where).select(F.col(code).alias("code")) for name, (t, code, where) in _CODES.items()}
    return silver.silver_deaths(records, catalogues, exact_bounds=True)


def _flags() -> str:
    cleaned = ", ".join(
        f"coalesce({c}, 99) AS {c}" if c in ("escodif", "ciuodif") else f"CASE WHEN {c} <> 999 THEN {c} END AS {c}" if c == "edadif" else c for c in _FIELDS
    )
    known = lambda c: "SELECT {1} FROM {0} WHERE {2}".format(*_CODES[c])
    oks = ", ".join(f"coalesce({c.column} IN ({known(c.catalogue)}), false) AS ok{i}" for i, c in enumerate(silver.DEATH_CHECKS))
    return (
        f"raw AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _FIELDS.items())} FROM lineitem), cleaned AS (SELECT {cleaned} FROM raw), "
        "q AS (SELECT quantile_cont(edadif, 0.25) AS a, quantile_cont(edadif, 0.75) AS b FROM cleaned), "
        "bounded AS (SELECT cleaned.* FROM cleaned, q WHERE edadif IS NULL OR edadif BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)), "
        f"flags AS (SELECT *, {oks} FROM bounded)"
    )


def _reached(i: int) -> str:
    return " AND ".join(["true", *(f"ok{j}" for j in range(i) if silver.DEATH_CHECKS[j].critical)])


_NULLED = [(i, c.column) for i, c in enumerate(silver.DEATH_CHECKS) if not c.critical]


@query(
    "silver_deaths_kept",
    f"WITH {_flags()} SELECT depocu, count(*) AS n, CAST(sum(edadif) AS BIGINT) AS ages, CAST(sum(mupreg) AS BIGINT) AS towns, "
    + ", ".join(f"count(CASE WHEN ok{i} THEN {c} END) AS {c}" for i, c in _NULLED)
    + f" FROM flags WHERE {_reached(len(silver.DEATH_CHECKS))} GROUP BY 1",
)
def silver_deaths_kept(spark, sf_dir):
    """Cleaned, fenced and checked records: rows, sums and the codes that stay, by place."""
    sums = [F.sum("edadif").cast("long").alias("ages"), F.sum("mupreg").cast("long").alias("towns")]
    return _silver(spark, sf_dir).kept.groupBy("depocu").agg(F.count(F.lit(1)).alias("n"), *sums, *[F.count(c).alias(c) for _, c in _NULLED])


@query(
    "silver_deaths_rejects",
    f"WITH {_flags()} "
    + " UNION ALL ".join(f"SELECT '{c.column}' AS rejected_by, count(*) AS n, CAST(sum(mredif) AS BIGINT) AS checksum FROM flags WHERE {_reached(i)} AND NOT ok{i} HAVING count(*) > 0" for i, c in enumerate(silver.DEATH_CHECKS)),
)
def silver_deaths_rejects(spark, sf_dir):
    return _silver(spark, sf_dir).rejects.groupBy("rejected_by").agg(F.count(F.lit(1)).alias("n"), F.sum("mredif").alias("checksum"))


@query(
    "silver_deaths_report",
    f"WITH {_flags()} "
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c.column}' AS column_name, {str(c.critical).lower()} AS critical, count(*) AS checked_rows, count(*) FILTER (NOT ok{i}) AS invalid_count, "
        f"{pct(f'(count(*) FILTER (NOT ok{i}))', 'count(*)')} AS invalid_pct FROM flags WHERE {_reached(i)}"
        for i, c in enumerate(silver.DEATH_CHECKS)
    ),
)
def silver_deaths_report(spark, sf_dir):
    return _silver(spark, sf_dir).report
