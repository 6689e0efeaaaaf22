"""Dimensions, facts and the analytic questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.operators.reshape import months_to_columns, months_to_rows, unpivot_by_sql, unpivot_by_stack
from strataframe.operators.aggregate import pivot_sum, share_of_total
from strataframe.operators.validate import completeness, orphan_rows, part_whole, source_gap
from strataframe.functions.calendar import MONTH_COLUMNS
from strataframe.functions.naming import rename_all
from strataframe.plans import analytics as an
from strataframe.plans import star as gold
from strataframe.workload import adapters as ad
from strataframe.workload.adapters import table
from strataframe.workload.oracle import (
    CAUSE, CAUSE_CASE, CONTEXT, EVENTS, FACT, FACT_A, FACT_S, PLACE, PROFILE, RECORDS, TIME, pct, rounded, with_star,
)
from strataframe.workload.registry import query

# --- dimensions -------------------------------------------------------------


@query("dim_month", with_star("SELECT * FROM dim_t", TIME))
def dim_month(spark, sf_dir):
    return ad.months(spark, sf_dir)


@query("dim_geography", with_star("SELECT * FROM dim_g", PLACE))
def dim_geography(spark, sf_dir):
    return ad.geography(spark, sf_dir)


@query(
    "dim_profile_usage",
    with_star("SELECT p.*, CAST(coalesce(sum(f.cantidad_fallecidos), 0) AS BIGINT) AS total FROM dim_p p LEFT JOIN fact_a f USING (id_perfil) GROUP BY ALL", PROFILE, FACT_A),
)
def dim_profile_usage(spark, sf_dir):
    """Every member of the profile dimension with what the detail fact holds for it."""
    used = ad.star(spark, sf_dir).fact_mortalidad_unificada.filter("fuente = 'A'").groupBy("id_perfil").agg(F.sum(gold.MEASURE).alias("total"))
    return gold.profile_dimension(spark).join(used, "id_perfil", "left").fillna(0, ["total"])


@query("dim_cause", with_star("SELECT * FROM dim_c", CAUSE))
def dim_cause(spark, sf_dir):
    return gold.cause_dimension(ad.cause_names(spark, sf_dir))


# --- facts ------------------------------------------------------------------


@query("fact_detail", with_star("SELECT * FROM fact_a", FACT_A))
def fact_detail(spark, sf_dir):
    return ad.detail_fact(spark, sf_dir)


@query(
    "fact_age_unit",
    with_star(
        """SELECT id_tiempo_mes, id_perfil, count(*) AS cantidad_fallecidos FROM (SELECT anoreg || '-' || lpad(CAST(mesreg AS VARCHAR), 2, '0') AS id_tiempo_mes,
        CASE sexo WHEN 1 THEN 'H' WHEN 2 THEN 'M' ELSE 'A' END || '-' || CASE WHEN edadif IS NULL THEN 'Todas' WHEN (mesreg + edadif // 2) % 4 IN (1, 2) OR edadif < 15 THEN '0-14' WHEN edadif < 65 THEN '15-64' ELSE '65+' END AS id_perfil
        FROM records) GROUP BY 1, 2""",
        RECORDS,
    ),
)
def fact_age_unit(spark, sf_dir):
    """Records whose ages are days or months for some: these are children, whatever the number."""
    records = rename_all(ad.death_records(spark, sf_dir))
    age = F.when(F.col("edadif") != 999, F.col("edadif"))
    coded = records.withColumns({"edadif": age, "perdif": (F.col("mesreg") + F.floor(F.col("edadif") / 2)) % 4})
    fact = gold.fact_from_records(coded, "A", "N-", age_unit="perdif")
    return fact.groupBy("id_tiempo_mes", "id_perfil").agg(F.sum("cantidad_fallecidos").alias("cantidad_fallecidos"))


@query(
    "dim_month_fixed",
    """WITH m AS (SELECT CAST(y AS VARCHAR) || '-' || lpad(CAST(k AS VARCHAR), 2, '0') AS id_tiempo_mes, y AS anio, k AS mes FROM range(1994, 2004) a(y), range(1, 13) b(k))
    SELECT id_tiempo_mes, CAST(anio AS INTEGER) AS anio, CAST(mes AS INTEGER) AS mes, count(o_orderkey) AS n FROM m LEFT JOIN orders ON strftime(o_orderdate, '%Y-%m') = id_tiempo_mes GROUP BY ALL""",
)
def dim_month_fixed(spark, sf_dir):
    """Every month of a fixed range, with the orders that it has; months without any are there too."""
    months = gold.month_dimension(spark, 1994, 2003).select("id_tiempo_mes", F.col("anio").cast("int").alias("anio"), F.col("mes").cast("int").alias("mes"))
    orders = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("id_tiempo_mes")).agg(F.count(F.lit(1)).alias("n"))
    return months.join(orders, "id_tiempo_mes", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


@query("fact_monthly_series", with_star("SELECT * FROM fact_s", FACT_S))
def fact_monthly_series(spark, sf_dir):
    return ad.series_fact(spark, sf_dir)


@query("fact_context", with_star("SELECT * FROM ctx", CONTEXT))
def fact_context(spark, sf_dir):
    return ad.context(spark, sf_dir)


@query("fact_unified", with_star("SELECT * FROM fact", FACT))
def fact_unified(spark, sf_dir):
    return ad.raw_star(spark, sf_dir).fact_mortalidad_unificada


@query(
    "cause_rule_usage",
    with_star(
        f"SELECT caudef, {CAUSE_CASE} AS id_causa, count(*) AS n FROM records GROUP BY 1, 2", RECORDS
    ),
)
def cause_rule_usage(spark, sf_dir):
    """Which cleaned cause text falls under which cause, over all records."""
    from strataframe.functions.classify import classify_cause
    from strataframe.plans.silver import clean_deaths

    counted = clean_deaths(ad.death_records(spark, sf_dir)).groupBy("caudef").agg(F.count(F.lit(1)).alias("n"))
    return classify_cause(counted, "caudef").select("caudef", "id_causa", "n")


# --- yearly wide tables -----------------------------------------------------

_WIDE_MONTHS = ", ".join(f"CAST(sum(CASE WHEN mes_numero = {i} THEN cantidad END) AS BIGINT) AS {c}" for i, c in enumerate(MONTH_COLUMNS, 1))
_WIDE_RAW = EVENTS + f", wide AS (SELECT anio, evento, {_WIDE_MONTHS}, CAST(sum(cantidad) AS BIGINT) AS total_anual FROM civil GROUP BY 1, 2)"
_DRIFT = ", ".join(
    (f"CASE WHEN anio IN (1996{', 2001' if i >= 9 else ''}) THEN NULL ELSE {c} END AS {c}" if i == 12 else f"CASE WHEN anio = 2001 THEN NULL ELSE {c} END AS {c}" if i >= 9 else c)
    for i, c in enumerate(MONTH_COLUMNS, 1)
)
_WIDE = _WIDE_RAW + f", drift AS (SELECT anio, evento, {_DRIFT}, total_anual FROM wide)"


@query("harmonise_years", with_star(f"SELECT CAST(anio AS INTEGER) AS anio, evento, {', '.join(MONTH_COLUMNS)}, total_anual FROM drift", _WIDE))
def harmonise_years(spark, sf_dir):
    return ad.unified_events(spark, sf_dir)


@query(
    "unpivot_months",
    with_star(
        "SELECT anio || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-01' AS fecha, CAST(anio AS INTEGER) AS anio, m AS mes_numero, mes_nombre, evento, cantidad FROM ("
        + " UNION ALL ".join(f"SELECT anio, {i} AS m, '{c}' AS mes_nombre, evento, {c} AS cantidad FROM drift" for i, c in enumerate(MONTH_COLUMNS, 1))
        + ") WHERE cantidad IS NOT NULL",
        _WIDE,
    ),
)
def unpivot_months(spark, sf_dir):
    from strataframe.plans.silver import events_by_month

    return events_by_month(ad.unified_events(spark, sf_dir)).withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd"))


@query(
    "unpivot_variants",
    with_star(
        "SELECT a.evento, CAST(count(*) AS BIGINT) AS months, CAST(sum(v) AS BIGINT) AS total FROM ("
        + " UNION ALL ".join(f"SELECT evento, {c} AS v FROM wide" for c in MONTH_COLUMNS)
        + ") a WHERE v IS NOT NULL GROUP BY 1 ORDER BY 1",
        _WIDE_RAW,
    ),
)
def unpivot_variants(spark, sf_dir):
    """SQL UNPIVOT and stack() must agree: disagreeing totals leave no row."""
    wide = months_to_columns(ad.civil_events(spark, sf_dir))
    size = [F.count(F.lit(1)).alias("months"), F.sum("v").alias("total")]
    by_sql = unpivot_by_sql(wide, ["anio", "evento"], MONTH_COLUMNS, "m", "v").groupBy("evento").agg(*size)
    by_stack = unpivot_by_stack(wide, ["anio", "evento"], MONTH_COLUMNS, "m", "v").filter("v is not null").groupBy("evento").agg(*size)
    return by_sql.join(by_stack, ["evento", "months", "total"])


@query(
    "pivot_events",
    with_star(
        "SELECT id_tiempo_mes, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN tipo_evento = '{k}' THEN cantidad END), 0) AS BIGINT) AS {v}" for k, v in ad.EVENT_COLUMNS.items()) + " FROM ctx GROUP BY 1",
        CONTEXT,
    ),
)
def pivot_events(spark, sf_dir):
    return pivot_sum(ad.context(spark, sf_dir), ["id_tiempo_mes"], "tipo_evento", ad.EVENT_COLUMNS, "cantidad")


@query(
    "context_from_years",
    with_star(
        """SELECT anio || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS id_tiempo_mes, CASE WHEN evento LIKE '%NACIMIENTO%' THEN 'Nacimientos'
        WHEN evento LIKE '%DEFUNCI%' THEN 'Defunciones' WHEN upper(evento) LIKE '%MATRIMONIO%' THEN 'Matrimonios' WHEN evento = 'DIVORCIO' THEN 'Divorcios'
        WHEN evento = 'ADOPCION' THEN 'Adopciones' ELSE evento END AS tipo_evento, CAST(sum(cantidad) AS BIGINT) AS cantidad, 'RENAP' AS fuente FROM ("""
        + " UNION ALL ".join(f"SELECT anio, {i} AS m, evento, {c} AS cantidad FROM drift" for i, c in enumerate(MONTH_COLUMNS, 1))
        + ") WHERE cantidad IS NOT NULL AND evento <> 'Otros' GROUP BY 1, 2",
        _WIDE,
    ),
)
def context_from_years(spark, sf_dir):
    """The whole route: drifting wide years, one schema, long form, canonical events."""
    return ad.context_from_years(spark, sf_dir)


# --- audits over the star ---------------------------------------------------


@query(
    "fk_audit",
    with_star(
        """SELECT f.*, concat_ws(',', CASE WHEN t.id_tiempo_mes IS NULL THEN 'id_tiempo_mes' END, CASE WHEN g.id_geografia IS NULL THEN 'id_geografia' END) AS missing
        FROM fact f LEFT JOIN (SELECT id_tiempo_mes FROM dim_t WHERE anio <> 1999) t ON f.id_tiempo_mes = t.id_tiempo_mes
        LEFT JOIN (SELECT id_geografia FROM dim_g WHERE id_geografia NOT IN ('N-3', 'EU-NA')) g ON f.id_geografia = g.id_geografia
        WHERE t.id_tiempo_mes IS NULL OR g.id_geografia IS NULL""",
        FACT, TIME, PLACE,
    ),
)
def fk_audit(spark, sf_dir):
    """Orphans of the fact against dimensions from which a year and two places were taken away."""
    star = ad.star(spark, sf_dir)
    return orphan_rows(
        star.fact_mortalidad_unificada,
        {
            "id_tiempo_mes": star.dim_tiempo.filter("anio <> 1999"),
            "id_geografia": star.dim_geografia.filter("id_geografia not in ('N-3', 'EU-NA')"),
            "id_perfil": star.dim_perfil,
            "id_causa": star.dim_causa_muerte,
        },
    )


@query(
    "part_whole",
    with_star(
        "SELECT fuente, count(*) AS part_rows, count(*) AS whole_rows, CAST(0 AS BIGINT) AS difference FROM fact GROUP BY 1", FACT
    ),
)
def part_whole_check(spark, sf_dir):
    series = ad.series_fact(spark, sf_dir)
    parts = {"A": ad.detail_fact(spark, sf_dir), "B": series.filter("fuente = 'B'"), "C": series.filter("fuente = 'C'")}
    return part_whole(parts, ad.star(spark, sf_dir).fact_mortalidad_unificada)


@query(
    "completeness",
    with_star(
        f"""SELECT count(*) AS fact_rows, {pct('count(*)', 'count(*)')} AS complete_key_pct, count(DISTINCT id_tiempo_mes) AS months_with_data,
        CAST(sum(cantidad_fallecidos) AS BIGINT) AS total, (SELECT count(*) FROM daily WHERE new_deaths IS NULL OR isnan(new_deaths)) AS repaired_values FROM fact""",
        FACT,
    ),
)
def completeness_report(spark, sf_dir):
    fact = ad.star(spark, sf_dir).fact_mortalidad_unificada
    return completeness(fact, gold.FACT_KEYS, "id_tiempo_mes", gold.MEASURE, ad.daily_series(spark, sf_dir), "new_deaths")


# --- analytic questions -----------------------------------------------------

_COVID = "JOIN dim_c c ON f.id_causa = c.id_causa AND c.es_covid"
_SUM = "CAST(sum(f.cantidad_fallecidos) AS BIGINT)"
_MEAN = rounded("avg(f.cantidad_fallecidos)", 2)
_YEAR = "CAST(substr(f.id_tiempo_mes, 1, 4) AS INTEGER)"


def _question(name: str, fn, check: str | None, *parts: str, **options):
    @query(name, with_star(check, *parts) if check else None)
    def run(spark, sf_dir):
        return fn(ad.star(spark, sf_dir), scope=ad.SCOPE, **options)

    return run


_question(
    "q01_covid_by_country_year", an.covid_by_country_year,
    f"SELECT g.pais, {_YEAR} AS anio, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos_covid "
    f"FROM fact_s f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} WHERE f.fuente IN ('B', 'C') GROUP BY 1, 2 ORDER BY 2, 1",
    FACT_S, PLACE, CAUSE,
)
_question(
    "q02_covid_by_source_year", an.covid_by_source_year,
    f"SELECT f.fuente, {_YEAR} AS anio, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos_covid "
    f"FROM fact f {_COVID} WHERE f.fuente IN ('A', 'B') GROUP BY 1, 2 ORDER BY 2, 1",
    FACT, CAUSE,
)
_FOUR = (
    f"FROM fact_a f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes JOIN dim_g g ON f.id_geografia = g.id_geografia "
    f"JOIN dim_p p ON f.id_perfil = p.id_perfil {_COVID} WHERE t.periodo = 'Pandemia' AND g.pais = 'AMERICA'"
)
_question(
    "q03_covid_detail_top100", an.covid_detail,
    f"SELECT * EXCLUDE (mes) FROM (SELECT t.anio, t.mes, t.nombre_mes, g.nombre_departamento, p.sexo, p.rango_edad, {_SUM} AS total_fallecidos "
    f"{_FOUR} GROUP BY 1, 2, 3, 4, 5, 6 ORDER BY 1, 2, 7 DESC, 4, 5, 6 LIMIT 100)",
    FACT_A, TIME, PLACE, PROFILE, CAUSE,
)
_question(
    "q04_bands_by_period", an.bands_by_period,
    f"SELECT p.rango_edad, t.periodo, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos, {_MEAN} AS promedio_mensual, "
    f"{pct('sum(f.cantidad_fallecidos)', 'sum(sum(f.cantidad_fallecidos)) OVER (PARTITION BY t.periodo)')} AS porcentaje_del_periodo "
    "FROM fact_a f JOIN dim_p p ON f.id_perfil = p.id_perfil JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes "
    "WHERE p.sexo = 'Ambos' AND p.rango_edad <> 'Todas' GROUP BY 1, 2",
    FACT_A, PROFILE, TIME,
)
_PER_MONTH = rounded("sum(f.cantidad_fallecidos) / CAST(count(DISTINCT f.id_tiempo_mes) AS DOUBLE)", 2)
_question(
    "q04_bands_by_period_per_month", an.bands_by_period,
    f"SELECT p.rango_edad, t.periodo, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos, {_PER_MONTH} AS promedio_mensual, "
    f"{pct('sum(f.cantidad_fallecidos)', 'sum(sum(f.cantidad_fallecidos)) OVER (PARTITION BY t.periodo)')} AS porcentaje_del_periodo "
    "FROM fact_a f JOIN dim_p p ON f.id_perfil = p.id_perfil JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes "
    "WHERE p.sexo = 'Hombre' AND p.rango_edad <> 'Todas' GROUP BY 1, 2",
    FACT_A, PROFILE, TIME, sex="Hombre", per_month=True,
)
_question(
    "q05_natural_growth_by_year", an.natural_growth_by_year,
    f"""SELECT n.anio, b AS total_nacimientos, d AS total_defunciones, m AS total_matrimonios, b - d AS crecimiento_natural, {pct('b - d', 'b')} AS tasa_crecimiento_pct
    FROM (SELECT substr(id_tiempo_mes, 1, 4) AS anio, CAST(sum(cantidad) AS BIGINT) AS b FROM ctx WHERE tipo_evento = 'Nacimientos' GROUP BY 1) n
    JOIN (SELECT substr(id_tiempo_mes, 1, 4) AS anio, CAST(sum(cantidad_fallecidos) AS BIGINT) AS d FROM fact_a GROUP BY 1) d ON n.anio = d.anio
    JOIN (SELECT substr(id_tiempo_mes, 1, 4) AS anio, CAST(sum(cantidad) AS BIGINT) AS m FROM ctx WHERE tipo_evento = 'Matrimonios' GROUP BY 1) m ON n.anio = m.anio""",
    CONTEXT, FACT_A,
)
_question(
    "q06_top_places", an.top_covid_places,
    f"SELECT g.nombre_departamento, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos_covid, {_MEAN} AS promedio_mensual, "
    "min(f.id_tiempo_mes) AS primer_registro, max(f.id_tiempo_mes) AS ultimo_registro "
    f"FROM fact_a f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} WHERE g.id_geografia NOT LIKE '%-NA' GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10",
    FACT_A, PLACE, CAUSE,
)
_question(
    "q06_top_places_per_month", an.top_covid_places,
    f"SELECT g.nombre_departamento, count(DISTINCT f.id_tiempo_mes) AS meses_con_datos, {_SUM} AS total_fallecidos_covid, {_PER_MONTH} AS promedio_mensual, "
    "min(f.id_tiempo_mes) AS primer_registro, max(f.id_tiempo_mes) AS ultimo_registro "
    f"FROM fact_a f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} WHERE g.id_geografia NOT LIKE '%-NA' GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10",
    FACT_A, PLACE, CAUSE, per_month=True,
)
_question(
    "q07_covid_by_sex_band", an.covid_by_sex_band,
    f"""SELECT p.sexo, p.rango_edad, CAST(sum(CASE WHEN c.es_covid THEN f.cantidad_fallecidos ELSE 0 END) AS BIGINT) AS fallecidos_covid,
    CAST(sum(CASE WHEN NOT c.es_covid THEN f.cantidad_fallecidos ELSE 0 END) AS BIGINT) AS fallecidos_otras_causas, {_SUM} AS total_fallecidos,
    {pct('sum(CASE WHEN c.es_covid THEN f.cantidad_fallecidos ELSE 0 END)', 'sum(f.cantidad_fallecidos)')} AS porcentaje_covid
    FROM fact_a f JOIN dim_p p ON f.id_perfil = p.id_perfil JOIN dim_c c ON f.id_causa = c.id_causa JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes
    WHERE t.periodo = 'Pandemia' AND p.sexo <> 'Ambos' AND p.rango_edad <> 'Todas' GROUP BY 1, 2""",
    FACT_A, PROFILE, CAUSE, TIME,
)
_question(
    "q08_monthly_trend", an.covid_monthly_trend,
    f"SELECT f.id_tiempo_mes, t.anio, t.nombre_mes, g.pais, {_SUM} AS fallecidos_covid FROM fact_s f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes "
    f"JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} WHERE f.id_tiempo_mes >= '1998-03' GROUP BY 1, 2, 3, 4",
    FACT_S, TIME, PLACE, CAUSE,
)
_question(
    "q09a_period_summary", an.period_summary,
    f"SELECT t.periodo, count(DISTINCT f.id_tiempo_mes) AS total_meses, {_SUM} AS total_fallecidos, {_MEAN} AS promedio_mensual, "
    f"{rounded('stddev_samp(f.cantidad_fallecidos)', 2)} AS desviacion_estandar FROM fact_a f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes GROUP BY 1",
    FACT_A, TIME,
)
_question(
    "q09a_period_summary_per_month", an.period_summary_per_month,
    f"SELECT t.periodo, count(*) AS total_meses, CAST(sum(m) AS BIGINT) AS total_fallecidos, {rounded('avg(m)', 2)} AS promedio_mensual, {rounded('stddev_samp(m)', 2)} AS desviacion_estandar "
    "FROM (SELECT id_tiempo_mes, CAST(sum(cantidad_fallecidos) AS BIGINT) AS m FROM fact_a GROUP BY 1) f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes GROUP BY 1",
    FACT_A, TIME,
)
_question(
    "q09b_year_on_year", an.year_on_year,
    f"""SELECT anio, periodo, s AS total_fallecidos, s - p AS diferencia_vs_anio_anterior, {pct('(s - p)', 'p')} AS porcentaje_cambio FROM (
    SELECT anio, periodo, s, lag(s) OVER (ORDER BY anio, CASE periodo WHEN 'Pre-COVID' THEN 0 ELSE 1 END) AS p FROM (
      SELECT t.anio, t.periodo, {_SUM} AS s FROM fact_a f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes GROUP BY 1, 2))""",
    FACT_A, TIME,
)
_question(
    "q10_cause_ranking", an.cause_ranking,
    f"""SELECT c.categoria_general, c.es_covid, count(DISTINCT f.id_tiempo_mes) AS meses_registrados, {_SUM} AS total_fallecidos,
    {pct('sum(f.cantidad_fallecidos)', 'sum(sum(f.cantidad_fallecidos)) OVER ()')} AS porcentaje_total, {_MEAN} AS promedio_mensual
    FROM fact_a f JOIN dim_c c ON f.id_causa = c.id_causa GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""",
    FACT_A, CAUSE,
)
_question(
    "q10_cause_ranking_per_month", an.cause_ranking,
    f"""SELECT c.categoria_general, c.es_covid, count(DISTINCT f.id_tiempo_mes) AS meses_registrados, {_SUM} AS total_fallecidos,
    {pct('sum(f.cantidad_fallecidos)', 'sum(sum(f.cantidad_fallecidos)) OVER ()')} AS porcentaje_total, {_PER_MONTH} AS promedio_mensual
    FROM fact_a f JOIN dim_c c ON f.id_causa = c.id_causa GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""",
    FACT_A, CAUSE, per_month=True,
)
_question(
    "q11_covid_totals_country", an.covid_totals_for_country,
    f"SELECT t.periodo, g.nombre_departamento, p.sexo, p.rango_edad, {_SUM} AS total_fallecidos {_FOUR} GROUP BY 1, 2, 3, 4",
    FACT_A, TIME, PLACE, PROFILE, CAUSE,
)
_question(
    "q12_covid_country_all_sources", an.covid_by_country_all_sources,
    f"SELECT g.pais, t.anio, {_SUM} AS fallecidos_covid FROM fact f JOIN dim_g g ON f.id_geografia = g.id_geografia JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes {_COVID} GROUP BY 1, 2",
    FACT, PLACE, TIME, CAUSE,
)
_question("q13_totals_by_source", an.totals_by_source, f"SELECT fuente, count(*) AS registros, {_SUM} AS total FROM fact f GROUP BY 1", FACT)
_question(
    "q14_covid_by_country", an.covid_by_country,
    f"SELECT g.pais, {_SUM} AS total_covid FROM fact_s f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} GROUP BY 1",
    FACT_S, PLACE, CAUSE,
)
_question(
    "q15_places_ranked", an.covid_places_ranked,
    f"SELECT g.nombre_departamento, {_SUM} AS total FROM fact_a f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    FACT_A, PLACE, CAUSE,
)
_question(
    "q15_places_ranked_all", an.covid_places_ranked,
    f"SELECT g.nombre_departamento, {_SUM} AS total FROM fact_a f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} GROUP BY 1",
    FACT_A, PLACE, CAUSE, limit=None,
)
_question(
    "q16_totals_by_year", an.totals_by_year,
    f"SELECT t.anio, {_SUM} AS total FROM fact f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes GROUP BY 1", FACT, TIME,
)
_question(
    "q17_source_totals_prefix", an.source_totals_for_prefix,
    f"SELECT fuente, {_SUM} AS total FROM fact f WHERE id_geografia LIKE 'N-%' GROUP BY 1", FACT,
)
_question(
    "q18_natural_growth_by_month", an.natural_growth_by_month,
    """SELECT *, nacimientos - defunciones AS crecimiento_natural FROM (SELECT id_tiempo_mes,
    max(CASE WHEN tipo_evento = 'Nacimientos' THEN cantidad END) AS nacimientos, max(CASE WHEN tipo_evento = 'Defunciones' THEN cantidad END) AS defunciones FROM ctx GROUP BY 1)""",
    CONTEXT,
)
_question(
    "q19_mean_weddings_by_period", an.mean_event_by_period,
    f"SELECT t.periodo, {rounded('avg(f.cantidad)', 2)} AS promedio_matrimonios FROM ctx f JOIN dim_t t ON f.id_tiempo_mes = t.id_tiempo_mes WHERE tipo_evento = 'Matrimonios' GROUP BY 1",
    CONTEXT, TIME, digits=2,
)
_question(
    "q20_events_by_year", an.events_by_year,
    "SELECT substr(id_tiempo_mes, 1, 4) AS anio, tipo_evento, CAST(sum(cantidad) AS BIGINT) AS total FROM ctx GROUP BY 1, 2", CONTEXT,
)


@query(
    "q21_covid_rate_by_country",
    with_star(
        f"""SELECT p.pais, total_covid, poblacion, {rounded('total_covid * 100000.0 / poblacion', 2)} AS tasa FROM (
        SELECT g.pais, {_SUM} AS total_covid FROM fact_s f JOIN dim_g g ON f.id_geografia = g.id_geografia {_COVID} GROUP BY 1) d
        JOIN (SELECT r_name AS pais, count(*) AS poblacion FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1) p ON d.pais = p.pais""",
        FACT_S, PLACE, CAUSE,
    ),
)
def q21(spark, sf_dir):
    places = ad.table(spark, sf_dir, "nation").join(ad.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = ad.table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    population = people.groupBy(F.col("r_name").alias("pais")).agg(F.count(F.lit(1)).alias("poblacion"))
    return an.covid_rate_by_country(ad.star(spark, sf_dir), population, ad.SCOPE)


_INDICATORS = "(SELECT year(o_orderdate) AS year, o_orderpriority AS indicator_code, o_orderstatus AS pais FROM orders)"


def _indicators(spark, sf_dir):
    return ad.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("indicator_code"), F.col("o_orderstatus").alias("pais")
    )


@query(
    "q22_coverage_by_year",
    f"SELECT CAST(year AS INTEGER) AS year, count(*) AS filas, count(DISTINCT indicator_code) AS indicadores_unicos, count(DISTINCT pais) AS paises FROM {_INDICATORS} WHERE year >= 1997 GROUP BY 1",
)
def q22_by_year(spark, sf_dir):
    return an.coverage_by_year(_indicators(spark, sf_dir), since=1997)


@query(
    "q22_coverage_summary",
    "SELECT count(*) AS total_filas, count(DISTINCT year) AS anos_cobertura, count(DISTINCT indicator_code) AS total_indicadores, "
    f"CAST(min(year) AS INTEGER) AS ano_min, CAST(max(year) AS INTEGER) AS ano_max FROM {_INDICATORS}",
)
def q22_summary(spark, sf_dir):
    return an.coverage_summary(_indicators(spark, sf_dir))


@query(
    "source_gap",
    with_star(
        f"""SELECT anio, a AS first_total, b AS second_total, b - a AS difference, {pct('(b - a)', 'a')} AS difference_pct FROM (
        SELECT substr(id_tiempo_mes, 1, 4) AS anio, CAST(coalesce(sum(cantidad_fallecidos) FILTER (fuente = 'A'), 0) AS BIGINT) AS a,
        CAST(coalesce(sum(cantidad_fallecidos) FILTER (fuente = 'B'), 0) AS BIGINT) AS b FROM fact WHERE fuente IN ('A', 'B') GROUP BY 1)""",
        FACT,
    ),
)
def source_gap_by_year(spark, sf_dir):
    return source_gap(ad.star(spark, sf_dir).fact_mortalidad_unificada, [F.substring("id_tiempo_mes", 1, 4).alias("anio")], "A", "B")


@query(
    "source_scale",
    with_star(
        f"""SELECT fuente, n AS registros, {pct('n', 'sum(n) OVER ()')} AS porcentaje_registros, {rounded('m', 2)} AS promedio_fallecidos,
        {rounded("m / max(CASE WHEN fuente = 'A' THEN m END) OVER ()", 2)} AS razon_escala
        FROM (SELECT fuente, count(*) AS n, avg(cantidad_fallecidos) AS m FROM fact GROUP BY 1)""",
        FACT,
    ),
)
def source_scale(spark, sf_dir):
    return an.source_scale(ad.star(spark, sf_dir), ad.SCOPE)


@query(
    "share_of_total",
    with_star(
        f"SELECT id_geografia, n AS total, {pct('n', '(SELECT sum(cantidad_fallecidos) FROM fact_a)')} AS pct_total FROM (SELECT id_geografia, CAST(sum(cantidad_fallecidos) AS BIGINT) AS n FROM fact_a GROUP BY 1)",
        FACT_A,
    ),
)
def share_of_total_by_place(spark, sf_dir):
    facts = ad.star(spark, sf_dir).fact_mortalidad_unificada.filter("fuente = 'A'")
    per = facts.groupBy("id_geografia").agg(F.sum(gold.MEASURE).alias("total"))
    return share_of_total(per, "total", "pct_total")
