"""Dimensions and facts on the worked examples."""

from conftest import rows
from pyspark.sql import functions as F

from strataframe.functions.calendar import MONTH_COLUMNS
from strataframe.operators.reshape import months_to_columns
from strataframe.operators.validate import orphan_rows, part_whole
from strataframe.plans import analytics as an
from strataframe.plans import silver
from strataframe.plans import star as gold
from strataframe.sources.tables import literal_rows

RECORD = "`Añoreg` int, `Mesreg` int, `Depocu` int, `Sexo` int, `Edadif` int, `Caudef` string"


def test_record_to_fact(spark):
    raw = literal_rows(spark, [
        (2020, 10, 1, 1, 68, " covid-19, virus identificado (u07.1)"), (2020, 10, 1, 9, 999, None), (None, 10, 1, 1, 3, "J12"),
    ], RECORD)
    fact = gold.fact_from_records(silver.clean_deaths(raw))
    assert rows(fact) == [("2020-10", "GT-1", "A-Todas", "DESCONOCIDA", 1, "INE"), ("2020-10", "GT-1", "H-65+", "COVID", 1, "INE")]


def test_daily_to_monthly(spark):
    nan = float("nan")
    series = literal_rows(spark, [
        ("2020-04-01", "Guatemala", 23.0), ("2020-04-02", "Guatemala", 17.0), ("2020-04-03", "Guatemala", nan), ("2020-05-01", "Guatemala", None),
        ("2020-05-02", "Guatemala", 0.0), ("2019-12-31", "Guatemala", 5.0), ("2020-04-09", "Costa Rica", 2.0), ("2020-04-09", "Elsewhere", 2.0),
    ], "date_reported string, country string, new_deaths double")
    assert rows(gold.fact_from_series(series)) == [
        ("2020-04", "CR-NA", "A-Todas", "COVID", 2, "CR"), ("2020-04", "GT-NA", "A-Todas", "COVID", 40, "OMS"),
    ]


def test_drifting_years_to_context(spark):
    months = list(MONTH_COLUMNS)
    y2015 = literal_rows(spark, [("NACIMIENTO", *[float(i) for i in range(12)], 66)], "evento string, " + ", ".join(f"{m} double" for m in months) + ", total_anual long")
    y2016 = literal_rows(spark, [("NACIMIENTOS", *range(11), 55), ("Total", *range(11), 55)], "evento string, " + ", ".join(f"{m} long" for m in months[:11]) + ", total_general long")
    y2026 = literal_rows(spark, [("DEFUNCIONES", 1, 2, 3, 4, 5, 15)], "evento string, " + ", ".join(f"{m} long" for m in months[:5]) + ", total long")
    unified = silver.unify_event_years({2015: y2015, 2016: y2016, 2026: y2026})
    assert unified.columns == ["anio", "evento", *months, "total_anual"]
    assert unified.filter("anio = 2016 and diciembre is null").count() == 2
    long = silver.events_by_month(unified)
    assert long.groupBy("anio").count().orderBy("anio").collect() == [(2015, 12), (2016, 22), (2026, 5)]
    context = gold.context_fact(long)
    assert context.filter("tipo_evento = 'Nacimientos'").agg(F.sum("cantidad")).first()[0] == 66 + 55
    back = months_to_columns(silver.events_by_month(unified.filter("anio = 2015")))
    assert rows(back) == rows(unified.filter("anio = 2015").drop("total_anual"))


def test_dimension_sizes(spark):
    time = gold.month_dimension(spark)
    assert time.count() == 144 and time.filter("periodo = 'Pre-COVID'").count() == 62
    assert gold.profile_dimension(spark).count() == 12
    catalogue = literal_rows(spark, [(i, f"causa {i}") for i in range(41)], "id int, nombre string")
    assert gold.cause_dimension(catalogue).count() == 48
    places = literal_rows(spark, [(i, f"lugar {i}") for i in range(23)], "id int, nombre string")
    assert gold.geography_dimension(places).count() == 25


def small_star(spark):
    fact = literal_rows(spark, [
        ("2019-05", "GT-1", "H-65+", "OTRA", 10, "INE"), ("2020-01", "GT-1", "H-65+", "OTRA", 4, "INE"), ("2020-06", "GT-2", "M-15-64", "COVID", 6, "INE"),
        ("2021-06", "GT-2", "A-0-14", "COVID", 3, "INE"), ("2020-06", "GT-NA", "A-Todas", "COVID", 9, "OMS"), ("2020-07", "CR-NA", "A-Todas", "COVID", 2, "CR"),
    ], "id_tiempo_mes string, id_geografia string, id_perfil string, id_causa string, cantidad_fallecidos long, fuente string")
    context = literal_rows(spark, [("2020-06", "Nacimientos", 30, "RENAP"), ("2020-06", "Matrimonios", 5, "RENAP")], "id_tiempo_mes string, tipo_evento string, cantidad long, fuente string")
    places = literal_rows(spark, [(1, "Uno"), (2, "Dos")], "id int, nombre string")
    causes = literal_rows(spark, [(1, "Otra cosa")], "id int, nombre string")
    return gold.Star(gold.month_dimension(spark), gold.geography_dimension(places), gold.profile_dimension(spark), gold.cause_dimension(causes), fact, context)


def test_questions_by_hand(spark):
    star = small_star(spark)
    assert rows(an.covid_by_country_year(star)) == [("Costa Rica", 2020, 1, 2), ("Guatemala", 2020, 1, 9)]
    assert [tuple(r) for r in an.year_on_year(star).collect()] == [
        (2019, "Pre-COVID", 10, None, None), (2020, "Pandemia", 6, 2, 50.0), (2020, "Pre-COVID", 4, -6, -60.0), (2021, "Pandemia", 3, -3, -50.0),
    ]
    assert rows(an.bands_by_period(star)) == [("0-14", "Pandemia", 1, 3, 3.0, 100.0)]
    assert rows(an.natural_growth_by_year(star)) == [("2020", 30, 10, 5, 20, 66.67)]


def test_sql_text_over_registered_views(spark):
    star = small_star(spark)
    star.register()
    text = """SELECT g.pais, SUM(f.cantidad_fallecidos) AS total FROM fact_mortalidad_unificada f JOIN dim_geografia g ON f.id_geografia = g.id_geografia
              JOIN dim_causa_muerte c ON f.id_causa = c.id_causa WHERE c.es_covid = TRUE AND f.fuente IN ('OMS', 'CR') GROUP BY g.pais"""
    assert rows(spark.sql(text)) == rows(an.covid_by_country(star))


def test_gate_and_audits(spark):
    star = small_star(spark)
    bad = literal_rows(spark, [("2020-01", None, "A-Todas", "COVID", 1, "INE"), ("2020-01", "GT-1", "A-Todas", "COVID", 0, "INE"), ("2020-01", "GT-9", "A-Todas", "COVID", 2, "INE")],
                       "id_tiempo_mes string, id_geografia string, id_perfil string, id_causa string, cantidad_fallecidos long, fuente string")
    whole = gold.unified_fact([star.fact_mortalidad_unificada, bad])
    assert whole.count() == 7 and "fecha_actualizacion" in whole.columns
    dims = {"id_tiempo_mes": star.dim_tiempo, "id_geografia": star.dim_geografia, "id_perfil": star.dim_perfil, "id_causa": star.dim_causa_muerte}
    orphans = orphan_rows(whole, dims).select("id_geografia", "missing").collect()
    assert [tuple(r) for r in orphans] == [("GT-9", "id_geografia")]
    parts = {"INE": star.fact_mortalidad_unificada.filter("fuente = 'INE'"), "OMS": star.fact_mortalidad_unificada.filter("fuente = 'OMS'")}
    assert rows(part_whole(parts, whole)) == [("CR", 0, 1, 1), ("INE", 4, 5, 1), ("OMS", 1, 1, 0)]
