"""The analytic questions, as functions over a star.

Grouped results keep the published column names.  Joins carry no hints: the
dimensions are small files or small aggregates, and Spark broadcasts them by
measured size or shuffles them otherwise.  Filters on source and flag reach the
branches of the consolidated fact, so sources a question excludes are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.calendar import PERIOD_AFTER, PERIOD_BEFORE
from strataframe.functions.numeric import percent, rounded_mean
from strataframe.operators.aggregate import crude_rate, share_of_group, share_of_total
from strataframe.plans.star import MEASURE, Star


class Scope(NamedTuple):
    """Which sources and places a question is about."""

    detail: str = "INE"
    national: tuple = ("OMS", "CR")
    country: str = "Guatemala"
    before: str = PERIOD_BEFORE
    after: str = PERIOD_AFTER
    trend_from: str = "2020-03"
    place_prefix: str = "GT"


DEFAULT = Scope()

def _year_of_key() -> Column:
    return F.substring("id_tiempo_mes", 1, 4).cast("int").alias("anio")


def _sum(alias: str) -> Column:
    return F.sum(MEASURE).alias(alias)


def _months(alias: str = "meses_con_datos") -> Column:
    return F.countDistinct("id_tiempo_mes").alias(alias)


def _mean(per_month: bool) -> Column:
    """``promedio_mensual`` as published (mean of fact rows), or the true mean per month with data."""
    monthly = F.round(F.try_divide(F.sum(MEASURE).cast("double"), F.countDistinct("id_tiempo_mes").cast("double")), 2)
    return (monthly if per_month else rounded_mean(F.col(MEASURE))).alias("promedio_mensual")


def _covid_facts(star: Star) -> DataFrame:
    flagged = star.dim_causa_muerte.filter("es_covid").select("id_causa")
    return star.fact_mortalidad_unificada.join(flagged, "id_causa")


def _of(df: DataFrame, *sources: str) -> DataFrame:
    return df.filter(F.col("fuente").isin(*sources))


def covid_by_country_year(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = _of(_covid_facts(star), *scope.national).join(star.dim_geografia.select("id_geografia", "pais"), "id_geografia")
    return facts.groupBy("pais", _year_of_key()).agg(_months(), _sum("total_fallecidos_covid")).orderBy("anio", "pais")


def covid_by_source_year(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = _of(_covid_facts(star), scope.detail, scope.national[0])
    return facts.groupBy("fuente", _year_of_key()).agg(_months(), _sum("total_fallecidos_covid")).orderBy("anio", "fuente")


def _four_way(star: Star, scope: Scope) -> DataFrame:
    return (
        _of(_covid_facts(star), scope.detail)
        .join(star.dim_tiempo.filter(F.col("periodo") == scope.after), "id_tiempo_mes")
        .join(star.dim_geografia.filter(F.col("pais") == scope.country).select("id_geografia", "nombre_departamento"), "id_geografia")
        .join(star.dim_perfil, "id_perfil")
    )


def covid_detail(star: Star, scope: Scope = DEFAULT, limit: int = 100) -> DataFrame:
    """Month, place, sex and band in the pandemic period; the first ``limit`` cells by month and size."""
    grouped = _four_way(star, scope).groupBy("anio", "mes", "nombre_mes", "nombre_departamento", "sexo", "rango_edad").agg(_sum("total_fallecidos"))
    top = grouped.orderBy("anio", "mes", F.desc("total_fallecidos"), "nombre_departamento", "sexo", "rango_edad").limit(limit)
    return top.drop("mes")


def bands_by_period(star: Star, scope: Scope = DEFAULT, sex: str = "Ambos", per_month: bool = False) -> DataFrame:
    """Age bands per period with their share of it."""
    facts = (
        _of(star.fact_mortalidad_unificada, scope.detail)
        .join(star.dim_perfil.filter((F.col("sexo") == sex) & (F.col("rango_edad") != "Todas")), "id_perfil")
        .join(star.dim_tiempo.select("id_tiempo_mes", "periodo"), "id_tiempo_mes")
    )
    grouped = facts.groupBy("rango_edad", "periodo").agg(_months(), _sum("total_fallecidos"), _mean(per_month))
    return share_of_group(grouped, ["periodo"], "total_fallecidos", "porcentaje_del_periodo").orderBy("periodo", F.desc("total_fallecidos"), "rango_edad")


def natural_growth_by_year(star: Star, scope: Scope = DEFAULT, births: str = "Nacimientos", weddings: str = "Matrimonios") -> DataFrame:
    """Births, deaths and weddings per year; the context fact is read once."""
    kind = F.col("tipo_evento")
    year = F.substring("id_tiempo_mes", 1, 4).alias("anio")
    civil = (
        star.fact_contexto_renap.filter(kind.isin(births, weddings)).groupBy(year)
        .agg(
            F.sum(F.when(kind == births, F.col("cantidad"))).alias("total_nacimientos"),
            F.sum(F.when(kind == weddings, F.col("cantidad"))).alias("total_matrimonios"),
        )
        .dropna()
    )
    deaths = _of(star.fact_mortalidad_unificada, scope.detail).groupBy(year).agg(_sum("total_defunciones"))
    growth = F.col("total_nacimientos") - F.col("total_defunciones")
    return (
        civil.join(deaths, "anio")
        .select(
            "anio", "total_nacimientos", "total_defunciones", "total_matrimonios", growth.alias("crecimiento_natural"),
            percent(growth, F.col("total_nacimientos")).alias("tasa_crecimiento_pct"),
        )
        .orderBy("anio")
    )


def top_covid_places(star: Star, scope: Scope = DEFAULT, limit: int = 10, per_month: bool = False) -> DataFrame:
    local = star.dim_geografia.filter(~F.col("id_geografia").like("%-NA")).select("id_geografia", "nombre_departamento")
    grouped = _of(_covid_facts(star), scope.detail).join(local, "id_geografia").groupBy("nombre_departamento").agg(
        _months(), _sum("total_fallecidos_covid"), _mean(per_month),
        F.min("id_tiempo_mes").alias("primer_registro"), F.max("id_tiempo_mes").alias("ultimo_registro"),
    )
    return grouped.orderBy(F.desc("total_fallecidos_covid"), "nombre_departamento").limit(limit)


def covid_by_sex_band(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = (
        _of(star.fact_mortalidad_unificada, scope.detail)
        .join(star.dim_perfil.filter((F.col("sexo") != "Ambos") & (F.col("rango_edad") != "Todas")), "id_perfil")
        .join(star.dim_causa_muerte.select("id_causa", "es_covid"), "id_causa")
        .join(star.dim_tiempo.filter(F.col("periodo") == scope.after).select("id_tiempo_mes"), "id_tiempo_mes")
    )
    covid = F.sum(F.when(F.col("es_covid"), F.col(MEASURE)).otherwise(0))
    other = F.sum(F.when(~F.col("es_covid"), F.col(MEASURE)).otherwise(0))
    return (
        facts.groupBy("sexo", "rango_edad")
        .agg(covid.alias("fallecidos_covid"), other.alias("fallecidos_otras_causas"), _sum("total_fallecidos"))
        .withColumn("porcentaje_covid", percent(F.col("fallecidos_covid"), F.col("total_fallecidos")))
        .orderBy(F.desc("fallecidos_covid"), "sexo", "rango_edad")
    )


def covid_monthly_trend(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = (
        _of(_covid_facts(star), *scope.national).filter(F.col("id_tiempo_mes") >= scope.trend_from)
        .join(star.dim_tiempo.select("id_tiempo_mes", "anio", "nombre_mes"), "id_tiempo_mes")
        .join(star.dim_geografia.select("id_geografia", "pais"), "id_geografia")
    )
    return facts.groupBy("id_tiempo_mes", "anio", "nombre_mes", "pais").agg(_sum("fallecidos_covid")).orderBy("id_tiempo_mes", "pais")


def period_summary(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = _of(star.fact_mortalidad_unificada, scope.detail).join(star.dim_tiempo.select("id_tiempo_mes", "periodo"), "id_tiempo_mes")
    return facts.groupBy("periodo").agg(
        _months("total_meses"), _sum("total_fallecidos"), rounded_mean(F.col(MEASURE)).alias("promedio_mensual"),
        F.round(F.stddev(MEASURE), 2).alias("desviacion_estandar"),
    ).orderBy("periodo")


def period_summary_per_month(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    """The same summary with true monthly means: months are summed before they are averaged."""
    monthly = _of(star.fact_mortalidad_unificada, scope.detail).groupBy("id_tiempo_mes").agg(_sum("_m"))
    return monthly.join(star.dim_tiempo.select("id_tiempo_mes", "periodo"), "id_tiempo_mes").groupBy("periodo").agg(
        F.count(F.lit(1)).alias("total_meses"), F.sum("_m").alias("total_fallecidos"),
        rounded_mean(F.col("_m")).alias("promedio_mensual"), F.round(F.stddev("_m"), 2).alias("desviacion_estandar"),
    ).orderBy("periodo")


def year_on_year(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    """Change against the row before, by year and within a year by period in time order.

    The window runs over one row per year and period.
    """
    grouped = _of(star.fact_mortalidad_unificada, scope.detail).join(
        star.dim_tiempo.select("id_tiempo_mes", "anio", "periodo"), "id_tiempo_mes"
    ).groupBy("anio", "periodo").agg(_sum("total_fallecidos"))
    in_time = Window.orderBy("anio", F.when(F.col("periodo") == scope.before, 0).otherwise(1))
    previous = F.lag("total_fallecidos").over(in_time)
    change = F.col("total_fallecidos") - F.col("_previous")
    return (
        grouped.withColumn("_previous", previous)
        .select("anio", "periodo", "total_fallecidos", change.alias("diferencia_vs_anio_anterior"), percent(change, F.col("_previous")).alias("porcentaje_cambio"))
        .orderBy("anio", "periodo")
    )


def cause_ranking(star: Star, scope: Scope = DEFAULT, limit: int = 10, per_month: bool = False) -> DataFrame:
    facts = _of(star.fact_mortalidad_unificada, scope.detail).join(
        star.dim_causa_muerte.select("id_causa", "categoria_general", "es_covid"), "id_causa"
    )
    grouped = facts.groupBy("categoria_general", "es_covid").agg(
        _months("meses_registrados"), _sum("total_fallecidos"), _mean(per_month)
    )
    # at most one row per category and flag, so the one-partition window is a handful of rows
    total = F.sum("total_fallecidos").over(Window.partitionBy())
    shared = grouped.withColumn("porcentaje_total", percent(F.col("total_fallecidos"), total))
    return shared.orderBy(F.desc("total_fallecidos"), "categoria_general", "es_covid").limit(limit)


def covid_totals_for_country(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    return _four_way(star, scope).groupBy("periodo", "nombre_departamento", "sexo", "rango_edad").agg(_sum("total_fallecidos")).orderBy(
        F.desc("total_fallecidos"), "nombre_departamento", "sexo", "rango_edad"
    )


def covid_by_country_all_sources(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    """As published without a source filter: countries with two sources count twice."""
    facts = (
        _covid_facts(star).join(star.dim_geografia.select("id_geografia", "pais"), "id_geografia")
        .join(star.dim_tiempo.select("id_tiempo_mes", "anio"), "id_tiempo_mes")
    )
    return facts.groupBy("pais", "anio").agg(_sum("fallecidos_covid")).orderBy("pais", "anio")


def totals_by_source(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    return star.fact_mortalidad_unificada.groupBy("fuente").agg(F.count(F.lit(1)).alias("registros"), _sum("total"))


def covid_by_country(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    facts = _of(_covid_facts(star), *scope.national).join(star.dim_geografia.select("id_geografia", "pais"), "id_geografia")
    return facts.groupBy("pais").agg(_sum("total_covid"))


def covid_places_ranked(star: Star, scope: Scope = DEFAULT, limit: int | None = 10) -> DataFrame:
    """``limit`` None gives the full ranking."""
    ranked = _of(_covid_facts(star), scope.detail).join(
        star.dim_geografia.select("id_geografia", "nombre_departamento"), "id_geografia"
    ).groupBy("nombre_departamento").agg(_sum("total")).orderBy(F.desc("total"), "nombre_departamento")
    return ranked if limit is None else ranked.limit(limit)


def totals_by_year(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    return star.fact_mortalidad_unificada.join(star.dim_tiempo.select("id_tiempo_mes", "anio"), "id_tiempo_mes").groupBy("anio").agg(_sum("total"))


def source_totals_for_prefix(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    return star.fact_mortalidad_unificada.filter(F.col("id_geografia").like(f"{scope.place_prefix}%")).groupBy("fuente").agg(_sum("total"))


def natural_growth_by_month(star: Star, scope: Scope = DEFAULT, births: str = "Nacimientos", deaths: str = "Defunciones") -> DataFrame:
    kind = F.col("tipo_evento")
    pivoted = star.fact_contexto_renap.groupBy("id_tiempo_mes").agg(
        F.max(F.when(kind == births, F.col("cantidad"))).alias("nacimientos"),
        F.max(F.when(kind == deaths, F.col("cantidad"))).alias("defunciones"),
    )
    return pivoted.withColumn("crecimiento_natural", F.col("nacimientos") - F.col("defunciones")).orderBy("id_tiempo_mes")


def mean_event_by_period(star: Star, scope: Scope = DEFAULT, event: str = "Matrimonios", digits: int | None = None) -> DataFrame:
    mean = F.avg("cantidad") if digits is None else rounded_mean(F.col("cantidad"), digits)
    return star.fact_contexto_renap.filter(F.col("tipo_evento") == event).join(
        star.dim_tiempo.select("id_tiempo_mes", "periodo"), "id_tiempo_mes"
    ).groupBy("periodo").agg(mean.alias("promedio_matrimonios"))


def events_by_year(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    return star.fact_contexto_renap.groupBy(F.substring("id_tiempo_mes", 1, 4).alias("anio"), "tipo_evento").agg(
        F.sum("cantidad").alias("total")
    ).orderBy("anio", F.desc("total"), "tipo_evento")


def covid_rate_by_country(star: Star, population: DataFrame, scope: Scope = DEFAULT) -> DataFrame:
    """Deaths per 100,000 inhabitants; ``population`` holds (pais, poblacion)."""
    facts = _of(_covid_facts(star), *scope.national).join(star.dim_geografia.select("id_geografia", "pais"), "id_geografia")
    return crude_rate(facts.withColumnRenamed(MEASURE, "total_covid"), population, "pais", "total_covid").orderBy("pais")


def coverage_by_year(df: DataFrame, year: str = "year", indicator: str = "indicator_code", country: str = "pais", since: int | None = None) -> DataFrame:
    rows = df if since is None else df.filter(F.col(year) >= since)
    return rows.groupBy(year).agg(
        F.count(F.lit(1)).alias("filas"), F.countDistinct(indicator).alias("indicadores_unicos"), F.countDistinct(country).alias("paises")
    ).orderBy(year)


def coverage_summary(df: DataFrame, year: str = "year", indicator: str = "indicator_code") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_filas"), F.countDistinct(year).alias("anos_cobertura"),
        F.countDistinct(indicator).alias("total_indicadores"), F.min(year).alias("ano_min"), F.max(year).alias("ano_max"),
    )


def source_scale(star: Star, scope: Scope = DEFAULT) -> DataFrame:
    """Rows, share of rows, mean measure and ratio to the granular source."""
    per = star.fact_mortalidad_unificada.groupBy("fuente").agg(
        F.count(F.lit(1)).alias("registros"), F.avg(MEASURE).alias("_mean")
    )
    # one row per source
    everything = Window.partitionBy()
    base = F.max(F.when(F.col("fuente") == scope.detail, F.col("_mean"))).over(everything)
    return per.select(
        "fuente", "registros", percent(F.col("registros"), F.sum("registros").over(everything)).alias("porcentaje_registros"),
        F.round("_mean", 2).alias("promedio_fallecidos"), F.round(F.try_divide(F.col("_mean"), base), 2).alias("razon_escala"),
    )
