"""Gold layer: dimensions, partial facts, the consolidated fact and the context fact.

Column names are the gold contract; labels, cuts and key prefixes are parameters.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import calendar as cal
from strataframe.functions.classify import (
    AGE_BANDS, CAUSE_RULES, NON_EVENTS, SEX_LABELS, SEX_LETTERS, band, classify_catalogue, classify_cause,
    normalise_event, profile_key, relabel, sex_label,
)
from strataframe.functions.numeric import all_present, missing_to_zero
from strataframe.operators.filters import excluding, measured, since_date
from strataframe.operators.reshape import stack_tables
from strataframe.sources.tables import literal_rows, month_rows

FACT_KEYS = ("id_tiempo_mes", "id_geografia", "id_perfil", "id_causa")
MEASURE = "cantidad_fallecidos"
FACT_COLUMNS = (*FACT_KEYS, MEASURE, "fuente")
ALL_PROFILES = "A-Todas"

# Synthetic members of the cause dimension.
SYNTHETIC_CAUSES = (
    ("RESP", "Enfermedad Respiratoria", "Enfermedades del sistema respiratorio", False),
    ("COVID", "COVID-19", "COVID-19 (U07.1 o U07.2)", True),
    ("CARDIO", "Enfermedad Cardiovascular", "Enfermedades del sistema circulatorio", False),
    ("CANCER", "Cáncer", "Tumores (neoplasias)", False),
    ("EXTERNA", "Causa Externa", "Causas externas de mortalidad", False),
    ("OTRA", "Otra", "Otras causas de muerte", False),
    ("DESCONOCIDA", "Desconocida", "Causa no especificada", False),
)
# National members of the geography dimension and the source of each national series.
NATIONAL_PLACES = (("GT-NA", "Guatemala", 99, "Nacional"), ("CR-NA", "Costa Rica", 0, "Nacional"))
NATIONAL_SERIES = {"Guatemala": ("GT-NA", "OMS"), "Costa Rica": ("CR-NA", "CR")}


class Star(NamedTuple):
    dim_tiempo: DataFrame
    dim_geografia: DataFrame
    dim_perfil: DataFrame
    dim_causa_muerte: DataFrame
    fact_mortalidad_unificada: DataFrame
    fact_contexto_renap: DataFrame

    def register(self, prefix: str = "") -> None:
        """Temp views under the contract names, for plain SQL users."""
        for name, df in self._asdict().items():
            df.createOrReplaceTempView(f"{prefix}{name}")


def _month_attributes(months: DataFrame, cut: str, before: str, after: str) -> DataFrame:
    keyed = months.withColumn("id_tiempo_mes", cal.month_key_from_parts(F.col("anio"), F.col("mes")))
    return keyed.select(
        "id_tiempo_mes", F.col("anio").cast("long").alias("anio"), F.col("mes").cast("long").alias("mes"),
        cal.month_name(F.col("mes")).alias("nombre_mes"),
        cal.period_of(F.col("id_tiempo_mes"), cut, before, after).alias("periodo"),
    )


def month_dimension(spark: SparkSession, first_year: int = 2015, last_year: int = 2026, cut: str = cal.PERIOD_CUT,
                    before: str = cal.PERIOD_BEFORE, after: str = cal.PERIOD_AFTER) -> DataFrame:
    """Twelve rows per year of a fixed range."""
    return _month_attributes(month_rows(spark, first_year, last_year), cut, before, after)


def month_dimension_of(df: DataFrame, date: str, cut: str = cal.PERIOD_CUT,
                       before: str = cal.PERIOD_BEFORE, after: str = cal.PERIOD_AFTER) -> DataFrame:
    """All months of the years the data covers (a one-column aggregate finds the range)."""
    span = df.agg(F.min(date).cast("date").alias("a"), F.max(date).cast("date").alias("b"))
    first = F.trunc("a", "year")
    last = F.add_months(F.trunc("b", "year"), 11)
    months = span.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("m"))
    return _month_attributes(months.select(F.year("m").alias("anio"), F.month("m").alias("mes")), cut, before, after)


def geography_dimension(places: DataFrame, id_column: str = "id", name_column: str = "nombre",
                        country: Column | str = "Guatemala", prefix: str = "GT-", national=NATIONAL_PLACES) -> DataFrame:
    """Catalogue places plus the national members."""
    nation = F.lit(country) if isinstance(country, str) else country
    local = places.select(
        F.concat(F.lit(prefix), F.col(id_column).cast("string")).alias("id_geografia"),
        nation.alias("pais"),
        F.col(id_column).cast("long").alias("id_departamento"),
        F.col(name_column).alias("nombre_departamento"),
    )
    whole = literal_rows(
        places.sparkSession, national, "id_geografia string, pais string, id_departamento long, nombre_departamento string"
    )
    return local.unionByName(whole)


def profile_dimension(spark: SparkSession, sexes=SEX_LETTERS, cuts=AGE_BANDS, total: str = "Todas") -> DataFrame:
    """Sex times age band, totals included; as many rows as the two literal lists allow."""
    bands = [*[label for _, label in cuts], total]
    rows = [(f"{letter}-{label}", sex, label) for sex, letter in sexes.items() for label in bands]
    return literal_rows(spark, rows, "id_perfil string, sexo string, rango_edad string")


def cause_dimension(catalogue: DataFrame, id_column: str = "id", name_column: str = "nombre",
                    prefix: str = "INACIF-", synthetic=SYNTHETIC_CAUSES) -> DataFrame:
    """Classified catalogue causes plus the synthetic members the facts use."""
    named = catalogue.select(
        F.concat(F.lit(prefix), F.col(id_column).cast("string")).alias("id_causa"), F.col(name_column).alias("nombre_causa")
    )
    columns = ("id_causa", "categoria_general", "nombre_causa", "es_covid")
    extra = literal_rows(
        catalogue.sparkSession, synthetic, "id_causa string, categoria_general string, nombre_causa string, es_covid boolean"
    )
    return classify_catalogue(named, "nombre_causa").select(*columns).unionByName(extra)


# Codes of the age unit for days and months.
UNITS_BELOW_A_YEAR = (1, 2)


def fact_from_records(records: DataFrame, source: str = "INE", prefix: str = "GT-", year: str = "anoreg", month: str = "mesreg",
                      place: str = "depocu", sex: str = "sexo", age: str = "edadif", cause: str = "caudef",
                      sex_labels=SEX_LABELS, cuts=AGE_BANDS, rules=CAUSE_RULES, age_unit: str | None = None) -> DataFrame:
    """Individual records counted by month, place, profile and cause.

    ``age_unit`` names a column that says in what ages are counted: days and months
    (``UNITS_BELOW_A_YEAR``) are age 0, so an infant of 20 days is no adult.  Without it ages are years.

    Keys are derived and only the six source columns read; counting starts before
    the one shuffle, so a dominant cell costs no more than a rare one.
    """
    label = sex_label(F.col(sex)) if sex_labels is SEX_LABELS else relabel(F.col(sex), sex_labels, default="Ambos")
    usable = records.filter(all_present(year, month, place))
    years = F.col(age)
    if age_unit is not None:
        years = F.when(F.col(age_unit).isin(*UNITS_BELOW_A_YEAR) & F.col(age).isNotNull(), F.lit(0)).otherwise(F.col(age))
    cells = (
        classify_cause(usable, cause, "id_causa", rules)
        .groupBy(
            cal.month_key_from_parts(F.col(year), F.col(month)).alias("id_tiempo_mes"), F.col(place).alias("_place"),
            label.alias("_sex"), band(years, cuts).alias("_band"), "id_causa",
        )
        .agg(F.count(F.lit(1)).alias(MEASURE))
    )
    # the longer keys are spelled out per cell, not per record
    return cells.select(
        "id_tiempo_mes", F.concat(F.lit(prefix), F.col("_place").cast("string")).alias("id_geografia"),
        profile_key(F.col("_sex"), F.col("_band")).alias("id_perfil"), "id_causa", MEASURE, F.lit(source).alias("fuente"),
    )


def fact_from_series(series: DataFrame, places: dict[str, tuple[str, str]] = NATIONAL_SERIES, first_day: str = "2020-01-01",
                     country: str = "country", date: str = "date_reported", value: str = "new_deaths", cause: str = "COVID") -> DataFrame:
    """Daily national counts summed by month for all mapped countries in one scan.

    ``places``: country -> (place key, source tag).  NaN and NULL days count 0;
    months that sum to 0 vanish.
    """
    chosen = series.filter(F.col(country).isin(*places) & since_date(date, first_day))
    monthly = chosen.groupBy(F.col(country).alias("_country"), F.trunc(cal.iso_date(F.col(date)), "month").alias("_month")).agg(
        F.sum(missing_to_zero(F.col(value))).cast("long").alias(MEASURE)
    )
    key = relabel(F.col("_country"), {c: k for c, (k, _) in places.items()}, default=F.lit(None))
    tag = relabel(F.col("_country"), {c: s for c, (_, s) in places.items()}, default=F.lit(None))
    facts = monthly.select(
        cal.month_key_of(F.col("_month")).alias("id_tiempo_mes"), key.alias("id_geografia"), F.lit(ALL_PROFILES).alias("id_perfil"),
        F.lit(cause).alias("id_causa"), MEASURE, tag.alias("fuente"),
    )
    return facts.filter(measured(FACT_KEYS, MEASURE))


def context_fact(events: DataFrame, source: str = "RENAP", fold_accents: bool = False) -> DataFrame:
    """Civil events by month and canonical type."""
    real = events.filter(excluding("evento", NON_EVENTS))
    keyed = normalise_event(real, "evento", fold=fold_accents).withColumn("id_tiempo_mes", cal.month_key_of(F.col("fecha")))
    summed = keyed.groupBy("id_tiempo_mes", "tipo_evento").agg(F.sum("cantidad").alias("cantidad"))
    return summed.withColumn("fuente", F.lit(source)).select("id_tiempo_mes", "tipo_evento", "cantidad", "fuente")


def unified_fact(partials, stamp: bool = True) -> DataFrame:
    """Union of the partial facts behind the quality gate; optionally stamped with the refresh time."""
    whole = stack_tables(partials).filter(measured(FACT_KEYS, MEASURE)).select(*FACT_COLUMNS)
    return whole.withColumn("fecha_actualizacion", F.current_timestamp()) if stamp else whole


def necropsy_fact(records: DataFrame, municipalities: DataFrame, causes: DataFrame) -> DataFrame:
    """Detailed fact with surrogate lookups (-1 when unknown) and derived attributes.

    ``municipalities`` holds (municipio_id, municipio_key), ``causes`` (causa_id, causa_muerte_key).
    """
    from strataframe.functions.classify import five_year_group, is_senior
    from strataframe.functions.text import clean_upper, first_number
    from strataframe.operators.keys import lookup_key

    placed = lookup_key(records, municipalities, {"municipio_id": "municipio_id"}, "municipio_key")
    keyed = lookup_key(placed, causes, {"causa_muerte_id": "causa_id"}, "causa_muerte_key")
    aged = keyed.withColumn("edad", first_number(F.col("edad").cast("string")))
    return aged.select(
        F.col("id").alias("necropsia_id"), "municipio_key", "causa_muerte_key",
        clean_upper(F.col("sexo")).alias("sexo"), "edad",
        is_senior(F.col("edad")).alias("es_adulto_mayor"),
        five_year_group(F.col("edad")).alias("grupo_etario"),
        cal.month_key_from_parts(F.col("anio"), F.col("mes")).alias("anio_mes"),
    )
