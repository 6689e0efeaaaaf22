"""Silver layer: cleaning and conformance of the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.calendar import MONTH_COLUMNS
from strataframe.functions.classify import SEX_SHORT, five_year_group, is_senior, relabel, band, AGE_GROUPS
from strataframe.functions.naming import rename_all
from strataframe.functions.numeric import sentinel_to_null
from strataframe.functions.text import clean_upper, first_number, slug, strip_brackets, unquote
from strataframe.operators.filters import non_negative
from strataframe.operators.project import cast_columns, rename_present, with_processing_stamp
from strataframe.operators.reshape import first_by, harmonise, months_to_rows, stack_tables
from strataframe.operators.validate import Validated, remove_outliers, validate_all
from strataframe.spec import CodeCheck, SchemaPatch

# Validated columns with their catalogue and severity, in order.
DEATH_CHECKS = [
    CodeCheck("asist", "asistencia_recibida"),
    CodeCheck("cerdef", "certificador", critical=True),
    CodeCheck("ocur", "sitio_ocurrencia", critical=True),
    CodeCheck("depreg", "departamentos", critical=True),
    CodeCheck("depocu", "departamentos", critical=True),
    CodeCheck("dredif", "departamentos"),
    CodeCheck("mupreg", "municipios", critical=True),
    CodeCheck("mupocu", "municipios", critical=True),
    CodeCheck("mredif", "municipios"),
    CodeCheck("escodif", "escolaridad"),
    CodeCheck("ecidif", "estado_civil"),
    CodeCheck("ciuodif", "ocupaciones"),
    CodeCheck("pnadif", "paises"),
    CodeCheck("nacdif", "paises"),
    CodeCheck("predif", "paises"),
    CodeCheck("perdif", "periodo_edad"),
]
# Sentinels of the record table.
UNKNOWN_AGE = 999
UNKNOWN_CODE = 99


def clean_deaths(df: DataFrame, drop_duplicates: bool = False, drop_negative_ages: bool = False) -> DataFrame:
    """Names, sentinels and cause text of individual death records."""
    named = rename_all(df, "snake")
    fills = {c: UNKNOWN_CODE for c in ("escodif", "ciuodif") if c in named.columns}
    cleaned = (named.fillna(fills) if fills else named).withColumns({
        "caudef": clean_upper(F.col("caudef")),
        "edadif": sentinel_to_null(F.col("edadif"), UNKNOWN_AGE),
    })
    if drop_negative_ages:
        cleaned = cleaned.filter(non_negative("edadif"))
    return cleaned.dropDuplicates() if drop_duplicates else cleaned


def silver_deaths(df: DataFrame, catalogues: dict[str, DataFrame], checks=None, exact_bounds: bool = False, **options) -> Validated:
    """Cleaned, outlier-free and code-checked records, with rejects and a report.

    A check of a column that is not there is an error: passing over it would let every row in.
    """
    bounded = remove_outliers(clean_deaths(df, **options), "edadif", exact=exact_bounds)
    checks = DEATH_CHECKS if checks is None else checks
    result = validate_all(bounded, list(checks), catalogues)
    return result._replace(kept=with_processing_stamp(result.kept))


# The common schema of the yearly event tables and the names of their totals.
EVENT_SCHEMA = {"anio": "int", "evento": "string", **{m: "bigint" for m in MONTH_COLUMNS}, "total_anual": "bigint"}
TOTAL_NAMES = {"total_general": "total_anual", "total": "total_anual"}


def unify_event_years(tables: dict[int, DataFrame], patches: dict[int, SchemaPatch] | None = None) -> DataFrame:
    """Wide yearly tables with drifting columns to one schema; absent months are NULL."""
    frames = []
    for year, df in sorted(tables.items()):
        patch = (patches or {}).get(year, SchemaPatch(rename=TOTAL_NAMES))
        frames.append(harmonise(df, SchemaPatch(patch.rename, {**patch.constants, "anio": year}), EVENT_SCHEMA))
    return stack_tables(frames)


def events_by_month(unified: DataFrame, keep_missing: bool = False) -> DataFrame:
    long = months_to_rows(unified, keep_missing=keep_missing)
    return long.select("fecha", "anio", "mes_numero", "mes_nombre", "evento", "cantidad")


# Numeric columns of the indicator tables.
INDICATOR_TYPES = {
    "year": "int",
    "number": "int",
    "percentage_of_cause_specific_deaths_out_of_total_deaths": "double",
    "age_standardized_death_rate_per_100_000_standard_population": "double",
    "death_rate_per_100_000_population": "double",
}


def consolidate_indicators(tables, country: str, country_code: str, source: str) -> DataFrame:
    """Indicator tables of one country: union, casts, category labels, duplicates removed."""
    typed = cast_columns(stack_tables(tables), INDICATOR_TYPES)
    labelled = typed.withColumns({
        "sex": relabel(F.col("sex"), SEX_SHORT),
        "age_group": strip_brackets(F.col("age_group")),
    }).filter(non_negative("number", keep_null=False))
    tagged = labelled.withColumns({
        "pais": F.lit(country), "codigo_pais": F.lit(country_code), "fuente": F.lit(source),
    })
    return tagged.dropDuplicates()


def clean_icd_catalogue(df: DataFrame, origin: str, keep_accents: bool = False) -> DataFrame:
    """ICD catalogue: names, upper-case codes, slug of the description, one row per code."""
    named = rename_present(df, {"CAUSA": "causa", "DESCRIP": "descripcion"})
    shaped = named.withColumns({
        "descripcion_snake_case": slug(F.col("descripcion"), keep_accents),
        "causa": F.upper("causa"),
        "descripcion": unquote(F.col("descripcion")),
        "pais_origen": F.lit(origin),
    })
    return first_by(shaped, "causa", ["descripcion"])


def enrich_necropsies(records: DataFrame, municipalities: DataFrame, departments: DataFrame, causes: DataFrame) -> DataFrame:
    """Record joined to its place and cause names, with numeric age and derived attributes."""
    towns = municipalities.select(F.col("id").alias("_m"), F.col("nombre").alias("municipio_nombre"), F.col("departamento_id").alias("_d"))
    regions = departments.select(F.col("id").alias("_r"), F.col("nombre").alias("departamento_nombre"))
    reasons = causes.select(F.col("id").alias("_c"), F.col("nombre").alias("causa_muerte_nombre"))
    placed = records.join(towns, F.col("municipio_id") == F.col("_m"), "left").join(regions, F.col("_d") == F.col("_r"), "left")
    joined = placed.join(reasons, F.col("causa_muerte_id") == F.col("_c"), "left").drop("_m", "_d", "_r", "_c")
    age = F.col("edad_numerica")
    return joined.withColumn("edad_numerica", first_number(F.col("edad"))).withColumns({
        "grupo_etario": band(age, AGE_GROUPS, missing=AGE_GROUPS[-1][1]),
        "grupo_quinquenal": five_year_group(age),
        "es_adulto_mayor": is_senior(age),
    })
