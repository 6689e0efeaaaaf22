"""Ordered rule lists, bands and code labels as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.spec import Rule

# ---------------------------------------------------------------------------
# Labels, fragments and code patterns whose results are given.
# ---------------------------------------------------------------------------
CAUSE_RULES = (
    Rule("COVID", ("COVID", "U07")),
    Rule("RESP", ("RESPIRAT",), "J[0-9]{2}"),
    Rule("CARDIO", ("CARDIO",), "I[0-9]{2}"),
    Rule("CANCER", ("CANCER", "NEOPLAS"), "C[0-9]{2}"),
    Rule("EXTERNA", ("ACCIDENT", "VIOLENT", "HOMICID"), "[VXY][0-9]{2}"),
)
# Documented variant: anchored code ranges, W counted as external, more keywords.
DOCUMENTED_CAUSE_RULES = (
    Rule("COVID", ("COVID", "U07")),
    Rule("RESP", ("RESPIRAT",), "^J[0-9]{2}"),
    Rule("CARDIO", ("CARDIO", "CORAZON"), "^I[0-9]{2}"),
    Rule("CANCER", ("CANCER", "TUMOR", "NEOPLAS"), "^C[0-9]{2}"),
    Rule("EXTERNA", ("ACCIDENT", "TRAUMA", "HERIDA"), "^[VWXY][0-9]{2}"),
    Rule("DESCONOCIDA", (), "^R99"),
)
CATALOGUE_RULES = (
    Rule("COVID-19", ("COVID",)),
    Rule("Enfermedad Respiratoria", ("RESPIRAT",)),
    Rule("Enfermedad Cardiovascular", ("CARDIO",)),
    Rule("Causa Externa", ("VIOLENT", "ACCIDENT", "HOMICID")),
)
EVENT_RULES = (
    Rule("Nacimientos", ("NACIMIENTO",)),
    Rule("Defunciones", ("DEFUNCI",)),
    Rule("Matrimonios", ("MATRIMONIO",)),
    Rule("Divorcios", ("DIVORCIO",)),
    Rule("Reconocimientos", ("RECONOCIMIENTO",)),
    Rule("Identificación de Persona", ("IDENTIFICACION",)),
    Rule("Adopciones", ("ADOPCION",)),
    Rule("Cambio de Nombre", ("CAMBIO DE NOMBRE",)),
    Rule("Unión de Hecho", ("UNION DE HECHO",)),
    Rule("Naturalizaciones", ("GUATEMALTECO",)),
    Rule("Extranjeros Domiciliados", ("EXTRANJERO",)),
)
# Rows of the yearly files that are totals or adjustments, not events.
NON_EVENTS = ("TOTAL GENERAL", "Total", "AJUSTE (FILAS FALTANTES EN IMAGEN)", "Otros")
# Code -> label pairs.
SEX_LABELS = {1: "Hombre", 2: "Mujer"}
SEX_LETTERS = {"Hombre": "H", "Mujer": "M", "Ambos": "A"}
SEX_SHORT = {"Male": "M", "Female": "F", "All": "TODOS"}
AGE_BANDS = ((15, "0-14"), (65, "15-64"), (None, "65+"))
AGE_GROUPS = ((18, "Menor"), (60, "Adulto"), (None, "Adulto Mayor"))
# Chapters of the public ICD-10 classification (first code, label).
ICD10_CHAPTERS = (
    ("A00", "I"), ("C00", "II"), ("D50", "III"), ("E00", "IV"), ("F00", "V"), ("G00", "VI"),
    ("H00", "VII"), ("H60", "VIII"), ("I00", "IX"), ("J00", "X"), ("K00", "XI"), ("L00", "XII"),
    ("M00", "XIII"), ("N00", "XIV"), ("O00", "XV"), ("P00", "XVI"), ("Q00", "XVII"),
    ("R00", "XVIII"), ("S00", "XIX"), ("U00", "XXII"), ("V00", "XX"), ("Z00", "XXI"),
)


def _rule_hit(text: Column, rule: Rule) -> Column:
    tests = [text.contains(fragment) for fragment in rule.contains]
    if rule.pattern:
        tests.append(text.rlike(rule.pattern))
    return reduce(or_, tests)


def first_match(upper_text: Column, rules, default: Column) -> Column:
    """The label of the first rule that fires on upper-case text, else ``default``."""
    chain = None
    for rule in rules:
        hit = _rule_hit(upper_text, rule)
        chain = F.when(hit, rule.label) if chain is None else chain.when(hit, rule.label)
    return chain.otherwise(default)


def classify(
    df: DataFrame,
    source: str,
    target: str,
    rules,
    default: Column | str,
    missing: str | None = None,
    fold: bool = False,
) -> DataFrame:
    """Add ``target`` by the ordered rules; NULL and '' get ``missing`` when given.

    The folded text is projected once so that the branches do not recompute it.
    """
    from strataframe.functions.text import fold_accents

    text = "_rule_text"
    folded = F.upper(fold_accents(F.col(source)) if fold else F.col(source))
    label = first_match(F.col(text), rules, F.lit(default) if isinstance(default, str) else default)
    if missing is not None:
        label = F.when(F.coalesce(F.col(source), F.lit("")) == "", missing).otherwise(label)
    return df.withColumn(text, folded).withColumn(target, label).drop(text)


def classify_cause(df: DataFrame, source: str, target: str = "id_causa", rules=CAUSE_RULES) -> DataFrame:
    """Cause code from free text or an ICD-10 code."""
    return classify(df, source, target, rules, default="OTRA", missing="DESCONOCIDA")


def classify_catalogue(df: DataFrame, source: str) -> DataFrame:
    """General category and COVID flag of a catalogue name."""
    flagged = F.coalesce(F.upper(F.col(source)).contains("COVID"), F.lit(False))
    return classify(df, source, "categoria_general", CATALOGUE_RULES, default="Otra").withColumn("es_covid", flagged)


def normalise_event(df: DataFrame, source: str, target: str = "tipo_evento", fold: bool = False) -> DataFrame:
    """Canonical event name; names no rule knows pass through."""
    return classify(df, source, target, EVENT_RULES, default=F.col(source), fold=fold)


def band(value: Column, cuts=AGE_BANDS, missing: str | None = "Todas") -> Column:
    """Label of the first cut the value lies below; NULL gets ``missing``."""
    chain = F.when(value.isNull(), F.lit(missing))
    for upper, label in cuts:
        if upper is None:
            return chain.otherwise(label)
        chain = chain.when(value < upper, label)
    return chain


def five_year_group(age: Column) -> Column:
    """43 -> "40-44"; negative or missing ages give NULL."""
    start = (F.floor(age / 5) * 5).cast("int")
    text = F.concat(start.cast("string"), F.lit("-"), (start + 4).cast("string"))
    return F.when(age >= 0, text)


def is_senior(age: Column, limit: int = 60) -> Column:
    return F.coalesce(age >= limit, F.lit(False))


def relabel(col: Column, labels: dict, default: Column | str | None = None) -> Column:
    """Code -> label; unknown codes get ``default``, or stay as they are when it is None."""
    fallback = col if default is None else (F.lit(default) if isinstance(default, str) else default)
    chain = None
    for code, label in labels.items():
        chain = F.when(col == code, label) if chain is None else chain.when(col == code, label)
    return chain.otherwise(fallback)


def sex_label(code: Column) -> Column:
    return relabel(code, SEX_LABELS, default="Ambos")


def profile_key(sex: Column, age_band: Column) -> Column:
    return F.concat(relabel(sex, SEX_LETTERS, default="A"), F.lit("-"), age_band)


def icd_chapter(code: Column, chapters=ICD10_CHAPTERS) -> Column:
    """Chapter of an ICD-10 code by its three-character stem; other text gives NULL."""
    stem = F.upper(F.substring(F.trim(code), 1, 3))
    label = F.lit(None).cast("string")
    for first, name in chapters:
        label = F.when(stem >= first, name).otherwise(label)
    return F.when(stem.rlike("^[A-Z][0-9][0-9A-Z]$"), label)
