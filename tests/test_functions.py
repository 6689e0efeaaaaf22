"""Names, text, dates, numbers and rule lists on hand-made rows."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strataframe.functions import calendar as cal
from strataframe.functions import classify as cl
from strataframe.functions import naming as nm
from strataframe.functions import numeric as nu
from strataframe.functions import text as tx
from strataframe.sources.tables import literal_rows


def evaluate(spark, values, kind, fn):
    df = literal_rows(spark, [(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("Añoreg", "anoreg"), ("Número Correlativo", "numero_correlativo"), ("bronzeLoadedAt", "bronze_loaded_at"),
    ("__a--b__", "a_b"), ("ABCDef", "abcdef"), ("aB1C", "a_b1_c"), ("Año 2020 (total)", "ano_2020_total"),
])
def test_snake_case(raw, expected):
    assert nm.snake_case(raw) == expected


def test_other_name_styles():
    assert nm.storage_safe("a b,c;d{e}(f)=g\th") == "a_b_c_d_e__f__g_h"
    assert nm.punctuation_free(" Total % (año) ") == "total____año_"
    assert nm.separator_free(" Death-rate/100 000 ") == "death_rate_100_000"


def test_renaming_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        nm.rename_all(df)
    assert nm.drop_matching(df, pattern="^A B$").columns == ["a_b"]


def test_slug_forms(spark):
    assert evaluate(spark, ["Cólera, no especificado"], "string", tx.slug) == ["clera_no_especificado"]
    assert evaluate(spark, ["Cólera, no especificado"], "string", lambda c: tx.slug(c, True)) == ["cólera_no_especificado"]


def test_slugs_of_any_characters(spark):
    draw = random.Random(5)
    every = [chr(c) for c in [*range(0x300), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0xFFFD, 0x1F600, 0x10FFFF]]
    texts = ["".join(every), *["".join(draw.choices([*" \t\n\x0b\f\r", *"aZ9_-éÑü", *every], k=60)) for _ in range(300)], "", None]
    for keep in (False, True):
        gone = re.compile(f"[^a-zA-Z0-9 \t\n\x0b\f\r{'áéíóúÁÉÍÓÚñÑ' if keep else ''}]+")
        want = [t if t is None else re.sub("[ \t\n\x0b\f\r]+", "_", gone.sub("", t)).lower() for t in texts]
        assert evaluate(spark, texts, "string", lambda c: tx.slug(c, keep)) == want  # noqa: B023


def test_slugs_look_characters_up(spark):
    """Ranges in the class cost six times the time of single characters."""
    assert all("a-z" not in str(tx.slug(F.col("t"), keep)) and "\\s" not in str(tx.slug(F.col("t"), keep)) for keep in (False, True))


def test_text_helpers(spark):
    assert evaluate(spark, ["45 años", "NI", None, "3 de 7"], "string", tx.first_number) == [45, None, None, 3]
    assert evaluate(spark, ['"a"', "b"], "string", tx.unquote) == ["a", "b"]
    assert evaluate(spark, ["[All]"], "string", tx.strip_brackets) == ["All"]
    assert evaluate(spark, ["/x/defunciones-2018.csv"], "string", tx.base_name) == ["defunciones-2018.csv"]
    assert evaluate(spark, ["defunciones-2018.csv", "x"], "string", tx.year_in_name) == [2018, None]
    assert evaluate(spark, ["ADOPCIÓN"], "string", tx.fold_accents) == ["ADOPCION"]


def test_dates(spark):
    assert evaluate(spark, ["2020-02-29", "31/01/2020", None], "string", lambda c: cal.safe_date(c).cast("string")) == ["2020-02-29", None, None]
    assert evaluate(spark, [1, 12, 13], "int", cal.month_name) == ["Enero", "Diciembre", None]
    assert evaluate(spark, ["Enero", "diciembre", "x"], "string", cal.month_number) == [1, 12, None]
    assert evaluate(spark, [1, 13], "int", lambda c: cal.first_of_month(F.lit(2015), c).cast("string")) == ["2015-01-01", None]
    assert evaluate(spark, ["2020-02", "2020-03"], "string", cal.period_of) == ["Pre-COVID", "Pandemia"]


def test_numbers(spark):
    nan = float("nan")
    assert evaluate(spark, [1.5, nan, None], "double", nu.missing_to_zero) == [1.5, 0.0, 0.0]
    assert evaluate(spark, [7.0, nan, None], "double", nu.safe_long) == [7, None, None]
    assert evaluate(spark, [999, 5, None], "int", lambda c: nu.sentinel_to_null(c, 999)) == [None, 5, None]
    assert evaluate(spark, [0, 4], "int", lambda c: nu.percent(F.lit(1), c)) == [None, 25.0]


def test_stable_draws(spark):
    df = spark.range(20000)
    one = df.select(nu.stable_gaussian(F.col("id"), seed=3).alias("g"))
    mean, spread = one.agg(F.avg("g"), F.stddev("g")).first()
    assert abs(mean) < 0.03 and abs(spread - 1) < 0.03
    again = df.repartition(7).select(nu.stable_gaussian(F.col("id"), seed=3).alias("g"))
    assert math.isclose(one.agg(F.sum("g")).first()[0], again.agg(F.sum("g")).first()[0], abs_tol=1e-6)


CAUSES = [
    ("U071", "COVID"), ("j189", "RESP"), ("I219", "CARDIO"), ("C349", "CANCER"), ("X954", "EXTERNA"), ("V892", "EXTERNA"), ("Y34", "EXTERNA"),
    ("W19", "OTRA"), ("R99", "OTRA"), ("XJ12", "RESP"), ("accidente", "EXTERNA"), (None, "DESCONOCIDA"), ("", "DESCONOCIDA"), (" ", "OTRA"),
]


def test_cause_rules(spark):
    df = literal_rows(spark, [(i, c) for i, (c, _) in enumerate(CAUSES)], "i int, c string")
    assert [r[0] for r in cl.classify_cause(df, "c").orderBy("i").select("id_causa").collect()] == [e for _, e in CAUSES]


def test_documented_cause_rules(spark):
    df = literal_rows(spark, [(0, "W19"), (1, "R99"), (2, "XJ12"), (3, "tumor")], "i int, c string")
    got = cl.classify_cause(df, "c", rules=cl.DOCUMENTED_CAUSE_RULES).orderBy("i").select("id_causa").collect()
    assert [r[0] for r in got] == ["EXTERNA", "DESCONOCIDA", "OTRA", "CANCER"]


def test_catalogue_flag_is_never_null(spark):
    df = literal_rows(spark, [(0, "Sospecha covid"), (1, None), (2, "Fallo cardiorespiratorio")], "i int, n string")
    got = [tuple(r) for r in cl.classify_catalogue(df, "n").orderBy("i").select("categoria_general", "es_covid").collect()]
    assert got == [("COVID-19", True), ("Otra", False), ("Enfermedad Respiratoria", False)]


def test_age_bands(spark):
    assert evaluate(spark, [0, 14, 15, 64, 65, None, -1], "int", cl.band) == ["0-14", "0-14", "15-64", "15-64", "65+", "Todas", "0-14"]
    assert evaluate(spark, [43, 0, -2, None], "int", cl.five_year_group) == ["40-44", "0-4", None, None]


def test_labels(spark):
    assert evaluate(spark, [1, 2, 9, None], "int", cl.sex_label) == ["Hombre", "Mujer", "Ambos", "Ambos"]
    assert evaluate(spark, ["Male", "All", "X", None], "string", lambda c: cl.relabel(c, cl.SEX_SHORT)) == ["M", "TODOS", "X", None]
    assert evaluate(spark, ["j189", "D48", "D50", "U07.1", "zz", None], "string", cl.icd_chapter) == ["X", "II", "III", "XXII", None, None]


def test_event_names(spark):
    names = ["ADOPCION", "ADOPCIÓN", "Nacimientos ", "algo"]
    df = literal_rows(spark, list(enumerate(names)), "i int, e string")
    plain = [r[0] for r in cl.normalise_event(df, "e").orderBy("i").select("tipo_evento").collect()]
    folded = [r[0] for r in cl.normalise_event(df, "e", fold=True).orderBy("i").select("tipo_evento").collect()]
    assert plain == ["Adopciones", "ADOPCIÓN", "Nacimientos", "algo"]
    assert folded[1] == "Adopciones"
