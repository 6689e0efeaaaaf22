"""Maps the driver's tables onto the sources of the star, with defects injected by fixed expressions.

The star's detail source is ``A`` (line items), its national daily series are
``B`` and ``C`` (orders of two regions), and orders also play the civil events.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataframe.functions.text import zero_padded
from strataframe.plans import star as gold
from strataframe.plans.analytics import Scope
from strataframe.plans.silver import clean_deaths, events_by_month, unify_event_years
from strataframe.operators.reshape import months_to_columns
from strataframe.session import apply_scale_settings, cut_lineage, scratch_path
from strataframe.sources.sinks import GOLD_TABLES, read_gold, write_gold
from strataframe.spec import SchemaPatch

CUT = "1998-03"
SERIES = {"AMERICA": ("AM-NA", "B"), "EUROPE": ("EU-NA", "C")}
NATIONAL = (("AM-NA", "AMERICA", 99, "Nacional"), ("EU-NA", "EUROPE", 0, "Nacional"))
SCOPE = Scope(detail="A", national=("B", "C"), country="AMERICA", trend_from=CUT, place_prefix="N-")
FIRST_DAY = "1996-01-01"
EVENT_COLUMNS = {"Nacimientos": "renap_nacimientos", "Matrimonios": "renap_matrimonios", "Divorcios": "renap_divorcios", "Adopciones": "renap_adopciones"}


@lru_cache(maxsize=None)
def _schema(path: str) -> StructType:
    """The schema of one stored table; asked for once, as each inference is a job of its own."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return apply_scale_settings(spark).read.schema(_schema(path)).parquet(path)


def parts_with_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, p_size, caudef): cause texts of every kind the rules know."""
    kind, size = F.col("p_partkey") % 9, zero_padded(F.col("p_size"))
    text = (
        F.when(kind == 0, "covid-19, virus identificado (u07.1) ")
        .when(kind == 1, F.concat(F.lit("J"), size, F.lit("9")))
        .when(kind == 2, F.concat(F.lit("i"), size))
        .when(kind == 3, F.concat(F.lit("C"), size))
        .when(kind == 4, F.concat(F.lit("X"), size))
        .when(kind == 5, F.concat(F.lit(" accidente "), F.col("p_name")))
        .when(kind == 7, F.concat(F.lit("W"), size))
        .when(kind == 8, F.col("p_type"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", text.alias("caudef"))


def death_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as individual records: registration month, place, sex code, age, cause text."""
    segment = F.col("c_mktsegment")
    sex = F.when(segment.isin("AUTOMOBILE", "MACHINERY"), 1).when(segment.isin("BUILDING", "HOUSEHOLD"), 2).otherwise(9)
    age = F.when(F.col("l_partkey") % 29 == 0, 999).otherwise(F.col("p_size") * 2)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    parts = parts_with_cause(spark, sf_dir)
    described = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    placed = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return described.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.year("o_orderdate").alias("Añoreg"), F.month("o_orderdate").alias("Mesreg"),
        F.col("c_nationkey").alias("Depocu"), sex.alias("Sexo"), age.alias("Edadif"), F.col("caudef").alias("Caudef"),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily national series with NaN and NULL measures."""
    k = F.col("o_orderkey")
    value = F.when(k % 13 == 0, float("nan")).when(k % 17 != 0, (k % 7).cast("double"))
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    residents = people.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        orders.join(residents, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_reported"), F.col("r_name").alias("country"), value.alias("new_deaths"))
    )


def civil_events(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Orders counted as civil events: (anio, mes_numero, evento, cantidad).

    A single year is a date range, which the scan can prune by.
    """
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    name = (
        F.when(p == "1-URGENT", "NACIMIENTO")
        .when(p == "2-HIGH", "DEFUNCIONES")
        .when((p == "3-MEDIUM") & (s == "O"), "Matrimonio civil")
        .when(p == "3-MEDIUM", "MATRIMONIO NOTARIAL")
        .when((p == "4-NOT SPECIFIED") & (s == "O"), "Otros")
        .when(p == "4-NOT SPECIFIED", "DIVORCIO")
        .when(s == "F", "ADOPCION")
        .otherwise("Inscripción tardía")
    )
    orders = table(spark, sf_dir, "orders")
    if year is not None:
        day = F.col("o_orderdate")
        orders = orders.filter((day >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (day < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    return (
        orders
        .groupBy(F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes_numero"), name.alias("evento"))
        .agg(F.count(F.lit(1)).alias("cantidad"))
    )


def yearly_event_tables(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Wide yearly tables that drift as real ones do: months as double, a missing month, other total names.

    One scan counts all years; the years are those of the data.
    """
    tables, wide = {}, cut_lineage(months_to_columns(civil_events(spark, sf_dir)))
    for year in sorted(r.anio for r in wide.select("anio").distinct().collect()):
        df = wide.filter(F.col("anio") == year).drop("anio")
        months = [c for c in df.columns if c != "evento"]
        total = sum((F.coalesce(F.col(c), F.lit(0)) for c in months[1:]), F.coalesce(F.col(months[0]), F.lit(0)))
        name = {1996: "total_general", 2000: "total", 2001: "total"}.get(year, "total_anual")
        df = df.withColumn(name, total)
        if year == 1995:
            df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in months})
        if year == 1996:
            df = df.drop("diciembre")
        if year == 2001:
            df = df.drop("septiembre", "octubre", "noviembre", "diciembre")
        tables[year] = df
    return tables


def unified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch = SchemaPatch(rename={"total_general": "total_anual", "total": "total_anual"})
    tables = yearly_event_tables(spark, sf_dir)
    return unify_event_years(tables, dict.fromkeys(tables, patch))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return gold.geography_dimension(places, "n_nationkey", "n_name", F.col("r_name"), "N-", NATIONAL)


def cause_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cause catalogue from part types: (id, nombre), some with words the rules know."""
    k = F.col("p_size") % 5
    word = F.when(k == 0, "paro Cardiorespiratorio ").when(k == 1, "Homicidio ").when(k == 2, "Sospecha COVID ").otherwise("")
    name = F.concat(word, F.col("p_type"))
    return table(spark, sf_dir, "part").select((F.col("p_size") * 10 + F.length("p_type")).alias("id"), name.alias("nombre")).groupBy("id").agg(F.min("nombre").alias("nombre"))


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the months come from one grouped scan; wide yearly tables are their own query
    long = civil_events(spark, sf_dir).withColumn("fecha", F.make_date("anio", "mes_numero", F.lit(1)))
    return gold.context_fact(long)


def context_from_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.context_fact(events_by_month(unified_events(spark, sf_dir)))


def detail_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_from_records(clean_deaths(death_records(spark, sf_dir)), source="A", prefix="N-")


def series_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_from_series(daily_series(spark, sf_dir), SERIES, FIRST_DAY)


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.month_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate", CUT)


class DriverStar:
    """The star over the driver's tables.  A table is planned when a question first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)

    @cached_property
    def dim_tiempo(self) -> DataFrame:
        return months(*self._at)

    @cached_property
    def dim_geografia(self) -> DataFrame:
        return geography(*self._at)

    @cached_property
    def dim_perfil(self) -> DataFrame:
        return gold.profile_dimension(self._at[0])

    @cached_property
    def dim_causa_muerte(self) -> DataFrame:
        return gold.cause_dimension(cause_names(*self._at))

    @cached_property
    def fact_mortalidad_unificada(self) -> DataFrame:
        return gold.unified_fact([detail_fact(*self._at), series_fact(*self._at)], stamp=False)

    @cached_property
    def fact_contexto_renap(self) -> DataFrame:
        return context(*self._at)


def raw_star(spark: SparkSession, sf_dir: str) -> DriverStar:
    """The star planned from the raw tables."""
    return DriverStar(spark, sf_dir)


SOURCES = ("region", "nation", "customer", "part", "orders", "lineitem")
_stored: dict[tuple, gold.Star] = {}


def _inputs(spark: SparkSession, sf_dir: str) -> int:
    """A digest of path, size and time of every source file (a listing, no content)."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCES]
    listed = spark.read.format("binaryFile").load(paths)
    return listed.agg(F.sum(F.xxhash64("path", "length", "modificationTime") % 1_000_000_007)).first()[0]


def star(spark: SparkSession, sf_dir: str) -> gold.Star:
    """The stored gold layer, refreshed when a source file has changed.

    Questions read the six gold tables, as they would in production, instead of
    joining the raw tables each time.  The tables lie in the shared folder, belong
    to this application and are written by whichever question comes first.
    """
    key = (spark.sparkContext.applicationId, sf_dir, _inputs(spark, sf_dir))
    if key not in _stored:
        _stored[key] = refresh(spark, sf_dir)
    return _stored[key]


def refresh(spark: SparkSession, sf_dir: str) -> gold.Star:
    """Build and store the gold layer, and open what was stored."""
    raw, folder = raw_star(spark, sf_dir), scratch_path(spark, "gold")
    write_gold(raw, folder)
    return read_gold(spark, folder, {name: getattr(raw, name).schema for name in GOLD_TABLES})
