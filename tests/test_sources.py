"""Files, options, sinks and streams in a scratch folder."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataframe.plans import bronze
from strataframe.sources import files, sinks, tables
from strataframe.spec import SourceSpec, TableSpec
from strataframe.streaming.arrival import arriving_files, ingest_available, upsert_available

RAGGED = (
    b"\xef\xbb\xbfTitle, with comma and \" quote\r\nsecond line\r\nCode,Indicator Name,<!___COPYRIGHT_x,Death-rate\r\n"
    b"A,one,c,1.5,\r\nB,\"two, quoted\",c,\xff2.5,\r\n\r\nC,three\r\nD,too,many,1,2,3,4\r\n"
    b"E,\"a \"\"line\"\"\r\nbreak\",c,3,filled\r\nCode,Indicator Name,<!___COPYRIGHT_x,Death-rate\r\n   \r\n\"second line\",\\,c,\xef\xbf\xbd\r\n"
)
GOOD = [
    ("   ", None, None), ("A", "one", "1.5"), ("B", "two, quoted", "2.5"), ("C", "three", None), ("Code", "Indicator Name", "Death-rate"),
    ("E", 'a "line"\nbreak', "3"), ("second line", "\\", "\ufffd"),
]


@pytest.mark.parametrize("split", ["1g", "64", "17", "5"])
def test_ragged_csv(spark, tmp_path, split):
    """The same bytes give the same rows however the file is split."""
    path = tmp_path / "who.csv"
    path.write_bytes(RAGGED)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = files.read_ragged(spark, str(path), skip=2)
        assert found.rows.columns == ["code", "indicator_name", "death_rate"]
        assert rows(found.rows) == sorted(GOOD, key=repr)
        assert rows(found.rejects.select("line", "record", "reason")) == [(8, "D,too,many,1,2,3,4", "overlong")]
        cut = files.read_ragged_csv(spark, str(path), skip=2, overlong="truncate")
        assert rows(cut) == sorted([*GOOD, ("D", "too", "1")], key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_by_name(spark, tmp_path):
    (tmp_path / "deaths-2018.csv").write_text("Depreg,Sexo,Edadif\n1,2,30\n")
    (tmp_path / "deaths-2019.csv").write_text("Depreg,Edadif,Sexo,Nuevo\n5,77,1,9\n")
    (tmp_path / "deaths-2020.csv").write_text("Sexo\n1\n")
    out = bronze.yearly_records(spark, str(tmp_path), "deaths-*.csv", "Depreg int, Sexo int, Edadif int")
    assert rows(out.select("Depreg", "Sexo", "Edadif", "Nuevo")) == sorted([(1, 2, 30, None), (5, 1, 77, "9"), (None, 1, None, None)], key=repr)


def test_malformed_rows_do_not_depend_on_the_columns(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("a,b\n1,x\nbad,y\n2,z\n")
    df = files.read_csv(spark, str(tmp_path / "plain.csv"), "a int, b string", drop_malformed=True)
    assert df.count() == len(df.collect()) == df.select("b").count() == 2
    assert [r[0] for r in files.csv_rejects(spark, str(tmp_path / "plain.csv"), "a int, b string").collect()] == ["bad,y"]


def test_title_row_and_plain_csv(spark, tmp_path):
    (tmp_path / "icd.csv").write_text("Long title\nCAUSA,DESCRIP\na00,Cólera\n", encoding="utf-8")
    assert rows(files.load(spark, SourceSpec("icd", str(tmp_path / "icd.csv"), "ragged_csv", skip_rows=1))) == [("a00", "Cólera")]
    (tmp_path / "plain.csv").write_text("a,b\n1,x\nbad,y\n2,z\n")
    assert rows(files.read_csv(spark, str(tmp_path / "plain.csv"), "a int, b string", drop_malformed=True)) == [(1, "x"), (2, "z")]


def test_lists_of_files(spark, tmp_path):
    for year in (2018, 2019):
        (tmp_path / f"deaths-{year}.csv").write_text(f"Año reg,x\n{year},1\n", encoding="utf-8")
    sets = files.one_dataset_per_file(spark, str(tmp_path), "deaths-*.csv")
    assert sorted(sets) == ["deaths-2018", "deaths-2019"] and sets["deaths-2018"].count() == 1
    unified = bronze.yearly_records(spark, str(tmp_path), "deaths-*.csv")
    assert {r.source_file for r in unified.collect()} == {"deaths-2018.csv", "deaths-2019.csv"} and "Año_reg" in unified.columns
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path), "nothing-*")


def test_specs(spark, tmp_path):
    with pytest.raises(ValueError):
        SourceSpec("x", "y", "xlsx")
    (tmp_path / "a.csv").write_text("a\n1\n")
    spec = SourceSpec("one", str(tmp_path / "a.csv"), schema="a int")
    with pytest.raises(ValueError):
        files.load_all(spark, [spec, spec])
    landed = bronze.ingest(spark, [spec], "batch-1")["one"]
    assert landed.select("a", "bronze_batch_id", "bronze_source").first() == (1, "batch-1", "one")


def test_jdbc_options():
    plain = tables.jdbc_options(url="jdbc:x", table="t")
    assert plain["dbtable"] == "t" and "numPartitions" not in plain
    split = tables.jdbc_options(url="jdbc:x", query="SELECT 1 AS id", partition_column="id", bounds=(0, 10), partitions=4)
    assert split["dbtable"] == "(SELECT 1 AS id) AS src" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        tables.jdbc_options(url="jdbc:x")
    assert "O''Brien" in tables.base_tables_query("O'Brien")


def test_fallback_and_catalogue(spark):
    def broken():
        raise RuntimeError("gone")

    assert tables.read_first_available(broken, lambda: spark.range(3)).count() == 3
    with pytest.raises(RuntimeError, match="gone"):
        tables.read_first_available(broken)
    listed = tables.column_catalogue({"t": spark.range(1).withColumn("b", F.lit("x"))})
    assert rows(listed.select("dataset", "ordinal", "column_name", "data_type")) == [("t", 1, "id", "bigint"), ("t", 2, "b", "string")]
    assert tables.metadata_records(spark, [TableSpec("t", "parquet", "team", "2020-01-01", "sum")]).count() == 1
    assert tables.list_databases(spark).filter("name = 'default'").count() == 1
    spark.range(1).createOrReplaceTempView("some_view")
    assert tables.list_tables(spark).filter("name = 'some_view'").count() == 1


def test_sinks(spark, tmp_path):
    df = spark.range(100).withColumn("anio", (F.col("id") % 3).cast("int"))
    path = str(tmp_path / "t")
    sinks.overwrite(df, path)
    sinks.append(df.withColumn("extra", F.lit(1)), path)
    assert sinks.read_merged(spark, path).filter("extra is null").count() == 100
    sinks.overwrite_partitioned(df, path + "p", "anio")
    assert rows(spark.read.parquet(path + "p").select("id", "anio")) == rows(df.select("id", "anio"))
    sinks.export_sorted_csv(df, path + "c", "anio", "id")
    back = spark.read.option("header", True).csv(path + "c")
    assert back.count() == 100
    assert rows(sinks.row_counts({"a": df, "b": df.limit(3)})) == [("a", 100), ("b", 3)]


def test_catalogue_table(spark):
    sinks.drop_table(spark, "strata_things")
    try:
        sinks.overwrite_table(spark.range(3), "strata_things", "Things, the owner's", {"quality": "bronze"})
        sinks.overwrite_table(spark.range(2).withColumn("b", F.lit("x")), "strata_things", "Things", {"quality": "silver"})
        assert tables.read_table(spark, "strata_things").columns == ["id", "b"]
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED strata_things").collect()}
        assert described["Comment"] == "Things" and "quality=silver" in described["Table Properties"]
    finally:
        sinks.drop_table(spark, "strata_things")
    assert not spark.catalog.tableExists("strata_things")


def test_stream_is_incremental(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.range(10).write.parquet(source)
    for expected in (10, 10):
        ingest_available(arriving_files(spark, source, "id long"), target, mark, batch_id="b1")
        assert spark.read.parquet(target).count() == expected
    spark.range(10, 15).write.mode("append").parquet(source)
    ingest_available(arriving_files(spark, source, "id long", max_files=1), target, mark, batch_id="b2")
    assert spark.read.parquet(target).count() == 15
    seen = []
    upsert_available(arriving_files(spark, source, "id long"), str(tmp_path / "mark2"), lambda batch, n: seen.append(batch.count()))
    assert sum(seen) == 15


def split_records(text: str) -> list[str]:
    """Records by the four states of a quote automaton, one character at a time; an open quote at the end is text."""
    out, start, state, i = [], 0, "begin", 0
    while i <= len(text):
        c = text[i] if i < len(text) else None
        if state == "quoted":
            if c is None:  # nothing closes it: the lines from here on stand alone
                return [r for r in out + text[start:].split("\n") if r]
            if c == '"':
                state = "after"
        elif state == "after" and c == '"':
            state = "quoted"
        elif c is None or c == "\n":
            out.append(text[start:i])
            start, state = i + 1, "begin"
        elif c == ",":
            state = "begin"
        elif state == "begin" and c == '"':
            state = "quoted"
        else:
            state = "inside"
        i += 1
    return [r for r in out if r]


def test_quotes_count_at_a_field_start_only(spark, tmp_path):
    (tmp_path / "probe.csv").write_text('a,b\n1,5" pipe\n2,x\n3,y\n4,z\n')
    found = files.read_ragged(spark, str(tmp_path / "probe.csv"))
    assert rows(found.rows) == [("1", '5" pipe'), ("2", "x"), ("3", "y"), ("4", "z")] and found.rejects.isEmpty()
    (tmp_path / "open.csv").write_text('a,b\n1,"x\ny"\n2,"5\n3,y\n4,""\n')
    assert rows(files.read_ragged_csv(spark, str(tmp_path / "open.csv")).select("a")) == [("1",), ("2",), ("3",), ("4",)]
    (tmp_path / "two.csv").write_text('a,b,c\n1,5" a,7" b\n2,"5"" a,""b",c\n')
    assert rows(files.read_ragged_csv(spark, str(tmp_path / "two.csv"))) == [("1", '5" a', '7" b'), ("2", '5" a,"b', "c")]


def test_records_of_any_text_split_anywhere(spark, tmp_path):
    import random

    draw, texts = random.Random(5), {}
    for i in range(12):
        texts[f"t{i:02}.csv"] = "".join(draw.choices('ab,"\n', [4, 2, 3, 3, 3], k=draw.randint(0, 60)))
        (tmp_path / f"t{i:02}.csv").write_text(texts[f"t{i:02}.csv"])
    want = sorted((name, r) for name, text in texts.items() for r in split_records(text))
    for split in ("1g", "7"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            found = files.csv_records(spark, str(tmp_path))
            assert sorted((r.file.rsplit("/", 1)[1], r.record) for r in found.rows.collect()) == want
            firsts = {name: split_records(text)[0] for name, text in texts.items() if split_records(text)}
            assert {f.rsplit("/", 1)[1]: header for f, _, header in found.headers} == firsts
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_sources_take_the_same_jobs(spark, tmp_path):
    def jobs(n):
        root = tmp_path / f"n{n}"
        for i in range(n):
            (root / f"s{i % 2}").mkdir(parents=True, exist_ok=True)
            text = f"a,b\n{i},x\n" if i % 3 else f"b,c\ny,{i}\n"
            (root / f"s{i % 2}" / f"f+ {i}%.csv").write_text(text if i % 2 == 0 else "Title\n" + text)
        specs = [SourceSpec("even", str(root / "s0")), SourceSpec("odd", str(root / "s1" / "f+ *.csv"), "ragged_csv", skip_rows=1)]
        group = f"many-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            found = rows(files.read_sources(spark, specs).select("source_name", "source_file", "a", "b", "c"))
        finally:
            spark.sparkContext.setJobGroup("", "")
        want = [(["even", "odd"][i % 2], f"f+ {i}%.csv", *((str(i), "x", None) if i % 3 else (None, "y", str(i)))) for i in range(n)]
        assert found == sorted(want, key=repr)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(4) == jobs(24)
    with pytest.raises(ValueError, match="unique"):
        files.read_sources(spark, [SourceSpec("a", "x"), SourceSpec("a", "y")])
    with pytest.raises(ValueError, match="no CSV"):
        files.read_sources(spark, [SourceSpec("a", "x", "parquet")])


def test_rejects_are_handed_over(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("a,b\n1,x\nbad,y\n2,z\n")
    good, bad = files.load_with_rejects(spark, SourceSpec("p", str(tmp_path / "plain.csv"), schema="a int, b string"))
    assert rows(good) == [(1, "x"), (2, "z")] and rows(bad) == [("bad,y",)]
    (tmp_path / "ragged.csv").write_text("T\na,b\n1,x\n2,x,,,y\n")
    good, bad = files.load_with_rejects(spark, SourceSpec("r", str(tmp_path / "ragged.csv"), "ragged_csv", skip_rows=1))
    assert rows(good) == [("1", "x")] and rows(bad) == [("2,x,,,y",)]
