"""File sources: plain CSV, ragged CSV with preamble and BOM, config-driven lists of files.

Landed files only; fetching them is not data work.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from fnmatch import fnmatch
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.naming import drop_matching, rename_all
from strataframe.functions.text import base_name, without_extension, year_in_name
from strataframe.operators.reshape import stack_tables
from strataframe.spec import SourceSpec

COPYRIGHT_COLUMN = "^<!___copyright_"


BAD_RECORD = "_bad_record"


def read_csv(spark: SparkSession, path, schema: str | None = None, drop_malformed: bool = False) -> DataFrame:
    """CSV with a header.  Pass a schema at scale: inferring types reads the data twice.

    ``drop_malformed`` leaves out records that do not fit the schema; which ones does not depend
    on the columns used later, since every record is parsed whole.  See :func:`csv_rejects`.
    """
    if drop_malformed and schema:
        return _checked_csv(spark, path, schema).filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def csv_rejects(spark: SparkSession, path, schema: str) -> DataFrame:
    """The records that ``read_csv(..., drop_malformed=True)`` leaves out, as text."""
    return _checked_csv(spark, path, schema).filter(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def _checked_csv(spark: SparkSession, path, schema: str) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    # without pruning a record is bad or good as a whole; the reader refuses queries of the bad record alone
    rows = reader.option("columnPruning", False).schema(f"{schema}, {BAD_RECORD} string").csv(path)
    own = [F.col(f"`{c}`").cast("string") for c in rows.columns if c != BAD_RECORD]
    return rows.filter(F.length(F.concat_ws("", *own)) >= 0)


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Files that match the glob: path, name, stem, year in the name, length.  Reads no content.

    An empty match is an error.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = base_name(F.col("path"))
    listed = found.select(
        "path", "length", name.alias("file_name"),
        without_extension(name).alias("stem"), year_in_name(name).alias("file_year"),
    )
    if listed.isEmpty():
        raise FileNotFoundError(f"no file matches {glob!r} in {folder!r}")
    return listed


def one_dataset_per_file(spark: SparkSession, folder: str, glob: str, schema: str | None = None) -> dict[str, DataFrame]:
    """File stem -> DataFrame.  Only the list of paths comes to the driver."""
    return {
        row.stem: read_csv(spark, row.path, schema)
        for row in list_files(spark, folder, glob).select("stem", "path").toLocalIterator()
    }


def _plain_name(path: Column) -> Column:
    """The file's own name from a path as scans report it, with odd characters as %xx."""
    return F.url_decode(F.replace(base_name(path), F.lit("+"), F.lit("%2B")))


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file name each row came from, for file-based scans."""
    return df.withColumn("source_file", _plain_name(F.col("_metadata.file_path")))


class Ragged(NamedTuple):
    """Rows of a ragged file as text columns, and the records that do not fit with the reason."""

    rows: DataFrame
    rejects: DataFrame


# A line that begins outside quotes: closed fields, then perhaps one that stays open.  A quote counts only where a field
# begins; elsewhere it is text.  All repeats are possessive, so the patterns take linear time.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = f"^{_FIELDS}{_QUOTED}$"
_STAYS = f'^[^"]*+(?:""[^"]*+)*+(?:$|"[^,]*+,{_FIELDS}{_QUOTED}$)'

_BLOCK = ["file", "block", "part"]
_SUMMARY = (
    "file string, block long, part int, first_row long, n long, plain boolean, "
    "ends_out boolean, ends_in boolean, open_out long, open_in long, header_at long, header string"
)
MOST_BLOCKS = 500_000  # splits whose states are broadcast; beyond, lines are dealt out by block


def _run(inside: bool, opens: np.ndarray, stays: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line begins and ends inside quotes; only lines that can change the state are stepped through."""
    at, after, state = np.flatnonzero(opens | ~stays), [], inside
    for opening, staying in zip(opens[at].tolist(), stays[at].tolist()):
        state = staying if state else opening
        after.append(state)
    ends = np.array([inside, *after], bool)[np.searchsorted(at, np.arange(len(opens)), side="right")]
    return np.concatenate([[inside], ends])[: len(ends)], ends


class _Block:
    """One block's summary: where both states that its first line can begin in lead to."""

    def __init__(self, key: list, first_row: int):
        self.key, self.first_row, self.n, self.plain = key, first_row, 0, True
        self.ends, self.open = [False, True], [-1, -1]
        self.header_at, self.header, self.pending = None, None, None

    def add(self, opens: np.ndarray, stays: np.ndarray, head: list) -> None:
        for i in (0, 1):
            begins, ends = _run(self.ends[i], opens, stays)
            if ends[-1] and not begins.all():
                self.open[i] = self.n + int(np.flatnonzero(~begins)[-1])
            if i == 0:
                self.plain &= not (begins.any() or ends[-1])
                self._seek_header(begins, ends, head)
            self.ends[i] = bool(ends[-1])
        self.n += len(opens)

    def _seek_header(self, begins: np.ndarray, ends: np.ndarray, head: list) -> None:
        for place, text in enumerate(head):
            if self.header is not None:
                return
            if text is None:  # a line before the CSV, or not of a file's first block
                continue
            if not begins[place]:
                self.header_at, self.pending = self.n + place, []
            self.pending.append(text)
            if not ends[place] and self.pending != [""]:
                self.header = "\n".join(self.pending)

    def row(self) -> tuple:
        return (*self.key, self.first_row, self.n, self.plain, *self.ends, *self.open, self.header_at if self.header is not None else None, self.header)


def _summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = None
    for frame in frames:
        done, keys = [], frame[_BLOCK].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(frame)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            key, part = keys[a].tolist(), frame.iloc[a:b]
            if block is None or block.key != key:
                if block is not None:
                    done.append(block.row())
                block = _Block(key, int(part["row"].iloc[0]))
            block.add(part["opens"].to_numpy(), part["stays"].to_numpy(), part["head"].tolist() if block.header is None else [])
        yield pd.DataFrame(done, columns=[c.split()[0] for c in _SUMMARY.split(", ")])
    if block is not None:
        yield pd.DataFrame([block.row()], columns=[c.split()[0] for c in _SUMMARY.split(", ")])


def _records_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(file, line, start, whole, value) of lines whose block's first state is known; whole records stand in one line."""
    key, inside, start = None, False, 0
    for frame in frames:
        for own, part in frame.groupby(["file", "block"], sort=False):
            if own != key:
                key, inside, start = own, bool(part["inside"].iloc[0]), int(part["open_line"].iloc[0])
            begins, ends = _run(inside, part["opens"].to_numpy(), part["stays"].to_numpy())
            line = part["line"].to_numpy()
            starts = np.maximum.accumulate(np.where(begins, start, line))
            inside, start = bool(ends[-1]), int(starts[-1])
            text = line >= part["unclosed"].to_numpy()  # an opening quote that nothing closes is text
            yield pd.DataFrame({"file": part["file"], "line": line, "start": np.where(text, line, starts), "whole": text | ~(begins | ends), "value": part["value"]})


class Records(NamedTuple):
    """CSV records of files (file, line, record), and the header of each file with its line."""

    rows: DataFrame
    headers: list[tuple[str, int, str]]


def csv_records(spark: SparkSession, path, skip: int = 0) -> Records:
    """The CSV records of text files, those with quoted line ends whole, and each file's first record.

    Files are split by line whatever their size.  One scan gives every block's line count and where
    the states outside and inside quotes lead from its first line to its last; composed over the
    blocks of a file, these give each block its first line's number and state.  The scan of the
    records then parses in place; only lines of records that span several are shuffled.  One row per
    split comes to the driver, which has planned those splits.

    A quote counts only where a field begins, elsewhere it is text, and so is an opening quote that
    nothing closes.  ``line`` is the number of a record's first line, from 1; the first ``skip``
    lines are no records.  Bytes that do not decode vanish; empty lines between records are left out.
    """
    text = F.col("value")
    decoded = F.when(F.is_valid_utf8(text), text).otherwise(F.translate(F.make_valid_utf8(text), "\ufffd", ""))
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"), F.regexp_replace(decoded, "^\ufeff|\r$", "").alias("value"),
    )
    opens, stays = F.col("value").rlike(_OPENS), F.col("value").rlike(_STAYS)

    def scanned(lines: DataFrame, line) -> pd.DataFrame:
        csv_line = line > skip
        head = F.when(csv_line & (F.col("block") == 0), F.col("value"))
        slim = lines.select(*_BLOCK, "row", (csv_line & opens).alias("opens"), (~csv_line | stays).alias("stays"), head.alias("head"))
        return slim.mapInPandas(_summaries, _SUMMARY).toPandas().sort_values(["file", "block"]).reset_index(drop=True)

    if skip:  # which lines are preamble is known once the lines are counted
        counts = raw.groupBy(*_BLOCK).agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n")).toPandas().sort_values(["file", "block"])
        counts["first_line"] = counts.groupby("file")["n"].cumsum() - counts["n"]
        blocks = scanned(*_numbered(raw, counts[[*_BLOCK, "first_row", "first_line"]]))
    else:
        blocks = scanned(raw, F.lit(1))
    if not len(blocks):
        return Records(raw.select("file", F.lit(0).cast("long").alias("line"), F.col("value").alias("record")).filter("false"), [])

    states, headers = [], []
    for file, own in blocks.groupby("file", sort=True):
        first, inside, open_line, mine = 0, False, 0, []
        for b in own.itertuples():
            mine.append([file, b.block, b.part, b.first_row, first, b.plain, inside, open_line])
            if b.header is not None and b.block == 0:
                headers.append((file, first + int(b.header_at) + 1, b.header))
            ends, opened = (b.ends_in, b.open_in) if inside else (b.ends_out, b.open_out)
            if ends and opened >= 0:
                open_line = first + int(opened) + 1
            first, inside = first + b.n, bool(ends)
        states += [[*m, open_line if inside else np.iinfo(np.int64).max] for m in mine]
    known = pd.DataFrame(states, columns=[*_BLOCK, "first_row", "first_line", "plain", "inside", "open_line", "unclosed"])
    numbered, line = _numbered(raw, known)
    numbered = numbered.withColumn("line", line).filter(F.col("line") > skip)
    simple = F.col("plain") & ~F.col("inside")
    rows = numbered.filter(simple & (F.col("value") != "")).select("file", "line", F.col("value").alias("record"))
    if not (known["plain"] & ~known["inside"]).all():
        walked = numbered.filter(~simple).select("file", "block", "row", "line", "value", opens.alias("opens"), stays.alias("stays"), "inside", "open_line", "unclosed")
        if len(known) > MOST_BLOCKS:
            walked = walked.repartition("file", "block").sortWithinPartitions("file", "block", "row")
        walked = walked.mapInPandas(_records_of, "file string, line long, start long, whole boolean, value string")
        pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda p: p["value"]), "\n")
        spread = walked.filter("not whole").groupBy("file", F.col("start").alias("line")).agg(pieces.alias("record"))
        rows = rows.unionByName(walked.filter("whole and value <> ''").select("file", "line", F.col("value").alias("record"))).unionByName(spread)
    missing = set(known["file"]) - {f for f, _, _ in headers}
    if missing:  # the first record does not end in the first block
        first = rows.filter(F.col("file").isin(*missing)).groupBy("file").agg(F.min("line").alias("line"), F.min_by("record", "line").alias("header"))
        headers += [(r.file, r.line, r.header) for r in first.collect()]
    return Records(rows, sorted(headers))


def _numbered(raw: DataFrame, blocks: pd.DataFrame):
    """The lines with what is known of their blocks, and the number of a line.  A block of another split is an error."""
    known = raw.sparkSession.createDataFrame(blocks)
    joined = raw.join(F.broadcast(known) if len(blocks) <= MOST_BLOCKS else known, _BLOCK, "left")
    unknown = F.raise_error(F.lit("files were split anew between two scans")).cast("long")
    return joined, F.coalesce("first_line", unknown) + F.col("row") - F.col("first_row") + 1


def text_records(spark: SparkSession, path, skip: int = 0) -> DataFrame:
    """The rows of :func:`csv_records`."""
    return csv_records(spark, path, skip).rows


def _parsed(records: Records) -> tuple[DataFrame, list[list[str]]]:
    """Records below their file's header, with the fields as one array of text, their number and the layout's number; the layouts' names.

    All layouts are parsed in one scan.  One row per file is joined to the records.
    """
    texts = sorted({header for _, _, header in records.headers})
    layouts = [next(csv.reader(io.StringIO(text, newline=""))) for text in texts]
    width = max(map(len, layouts), default=0)
    schema = ", ".join(f"c{i} string" for i in range(width + 1))
    options = {"mode": "PERMISSIVE", "escape": '"', "maxCharsPerColumn": "-1", "lineSep": "\u0000"}
    of_file = [(file, line, texts.index(header)) for file, line, header in records.headers]
    files = records.rows.sparkSession.createDataFrame(of_file, "file string, _header long, layout int")
    data = records.rows.join(F.broadcast(files) if len(of_file) <= MOST_BLOCKS else files, "file").filter(F.col("line") > F.col("_header")).drop("_header")
    bare = F.regexp_replace("record", f'(^|,){_QUOTED}"', "$1")
    parsed = data.withColumns({"fields": F.size(F.split(bare, ",", -1)), "r": F.from_csv("record", schema, options)})
    values = F.array(*[F.nullif(F.col(f"r.c{i}"), F.lit("")) for i in range(width)])
    return parsed.withColumn("values", values).drop("r"), layouts


def read_ragged(spark: SparkSession, path: str, skip: int = 0, overlong: str = "reject", style: str = "separator") -> Ragged:
    """CSV with BOM, preamble, CRLF, undecodable bytes, a phantom last field and overlong records.

    All columns arrive as text (cast afterwards, see ``cast_columns``).  ``path`` may name many
    files of one layout.  One field beyond the header is the phantom and is dropped, record by
    record; a record with more is a reject with its file, line and reason, or is cut
    (``overlong="truncate"``).  Missing fields are NULL.
    """
    if overlong not in ("reject", "truncate"):
        raise ValueError(f"unsupported treatment {overlong!r}")
    parsed, layouts = _parsed(csv_records(spark, path, skip))
    if not layouts:
        raise ValueError(f"{path}: no header after {skip} lines")
    if any(names != layouts[0] for names in layouts):
        raise ValueError("files of one read must share their header")
    names = layouts[0]
    fits = F.col("fields") <= len(names) + 1 if overlong == "reject" else F.lit(True)
    rows = parsed.filter(fits).select([F.get("values", F.lit(i)) for i in range(len(names))]).toDF(*names)
    rejects = parsed.filter(~fits).select("file", "line", "record", F.lit("overlong").alias("reason"))
    return Ragged(drop_matching(rename_all(rows, style), pattern=COPYRIGHT_COLUMN), rejects)


def read_ragged_csv(spark: SparkSession, path: str, skip: int = 0, overlong: str = "reject", style: str = "separator") -> DataFrame:
    """The rows of :func:`read_ragged`."""
    return read_ragged(spark, path, skip, overlong, style).rows


def read_by_name(spark: SparkSession, path) -> DataFrame:
    """Files whose headers differ, united by column name: columns a file lacks are NULL there.

    All layouts come from one scan: a column's place is looked up by the record's layout.  All
    columns are text, beside ``source_file``.
    """
    parsed, layouts = _parsed(csv_records(spark, path))
    if not layouts:
        raise FileNotFoundError(path)
    return parsed.select(*_by_name(layouts), _plain_name(F.col("file")).alias("source_file"))


def _by_name(layouts: list[list[str]]) -> list[Column]:
    """Every column of any layout, from the place it has in the record's own."""
    columns = []
    for name in dict.fromkeys(n for names in layouts for n in names):
        if any(names.count(name) > 1 for names in layouts):
            raise ValueError(f"column {name!r} stands twice in a header")
        places = F.array(*[F.lit(names.index(name) if name in names else None).cast("int") for names in layouts])
        columns.append(F.get("values", F.get(places, F.col("layout"))).alias(name))
    return columns


def read_sources(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """Many CSV sources as one table: ``source_name``, ``source_file`` and the united columns, as text.

    Specs are told apart by the lines they skip only; all files of one number are found, split and
    parsed in the same two scans, whatever their layouts.  Jobs do not grow with sources or files.
    A location may name a file, a folder or a glob; a file belongs to the spec whose location names it.
    """
    if len({spec.name for spec in specs}) != len(specs):
        raise ValueError("source names must be unique")
    if other := [spec.name for spec in specs if spec.format not in ("csv", "ragged_csv")]:
        raise ValueError(f"no CSV sources: {other}")
    parts = []
    for skip in sorted({spec.skip_rows for spec in specs}):
        own = [spec for spec in specs if spec.skip_rows == skip]
        records = csv_records(spark, [spec.location for spec in own], skip)
        names = {file: _spec_of(file, own) for file, _, _ in records.headers}
        of_file = spark.createDataFrame([(file, name) for file, name in names.items()], "file string, source_name string")
        parsed, layouts = _parsed(records)
        named = parsed.join(F.broadcast(of_file) if len(names) <= MOST_BLOCKS else of_file, "file")
        parts.append(named.select("source_name", _plain_name(F.col("file")).alias("source_file"), *_by_name(layouts)))
    return stack_tables(parts, allow_missing=True)


def _spec_of(file: str, specs: list[SourceSpec]) -> str:
    """The source whose location names the file; the longest such location counts."""
    path = unquote(urlsplit(file).path)
    found = []
    for spec in specs:
        where = urlsplit(spec.location).path.rstrip("/")
        if fnmatch(path, where) or fnmatch(path.rsplit("/", 1)[0], where):
            found.append((len(where), spec.name))
    if not found:
        raise LookupError(f"no source names {file}")
    return max(found)[1]


def load_with_rejects(spark: SparkSession, spec: SourceSpec) -> tuple[DataFrame, DataFrame | None]:
    """One source and the records that do not fit it, as text; None where the format has none."""
    if spec.format == "csv" and spec.skip_rows == 0:
        return load(spark, spec), csv_rejects(spark, spec.location, spec.schema).withColumnRenamed(BAD_RECORD, "record") if spec.schema else None
    if spec.format in ("csv", "ragged_csv"):
        found = read_ragged(spark, spec.location, spec.skip_rows)
        return found.rows, found.rejects.select("record")
    return load(spark, spec), None


def load(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """One source as its spec describes it; see :func:`load_with_rejects` for what does not fit."""
    if spec.format == "csv" and spec.skip_rows == 0:
        return read_csv(spark, spec.location, spec.schema, drop_malformed=spec.schema is not None)
    if spec.format in ("csv", "ragged_csv"):
        return read_ragged_csv(spark, spec.location, spec.skip_rows)
    if spec.format == "table":
        return spark.read.table(spec.location)
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    return reader.load(spec.location) if spec.format != "jdbc" else reader.load()


def load_all(spark: SparkSession, specs: list[SourceSpec]) -> dict[str, DataFrame]:
    names = [s.name for s in specs]
    if len(set(names)) != len(names):
        raise ValueError("source names must be unique")
    return {s.name: load(spark, s) for s in specs}
