"""Readers for landed files.

Text formats are read as text first and cast afterwards. That gives one set of null rules for CSV
and JSON, keeps ``12.0`` in an integer column, and turns a bad field into a null instead of losing
the row. The casts are built-in expressions, so a scan stays one stage.
"""

from __future__ import annotations

import csv
import logging
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.names import csv_name, league_of, season_of
from touchline.functions.values import typed_columns
from touchline.operators.joins import fits_broadcast, lookup
from touchline.schemas import LOAD_ORDER, RAW, as_text
from touchline.session import fresh_dir
from touchline.sources.pages import page_pieces
from touchline.sources.paths import children

log = logging.getLogger(__name__)

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a partition value

_BLOCK = 1 << 16
# Bytes of an indented response that one task reads as one text.
_WHOLE = 1 << 22


def _header_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to batches of file names each file's first line that isn't blank.

    The functions are made here, so that they travel to the executors as they are: reading a table takes
    no package there.
    """

    def first_line(uri: str) -> str | None:
        store, name = fs.FileSystem.from_uri(uri)
        rest = b""
        with store.open_input_stream(name) as stream:
            while block := stream.read(_BLOCK):
                *lines, rest = (rest + block).splitlines(keepends=True)
                found = next((x for x in lines if x.strip(b" \r\n")), None)
                if found is not None:
                    return found.decode(errors="replace").strip(" \r\n")
        return rest.decode(errors="replace").strip(" \r\n") or None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("file").to_pylist():
                try:
                    found.append((uri, first_line(uri), True))
                except (pa.ArrowInvalid, NotImplementedError, OSError):
                    found.append((uri, None, False))
            columns = zip(*found) if found else ([], [], [])
            kinds = (pa.string(), pa.string(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "header", "reached"])

    return read


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, reached): the first line of every file that isn't blank, null if there is none.

    The listing of files is dealt out as a table and a task opens the first block of each of its files, so
    the cost doesn't grow with the files' sizes and the driver sees no list. Files in a store that only
    Spark's readers know aren't reached.
    """
    listing = spark.newSession()  # in as many tasks as there are cores, whatever the files' sizes
    listing.conf.set("spark.sql.files.maxPartitionBytes", 2**50)
    known = listing.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return known.select(F.col("_metadata.file_path").alias("file")).mapInArrow(
        _header_reader(), "file string, header string, reached boolean"
    )


def _headers(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(file, header) of all files that have a line, and the different headers."""
    lines = _first_lines(spark, path)
    found = lines.select("header", "reached").distinct().collect()
    if all(row.reached for row in found):
        headers = {row.header for row in found}
    else:
        lines = _first_lines_by_scan(spark, path)
        headers = {row.header for row in lines.select("header").distinct().collect()}
    return lines.where(F.col("header").isNotNull()).select("file", "header"), sorted(headers - {None})


def _first_lines_by_scan(spark: SparkSession, path: str) -> DataFrame:
    """The same by Spark's reader, which reads every byte; reduced to a line per file in the map task."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).where(F.length(F.trim("value")) > 0)
    file, at = F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    first = lines.where(F.col("_metadata.file_block_start") == 0).select(file, at, F.trim("value").alias("line"))
    return first.groupBy("file").agg(F.min_by("line", "at").alias("header"))


def _names(header: str) -> list[str]:
    """The columns of a header line; a name that isn't the only one of its kind names no column."""
    names = next(csv.reader([header.rstrip("\r")]), [])
    often = Counter(n.lower() for n in names)
    return [n if n and often[n.lower()] == 1 else f"_c{i}" for i, n in enumerate(names)]


def _csv_text(
    spark: SparkSession, path: str, wanted: Sequence[str], also: Mapping[str, Column], multi_line: bool = False
) -> DataFrame | None:
    """The columns ``wanted`` of all ``*.csv`` files as text, by every file's own header; None without files.

    Doubled quotes are read as in RFC 4180; a column that a file lacks is null. ``also`` are columns that
    are made of the file's metadata. All files are one scan by position; if headers differ, rows learn
    theirs by a join with the table of first lines, which the driver sees by different headers only.
    ``multi_line`` allows line breaks inside quotes, at the price that a file can't be split between tasks.
    """
    lines, headers = _headers(spark, path)
    if not headers:
        return None
    named = [_names(h) for h in headers]
    columns = named[0] if len(named) == 1 else [f"_c{i}" for i in range(max(map(len, named)))]
    rows = (
        spark.read.schema(", ".join(f"`{c.replace('`', '``')}` string" for c in columns))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    if len(named) == 1:
        lacking = F.lit(None).cast("string")
        known = {c: F.col(f"`{c}`") for c in columns if c in wanted}
        return rows.select(*(known.get(c, lacking).alias(c) for c in wanted), *(v.alias(c) for c, v in also.items()))
    stored = fresh_dir(spark, "csv-headers")
    _with_kind(lines, headers).write.parquet(stored)
    kinds = spark.read.schema("file string, kind int").parquet(stored)
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), *(v.alias(f"_also_{c}") for c, v in also.items()))
    rows = lookup(rows, kinds, "file", small=fits_broadcast({"kinds": kinds})["kinds"])

    def found(name: str) -> Column:
        places = ((kind, names.index(name)) for kind, names in enumerate(named) if name in names)
        cases = (F.when(F.col("kind") == kind, F.col(f"_c{place}")) for kind, place in places)
        return F.coalesce(F.lit(None).cast("string"), *cases)

    return rows.select(*(found(c).alias(c) for c in wanted), *(F.col(f"_also_{c}").alias(c) for c in also))


def _with_kind(lines: DataFrame, headers: Sequence[str]) -> DataFrame:
    """(file, kind): the place of every file's header among ``headers``."""
    return lines.select("file", (F.array_position(F.lit(list(headers)), F.col("header")) - 1).cast("int").alias("kind"))


def _landed_at(landed: bool) -> list[Column]:
    """The load order of rows that come from files: when their file was last written."""
    return [F.unix_micros("_metadata.file_modification_time").alias(LOAD_ORDER)] if landed else []


def _table(schema: T.StructType, landed: bool) -> T.StructType:
    return T.StructType([*schema, T.StructField(LOAD_ORDER, T.LongType())]) if landed else schema


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW, multi_line: bool = False, landed: bool = False
) -> DataFrame:
    """All ``*.csv`` files of a file, folder or glob as one typed table.

    Columns are matched by header name, for every file by its own header. Columns missing from a
    header are null, columns that ``schema`` does not name are left out of the scan. A folder without
    such files has no rows. ``landed`` adds the load order.
    """
    order = dict(zip([LOAD_ORDER], _landed_at(landed)))
    text = _csv_text(spark, path, schema.names, order, multi_line)
    if text is None:
        return spark.createDataFrame([], _table(schema, landed))
    return typed_columns(text, schema, list(order))


def scan_csv_tree(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """``root/<folder>/*.csv``, exactly one level down.

    Deeper folders hold the inputs the merged files were made of; a recursive listing would count
    those rows twice.
    """
    return scan_csv(spark, f"{root}/*/*.csv", schema)


def scan_tagged_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files whose league and season come from the file name."""
    name = csv_name(F.col("_metadata.file_path"))
    tags = {"league": league_of(name), "season": season_of(name)}
    text = _csv_text(spark, path, [c for c in schema.names if c not in tags], tags)
    return spark.createDataFrame([], schema) if text is None else typed_columns(text, schema)


def json_lines(
    spark: SparkSession, path: str, schema: T.StructType = RAW, pretty: bool = False, only: Column | None = None
) -> DataFrame:
    """Every line that isn't blank, with its file and what the one parser makes of it.

    ``items`` are the objects of the line (one object, or an array of them), null if it doesn't parse
    or holds something else; so a line is either read or set aside, never both. With ``pretty`` a file is
    one text, as indented JSON has to be read; one of more than ``_WHOLE`` bytes comes in several texts, cut
    between its objects (see :func:`page_pieces`), and is read or set aside with all of them. ``only`` are
    the files to look at.
    """
    text = spark.read.text(path, wholetext=pretty)
    if pretty:
        small = F.col("_metadata.file_size") <= _WHOLE
        large = spark.read.text(path, lineSep="\n").where(~small if only is None else ~small & only)
        only = small if only is None else small & only
    blank = F.length(F.trim(F.translate("value", "\n\r\t", "   ") if pretty else "value")) == 0
    parsed = (text if only is None else text.where(only)).where(~blank).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        *_landed_at(True),
        F.from_json("value", T.ArrayType(as_text(schema))).alias("items"),
        # A filter on what the parser found isn't moved below a number that depends on the row's place, so
        # the parser isn't asked again in the filter.
        F.monotonically_increasing_id().alias("at"),
    )
    several = F.startswith(F.ltrim("value"), F.lit("["))
    torn = F.when(several, F.exists("items", lambda x: x.isNull())).otherwise(F.get("items", F.lit(0)).isNull())
    order = [LOAD_ORDER]
    lines = parsed.select("value", "file", *order, F.when(~torn & (F.col("at") >= 0), F.col("items")).alias("items"))
    if not pretty or large.isEmpty():
        return lines
    file = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    return lines.unionByName(page_pieces(large.select("value", *file, *_landed_at(True)), T.ArrayType(as_text(schema))))


def json_rows(lines: DataFrame, schema: T.StructType = RAW, landed: bool = False) -> DataFrame:
    """The objects of all lines that parse (see :func:`json_lines`) as typed rows."""
    order = [LOAD_ORDER] if landed else []
    return typed_columns(lines.select(*order, F.inline("items")), schema, order)


def scan_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = RAW, landed: bool = False
) -> DataFrame:
    """JSON lines without the lines that do not parse; see :func:`bad_json_lines` for those."""
    return json_rows(json_lines(spark, path, schema), schema, landed)


BAD_LINES = T.StructType([T.StructField("line", T.StringType()), T.StructField("file", T.StringType())])
# Files are told by so many hash values when it is noted which have bad lines.
_BUCKETS = 1 << 15


def bad_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    pretty: bool = False,
    buckets: Sequence[int] | None = None,
) -> DataFrame:
    """Lines that :func:`scan_jsonl` and :func:`scan_api_extract` leave out, with the file they stand in.

    With ``pretty`` they are whole files, large ones in several texts. ``buckets`` are those of the files to look at, as noted by
    :func:`bad_line_figures`; other files aren't parsed.
    """
    only = None if buckets is None else _bucket(F.col("_metadata.file_path")).isin(list(buckets))
    lines = json_lines(spark, path, schema, pretty, only)
    return lines.where(F.col("items").isNull()).select(F.col("value").alias("line"), "file")


def _bucket(file: Column) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(_BUCKETS))


def bad_line_figures() -> list[Column]:
    """To observe over :func:`json_lines` while its rows are written: how many lines are bad, and a bitmap
    (4 KiB) of the hash values of their files."""
    bad = F.col("items").isNull()
    return [
        F.count(F.when(bad, 1)).alias("bad"),
        F.bitmap_construct_agg(F.when(bad, _bucket(F.col("file")))).alias("files"),
    ]


def buckets_of(bitmap: bytes) -> list[int]:
    """The hash values in such a bitmap."""
    return [8 * at + bit for at, byte in enumerate(bitmap) if byte for bit in range(8) if byte >> bit & 1]


def scan_api_extract(
    spark: SparkSession, path: str, schema: T.StructType = RAW, pretty: bool = False, landed: bool = False
) -> DataFrame:
    """Landed API responses: arrays of objects, one compact response per line.

    Every object becomes a row; keys that ``schema`` does not name are skipped by the parser. Lines
    are split between tasks; a torn response is set aside as a whole by :func:`bad_json_lines`.
    ``pretty`` reads indented responses, one per file, which is read or set aside as a whole.
    """
    return json_rows(json_lines(spark, path, schema, pretty), schema, landed)


def present(read, spark: SparkSession, path: str, *args, **options) -> DataFrame | None:
    """``read(spark, path, ...)``, or None if nothing was landed at ``path``."""
    try:
        return read(spark, path, *args, **options)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no source at %s, going on without it", path)
        return None


def optional(read, spark: SparkSession, path: str, schema: T.StructType = RAW, **options) -> DataFrame:
    """``read(spark, path, schema)``, or no rows if nothing was landed at ``path``.

    A folder that is there without files has no rows either; any other fault stays loud.
    """
    found = present(read, spark, path, schema, **options)
    return spark.createDataFrame([], schema) if found is None else found


def scan_lake(
    spark: SparkSession, path: str, schema: T.StructType = RAW, landed: bool = False
) -> DataFrame:
    """The season lake. The season comes from the folder, so a season filter prunes files.

    ``landed`` adds the load order, null for rows from before it was kept.
    """
    full = _table(schema, landed)
    return spark.read.schema(full).parquet(path).select(*full.names)


def scan_season(spark: SparkSession, path: str, season: str, schema: T.StructType = RAW) -> DataFrame:
    return scan_lake(spark, path, schema).where(F.col("season") == season)


def _seasons(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Sorted season names of the folders below ``root``; no file is opened."""
    names = (unquote(n.removeprefix(prefix)) for n in children(spark, root) if n.startswith(prefix))
    seasons = sorted(n for n in names if n != _NULL_FOLDER)
    return spark.createDataFrame([(n,) for n in seasons], "season string")


def list_seasons(spark: SparkSession, path: str) -> DataFrame:
    """Seasons of the lake."""
    return _seasons(spark, path, "season=")


def list_legacy_seasons(spark: SparkSession, root: str) -> DataFrame:
    """Seasons of a lake with one ``season<S>`` folder per season."""
    return _seasons(spark, root, "season")


def scan_legacy_lake(spark: SparkSession, root: str, schema: T.StructType = RAW) -> DataFrame:
    """Lake with ``season<S>/players_data_<S>.parquet`` files, whose season is a column.

    Files of one season may hold integers where those of another hold doubles, so every season is
    read with its own schema and cast. The explicit column list drops the stray index column.
    """

    def season(folder: str) -> DataFrame:
        files = spark.read.parquet(f"{root}/{folder}")
        return files.select(
            *(
                (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema
            )
        )

    folders = sorted(n for n in children(spark, root) if n.startswith("season"))
    return reduce(DataFrame.unionByName, map(season, folders), spark.createDataFrame([], schema))
