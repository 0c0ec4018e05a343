"""Landed files and tables as DataFrames, always with a declared schema."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmgrid import schemas
from filmgrid.functions import html
from filmgrid.sources import csv_split, json_split

STRICT = {"mode": "FAILFAST"}
# Fixed value: the date window at the end of a file's name, a part number behind it or not.
_WINDOW = r"_(\d{8})_(\d{8})(?:-\d+)?\.[^.]*$"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row; columns are found by name, whatever else the files hold, and cast strictly.

    Only one header line is read ahead. Files with other headers are refused, not misread; read such sets apart and
    put them together with ``dedup.union_by_name``. ``multi_line`` allows line feeds in quoted fields. Such files are cut
    at their blocks, too; a quote may then stand only around a field, or doubled inside of a quoted one.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, **STRICT}
    names = spark.read.options(**options).csv(path).schema
    missing = [c for c in schema.names if c not in names.names]
    if missing:
        raise ValueError(f"columns missing from the files: {missing}")
    rows = _quoted_records(spark, path, names) if multi_line else spark.read.schema(names).options(enforceSchema=False, **options).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _quoted_records(spark: SparkSession, path: str | list[str], names: T.StructType) -> DataFrame:
    """The records behind the headers, all columns as text."""
    parsed = F.from_csv("text", names.toDDL(), {"escape": '"', **STRICT})
    records = csv_split.record_texts(spark, path).where("text <> ''").select("path", "number", parsed.alias("r"))
    same = F.lit(True)
    for name in names.names:
        same = same & F.col("r")[name].eqNullSafe(F.lit(name))
    refused = F.raise_error(F.concat(F.lit("another header than that of the other files: "), "path")).cast("boolean")
    rows = records.where(F.when(F.col("number") > 0, True).when(same, False).otherwise(refused))
    return rows.select("r.*")


def read_ndjson(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One JSON record per line."""
    return spark.read.schema(schema).options(**STRICT).json(path)


def read_json_document(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Files that hold one JSON record, or one array of records, each. An array is read by as many tasks as it has blocks.

    Entries of an array that are null are left out.
    """
    parts = json_split.record_texts(spark, path)
    is_array = F.col("opening") == "["
    # a document that is one record comes in parts as well
    pieces = F.array_sort(F.collect_list(F.struct("part", "text")))
    single = parts.where(~is_array).groupBy("path").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"))
    whole = single.select(F.concat(F.lit("["), "text", F.lit("]")).alias("text"))
    listed = parts.where(is_array).select(json_split.entries_of_part().alias("text"))
    rows = listed.union(whole).select(F.explode(F.from_json("text", T.ArrayType(schema), STRICT)).alias("r"))
    return rows.where("r IS NOT NULL").select("r.*")


def read_keyed_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Files that hold one object of records by key, read by as many tasks as they have blocks: ``(_file, _key, fields...)``."""
    parts = json_split.record_texts(spark, path)
    return entries(parts.select(F.col("file").alias("_file"), json_split.entries_of_part().alias("value")), "value", schema, "_file")


def entries(df: DataFrame, column: str, schema: T.StructType, *keep: str) -> DataFrame:
    """JSON objects of records by key as one row per record."""
    records = F.from_json(column, T.MapType(T.StringType(), schema), STRICT)
    return df.select(*keep, F.explode(records).alias("_key", "_record")).select(*keep, "_key", "_record.*")


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the name and modification time of the file each row came from, for a later "last one wins"."""
    return df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_modification_time").alias("_landed"))


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def has_window(path: str) -> bool:
    """Whether a file's name ends in a date window."""
    return re.search(_WINDOW, file_name(path)) is not None


def file_paths(spark: SparkSession, folder: str, prefix: str, extension: str) -> list[str]:
    """Paths of the matching files, by name. Names only; a folder holds some files a week."""
    return [r["path"] for r in list_files(spark, folder, prefix, extension).select("path").orderBy("path").collect()]


def read_ordered(spark: SparkSession, paths: list[str], extension: str, schema: T.StructType) -> DataFrame:
    """The rows of some files with ``_order`` and ``_position``, by which the last of several records can be told.

    ``_order`` begins with the end of the window in the file's name (files without one come first) and goes on with
    the name; ``_position`` is the place in the file: the start of the part that a task reads, then the row in it. No
    paths give an empty frame.
    """
    kinds = [T.StructField("_order", T.StringType()), T.StructField("_position", T.StructType([T.StructField("start", T.LongType()), T.StructField("row", T.LongType())]))]
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, *kinds]))
    rows = read_csv(spark, paths, schema) if extension == "csv" else read_ndjson(spark, paths, schema)
    name = F.col("_metadata.file_name")
    end = F.regexp_extract(name, _WINDOW, 2)
    position = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", F.concat(F.rpad(end, 8, "0"), F.lit(" "), name).alias("_order"), position.alias("_position"))


def read_ndjson_with_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The good records, and ``(file, line)`` of the lines that are no record of the schema.

    For loads that must not end at one bad line. Both frames read the files; count the rejects, or write them.
    """
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    # ``inline`` keeps Spark from parsing a line once for every field
    parsed = lines.where(F.trim("line") != "").select("file", "line", F.inline(F.array(F.from_json("line", whole, options))))
    return parsed.where("_bad IS NULL").select(*schema.names), parsed.where("_bad IS NOT NULL").select("file", "line")


def prefix_glob(folder: str, prefix: str, extension: str) -> str:
    """All files of a folder with a name prefix; one read takes them together."""
    return f"{folder.rstrip('/')}/{prefix}*.{extension}"


def window_prefix(prefix: str, start: date | None, end: date | None) -> str:
    """``prefix_20240101_20240108``; the bare prefix without a window."""
    return f"{prefix}_{start:%Y%m%d}_{end:%Y%m%d}" if start and end else prefix


def list_files(spark: SparkSession, folder: str, prefix: str, extension: str) -> DataFrame:
    """``(path, modificationTime, token)`` of matching files; contents are not read.

    ``token`` is the part of the name after the last underscore, which names the end of the file's date window.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*.{extension}")
        .load(folder)
        .select("path", "modificationTime")
    )
    return files.withColumn("token", F.regexp_extract("path", r"_([^_/]*)\.[^./]*$", 1))


def latest_file(spark: SparkSession, folder: str, prefix: str, extension: str) -> str | None:
    """Path of the matching file whose name ends in the greatest token."""
    files = list_files(spark, folder, prefix, extension)
    return files.agg(F.max_by("path", F.struct("token", "path"))).first()[0]


def read_window(
    spark: SparkSession,
    folder: str,
    prefix: str,
    extension: str,
    schema: T.StructType,
    start: date | None = None,
    end: date | None = None,
    required: bool = False,
) -> DataFrame:
    """The files of a date window. None at all gives an empty typed frame, or an error if they are required."""
    name = window_prefix(prefix, start, end)
    if list_files(spark, folder, name, extension).isEmpty():
        if required:
            raise FileNotFoundError(f"no file {name}*.{extension} in {folder}")
        return spark.createDataFrame([], schema)
    path = prefix_glob(folder, name, extension)
    return read_csv(spark, path, schema) if extension == "csv" else read_ndjson(spark, path, schema)


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order, so that the same rows come back every time."""
    return df.orderBy(*order).limit(n)


def run_query(spark: SparkSession, query: str, parameters: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL text to a DataFrame. Values go in as ``:name`` parameters, frames as ``{name}``; never by string pasting."""
    return spark.sql(query, args=parameters or {}, **tables)


def chart_rows(pages: DataFrame) -> DataFrame:
    """Chart pages ``(url, html)`` as rows ``(url, year, week, position, cells)``; ``cells`` maps header to text.

    The first table row gives the headers. Hidden cells are skipped, rows with fewer than three cells left out.
    """
    tables = pages.select(
        "url",
        html.chart_year(F.col("url")).alias("year"),
        html.chart_week(F.col("url")).alias("week"),
        html.elements(html.chart_table(F.col("html")), "tr").alias("rows"),
    )
    # the headers are taken before the rows are spread, so that they are read once per page
    headers = html.texts_of(html.visible(html.elements(F.try_element_at("rows", F.lit(1)), "th")))
    # no filter on the rows, which would find them a second time; a page without any gives none below
    spread = tables.withColumn("headers", headers)
    row = lambda markup, i: F.struct(
        i.alias("position"), html.visible(html.elements(markup, "td")).alias("shown")
    )
    kept = F.filter(F.transform("rows", row), lambda r: (r["position"] > 0) & (F.size(r["shown"]) >= 3))
    rows = spread.select("url", "year", "week", "headers", F.inline(kept))
    # a row without a text for some header has null there, texts beyond the headers are left out
    texts = F.slice(html.texts_of(F.col("shown")), F.lit(1), F.size("headers"))
    # of equal headers the last one counts
    last = lambda entry, i: i == F.size("headers") - F.array_position(F.reverse("headers"), entry["headers"])
    cells = F.map_from_entries(F.filter(F.arrays_zip("headers", texts.alias("texts")), last))
    return rows.select("url", "year", "week", "position", cells.alias("cells"))


def weekly_chart(pages: DataFrame) -> DataFrame:
    """Chart pages as rows of the weekly chart schema."""
    cell = lambda name: F.try_element_at("cells", F.lit(name))
    return chart_rows(pages).select(
        "year",
        "week",
        cell("Release").alias("Release"),
        cell("Rank").cast("bigint").alias("Rank"),
        cell("Gross").alias("Gross"),
        cell("Theaters").alias("Theaters"),
        cell("Weeks").alias("Weeks"),
    ).to(schemas.WEEKLY_CHART)
