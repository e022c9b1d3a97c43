"""CSV scans of raw match files."""

from __future__ import annotations

import csv as python_csv
import io
import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import contract as C
from touchline.functions.parsing import parse_date
from touchline.functions.text import blank_to_null, ref, strip
from touchline.operators.quality import validate_matches
from touchline.sources import files, records

# Every byte is one character in this encoding, so a scan passes bytes through unchanged
# and the text can be checked and decoded exactly.
_BYTES = "ISO-8859-1"
_ODD_LINE = "_odd_line"


def read_matches_csv(
    spark: SparkSession,
    path: str,
    na_tokens=C.NA_TOKENS,
    date_formats=C.DATE_FORMATS,
    multi_line: bool = False,
) -> DataFrame:
    """Scan one CSV file: UTF-8, header row, names trimmed and lower-cased, all columns text
    except date; missing-value tokens are NULL, text is trimmed, an unreadable date is NULL.

    Bytes that are not UTF-8 fail the scan (see scan_errors), as do lines with more fields than the header and, without
    multi_line, quotes left open; shorter lines are filled with NULL. Files split across tasks at line ends.
    multi_line=True accepts line breaks inside quotes; files split across tasks all the same, after a pass that counts quotes.
    """
    if not files.exists(spark, path):
        raise FileNotFoundError(f"CSV file does not exist: {path}")
    if not path.rstrip("/").lower().endswith(".csv"):
        raise ValueError(f"Expected a .csv file, got: {files.base_name(path)}")
    return _scan(spark, path, na_tokens, date_formats, multi_line)


def read_matches_dir(
    spark: SparkSession,
    path: str,
    na_tokens=C.NA_TOKENS,
    date_formats=C.DATE_FORMATS,
    multi_line: bool = False,
) -> DataFrame:
    """Scan all CSV files directly inside a directory as one frame, with their names in source_file.

    Files may differ in their headers: those with the same one are one scan, and scans are joined by column name, so the order of
    columns is free and a column that some files lack is NULL there. The header is read from the first bytes of each file.
    """
    _check_dir(spark, path)
    groups: dict[bytes, list[str]] = {}
    for file in files.list_files(spark, path, ".csv"):
        groups.setdefault(_header_record(files.head(spark, file)), []).append(files.literal(file))
    if len(groups) < 2:
        return _scan(spark, path, na_tokens, date_formats, multi_line, source_file=True)
    scans = [_scan(spark, paths, na_tokens, date_formats, multi_line, source_file=True) for paths in groups.values()]
    frame = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return frame.select(*[ref(c) for c in frame.columns if c != "source_file"], "source_file")


def _header_over_lines(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The header fields of the first file that has any; names left out are numbered as a scan numbers them."""
    for place in [path] if isinstance(path, str) else map(files.as_given, path):
        for file in files.list_files(spark, place, ".csv") if files.is_dir(spark, place) else [place]:
            if record := _header_record(files.head(spark, file)):
                fields = next(python_csv.reader(io.StringIO(record.decode(_BYTES), newline="")))
                return [name or f"_c{i}" for i, name in enumerate(fields)]
    return []


def _header_record(start: bytes) -> bytes:
    """The bytes up to the first line end outside quotes, which tell files with the same header; without its byte-order mark."""
    line = re.match(rb'(?:[^"\n]|"[^"]*"?)*', start.removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n"))
    return line[0].rstrip(b"\r")


def list_match_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, path, length) of the CSV files directly inside a directory, by name."""
    _check_dir(spark, path)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length").orderBy("name")


def read_and_validate(
    spark: SparkSession, path: str, as_of: date | None = None, duplicates: bool = True, **scan
) -> tuple[DataFrame, DataFrame]:
    """(data, validation report) of one CSV file; scan takes the options of read_matches_csv."""
    data = read_matches_csv(spark, path, **scan)
    return data, validate_matches(data, as_of, duplicates, stripped=True)


@contextmanager
def scan_errors() -> Iterator[None]:
    """Turn the failure of a scan over text that cannot be read in full into a ValueError."""
    try:
        yield
    except PySparkException as error:
        for message in (C.MSG_NOT_UTF8, C.MSG_TOO_MANY_FIELDS, C.MSG_OPEN_QUOTE):
            if message in str(error):
                raise ValueError(message) from error
        raise


def _check_dir(spark: SparkSession, path: str) -> None:
    if not files.exists(spark, path):
        raise FileNotFoundError(f"Directory does not exist: {path}")
    if not files.is_dir(spark, path):
        raise NotADirectoryError(f"Path is not a directory: {path}")


def _scan(spark, path, na_tokens, date_formats, multi_line, source_file=False) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("encoding", _BYTES)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", _ODD_LINE)
        .option("columnPruning", False)  # a parser that skips fields does not count them
        .option("pathGlobFilter", "*.[cC][sS][vV]")
    )
    header = _header_over_lines(spark, path) if multi_line else reader.csv(path).columns
    names = [_header_name(c) for c in header]
    if clashes := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(C.MSG_HEADERS_CLASH.format(", ".join(clashes)))
    kept = [F.col("source_file")] if source_file else []
    if multi_line and header:
        decoded = _parsed_records(spark, path, names, source_file)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _ODD_LINE)])
        raw = reader.schema(schema).csv(path)
        if header:
            raw = raw.filter(_is_whole(F.col(_ODD_LINE), ref(header[0]), len(header), multi_line))
        origin = [file_name(F.col("_metadata.file_name")).alias("source_file")] if source_file else []
        # One projection per step: each step uses its input more than once, and as one expression
        # the steps would multiply.
        decoded = raw.select(*[_as_utf8(ref(c)).alias(n) for c, n in zip(header, names)], *origin)
    present = decoded.select(*[blank_to_null(ref(n), na_tokens).alias(n) for n in names], *kept)

    def typed(name: str) -> Column:
        if name == "date":
            return parse_date(ref(name), T.StringType(), date_formats)
        return strip(ref(name))

    return present.select(*[typed(n).alias(n) for n in names], *kept)


def _parsed_records(spark: SparkSession, path: str | list[str], names: list[str], source_file: bool) -> DataFrame:
    """The fields of records that may go over lines, under their names."""
    places = [f"c{i}" for i in range(len(names))]
    text = F.when(F.is_valid_utf8("record"), F.col("record")).otherwise(F.raise_error(F.lit(C.MSG_NOT_UTF8)))
    options = {"escape": '"', "columnNameOfCorruptRecord": "odd"}
    fields = F.from_csv(text, ", ".join(f"{p} string" for p in (*places, "odd")), options)
    origin = [file_name(F.element_at(F.split("file", "/"), -1)).alias("source_file")] if source_file else []
    raw = records.csv_records(spark, path).filter(~F.col("first")).select(fields.alias("f"), *origin)
    whole = raw.filter(_is_whole(F.col("f.odd"), F.col("f.c0"), len(names), False))
    return whole.select(*[F.col(f"f.{p}").alias(n) for p, n in zip(places, names)], *(["source_file"] if source_file else []))


def file_name(name: Column) -> Column:
    """The name of a file as it was given, from the percent-encoded form in which Spark reports it."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _is_whole(odd_line: Column, first_field: Column, fields: int, multi_line: bool) -> Column:
    """TRUE, or a failure for a line with too many fields or an open quote. Spark hands over lines whose number of fields is odd.

    A filter is never pruned away. It reads the first column too, as Spark refuses to read the odd lines alone.
    """
    line = F.concat(odd_line, F.left(F.coalesce(first_field, F.lit("")), F.lit(0)))
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    stop = F.when(F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= fields, F.raise_error(F.lit(C.MSG_TOO_MANY_FIELDS)).cast("boolean"))
    if not multi_line:
        stop = F.when(bare.contains('"'), F.raise_error(F.lit(C.MSG_OPEN_QUOTE)).cast("boolean")).otherwise(stop)
    return F.when(line.isNull(), True).otherwise(F.coalesce(stop, F.lit(True)))


def _header_name(name: str) -> str:
    try:
        return name.encode(_BYTES).decode("utf-8").strip().lower()
    except UnicodeDecodeError as error:
        raise ValueError(C.MSG_NOT_UTF8) from error


def _as_utf8(value: Column) -> Column:
    """Decode the bytes a scan passed through. Plain ASCII, where bytes and characters agree, is done already."""
    text = F.encode(value, _BYTES).cast("string")
    return (
        F.when(F.octet_length(value) == F.length(value), value)
        .when(F.is_valid_utf8(text), text)
        .when(value.isNotNull(), F.raise_error(F.lit(C.MSG_NOT_UTF8)))
    )
