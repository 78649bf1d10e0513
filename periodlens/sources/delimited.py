"""Delimited text files as all-text DataFrames with resolved columns."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.functions.text import normalize_header
from periodlens.session import pin

# File position of a row; together these follow the order of lines in a file.
FILE_ORDER = ("_file_path", "_block_start", "_line_order")
TOO_MANY_FIELDS = "_too_many_fields"
UNBALANCED_QUOTES = "_unbalanced_quotes"


def _field_count(line: Column, delimiter: str) -> Column:
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(delimiter), F.lit(""))) + 1


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Every line of the files with its place, and whether it has an odd number of quotes."""
    # The text source hands bytes on as they are, so they can be decoded here.
    line = F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.text(path).select(
        line.alias("_line"),
        (_quotes(line) % 2).alias("_odd"),
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_line_order"),
    )


def _slices(lines: DataFrame) -> DataFrame:
    """One row for each slice of a file: lines with odd quotes in it, whether it begins inside quotes, and the header."""
    filled = F.trim("_line") != ""
    counted = lines.groupBy("_file_path", "_block_start").agg(
        F.sum("_odd").alias("_odd_lines"),
        F.min(F.when(filled, F.struct("_line_order", "_line", "_odd"))).alias("_first"),
    )
    file = Window.partitionBy("_file_path").orderBy("_block_start")
    before = F.sum("_odd_lines").over(file.rowsBetween(Window.unboundedPreceding, -1))
    # The header is the first line that is not blank, in whichever slice it is.
    earlier = F.count("_first").over(file.rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.select(
        "_file_path",
        "_block_start",
        "_odd_lines",
        (F.coalesce(before, F.lit(0)) % 2).alias("_inside"),
        F.when(earlier == 0, F.col("_first")).alias("_header"),
    )
    return pin(placed, "slices")


def _header(slices: DataFrame, path: str, delimiter: str) -> list[str]:
    """The header that all files of ``path`` share."""
    found = (
        slices.where("_header IS NOT NULL")
        .groupBy("_header._line", "_header._odd")
        .agg(F.min("_file_path").alias("file"))
        .limit(1000)
        .collect()
    )
    if not found:
        raise ValueError(f"missing header row in {path}")
    headers: dict[tuple[str, ...], str] = {}
    for row in found:
        if row._odd:
            raise ValueError(f"unbalanced quotes in the header of {row.file}")
        names = next(csv.reader([row._line], delimiter=delimiter))
        headers.setdefault(tuple(normalize_header(name) for name in names), row.file)
    if len(headers) > 1:
        raise ValueError(f"differing headers in {path}: {sorted(headers.values())}")
    return list(next(iter(headers)))


def _records(lines: DataFrame, slices: DataFrame, max_lines: int) -> DataFrame:
    """Whole records as ``_line``, each under the place of its first line, and lines that belong to none.

    Whether a line begins inside quotes follows from the odd lines before it:
    those of earlier slices are summed up by slice, those of its own by a
    window. Only slices with an odd line, or inside quotes, take that way.
    """
    place = ["_file_path", "_block_start"]
    state = slices.select(
        *place, "_odd_lines", "_inside", F.coalesce("_header._line_order", F.lit(-1)).alias("_header_order")
    )
    placed = lines.join(state, place).where("_line_order <> _header_order").drop("_header_order")
    simple = (F.col("_odd_lines") == 0) & (F.col("_inside") == 0)
    plain = placed.where(simple).select("_line", F.lit(False).alias(UNBALANCED_QUOTES), *FILE_ORDER)
    if slices.where(~simple).isEmpty():
        return plain.where(F.trim("_line") != "")
    in_slice = Window.partitionBy(*place).orderBy("_line_order")
    odd_before = F.coalesce(F.sum("_odd").over(in_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = F.when((F.col("_inside") + odd_before) % 2 == 0, F.struct("_block_start", "_line_order"))
    begun = pin(
        placed.where(~simple).withColumn("_begins", begins).withColumn("_start", F.max("_begins").over(in_slice)), "quoted"
    )
    # A slice that begins inside quotes goes on with the last record begun in an earlier slice.
    file = Window.partitionBy("_file_path").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = begun.groupBy(*place).agg(F.max("_start").alias("_last")).select(
        *place, F.last("_last", ignorenulls=True).over(file).alias("_carried")
    )
    owned = begun.join(carried, place).select(
        "_line", "_odd", *FILE_ORDER, F.coalesce("_start", "_carried").alias("_record")
    )
    sizes = owned.groupBy("_file_path", "_record").agg(F.count("*").alias("_n"), F.sum("_odd").alias("_odds"))
    broken = (F.col("_odds") % 2 == 1) | (F.col("_n") > max_lines)
    judged = owned.join(sizes.select("_file_path", "_record", broken.alias("_broken")), ["_file_path", "_record"])
    parts = F.array_sort(F.collect_list(F.struct("_block_start", "_line_order", "_line")))
    whole = (
        judged.where("NOT _broken")
        .groupBy("_file_path", "_record")
        .agg(F.array_join(F.transform(parts, lambda part: part["_line"]), "\n").alias("_line"))
        .select("_line", F.lit(False).alias(UNBALANCED_QUOTES), "_file_path", "_record._block_start", "_record._line_order")
    )
    alone = judged.where("_broken").select("_line", F.lit(True).alias(UNBALANCED_QUOTES), *FILE_ORDER)
    return plain.unionByName(whole).unionByName(alone).where(F.trim("_line") != "")


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str = "|",
    encoding: str = "ISO-8859-1",
    max_lines: int = 1000,
) -> DataFrame:
    """Rows as text under normalised header names, plus their file position.

    Line breaks inside quotes belong to their field, wherever files are split:
    they come back as line feeds. Rows with too few fields are padded with
    NULL; rows with too many are marked in ``_too_many_fields``. Blank lines
    outside quotes are left out. Files of one folder must have equal headers,
    each on one line. Lines after a quote that nothing closes, or that closes
    only after ``max_lines`` lines, are rows of their own, marked in
    ``_unbalanced_quotes``; they are no data. Encodings are those in which line
    feeds and quotes are single ASCII bytes.
    """
    lines = _lines(spark, path, encoding)
    slices = _slices(lines)
    header = _header(slices, path, delimiter)
    width = len(header)
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
    schema = T.StructType([*fields, T.StructField("_malformed", T.StringType())])
    options = {"sep": delimiter, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_malformed"}
    kinds = schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    rows = _records(lines, slices, max_lines).select(
        F.from_csv("_line", kinds, options).alias("_row"), UNBALANCED_QUOTES, *FILE_ORDER
    )
    # The last of equally named columns counts, as in a row dictionary.
    position = {name: i for i, name in enumerate(header)}
    too_many = F.coalesce(_field_count(F.col("_row._malformed"), delimiter) > width, F.lit(False))
    return rows.select(
        *[F.col(f"_row.c{i}").alias(name) for name, i in position.items()],
        too_many.alias(TOO_MANY_FIELDS),
        UNBALANCED_QUOTES,
        *FILE_ORDER,
    )


def data_columns(df: DataFrame) -> list[str]:
    """Columns that came from the file."""
    return [name for name in df.columns if not name.startswith("_")]


def resolve(df: DataFrame, candidates: Iterable[str]) -> Column:
    """The first candidate the header holds, even if blank; else NULL."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def require_columns(df: DataFrame, required: Iterable[str], candidates: Mapping[str, Sequence[str]]) -> None:
    """Raise unless the header holds a candidate of every required field."""
    missing = [f for f in required if not any(n in df.columns for n in candidates.get(f, (f,)))]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
