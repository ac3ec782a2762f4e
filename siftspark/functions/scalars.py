"""Scalar functions that have no single built-in."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def strip_ansi(line: Column) -> Column:
    return F.regexp_replace(line, "\\x1B\\[[0-9;?]*[A-Za-z]", "")


def percent_of(line: Column) -> Column:
    """The percentage at the start of a progress line such as ``12% 34:567=8s``; null for other lines."""
    return F.nullif(F.regexp_extract(line, "^\\s*(\\d{1,3})%\\s+\\d+:\\d+=", 1), F.lit("")).cast("int")


def batch_size_of(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, "[Bb]atch(?: \\d+)? size:?\\s*(\\d+)", 1), F.lit("")).cast("int")


def safe_name(text: Column) -> Column:
    return F.translate(text, "/ ", "__")


def one_hot(index: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (i == index).cast("int"))


def char_codes(text: Column, alphabet: str, length: int) -> Column:
    """Characters as positions in the alphabet from 1 (0 for others), padded with 0 and scaled by the alphabet's size."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    letters = F.array(*[F.lit(c) for c in alphabet])
    codes = F.transform(F.slice(chars, 1, length), lambda c: F.coalesce(F.array_position(letters, c), F.lit(0)).cast("double") / len(alphabet))
    return F.concat(codes, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), length - F.size(codes))))


def flip(label: Column) -> Column:
    return label.bitwiseXOR(F.lit(1))


def grouped(number: Column, places: int = 0) -> Column:
    return F.format_number(number, places)


def base_name(path: Column, suffix: str = "") -> Column:
    """The last part of a path, without a suffix, or without what follows its last dot."""
    name = F.substring_index(path, "/", -1)
    if suffix:
        return F.when(F.endswith(name, F.lit(suffix)), F.left(name, F.length(name) - len(suffix))).otherwise(name)
    return F.regexp_replace(name, r"(?<=.)\\.[^.]*$", "")


def stamp(ts: Column) -> Column:
    """A time as YYYY-MM-DD HH:MM:SS."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def elapsed(start: Column, end: Column) -> Column:
    """Whole seconds between two times."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def repeat_rows(n: Column) -> Column:
    """For explode: as many entries as a row should have copies."""
    return F.sequence(F.lit(1), n)


def register(spark: SparkSession) -> None:
    """Temporary SQL functions with the same meaning."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION bit_tanimoto(a BIGINT, b BIGINT) RETURNS DOUBLE RETURN CASE WHEN (a | b) = 0 THEN 0.0D ELSE CAST(bit_count(a & b) AS DOUBLE) / bit_count(a | b) END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION min_max(x DOUBLE, lo DOUBLE, hi DOUBLE) RETURNS DOUBLE RETURN CASE WHEN hi = lo THEN 1.0D ELSE (x - lo) / (hi - lo) END")
