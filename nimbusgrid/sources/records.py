"""Raw record files: scan, contract check, typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import locale_number, no_nan, parse_date

RAW_SCHEMA = ", ".join(f"{c} string" for c in k.RECORD_FIELDS)


def scan_record_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Records of every ``pattern`` document below ``path`` that is a list, as text columns.

    Partial batches (``part_*``), documents of another shape and unreadable files are skipped.
    A document holds a batch of records, so a whole file is a row of a few MB at most.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True,
                            pathGlobFilter=pattern)
    return (
        files.filter(~F.col("_metadata.file_name").startswith("part_"))
        .filter(F.col("value").rlike(r"^\s*\["))
        .select(F.inline(F.from_json("value", f"array<struct<{_fields()}>>")))
    )


def _fields() -> str:
    return ", ".join(f"{c}: string" for c in k.RECORD_FIELDS)


def scan_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records from line-delimited JSON (one object or one list per line); splittable."""
    return (spark.read.schema(RAW_SCHEMA).option("recursiveFileLookup", True).json(path))


def _contract() -> Column:
    """True where the date parses and the identity fields are present."""
    ok = parse_date(F.col("fecha")).isNotNull()
    for name in k.ID_FIELDS[1:]:
        ok = ok & F.col(name).isNotNull()
    return ok


def valid_records(raw: DataFrame, start: str = k.START_DATE,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Typed records that meet the contract, from ``start`` on; ``keep`` passes columns through."""
    typed = raw.filter(_contract()).select(*[
        parse_date(F.col(c)).alias(c) if c == "fecha"
        else no_nan(locale_number(F.col(c))).alias(c) if c in k.NUMBER_FIELDS
        else F.col(c)
        for c in (*k.RECORD_FIELDS, *keep)])
    return typed.filter(F.col("fecha") >= F.lit(start).cast("date"))


def rejected_records(raw: DataFrame) -> DataFrame:
    return raw.filter(~_contract())


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no valid records found in the raw data")
    return df
