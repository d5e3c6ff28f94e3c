"""Raw record files in one pass: accepted records, rejects by reason and skipped files together.

One scan classifies every document and every record of it, one job writes them, partitioned by
``outcome``, and metrics observed while they are written say how many there were, so the guard
against empty input costs no second job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import locale_number, no_nan, parse_date

ACCEPTED, REJECTED, SKIPPED = "accepted", "rejected", "skipped"


@dataclass(frozen=True)
class Intake:
    """What a pass saw, and where it is written."""

    path: str
    accepted: int
    rejected: int
    skipped: int

    def records(self, spark: SparkSession) -> DataFrame:
        """The accepted records, typed."""
        return spark.read.parquet(self.path).where(F.col("outcome") == ACCEPTED).select(*k.RECORD_FIELDS)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """(file, outcome, reason, records, example): what was not taken in, by file and reason.

        A skipped file counts as one; ``example`` is the least rejected record of its reason.
        """
        left = spark.read.parquet(self.path).where(F.col("outcome") != ACCEPTED)
        return left.groupBy("file", "outcome", "reason").agg(F.count("*").alias("records"), F.min("raw").alias("example"))


def _document_fault(name: Column, text: Column, parsed: Column) -> Column:
    return (F.when(name.startswith("part_"), "partial batch")
            .when(~text.rlike(r"^\s*\["), "not a list")
            .when(parsed.isNull(), "unreadable")
            .when(F.size(parsed) == 0, "no records"))


def _record_fault(record: Column, start: str) -> Column:
    missing = F.lit(False)
    for name in k.ID_FIELDS[1:]:
        missing = missing | record[name].isNull()
    day = parse_date(record["fecha"])
    return (F.when(day.isNull(), "date").when(missing, "identity")
            .when(day < F.lit(start).cast("date"), "before start"))


def classified(spark: SparkSession, path: str, *, start: str = k.START_DATE, pattern: str = "*.json") -> DataFrame:
    """Every record, and every document without any, with ``outcome``, ``reason``, ``file`` and ``raw``.

    A record with several faults has the first of: date, identity, before start.
    """
    fields = ", ".join(f"{c}: string" for c in k.RECORD_FIELDS)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), "value",
        F.from_json("value", f"array<struct<{fields}>>").alias("parsed"))
    fault = _document_fault(F.col("name"), F.col("value"), F.col("parsed"))
    records = files.withColumn("fault", fault).select(
        "file", "fault", F.explode_outer(F.when(F.col("fault").isNull(), F.col("parsed"))).alias("record"))
    judged = records.withColumn("reason", F.coalesce("fault", _record_fault(F.col("record"), start)))
    outcome = F.when(F.col("fault").isNotNull(), SKIPPED).when(F.col("reason").isNotNull(), REJECTED).otherwise(ACCEPTED)
    taken = F.col("reason").isNull()

    def typed(name: str) -> Column:
        text = F.col("record")[name]
        value = parse_date(text) if name == "fecha" else no_nan(locale_number(text)) if name in k.NUMBER_FIELDS else text
        return F.when(taken, value).alias(name)

    return judged.select(*[typed(c) for c in k.RECORD_FIELDS], "file", "reason",
                         F.when(~taken, F.to_json("record")).alias("raw"), outcome.alias("outcome"))


def take_in(spark: SparkSession, path: str, out: str, *, start: str = k.START_DATE, pattern: str = "*.json",
            require: bool = True) -> Intake:
    """Classify the documents below ``path`` and write them to ``out`` in one job.

    Without a single accepted record this raises ``ValueError`` unless ``require`` is off; what
    was rejected and skipped is written all the same.
    """
    seen = Observation()
    rows = classified(spark, path, start=start, pattern=pattern).observe(seen, *[
        F.count_if(F.col("outcome") == o).alias(o) for o in (ACCEPTED, REJECTED, SKIPPED)])
    rows.write.mode("overwrite").partitionBy("outcome").parquet(out)
    result = Intake(out, *(seen.get[o] for o in (ACCEPTED, REJECTED, SKIPPED)))
    if require and not result.accepted:
        raise ValueError(f"no valid records found in the raw data: {result.rejected} rejected, {result.skipped} files skipped")
    return result
