"""Mixing sources to target weights by Pareto order sampling.

Sizes are words.  Sources, by code point with null last, have weights that repeat; the targets
share ``total`` by weight, none above ``cap`` times its source, the excess reshared by weight.
A source's documents are each due ``d = target / size of the source`` copies on average: the whole
part is certain, and the rest is spread over inclusion probabilities ``p`` of one more that grow
with a document's size: ``p = d (1 + TILT (1 - d) (x - m) / top)``, where ``x`` is the number of
binary digits of the size, ``m`` its mean over the source's words and ``top`` its largest.  All
``p`` lie between 0 and 1, and the words they select add up to those due.  For that one more,
documents are ranked by their Pareto variable, the random odds ``u / (1 - u)`` over the inclusion
odds ``p / (1 - p)``, and taken in this order while the words left allow; the place that remains
goes to the document whose size is nearest to what is left.  ``u`` is a hash of id and text, so
reruns agree.

Rows alike in id, source and text share a rank.  Only the group in which the words run out, and
the one of the last place, are taken in part, by numbering their rows; all others go as a whole.

The order is never sorted as a whole: ranks are cut into bins whose words are summed map-side,
and only the bin in which a source's words run out is ordered, by groups of rows alike.  Bins grow
with the input, so a source, or an id, with a third of all rows costs no task more than a bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.llm.common import WORD, discard, keep, table, uniform
from nimbusgrid.llm.registry import query

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
BIN_ROWS = 4096
#: How far inclusion probabilities depend on size: 0 not at all, 1/2 keeps every one below 1.
TILT = 0.5
#: The order within a source.
KEY = ("q", "id", "digest", "size")


def words(text_col: str = "text"):
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, filled up to the caps.

    In ascending order of cap over weight, a source is capped if its share of what the sources
    before it leave exceeds its cap; the first that is not sets the level of all that follow.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    array = F.array(*[F.lit(w) for w in weights])
    w = sources.withColumn("weight", F.element_at(array, ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    w = w.withColumn("level", level).withColumn("capped", F.col("weight") * F.col("level") > F.col("cap"))
    final = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(F.col("weight") * final).alias("target"))


def digits(size: Column) -> Column:
    return F.length(F.bin(size))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the certain copies and the Pareto variable, null where no more can be due."""
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"])).drop("plan_source")
    joined = joined.withColumn("certain", F.floor(due)).withColumn("d", due - F.floor(due))
    tilted = F.col("d") * (1 + TILT * (1 - F.col("d")) * (digits(F.col("size")) - F.col("moment") / F.col("source_size")) / F.col("top"))
    joined = joined.withColumn("p", F.when((F.col("d") > 0) & (F.col("size") > 0), tilted))
    return joined.withColumn("q", (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))).drop("d", "p")


def _plan(goals: DataFrame) -> DataFrame:
    return goals.withColumnRenamed("source", "plan_source")


def cuts(rows: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: what its order needs, and where its documents stop.

    ``rows``: (id, source, size, digest, u).  Groups before ``part`` are taken as a whole, and of
    ``part`` (null: all are) the first ``some`` rows; ``last`` gives one more row (null: none).
    """
    spark = rows.sparkSession
    sizes, sized = keep(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * digits(F.col("size"))).alias("moment"),
        F.max(digits(F.col("size"))).alias("top")), "source-sizes")
    goals = targets(sizes.select("source", "source_size"), weights, cap).select(F.col("source").alias("goal_source"), "target")
    per_source, kept = keep(sizes.join(goals, sizes["source"].eqNullSafe(goals["goal_source"])).drop("goal_source"), "targets")
    bins = max(64, rows.count() // BIN_ROWS)
    ranked = _ranked(rows, _plan(per_source)).where("q is not null").withColumn(
        "bin", F.floor(F.col("q") / (1 + F.col("q")) * bins)).withColumn(
        "left", F.col("target") - F.col("certain") * F.col("source_size"))
    sums = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    upto = Window.partitionBy("source").orderBy("bin")
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    # the bin in which the words run out, or the last one
    edge = sums.where("before <= left").groupBy("source").agg(F.max_by(F.struct("bin", "before"), "bin").alias("e")).select(
        F.col("source").alias("edge_source"), "e.bin", F.col("e.before").alias("before"))
    inside = ranked.join(edge, ranked["source"].eqNullSafe(edge["edge_source"]) & (ranked["bin"] == edge["bin"])).groupBy(
        "source", *KEY).agg(F.sum("size").alias("words"), F.first("left").alias("left"), F.first("before").alias("before"))
    order = Window.partitionBy("source").orderBy(*KEY)
    inside = inside.withColumn("sum", F.col("before") + F.sum("words").over(order))
    beyond = F.when(F.col("sum") > F.col("left"), F.struct(*KEY))
    gap = F.first("left") - F.coalesce(F.max(F.when(F.col("sum") <= F.col("left"), F.col("sum"))), F.first("before"))
    stop = inside.groupBy("source").agg(F.min(beyond).alias("part"), gap.alias("gap")).withColumn(
        "some", F.when(F.col("part").isNotNull(), F.floor(F.col("gap") / F.col("part.size"))))
    stop, stopped = keep(stop.select(F.col("source").alias("stop_source"), "part", "some", (
        F.col("gap") - F.coalesce(F.col("some") * F.col("part.size"), F.lit(0))).alias("gap")), "stops")
    miss = F.abs(F.col("size") - F.col("gap"))
    last = ranked.join(stop, ranked["source"].eqNullSafe(stop["stop_source"])).where(
        (F.struct(*KEY) >= F.col("part")) & (miss < F.col("gap"))).groupBy("source").agg(
        F.min(F.struct(miss.alias("miss"), *KEY)).alias("m")).select(
        F.col("source").alias("last_source"), F.struct(*[f"m.{c}" for c in KEY]).alias("last"))
    out = per_source.join(stop.drop("gap"), per_source["source"].eqNullSafe(stop["stop_source"]), "left").join(
        last, per_source["source"].eqNullSafe(last["last_source"]), "left").drop("stop_source", "last_source")
    result, _ = keep(out, "cuts")
    discard(spark, sized, kept, stopped)
    return result


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``number`` of each among those alike, from 1.

    Rows are numbered within an input partition and follow those of the partitions before, so a
    group of any size is spread over as many tasks as it came from.
    """
    keys = ["source", *KEY]
    # written, as both sides below must see the same places
    placed, _ = keep(rows.withColumns({"_piece": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "alike")
    own = placed.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy("_at")))
    sums = placed.groupBy(*keys, "_piece").agg(F.count("*").alias("_rows"))
    sums = sums.withColumn("_before", F.sum("_rows").over(Window.partitionBy(*keys).orderBy("_piece")) - F.col("_rows"))
    same = F.lit(True)
    for c in (*keys, "_piece"):
        same = same & own[c].eqNullSafe(F.col(f"s.{c}"))
    return own.join(sums.alias("s"), same).select(
        *[own[c] for c in rows.columns], (own["_own"] + F.col("s._before")).alias("number"))


def copies(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` (id, source, size, digest, u, ...) with source_size, target and the number of copies."""
    key = F.struct(*KEY)
    at_part, at_last = F.coalesce(key == F.col("part"), F.lit(False)), F.coalesce(key == F.col("last"), F.lit(False))
    ranked = _ranked(rows, _plan(cut))
    whole = F.col("q").isNotNull() & (F.col("part").isNull() | (key < F.col("part")))
    rest = ranked.where(~(at_part | at_last)).withColumn("copies", F.col("certain") + F.coalesce(whole, F.lit(False)).cast("int"))
    # at most two groups of a source are taken in part
    some = F.when(at_part, F.col("some")).otherwise(0) + at_last.cast("int")
    shared = _numbered(ranked.where(at_part | at_last)).withColumn(
        "copies", F.col("certain") + (F.col("number") <= some).cast("int")).drop("number")
    return rest.unionByName(shared).drop("certain", "q", "moment", "top", "part", "some", "last")


def _measures(id_col: str, text_col: str, source_col: str, seed: str) -> list[Column]:
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return [F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(text_col).alias("size"), digest.alias("digest"),
            uniform(F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest, seed=seed).alias("u")]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(id, source, size, digest, u); a null id draws as the empty text."""
    return docs.select(*_measures(id_col, text_col, source_col, seed))


def mix(docs: DataFrame, *, weights=WEIGHTS, cap: int = CAP, **columns) -> DataFrame:
    """(id, source_size, target, size, copies) of every row of ``docs``.

    A null text has size 0 and only certain copies; null sources are one source, the last; rows
    that share an id are drawn by their texts, and rows alike are taken one by one where words run
    out; an empty table gives an empty result.
    """
    rows, path = keep(measured(docs, **columns), "sizes")
    return copies(rows, cuts(rows, weights, cap))


def mixed_documents(docs: DataFrame, *, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the columns of ``docs``."""
    spark, names = docs.sparkSession, docs.columns
    rows, path = keep(measured(docs), "sizes")
    cut = cuts(rows, weights, cap)
    discard(spark, path)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("document"), *_measures("doc_id", "text", "source", SEED))
    return copies(held, cut).where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("document.*")


ORACLE = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
             md5(coalesce(text, '')) AS h, length(bin(size)) AS x,
             (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size * x)::BIGINT AS moment, max(x) AS top FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
        3 * source_size AS cap FROM s),
l AS (SELECT *, cap::DOUBLE / weight AS ratio FROM w),
v AS (SELECT *, (sum(source_size) OVER ()
          - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER ()
          - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
      FROM l),
f AS (SELECT min_by(level, ratio) AS level FROM v WHERE NOT weight * level > cap),
t AS (SELECT source, source_size, moment, top, CASE WHEN weight * v.level > cap THEN cap::DOUBLE ELSE weight * f.level END AS target FROM v, f),
e AS (SELECT d.doc_id, d.source, size, h, x, u, source_size, moment, top, target,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS due
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, floor(due)::BIGINT AS certain, due - floor(due) AS f, row_number() OVER (PARTITION BY doc_id, source, h) AS number,
        f * (1 + {TILT}::DOUBLE * (1 - f) * (x - moment::DOUBLE / source_size) / top) AS p FROM e),
q AS (SELECT *, CASE WHEN f > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q,
        target - certain * source_size AS l FROM r),
c AS (SELECT source, q, doc_id, h, size, l, sum(sum(size)) OVER (PARTITION BY source ORDER BY q, doc_id, h) AS upto
      FROM q WHERE q IS NOT NULL GROUP BY source, q, doc_id, h, size, l),
g AS (SELECT source, max(l) - coalesce(max(CASE WHEN upto <= l THEN upto END), 0) AS gap,
        min(CASE WHEN upto > l THEN upto END) AS part, floor(gap / min_by(size, upto) FILTER (WHERE upto > l)) AS take,
        gap - coalesce(take * min_by(size, upto) FILTER (WHERE upto > l), 0) AS rest FROM c GROUP BY source),
o AS (SELECT c.source, min(row(abs(size - rest), q, doc_id, h)) AS pick FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
      WHERE upto > l AND abs(size - rest) < rest GROUP BY c.source),
y AS (SELECT c.doc_id, c.source, c.h, CASE WHEN upto <= l THEN 9223372036854775807 ELSE
        (CASE WHEN upto = part THEN take ELSE 0 END + CASE WHEN row(abs(size - rest), q, doc_id, h) = pick THEN 1 ELSE 0 END)::BIGINT END AS extra
      FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source LEFT JOIN o ON c.source IS NOT DISTINCT FROM o.source)
SELECT q.doc_id, q.size, q.source_size, q.target,
       (q.size * (q.certain + CASE WHEN q.number <= coalesce(y.extra, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q LEFT JOIN y ON q.doc_id IS NOT DISTINCT FROM y.doc_id AND q.source IS NOT DISTINCT FROM y.source AND q.h = y.h
"""


@query(ORACLE)
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    taken = mix(table(spark, sf, "documents", "doc_id", "text", "source"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"))
