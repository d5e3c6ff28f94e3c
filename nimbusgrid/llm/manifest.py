"""Merkle dataset manifest: leaf positions by bitmap rank, levels by keyed slots.

``H`` is lowercase hex SHA-256 of its inputs put together.  A row's *leaf* is H of its fields, each
``-`` if null, else ``length:value``.  The rows of a group (a language) form one tree: leaves ascend by
id, and every ``FAN`` consecutive nodes become their H until one is left, the group's *subroot*.  The
subroots, ordered by group (null first, bytewise), form the last tree, whose top is the *root*.

* Positions come from bitmaps, not from a sort.  A group's bitmap of ids is kept compressed: only words
  of 64 ids with a bit set, keyed by (group, word).  Tasks set bits for their own rows and the words
  are merged by OR.  A popcount directory counts rows before every word, over blocks of 1,024 words,
  blocks of 1,024 blocks and so on, so no window sees more than 1,024 rows however ids are spread.
  The rank of an id is its word's count plus the bits below its own.
* A node at position ``p`` goes to slot ``p mod FAN`` of run ``p / FAN``; a run is one row with FAN slots.
* Paths go down run by run: a run's path is its slot's neighbours in the run above and that run's path.
  Leaves read theirs from their own run's row, so no leaf travels with its path.

Rows that repeat an id stand next to one another, by leaf: the same rank again, over the leaf's first
60 bits in a group made of that id.  Equal rows are counted and take consecutive positions.  Null ids
come first.  Null fields, empty and very long texts are values like any other; columns other than the
five are not read.  An empty table has no root and no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.llm.common import keep, sql_crc32, table
from nimbusgrid.llm.registry import query
from nimbusgrid.operators.ranking import running_totals

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Bits of a word number that one block of the directory spans.
_BLOCK = 10
#: Equal rows that one task puts in place.
_COPIES = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tampered() -> Column:
    """Whether the check of the manifest alters this row."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(g, id, leaf, altered, m): distinct leaves of every group, how often each occurs, and the leaf
    after tampering where that applies.  ``g`` orders as the group does, with null as ''."""
    altered = F.translate("text", _UPPER, _LOWER)
    rows = docs.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"), F.col("doc_id").cast("long").alias("id"),
        digest(*[field(F.col(c)) for c in FIELDS]).alias("leaf"),
        F.when(tampered(), digest(*[field(altered if c == "text" else F.col(c)) for c in FIELDS])).alias("altered"))
    return rows.groupBy("g", "id", "leaf").agg(F.first("altered").alias("altered"), F.count("*").alias("m"))


def bitmaps(rows: DataFrame, group: str, number: str) -> DataFrame:
    """(group, word, bits, n, more): the words of every group's bitmap of ``number``, the rows they
    stand for (``m`` each) and, for numbers of several rows, the rows beyond one by bit."""
    counted = rows.groupBy(group, number).agg(F.sum("m").alias("m")).select(
        group, F.shiftright(number, 6).alias("word"), F.col(number).bitwiseAND(F.lit(63)).cast("int").alias("bit"), "m")
    return counted.groupBy(group, "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum("m").alias("n"),
        F.collect_list(F.when(F.col("m") > 1, F.struct("bit", (F.col("m") - 1).alias("n")))).alias("more"))


def directory(words: DataFrame, group: str) -> DataFrame:
    """``words`` with ``before``, the rows of the group in earlier words."""
    low, high = words.agg(F.min("word"), F.max("word")).first()
    if low is None:
        return words.withColumn("before", F.lit(0).cast("long"))
    shift, level, levels = 0, words.select(group, F.col("word").alias("at"), "n"), []
    while True:
        top = (high >> shift) - (low >> shift) < 1 << _BLOCK
        over = Window.partitionBy(group, *([] if top else [F.shiftright("at", _BLOCK)])).orderBy("at")
        levels.append((shift, level.select(group, "at", F.coalesce(
            F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"before{shift}"))))
        if top:
            break
        level = level.groupBy(group, F.shiftright("at", _BLOCK).alias("at")).agg(F.sum("n").alias("n"))
        shift += _BLOCK
    out = words
    for shift, counts in levels:
        out = out.withColumn("at", F.shiftright("word", shift)).join(counts, [group, "at"]).drop("at")
    total = sum((F.col(f"before{s}") for s, _ in levels[1:]), F.col("before0"))
    return out.withColumn("before", total).drop(*[f"before{s}" for s, _ in levels])


def ranked(rows: DataFrame, group: str, number: str, out: str) -> DataFrame:
    """``rows`` (with ``m``) with ``out``: the rows of the group with a smaller number."""
    words, _ = keep(bitmaps(rows, group, number), "bitmaps")
    index, _ = keep(directory(words, group).drop("n"), "ranks")
    bit = F.col(number).bitwiseAND(F.lit(63)).cast("int")
    placed = rows.withColumn("word", F.shiftright(number, 6)).withColumn("bit", bit).join(index, [group, "word"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))").cast("long")
    more = F.expr("aggregate(filter(more, x -> x.bit < bit), 0L, (a, x) -> a + x.n)")
    return placed.withColumn(out, F.col("before") + below + more).drop("word", "bit", "bits", "more", "before")


def positions(found: DataFrame) -> DataFrame:
    """(g, n, at, id, leaf, altered): every row's position ``at`` among the ``n`` of its group."""
    sizes = found.groupBy("g").agg(F.sum("m").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("m"))), F.lit(0)).alias("nulls"))
    known = found.where("id is not null")
    several = found.groupBy("g", "id").agg(F.count("*").alias("kinds")).where("kinds > 1")
    several, _ = keep(several, "several")
    placed = ranked(known, "g", "id", "rank").unionByName(found.where("id is null").withColumn("rank", F.lit(0).cast("long")))
    if several.take(1):
        shown = F.concat_ws("\x00", "g", F.coalesce(F.col("id").cast("string"), F.lit("-"))).alias("one")
        inner = found.join(several.select(F.col("g").alias("_g"), F.col("id").alias("_id")),
                           (F.col("g") == F.col("_g")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi").select(
            shown, "leaf", "m", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long").alias("number"))
        inner = ranked(inner, "one", "number", "further").select("one", "leaf", "further")
        placed = placed.select("*", shown).join(inner, ["one", "leaf"], "left").withColumn(
            "rank", F.col("rank") + F.coalesce("further", F.lit(0))).drop("one", "further")
    placed = placed.join(sizes, "g").withColumn("rank", F.col("rank") + F.when(F.col("id").isNull(), 0).otherwise(F.col("nulls")))
    copies = lambda first, last: F.explode(F.sequence(first, last)).alias("copy")
    few = placed.where(F.col("m") <= _COPIES).select("*", copies(F.lit(0).cast("long"), F.col("m") - 1))
    most = found.agg(F.max("m")).first()[0] or 0
    if most > _COPIES:
        chunk = F.col("chunk") * _COPIES
        many = placed.where(F.col("m") > _COPIES).select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / _COPIES))).alias("chunk"))
        many = many.repartition("g", "id", "leaf", "chunk").select("*", copies(chunk, F.least(chunk + _COPIES, F.col("m")) - 1)).drop("chunk")
        few = few.unionByName(many)
    return few.select("g", "n", (F.col("rank") + F.col("copy")).alias("at"), "id", "leaf", "altered")


def _slots(value: Column) -> Column:
    return F.array(*[F.max(F.when(F.col("at").bitwiseAND(F.lit(FAN - 1)) == i, value)) for i in range(FAN)])


@dataclass(frozen=True)
class Tree:
    """Runs by level, (g, n, run, slots, and for leaves the slots' ids and altered leaves), and tops (g, top)."""

    levels: list[DataFrame]
    tops: DataFrame


def reduced(nodes: DataFrame, most: int, carried: Sequence[str] = ()) -> Tree:
    """Reduce (g, n, at, h): each level's nodes meet in the slots of their run.

    ``most`` is the size of the largest group; ``carried`` columns are kept beside the lowest slots.
    """
    levels, tops = [], nodes.where("n = 1").select("g", F.col("h").alias("top"))
    while most > 1:
        runs = nodes.where("n > 1").groupBy("g", "n", F.shiftright("at", 3).alias("run")).agg(
            _slots(F.col("h")).alias("slots"), *([] if levels else [_slots(F.col(c)).alias(c) for c in carried]))
        runs, _ = keep(runs, f"level-{len(levels)}")
        levels.append(runs)
        nodes = runs.select("g", F.ceil(F.col("n") / FAN).alias("n"), F.col("run").alias("at"), digest(F.concat_ws("", "slots")).alias("h"))
        tops = tops.unionByName(nodes.where("n = 1").select("g", F.col("h").alias("top")))
        most = -(-most // FAN)
    tops, _ = keep(tops, "tops")
    return Tree(levels, tops)


def step(slots: str, slot: Column) -> Column:
    """The siblings to the left and to the right of a slot."""
    slot = slot.cast("int")
    return F.struct(F.array_join(F.slice(F.col(slots), F.lit(1), slot), "").alias("left"),
                    F.array_join(F.slice(F.col(slots), slot + 2, F.lit(FAN)), "").alias("right"))


_PATH = "array<struct<left:string,right:string>>"


def placed_runs(tree: Tree, above: DataFrame) -> DataFrame | None:
    """The lowest runs with ``path``, the steps from the run's own node to the root.

    ``above``: (g, path) of every group's top.
    """
    upper = None
    for runs in reversed(tree.levels):
        here = runs.where(F.col("n") <= FAN).join(above, "g")
        if upper is not None:
            over = upper.select(F.col("g"), F.col("run").alias("over"), F.col("slots").alias("_slots"), F.col("path").alias("_path"))
            below = runs.where(F.col("n") > FAN).withColumn("over", F.shiftright("run", 3)).join(over, ["g", "over"]).withColumn(
                "path", F.concat(F.array(step("_slots", F.col("run").bitwiseAND(F.lit(FAN - 1)))), F.col("_path"))).drop("over", "_slots", "_path")
            here = here.unionByName(below)
        upper = here
    return upper


@dataclass(frozen=True)
class Manifest:
    nodes: DataFrame
    groups: Tree
    top: Tree
    root: str | None


def build(docs: DataFrame) -> Manifest:
    """The manifest's trees, every level written to the shared folder."""
    found, _ = keep(leaves(docs), "leaves")
    nodes, _ = keep(positions(found), "nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    groups = reduced(nodes.withColumnRenamed("leaf", "h"), most, ("id", "altered"))
    order = running_totals(groups.tops.select("g", "top", F.lit(1).cast("long").alias("one")), "g", ["one"])
    subroots, _ = keep(order.select(F.lit("").alias("g"), F.col("one_all").alias("n"), F.col("one_before").alias("at"),
                                    F.col("top").alias("h"), F.col("g").alias("of")), "subroots")
    size = subroots.agg(F.max("n")).first()[0] or 0
    top = reduced(subroots, size, ("of",))
    root = top.tops.first()
    return Manifest(nodes, groups, top, root.top if root else None)


def proofs(manifest: Manifest) -> DataFrame:
    """(id, g, leaf, altered, subroot, path) per row; ``path`` are its steps from leaf to root."""
    spark = manifest.nodes.sparkSession
    empty = spark.createDataFrame([("", [])], f"g string, path {_PATH}")
    if manifest.top.levels:
        last = placed_runs(manifest.top, empty).select("slots", "path", F.posexplode("of").alias("slot", "of")).where("of is not null")
        above = last.select(F.col("of").alias("g"), F.concat(F.array(step("slots", F.col("slot"))), F.col("path")).alias("path"))
    else:
        above = manifest.groups.tops.select("g", F.lit(None).cast(_PATH).alias("path")).withColumn("path", F.coalesce("path", F.array().cast(_PATH)))
    above, _ = keep(above, "above")
    tops = manifest.groups.tops.withColumnRenamed("top", "subroot")
    rows = manifest.nodes.where("n = 1").join(above, "g").select("g", "id", "leaf", "altered", "path")
    lowest = placed_runs(manifest.groups, above)
    if lowest is not None:
        each = lowest.select("g", "id", "altered", "slots", "path", F.posexplode("slots").alias("slot", "leaf")).where("leaf is not null")
        rows = rows.unionByName(each.select(
            "g", F.get("id", F.col("slot")).alias("id"), "leaf", F.get("altered", F.col("slot")).alias("altered"),
            F.concat(F.array(step("slots", F.col("slot"))), F.col("path")).alias("path")))
    return rows.join(tops, "g")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


_SQL = """
with recursive rows as (
  select doc_id, coalesce('=' || lang, '') as g,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
    CRC_OF_ID % 3 = 0 as hit
  from documents),
leaves as (
  select doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when hit then sha256(head || coalesce(strlen(low) || ':' || low, '-')) end as altered from rows),
nodes as (
  select doc_id, g, leaf, altered, count(*) over (partition by g) as n,
    row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos from leaves),
tree as (
  select 0 as level, g, n, pos, leaf as h from nodes
  union all
  (select level + 1, g, any_value((n + 7) // 8), pos // 8, sha256(string_agg(h, '' order by pos)) from tree
   where n > 1 group by level, g, pos // 8)),
subs as (select g, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from tree where n = 1),
upper_tree as (
  select 0 as level, n, pos, h from subs
  union all
  (select level + 1, any_value((n + 7) // 8), pos // 8, sha256(string_agg(h, '' order by pos)) from upper_tree
   where n > 1 group by level, pos // 8)),
steps as (
  select t.level, t.g, t.pos, coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos < t.pos), '') as l,
    coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos > t.pos), '') as r
  from tree t join tree o on t.level = o.level and t.g = o.g and t.pos // 8 = o.pos // 8 where t.n > 1 group by all),
upper_steps as (
  select t.level, t.pos, coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos < t.pos), '') as l,
    coalesce(string_agg(o.h, '' order by o.pos) filter (o.pos > t.pos), '') as r
  from upper_tree t join upper_tree o on t.level = o.level and t.pos // 8 = o.pos // 8 where t.n > 1 group by all),
upper_walk as (
  select g, 0 as level, pos, n, '' as sibs, []::struct(l varchar, r varchar)[] as path from subs
  union all
  select w.g, w.level + 1, w.pos // 8, (w.n + 7) // 8, sibs || s.l || s.r, list_append(path, {l: s.l, r: s.r})
  from upper_walk w join upper_steps s on w.level = s.level and w.pos = s.pos where w.n > 1),
walk as (
  select doc_id, g, leaf, altered, 0 as level, pos, n, '' as sibs, []::struct(l varchar, r varchar)[] as path from nodes
  union all
  select w.doc_id, w.g, w.leaf, w.altered, w.level + 1, w.pos // 8, (w.n + 7) // 8, sibs || s.l || s.r, list_append(path, {l: s.l, r: s.r})
  from walk w join steps s on w.level = s.level and w.g = s.g and w.pos = s.pos where w.n > 1),
whole as (
  select w.doc_id, w.leaf, coalesce(w.altered, w.leaf) as now, s.h as subroot, (select h from upper_tree where n = 1) as root,
    w.sibs || u.sibs as sibs, list_concat(w.path, u.path) as path
  from walk w join upper_walk u on u.g = w.g and u.n = 1 join subs s on s.g = w.g where w.n = 1),
ended as (
  select doc_id, leaf, subroot, root, sha256(sibs) as proof_sha256,
    list_reduce(list_prepend({l: now, r: ''}, path), lambda a, s: {l: sha256(s.l || a.l || s.r), r: ''}).l as folded_root from whole)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from ended
""".replace("CRC_OF_ID", sql_crc32("doc_id"))


@query(_SQL)
def op11_manifest(spark: SparkSession, sf: str) -> DataFrame:
    manifest = build(table(spark, sf, "documents", *FIELDS))
    rows = proofs(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
