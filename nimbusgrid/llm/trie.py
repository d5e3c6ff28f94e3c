"""Conversation prefix trie: a Z-fast trie built in batches by Spark joins.

A conversation is a sequence of turns.  Its *prefix digests* P(0) ... P(L) chain 128-bit digests, so P(d)
stands for its first d turns.  Only branching and ending points are trie nodes: a node has the depth
``e`` of its *extent*, the depth ``p`` of its parent's, and its edge, the digests from p + 1 to e.  It is
found by hash at its *handle*, the prefix whose depth is the two-fattest number in (p, e] (the one
that the highest power of two divides).

* ``located``: all waiting sequences search at once.  Fat binary search probes the handle table at the
  two-fattest depth of what is left of (0, L]; a hit goes on below the node's extent, a miss above the
  depth probed, so a sequence of L turns takes log2(L) + 1 joins.  The last hit, or its child at the next
  digest, is the *exit node*, and comparing digests with its edge gives the depth of the exit.
* ``inserted``: a batch.  All exits on an edge split it, at as many depths as there are.  Where sequences
  leave at the same point with the same next turn, one of them (by hash) becomes a leaf with all its
  other turns on its edge, the others wait for the next batch.  Each batch settles, of every branch, whatever
  lies on one member's path, so the number of batches grows as the logarithm of the branch's size, not
  with its depth.  Equal sequences are one from the start.
* ``measured``: sums over subtrees by pointer doubling, log2(height) rounds whatever the shape.
* ``expanded``: every depth on an edge is a node of the plain trie, its figures derived from the edge's.

Turns are ordered by number (null first), turns of one number by digest.  Null role and text are empty
strings.  Rows without a conversation id take no part.  Repeated rows are repeated turns.  An empty
table has no nodes.  Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import discard, keep, map_arrow, sql_crc32, table
from nimbusgrid.llm.registry import query

#: Conversation ids whose text one row holds before they are hashed: a power of two.
_CHUNK = 12
_BYTES = 16
_ROOT = hashlib.md5(b"").digest()
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(c, turns): every conversation's (digest, bytes) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.struct(
            F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn"), mark.alias("digest"),
            F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.groupBy("c").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "c", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """(c, turns) with the first turns, as many as the id's checksum says, those of the family's first."""
    c = F.col("c")
    head = (F.crc32(c.cast("string").cast("binary")) % 9).cast("int")
    first = lists.select(F.col("c").alias("base"), F.col("turns").alias("lent"))
    both = lists.select("c", "turns", head.alias("head"), (c - c % 5).alias("base")).join(first, "base", "left")
    taken = F.coalesce(F.slice("lent", F.lit(1), F.col("head")), F.slice("turns", 1, 0))
    return both.select("c", F.concat(taken, F.slice("turns", F.col("head") + 1, F.size("turns"))).alias("turns"))


def _chains(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        ids, paths, sums = batch.column(0), [], []
        for turns in batch.column(1).to_pylist():
            path, total = [_ROOT], [0]
            for turn in turns:
                path.append(hashlib.md5(path[-1] + turn["digest"]).digest())
                total.append(total[-1] + turn["bytes"])
            paths.append(b"".join(path))
            sums.append(total)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) - 1 for s in sums], pa.int32()), pa.array(paths, pa.binary()), pa.array(sums, pa.list_(pa.int64()))],
            ["c", "size", "path", "sums"])


def sequences(lists: DataFrame) -> DataFrame:
    """(c, size, path, sums): prefix digests from depth 0 and the bytes of texts up to each."""
    return map_arrow(lists, _chains, "c long, size int, path binary, sums array<long>")


def _at(blob: str, depth: str, base: str = "0") -> Column:
    """The digest at a depth of a blob that starts at depth ``base``."""
    return F.expr(f"substring({blob}, cast({_BYTES} * ({depth} - ({base})) + 1 as int), {_BYTES})")


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    zeros = f"(length(bin({low} ^ {high})) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {zeros}), {zeros})")


def _indexed(nodes: DataFrame) -> DataFrame:
    """(up, ext, p, e, edge, sums) with each node's handle and the first digest of its edge."""
    fat = nodes.withColumn("fat", fattest("p", "e"))
    return fat.withColumn("handle", _at("edge", "fat", "p + 1")).withColumn("first", _at("edge", "p + 1", "p + 1"))


def _shared(node: str) -> str:
    """How deep a sequence follows a node's edge."""
    e, p, edge = (f"{node}.{x}" for x in ("e", "p", "edge"))
    return (f"{p} + size(filter(sequence({p} + 1, least({e}, size)), i -> substring(path, {_BYTES} * i + 1, {_BYTES}) "
            f"= substring({edge}, cast({_BYTES} * (i - {p} - 1) + 1 as int), {_BYTES})))")


def located(waiting: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``waiting`` with its exit: ``node`` (null at the root) and the depth ``d`` it follows the trie to."""
    handles = nodes.select(F.col("handle").alias("key"), F.col("ext").alias("hit"), F.col("e").alias("hit_e"))
    out = waiting.withColumn("low", F.lit(0)).withColumn("high", F.col("size")).withColumn("last", F.lit(None).cast("binary"))
    for _ in range(longest.bit_length()):
        out = out.withColumn("probe", F.when(F.col("low") < F.col("high"), fattest("low", "high")))
        out = out.withColumn("key", F.when(F.col("probe").isNotNull(), _at("path", "probe"))).join(handles, "key", "left")
        out = out.withColumn("last", F.coalesce("hit", "last")).withColumn(
            "high", F.when(F.col("probe").isNotNull() & F.col("hit").isNull(), F.col("probe") - 1).otherwise(F.col("high"))).withColumn(
            "low", F.coalesce("hit_e", "low")).drop("key", "probe", "hit", "hit_e")
    whole = F.struct("ext", "p", "e", "edge")
    by_ext = nodes.select(F.col("ext").alias("last"), whole.alias("node"))
    out = out.drop("low", "high").join(by_ext, "last", "left")
    out = out.withColumn("d", F.when(F.col("node").isNull(), 0).otherwise(F.expr(_shared("node"))))
    through = F.col("node").isNull() | (F.col("d") == F.col("node.e"))
    out = out.withColumn("next", F.when(through & (F.col("d") < F.col("size")), _at("path", "d + 1")))
    by_first = nodes.select(F.col("first").alias("next"), whole.alias("child"))
    out = out.join(by_first, "next", "left")
    return out.withColumn("d", F.when(F.col("child").isNull(), F.col("d")).otherwise(F.expr(_shared("child")))).withColumn(
        "node", F.coalesce("child", "node")).drop("child", "next", "last")


_NODE = "up binary, ext binary, p int, e int, edge binary, sums array<long>"


def inserted(found: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, waiting) after the batch ``found``, as :func:`located` gives it."""
    cuts = found.where("node is not null and d < node.e").groupBy(F.col("node.ext").alias("ext")).agg(
        F.array_sort(F.collect_set("d")).alias("cuts"))
    parts = nodes.join(cuts, "ext", "left").withColumn("cuts", F.concat(
        F.array("p"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("e"))).select(
        "up", "p", "edge", "sums", F.explode(F.arrays_zip(F.expr("slice(cuts, 1, size(cuts) - 1)").alias("a"), F.expr("slice(cuts, 2, size(cuts) - 1)").alias("b"))).alias("x"))
    parts = parts.select(
        F.when(F.col("x.a") == F.col("p"), F.col("up")).otherwise(_at("edge", "x.a", "p + 1")).alias("up"), _at("edge", "x.b", "p + 1").alias("ext"),
        F.col("x.a").alias("p"), F.col("x.b").alias("e"),
        F.expr(f"substring(edge, cast({_BYTES} * (x.a - p) + 1 as int), cast({_BYTES} * (x.b - x.a) as int))").alias("edge"),
        F.expr("slice(sums, x.a - p + 1, x.b - x.a + 1)").alias("sums"))
    beyond = found.where("d < size").withColumn("next", _at("path", "d + 1"))
    chosen = beyond.groupBy("next").agg(F.min(F.struct(F.xxhash64("sid"), F.col("sid"))).alias("x")).select(F.col("x.sid").alias("sid"))
    leaves = beyond.join(chosen, "sid", "left_semi").select(
        _at("path", "d").alias("up"), F.col("sid").alias("ext"), F.col("d").alias("p"), F.col("size").alias("e"),
        F.expr(f"substring(path, cast({_BYTES} * (d + 1) + 1 as int))").alias("edge"), F.expr("slice(sums, d + 1, size - d + 1)").alias("sums"))
    waiting = beyond.join(chosen, "sid", "left_anti").select("sid", "size", "path", "sums")
    return parts.unionByName(leaves), waiting


def build(distinct: DataFrame) -> DataFrame:
    """The trie of (sid, size, path, sums), without its root: up, ext, p, e, edge, sums, fat, handle, first."""
    spark = distinct.sparkSession
    waiting, path = keep(distinct.where("size > 0").select("sid", "size", "path", "sums"), "waiting")
    longest = waiting.agg(F.max("size")).first()[0]
    nodes = _indexed(spark.createDataFrame([], _NODE))
    paths = [path]
    while longest:
        found, found_path = keep(located(waiting, nodes, longest), "located")
        grown, waiting = inserted(found, nodes)
        nodes, nodes_path = keep(_indexed(grown), "trie")
        waiting, waiting_path = keep(waiting, "waiting")
        longest = waiting.agg(F.max("size")).first()[0]
        discard(spark, *paths, found_path)
        paths = [nodes_path, waiting_path]
    return nodes


def measured(nodes: DataFrame, distinct: DataFrame) -> DataFrame:
    """(ext, least, n, leaves, children, m, q, b) per node and the root, over its subtree: smallest id, members,
    childless nodes; children and own ends; sums over members of their bytes, over nodes of their edge's."""
    spark = nodes.sparkSession
    ends = distinct.select(F.col("sid").alias("ext"), "m", "least", F.element_at("sums", -1).alias("depth_bytes"))
    children = nodes.groupBy(F.col("up").alias("ext")).agg(F.count("*").alias("children"))
    root = spark.createDataFrame([(bytearray(_ROOT), None, 0)], "ext binary, up binary, b long")
    every = nodes.select("ext", "up", (F.element_at("sums", -1) - F.element_at("sums", 1)).alias("b")).unionByName(root)
    start = every.join(ends, "ext", "left").join(children, "ext", "left").select(
        "ext", F.col("up").alias("anc"), F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("children", F.lit(0)).alias("children"), "least",
        F.coalesce("m", F.lit(0)).alias("n"), F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        F.coalesce(F.col("m") * F.col("depth_bytes"), F.lit(0)).alias("q"), "b")
    current, path = keep(start, "measures")
    while current.where("anc is not null").take(1):
        below = current.where("anc is not null").groupBy(F.col("anc").alias("ext")).agg(
            F.min("least").alias("least2"), *[F.sum(c).alias(f"{c}2") for c in ("n", "leaves", "q", "b")])
        higher = current.where("anc is not null").select(F.col("ext").alias("anc"), F.col("anc").alias("anc2"))
        step = current.join(below, "ext", "left").join(higher, "anc", "left").select(
            "ext", F.col("anc2").alias("anc"), "m", "children", F.least("least", "least2").alias("least"),
            *[(F.col(c) + F.coalesce(f"{c}2", F.lit(0))).alias(c) for c in ("n", "leaves", "q", "b")])
        following, next_path = keep(step, "measures")
        discard(spark, path)
        current, path = following, next_path
    return current.drop("anc")


def _hashed(batches: Iterator[pa.RecordBatch]):
    sid, state, first = None, None, True
    for batch in batches:
        out = []
        for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != sid:
                if sid is not None:
                    out.append((sid, state.hexdigest()))
                sid, state, first = key, hashlib.sha256(), True
            state.update(part.encode() if first else b"," + part.encode())
            first = False
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([v for _, v in out], pa.string())], ["ext", "ends_sha256"])
    if sid is not None:
        yield pa.RecordBatch.from_arrays([pa.array([sid], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["ext", "ends_sha256"])


def end_digests(members: DataFrame) -> DataFrame:
    """(ext, ends_sha256) of (sid, c): the ids in order, put together in bounded pieces and hashed as a stream."""
    pieces = members.groupBy("sid", F.shiftright("c", _CHUNK).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = pieces.repartition("sid").sortWithinPartitions("sid", "piece").select("sid", "ids")
    return map_arrow(ordered, _hashed, "ext binary, ends_sha256 string")


def expanded(nodes: DataFrame, measures: DataFrame, digests: DataFrame) -> DataFrame:
    """One row per node of the plain trie, the root included."""
    own = measures.join(digests, "ext", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    above = measures.select(F.col("ext").alias("up"), F.col("least").alias("above"))
    edges = nodes.select("ext", "up", "p", "e", "sums").join(own, "ext").join(above, "up").select(
        "*", F.explode(F.sequence(F.col("p") + 1, F.col("e"))).alias("depth"))
    last, before = F.col("depth") == F.col("e"), F.expr("element_at(sums, depth - p)")
    rows = edges.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == F.col("p") + 1, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("q") - F.col("n") * before - (F.col("b") - (before - F.element_at("sums", 1)))).alias("saved_tokens"),
        F.when(last, F.col("ends_sha256")).otherwise(EMPTY).alias("ends_sha256"))
    root = own.where((F.col("ext") == F.lit(bytearray(_ROOT))) & (F.col("n") > 0)).select(
        F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("q") - F.col("b")).alias("saved_tokens"), "ends_sha256")
    return rows.unionByName(root)


def prefix_trie(lists: DataFrame) -> DataFrame:
    """The plain trie's nodes for (c, turns)."""
    paths, _ = keep(sequences(lists).withColumn("sid", _at("path", "size")), "paths")
    distinct, _ = keep(paths.groupBy("sid").agg(
        F.count("*").alias("m"), F.min("c").alias("least"), F.first(F.struct("size", "path", "sums")).alias("x")).select("sid", "m", "least", "x.*"), "distinct")
    nodes = build(distinct)
    digests, _ = keep(end_digests(paths.select("sid", "c")), "ends")
    return expanded(nodes, measured(nodes, distinct), digests)


_SQL = """
with raw as (
  select conv_id as c, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as d,
    strlen(coalesce(text, '')) as b from conversations where conv_id is not null),
turns as (select *, row_number() over (partition by c order by turn nulls first, d, b) as k from raw),
ids as (select c, c - c % 5 as base, CRC_OF_C % 9 as h from (select distinct c from turns)),
lent as (select i.c, t.k as pos, t.d, t.b from ids i join turns t on t.c = i.base and t.k <= i.h),
rows as (
  select * from lent
  union all
  select i.c, t.k - i.h + (select count(*) from lent l where l.c = i.c), t.d, t.b from ids i join turns t on t.c = i.c and t.k > i.h),
seqs as (
  select i.c, coalesce(string_agg(r.d, '' order by r.pos), '') as s, list(r.b order by r.pos) as bs, count(r.d) as size
  from ids i left join rows r on r.c = i.c group by i.c),
members as (select c, size, bs, unnest(range(size + 1)) as depth, s from seqs),
nodes as (
  select left(s, 32 * depth) as prefix, depth, min(c) as conv_id, count(*) as n, any_value(case when depth > 0 then bs[depth] else 0 end) as b,
    sha256(coalesce(string_agg(case when size = depth then c::varchar end, ',' order by c), '')) as ends_sha256
  from members group by 1, 2),
kids as (select left(prefix, 32 * (depth - 1)) as prefix, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by 1, 2),
full_nodes as (select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k using (prefix, depth)),
spread as (select left(prefix, 32 * a) as prefix, a as depth, n, b, n_children from (select *, unnest(range(depth + 1)) as a from full_nodes)),
subtree as (select prefix, depth, count(*) filter (n_children = 0) as n_leaves, sum((n - 1) * b) as saved from spread group by 1, 2)
select f.conv_id, f.depth::bigint as depth, p.conv_id as parent_conv_id, f.n::bigint as n_convs, f.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, f.ends_sha256
from full_nodes f join subtree s using (prefix, depth)
left join full_nodes p on p.depth = f.depth - 1 and p.prefix = left(f.prefix, 32 * (f.depth - 1))
""".replace("CRC_OF_C", sql_crc32("c"))


@query(_SQL)
def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    lists, _ = keep(turn_lists(table(spark, sf, "conversations", "conv_id", "turn", "role", "text")), "turns")
    return prefix_trie(rebuilt(lists))
