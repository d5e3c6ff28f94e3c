"""N-gram Jaccard join over a token-group matrix.

A document's set is its distinct word shingles, as 64-bit hashes.  Documents with ``100 *
intersection >= percent * union`` are linked; the join is exact but for collisions of those
hashes (sets of equal documents are compared by a 128-bit digest of all their hashes).

* Documents with equal sets are one *representative*, so copies cost one row each.
* With ``n`` shingles, two linked sets share ``SHARED`` of the first ``n - ceil(percent * n / 100)
  + SHARED`` in any common order (all ``ceil(percent * n / 100)`` if those are fewer).  The order is
  by hash, but shingles of many representatives (passages that many documents share) come last,
  so they are rarely among the first.
* Families of near copies settle first: each representative is compared with the most typical one,
  that with the smallest share of rare shingles, among those with one of its ``LEADS`` lowest hashes.
* Similar documents are partitioned into *groups*: the components of those links, or a
  representative by itself.  The *matrix* holds every group's union of first shingles, with the
  least and largest set.  A representative meets another group if the sizes allow a link and its
  overlap with the group's union reaches what any linked member would make it.  Where sets share
  no rare shingle, the overlap is at most what is common in each; only sets whose common part is
  large enough meet by common shingles, so a large family of looser copies does not meet itself.
* A representative is first compared with a few members, the least, the greatest and one more, of the groups
  it overlaps most.  The links found join components, and groups of the representative's own component need
  no comparison any more, so a loose family costs its members a few comparisons each.
* The groups left are opened, and their members of fitting size and enough common first shingles
  compared with the representative.

Shingles are counted, joined and grouped by Spark; Python turns a text into its sorted hashes and puts
first shingles in order, common ones by a table of bits of bounded size, so only shingles that
several sets have are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.llm.common import components, discard, keep, map_arrow, picked, table
from nimbusgrid.llm.registry import query

#: A shingle among the lowest hashes of more than this many representatives is common and comes last.
COMMON = 24
#: Shingles that linked sets share among their first ones.
SHARED = 8
LEADS = 3
#: Groups that a representative is compared with in a round before all that are left are opened, and such rounds.
NEAREST, ROUNDS = 4, 2
#: At most so many bits tell flagged shingles; with more of them than fit, others are taken for flagged too.
FLAG_BITS = 28
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Hashes of the distinct shingles of ``width`` words, ascending, as signed 64-bit numbers.

    Words are runs of anything but ASCII blanks, with A-Z lowered.  Fewer words make one shingle;
    none make none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    wide = min(width, len(h))
    out = np.full(len(h) - wide + 1, np.uint64(wide))
    for k in range(wide):
        out = (out ^ h[k:len(h) - wide + 1 + k]) * _ODD
        out ^= out >> np.uint64(29)
        out *= _M1
        out ^= out >> np.uint64(32)
    out *= _M2
    out ^= out >> np.uint64(31)
    return np.unique(out.view(np.int64))


def _low(n: int, percent: int) -> int:
    """Lowest hashes kept of ``n``: the first shingles, and some more for common ones among them."""
    return (n - -(-percent * n // 100) + SHARED) * 5 // 4 + 16


def _sets(batches: Iterator[pa.RecordBatch], width: int, percent: int):
    for batch in batches:
        sizes, digests, lows, whole = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text, width)
            low = found[:_low(len(found), percent)]
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            lows.append(low)
            whole.append(len(low) == len(found))
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lows])]).astype(np.int32)
        flat = np.concatenate(lows) if lows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())), pa.array(whole, pa.bool_())],
            ["id", "n", "digest", "low", "whole"])


def _whole_sets(texts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, tokens): all shingles of the documents in ``ids`` (rep), made anew from their texts.

    Of a repeated id every row counts.
    """
    def run(batches):
        for batch in batches:
            found = [shingles(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], ["id", "tokens"])

    return map_arrow(picked(texts, ids, texts["id"] == ids["rep"], "left_semi"), run, "id long, tokens array<long>")


def _flags(tokens: DataFrame) -> np.ndarray:
    """A bit for each bucket (lowest bits) of shingles, set where one of ``tokens`` (token) falls into it.

    As large as the number of tokens asks, up to a fixed size.
    """
    bits = min(max((16 * tokens.count()).bit_length(), 15), FLAG_BITS)
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.col("token").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (tokens.select(F.shiftright(bucket, 15).cast("int").alias("at"), bucket.bitwiseAND(F.lit(0x7FFF)).cast("int").alias("bit"))
            .repartition(parts, "at").groupBy("at").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits")))
    flags = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.collect():
        flags[r["at"] << 12:(r["at"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return flags


def _flagged(flags: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    bucket = tokens & np.int64(8 * len(flags) - 1)
    return (flags[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1).astype(bool)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def _ordered(reps: DataFrame, common: np.ndarray, percent: int, twice: np.ndarray | None = None) -> DataFrame:
    """(rep, n, low, whole, rare, late, mixed, lead, own, rares, enough): the first shingles of every
    representative, the ``rare`` ones and the common ones, which come last, its lowest hashes, its
    share of rare ones, and how many first shingles are rare.

    Common shingles are told by ``common`` (see :func:`_flags`), alike for all sets, so no shingle
    is shuffled for it.  Of the rare ones only those flagged in ``twice`` are given: no other set has
    the rest.  Not ``enough``: too many of the lowest hashes are common to tell the first shingles.
    """
    flags = reps.sparkSession.sparkContext.broadcast((common, twice))

    def run(batches: Iterator[pa.RecordBatch]):
        common, twice = flags.value
        for batch in batches:
            flat, rows = batch.column(2).flatten().to_numpy(zero_copy_only=False), []
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            is_late = _flagged(common, flat)
            posted = np.ones(len(flat), bool) if twice is None else _flagged(twice, flat)
            for n, end, whole, start in zip(batch.column(1).to_pylist(), ends, batch.column(3).to_pylist(), [0, *ends]):
                low, behind, shown = flat[start:end], is_late[start:end], posted[start:end]
                wanted = n - -(-percent * n // 100) + SHARED
                first = np.flatnonzero(~behind)
                known = len(first)
                last = low[behind][:max(wanted - known, 0)]
                first = first[:wanted]
                rows.append((low[first[shown[first]]], last, len(last) > 0, low[:LEADS], known / len(low), min(known, wanted),
                             bool(whole or known >= wanted)))
            rare, late, mixed, lead, own, rares, enough = map(list, zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _lists(rare), _lists(late), pa.array(mixed, pa.bool_()),
                 _lists(lead), pa.array(own, pa.float64()), pa.array(rares, pa.int32()), pa.array(enough, pa.bool_())],
                ["rep", "n", "low", "whole", "rare", "late", "mixed", "lead", "own", "rares", "enough"])

    return map_arrow(reps.select("rep", "n", "low", "whole"), run,
                     "rep long, n long, low array<long>, whole boolean, rare array<long>, late array<long>, mixed boolean, "
                     "lead array<long>, own double, rares int, enough boolean")


def links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
          percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(membership, components) of the join.

    membership: (id, n_shingles, rep, texts) per row of ``docs``, rep being the smallest id with the
    same set, or null where the set is empty or the id is null.  components: (rep, component_id)
    of the representatives that are linked to another one.

    A null or empty text has the empty set and no links.  A null id takes no part.  Rows that
    repeat an id with another text make one document of both: they share a component.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    sets, sets_path = keep(map_arrow(texts, lambda b: _sets(b, width, percent),
                                     "id long, n long, digest binary, low array<long>, whole boolean"), "sets")
    usable = sets.where("n > 0 and id is not null")
    same, same_path = keep(usable.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "same")
    member = sets.select("id", "n", "digest").join(same.select("digest", "rep"), "digest", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("rep")).alias("rep"))
    member, _ = keep(member, "members")
    # only sets that occur again need to meet for one of them to stand for all
    again = same.where("rows > 1").select("digest", "rep")
    one = picked(usable, again, "digest", "inner").where("id = rep").groupBy("digest").agg(
        F.min("rep").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("whole").alias("whole"))
    single = picked(usable, again, "digest", "left_anti").withColumnRenamed("id", "rep")
    columns = ("rep", "n", "low", "whole")
    reps, reps_path = keep(single.select(*columns).unionByName(one.select(*columns)), "reps")
    several = usable.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select(F.col("id").alias("a"))
    several, several_path = keep(several, "several")
    discard(spark, sets_path, same_path)
    edges, paths = _edges(reps, texts, width, percent)
    own = member.where("rep is not null and rep <> id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    repeated = own.join(several, "a", "left_semi")
    found, _ = keep(components(edges.select("a", "b").union(repeated)), "components")
    discard(spark, reps_path, several_path, *paths)
    return member, found.withColumnRenamed("node", "rep").withColumnRenamed("component", "component_id")


def _counted(sets: DataFrame) -> DataFrame:
    """(token, common) of those in several of the sets, common where in more than ``COMMON``; which ones
    are common only decides an order."""
    return sets.select(F.explode("low").alias("token")).groupBy("token").count().where("count > 1").select(
        "token", (F.col("count") > COMMON).alias("common"))


def _edges(reps: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, list[str]]:
    """Checked links (a, b) between representatives that connect every component."""
    spark, paths = reps.sparkSession, []

    def stage(df, label):
        out, path = keep(df, label)
        paths.append(path)
        return out

    counted = stage(_counted(reps), "counted")
    common = counted.where("common").select("token")
    again = reps.limit(0)  # with whole sets: those whose lowest hashes are almost all common
    while True:
        flags = _flags(common)
        short = stage(_ordered(reps, flags, percent).where("not enough").select("rep", "n"), "short")
        fresh = stage(short.join(again.select("rep", "n"), ["rep", "n"], "left_anti"), "short")
        if not fresh.take(1):
            break
        whole = _whole_sets(texts, fresh.select("rep").distinct(), width).select(
            F.col("id").alias("rep"), F.size("tokens").cast("long").alias("n"), F.col("tokens").alias("low"),
            F.lit(True).alias("whole"))
        again = stage(again.unionByName(whole.join(fresh, ["rep", "n"], "left_semi").distinct()), "again")
        common = stage(common.union(_counted(again).where("common").select("token")).distinct(), "common")
    # what a whole set has besides its lowest hashes was not counted
    twice = _flags(stage(counted.select("token").union(again.select(F.explode("low"))).distinct(), "twice"))
    parts = _ordered(reps, flags, percent, twice).where("enough").unionByName(
        _ordered(again, flags, percent, twice).join(short, ["rep", "n"], "left_semi")).drop("enough")
    parts = stage(parts, "parts")
    fits = (F.col("n") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("n") * percent)
    leads = parts.select("rep", "n", "own", F.explode("lead").alias("token"))
    lead = leads.groupBy("token").agg(F.min(F.struct("own", "rep", "n")).alias("l"), F.count("*").alias("held")).where("held > 1")
    pairs = leads.join(lead.select("token", F.col("l.rep").alias("b"), F.col("l.n").alias("nb")), "token").where(
        "rep <> b").where(fits).select(F.greatest("rep", "b").alias("a"), F.least("rep", "b").alias("b")).distinct()
    tried = stage(_promising(stage(pairs, "leads"), parts, percent), "pairs")
    linked = stage(_checked(tried, texts, width, percent), "links")

    group_of = stage(components(linked).withColumnRenamed("node", "rep"), "groups")
    grouped = picked(parts.select("rep", "n", "rare", "late", "mixed", "rares"), group_of, "rep", "left").withColumn("g", F.coalesce("component", "rep"))
    placed = stage(grouped.select("rep", "n", "g").distinct(), "placed")
    # dealt out by shingle once, for the matrix and for the meeting of sets and groups
    entries = grouped.select(
        "rep", F.col("n").cast("int").alias("n"), "g", "rares", "mixed", F.size("rare").alias("ahead"),
        F.posexplode(F.concat("rare", "late")).alias("at", "token")).withColumn("late", F.col("at") >= F.col("ahead")).drop("at", "ahead").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "token")
    # of a set with common shingles among its first, all rare ones are known: the rest is what it can share without them
    reach = F.when(F.col("mixed"), F.col("n") - F.col("rares")).otherwise(0)
    matrix = entries.groupBy("token", "g").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("mixed").alias("any_mixed"),
                                               F.min("mixed").alias("all_mixed"), F.max(reach).alias("reach"))
    matrix = matrix.withColumn("groups", F.count("*").over(Window.partitionBy("token"))).where(F.col("groups") > 1).drop("groups")
    # the most that a set shares with a mixed one, both mixed: all but its rare shingles, and the rare ones that they share
    most = lambda rare: (F.least(F.col("n") - F.col("rares"), F.col("reach")) + rare) * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    enough = F.col("overlap") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100.0))
    met = (entries.withColumnRenamed("g", "own").join(matrix, "token").where("g <> own")
           .where((F.col("most") * 100 >= F.col("n") * percent) & (F.col("least") * percent <= F.col("n") * 100))
           .where(~F.col("late") | most(0))
           .groupBy("rep", "n", "rares", "g").agg(
               F.count("*").alias("overlap"), F.count(F.when(~F.col("late"), 1)).alias("rare"), F.min("least").alias("least"),
               F.max(F.col("mixed") & F.col("any_mixed")).alias("mixed"), F.min(F.col("mixed") & F.col("all_mixed")).alias("all_mixed"),
               F.max("reach").alias("reach"))
           # common shingles may have been left out of a count between two mixed sets
           .where((enough & ~F.col("all_mixed")) | ((enough | F.col("mixed") & (F.col("rare") > 0)) & most(F.col("rare"))))
           .select(F.col("rep").alias("b"), F.col("n").cast("long").alias("nb"), "g", "overlap"))
    met = stage(met, "met")
    size = F.struct("n", "rep")
    faces = stage(placed.groupBy("g").agg(F.min(size).alias("x"), F.max(size).alias("y"), F.min(F.struct(F.xxhash64("rep"), "n", "rep")).alias("z"))
                  .select("g", F.explode(F.array_distinct(F.array("x", "y", F.struct("z.n", "z.rep")))).alias("f")).select("g", "f.*"), "faces")
    closest = Window.partitionBy("b", "nb").orderBy(F.desc("overlap"), F.xxhash64("b", "g"))
    pair = (F.greatest("rep", "b").alias("a"), F.least("rep", "b").alias("b"))
    for _ in range(ROUNDS):
        few = met.withColumn("place", F.row_number().over(closest)).where(F.col("place") <= NEAREST).join(faces, "g").where(fits)
        few = stage(few.select(*pair).distinct().join(tried, ["a", "b"], "left_anti"), "few")
        if not few.take(1):
            break
        linked = stage(linked.union(_checked(stage(_promising(few, parts, percent), "few"), texts, width, percent)), "links")
        tried = stage(tried.union(few), "tried")
        whole = stage(components(linked), "joined")
        for name in ("b", "g"):
            side = whole.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
            met = picked(met, side, name, "left")
        met = stage(met.where("coalesce(of_b, b) <> coalesce(of_g, g)").drop("of_b", "of_g"), "met")
    opened = met.join(placed, "g").where(fits).select(*pair).distinct().join(tried, ["a", "b"], "left_anti")
    opened = stage(_promising(stage(opened, "opened"), parts, percent), "opened")
    more = _checked(opened, texts, width, percent)
    return stage(linked.union(more), "links"), paths


def _promising(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs that share as many first shingles as linked sets do, and may share enough in all.

    Up to the lesser of the last ones known of each set all lowest hashes of both are known, so what
    they share there, and the smaller one of the rests, is the most they can share.  Only the sets
    in a pair take part in the joins: their ids are picked first.
    """
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    asked = picked(parts.select("rep", "n", F.concat("rare", "late"), "low", F.when(~F.col("whole"), F.element_at("low", -1))),
                   ids, "rep", "left_semi")
    both = pairs.join(asked.toDF("a", "na", "pa", "la", "enda"), "a").join(asked.toDF("b", "nb", "pb", "lb", "endb"), "b")
    least = F.least(F.lit(SHARED), F.ceil(F.greatest("na", "nb") * percent / 100.0))
    both = both.where(F.size(F.array_intersect("pa", "pb")) >= least).withColumn(
        "end", F.coalesce(F.least("enda", "endb"), F.lit((1 << 63) - 1)))
    rest = F.least(*[F.col(f"n{s}") - F.size(F.filter(f"l{s}", lambda x: x <= F.col("end"))) for s in "ab"])
    most = F.size(F.array_intersect("la", "lb")) + rest
    return both.where(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b").distinct()


def _checked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are as similar as asked."""
    spark = pairs.sparkSession
    if not pairs.take(1):
        return pairs
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets, path = keep(_whole_sets(texts, ids, width), "whole")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    out, _ = keep(both.select("a", "b", shared.alias("i"), (F.size("ta") + F.size("tb") - shared).alias("u"))
                  .where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b").distinct(), "checked")
    discard(spark, path)
    return out


def join(docs: DataFrame, **options) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; see :func:`links`."""
    member, found = links(docs, **options)
    return member.join(found, "rep", "left").select(
        "id", "n_shingles", F.coalesce("component_id", "rep", "id").alias("component_id"))


@query()
def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return join(table(spark, sf, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")
