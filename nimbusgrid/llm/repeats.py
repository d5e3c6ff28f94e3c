"""Suffix-array dedup: bucket-pointer refinement of repeated 200-byte strings.

A byte goes if a string of ``SPAN`` bytes that covers it also starts anywhere else.  Every start of such a
string is a suffix pointer; pointers are sorted into buckets of equal beginnings, and a bucket is
refined by the bucket identifiers of its pointers at later offsets until it holds one pointer, or
equal strings.

1. *Initial buckets.*  The identifier of a ``GRAM``-byte string is a 64-bit rolling hash.  Of the grams in a
   string the least one (leftmost of equals) is its *anchor*; the strings with one anchor are consecutive
   starts, so an anchor stands for all of them.  Equal strings have equal anchors at equal offsets, so
   buckets of anchors lose no pair.  Spark counts the anchors of every bucket: a bucket of one is final.
2. *Whole blocks.*  An anchor's strings together are one stretch of text.  Its identifiers at later offsets
   (every GRAM bytes) make the key that refines the bucket: anchors with equal stretches are one class, and
   all strings of a class of two or more repeat.  A class is one row however many copies it has, and goes
   on with one member, as partner of the bucket's other classes.
3. *Strings.*  Buckets with several classes are refined string by string: pointers with equal distance to
   the anchor are sorted by identifier at the string's start, then at start + GRAM, and so on; the
   bucket made by one offset is the key of the next, and pointers alone in theirs leave.  A task gets
   whole buckets of at most ``BUCKET`` classes.  The strings of a larger one are cut into ranges of distances,
   halved until buckets are small: those of a range hold the same bytes in the middle, which make its
   buckets, and its stretches make classes as in 2.  In a range of one distance a bucket is one class.
4. Removed runs are the union of repeated strings; what is kept of each text is hashed.

Strings are equal if bucket and key, 128 bits, are.  Texts are taken in pieces of ``PIECE`` starts that
overlap, so memory does not grow with a text.  Null texts are empty; texts under SPAN bytes have no strings
and keep all.  Rows that repeat an id are documents of their own, whether or not their texts are equal.
Null ids are kept.  Only id and text are read.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import BROADCAST_IDS, keep, map_arrow, picked, table
from nimbusgrid.llm.registry import query

SPAN, GRAM = 200, 50
#: Grams among which a string's anchor is chosen.
_GRAMS = SPAN - GRAM + 1
PIECE = 1 << 20
#: Classes of one bucket that a task refines in memory, some 350 bytes each.
BUCKET = 4096
#: Distances in the first ranges that larger ones are cut into.
_WIDEST = 64
#: Bucket identifiers, 8 bytes each, that are sent to every executor.
_IDENTIFIERS = 1 << 21
_AT = np.uint64((1 << 21) - 1)  # positions in a piece
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STATE: dict = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every byte, the base's powers and their inverses modulo 2 ** 64."""
    if "powers" not in _STATE:
        n = PIECE + 2 * SPAN
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        letters = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
        _STATE["powers"] = letters, np.cumprod(up), np.cumprod(down)
    return _STATE["powers"]


def identifiers(data: np.ndarray) -> np.ndarray:
    """The identifier of the gram at every position of ``data``."""
    letters, up, down = _powers()
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * up[:len(data)], out=sums[1:])
    return _mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1])


def later(grams: np.ndarray, start: np.ndarray, length: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``key`` refined by the identifiers at start, start + GRAM ... of strings of at least GRAM bytes."""
    for j in range(-(-int(length.max()) // GRAM) if len(length) else 0):
        key = np.where(j * GRAM < length, _mixed(key ^ grams[np.minimum(start + j * GRAM, start + length - GRAM)]), key)
    return key


def anchors(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(bucket, class key, position, least and greatest distance of a string's start) by piece."""
    for at in range(0, len(data) - SPAN + 1, PIECE):
        piece = data[at:at + PIECE + SPAN - 1]
        grams = identifiers(piece)
        least = (grams & ~_AT) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width < _GRAMS:
            step = min(width, _GRAMS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        chosen = (least & _AT).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        place = chosen[first]
        low, high = place - last, place - first
        key = later(grams, first, last - first + SPAN, _mixed((low * 1024 + high + 1).astype(np.uint64)))
        yield grams[place], key, place + at, low, high


def _arrays(batch: pa.RecordBatch, body: int):
    """The texts of a batch as byte arrays."""
    for text in batch.column(body):
        yield np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)


_POINTERS = "h long, k long, d long, tag long, at long, low int, high int"


def _scan(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        found, rows = [], []
        for i, data in enumerate(_arrays(batch, 2)):
            for part in anchors(data):
                found.append(part)
                rows.append(np.full(len(part[0]), i))
        if found:
            h, k, at, low, high = (np.concatenate(x) for x in zip(*found))
            of = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(k.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of),
                 pa.array(at), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["h", "k", "d", "tag", "at", "low", "high"])


_CONTEXTS = "h long, classes long, d long, tag long, at long, low int, high int, body binary"


def _contexts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out = []
        for d, tag, data, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch, 2), batch.column(3).to_pylist()):
            for x in asked:
                out.append((x["h"], x["classes"], d, tag, x["at"], x["low"], x["high"], data[x["at"] - x["high"]:x["at"] - x["low"] + SPAN].tobytes()))
        if out:
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in _CONTEXTS.split(", ")])


def _strings(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Per string of the contexts: its row, distance to the anchor, and start in the texts put together."""
    low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
    size = high - low + 1
    row = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    base = np.concatenate([[0], np.cumsum(size + SPAN - 1)])[:-1]
    return row, high[row] - inside, base[row] + inside


def _grams(batch: pa.RecordBatch) -> np.ndarray:
    data = np.frombuffer(b"".join(batch.column("body").to_pylist()), np.uint8)
    parts, step = [], PIECE
    for at in range(0, max(len(data) - GRAM + 1, 0), step):
        parts.append(identifiers(data[at:at + step + GRAM - 1]))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _runs(batch: pa.RecordBatch, row: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    """Repeated strings as (d, tag, start, stop), consecutive ones put together."""
    start = batch.column("at").to_numpy()[row] - distance
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(row) - 1]]) if len(first) else first
    of = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [batch.column("d").take(of), batch.column("tag").take(of), pa.array(start[first]), pa.array(start[last] + SPAN)], ["d", "tag", "start", "stop"])


_SPANS = "d long, tag long, start long, stop long"


def refined(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The repeated strings of whole buckets."""
    row, distance, start = _strings(batch)
    grams = _grams(batch)
    _, bucket = np.unique(batch.column("h").to_numpy(), return_inverse=True)
    bucket = bucket[row] * _GRAMS + distance
    alive = np.arange(len(row))
    for offset in range(0, SPAN, GRAM):
        if not len(alive):
            break
        found = grams[start[alive] + min(offset, SPAN - GRAM)]
        order = np.lexsort((found, bucket))
        same = (bucket[order][1:] == bucket[order][:-1]) & (found[order][1:] == found[order][:-1])
        new = np.concatenate([[True], ~same])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        kept = order[several]
        bucket, alive = number[several], alive[kept]
    alive = np.sort(alive)
    return _runs(batch, row[alive], distance[alive])


def _refine(batches: Iterator[pa.RecordBatch]):
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        cut = int(np.argmax(h == h[-1]))  # the last bucket may go on
        if cut:
            held.append(batch.slice(0, cut))
        if held and (cut or held[-1].column("h")[held[-1].num_rows - 1].as_py() != h[-1]):
            yield refined(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield refined(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


_PIECES = "h long, k long, d long, tag long, at long, low int, high int, body binary"


def _halved(batches: Iterator[pa.RecordBatch], width: int):
    """The contexts cut to ranges of ``width`` distances, with the bucket and class key of each piece.

    All strings of a range hold the same 201 - ``width`` bytes around the anchor: those tell its buckets.
    """
    for whole in batches:
        for first in range(0, whole.num_rows, 1000):
            batch = whole.slice(first, 1000)
            grams, bodies = _grams(batch), batch.column("body").to_pylist()
            h = batch.column("h").to_numpy().view(np.uint64)
            low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
            size = np.array([len(x) for x in bodies])
            base = np.cumsum(size) - size
            parts = high // width - low // width + 1
            row = np.repeat(np.arange(len(low)), parts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts) + low[row] // width
            near, far = np.maximum(low[row], part * width), np.minimum(high[row], part * width + width - 1)
            begin = high[row] - far  # of the piece, in its context's text
            bucket = later(grams, base[row] + high[row] - part * width, np.full(len(row), SPAN + 1 - width),
                           _mixed(h[row] ^ _mixed((part * 256 + width).astype(np.uint64))))
            key = later(grams, base[row] + begin, far - near + SPAN, _mixed((near * 1024 + far + 1).astype(np.uint64)))
            cut = [bodies[r][x:x + n] for r, x, n in zip(row.tolist(), begin.tolist(), (far - near + SPAN).tolist())]
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.view(np.int64)), pa.array(key.view(np.int64)), *(batch.column(c).take(of) for c in ("d", "tag", "at")),
                 pa.array(near.astype(np.int32)), pa.array(far.astype(np.int32)), pa.array(cut, pa.binary())], [f.split()[0] for f in _PIECES.split(", ")])


def _merged(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out = []
        for d, tag, asked in zip(*(c.to_pylist() for c in batch.columns)):
            runs = []
            for x in sorted(asked, key=lambda x: x["start"]):
                if runs and x["start"] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x["stop"])
                else:
                    runs.append([x["start"], x["stop"]])
            out.append((d, tag, runs))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.list_(pa.list_(pa.int64())))], ["d", "tag", "runs"])


def _kept(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out = []
        for d, tag, data, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch, 2), batch.column(3).to_pylist()):
            digest, at = hashlib.sha256(), 0
            for start, stop in runs:
                digest.update(data[at:start])
                at = stop
            digest.update(data[at:])
            out.append((d, tag, sum(b - a for a, b in runs), len(runs), digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(),) * 4 + (pa.string(),))] if out else
            [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(),)], ["d", "tag", "n_removed", "n_spans", "kept_sha256"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, d, tag, body): ``d`` and ``tag`` tell documents apart, rows equal in id and text aside."""
    shown = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("d"),
                       F.xxhash64(shown, body).alias("tag"), body.cast("binary").alias("body"))


def _joined(texts: DataFrame, asked: DataFrame, entries: int) -> DataFrame:
    """(d, tag, body, asked) of the texts that something is asked of; few entries, as counted, are broadcast."""
    return texts.select("d", "tag", "body").join(F.broadcast(asked) if entries <= BROADCAST_IDS else asked, ["d", "tag"]).select("d", "tag", "body", "asked")


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, tag, start, stop): repeated strings of every document, consecutive ones partly put together."""
    texts = _texts(docs, id_col, text_col)
    scanned = map_arrow(texts.select("d", "tag", "body"), _scan, _POINTERS)
    buckets, _ = keep(scanned.groupBy("h").count().where("count > 1").select("h"), "buckets")
    few = buckets.count() <= _IDENTIFIERS
    pointers, _ = keep(scanned.join(F.broadcast(buckets) if few else buckets, "h", "left_semi"), "pointers")
    classes, _ = keep(pointers.groupBy("h", "k").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "tag", "at", "low", "high")).alias("p")), "classes")
    settled = _stretches(pointers, classes)

    shared = classes.groupBy("h").agg(F.count("*").alias("classes")).where("classes > 1")
    open_, _ = keep(classes.join(shared, "h").select("h", "classes", "p.*"), "open")
    asked = open_.groupBy("d", "tag").agg(F.collect_list(F.struct("h", "classes", "at", "low", "high")).alias("asked"))
    contexts, _ = keep(map_arrow(_joined(texts, asked, open_.count()), _contexts, _CONTEXTS), "contexts")
    spans, width = settled.unionByName(_in_memory(contexts)), _WIDEST
    large = contexts.where(F.col("classes") > BUCKET)
    while width and large.take(1):
        pieces, _ = keep(map_arrow(large.drop("classes"), lambda b, w=width: _halved(b, w), _PIECES), "pieces")
        classes, _ = keep(pieces.groupBy("h", "k").agg(
            F.count("*").alias("n"), F.min(F.struct("d", "tag", "at", "low", "high", "body")).alias("p")), "classes")
        shared = classes.groupBy("h").agg(F.count("*").alias("classes")).where("classes > 1")
        open_, _ = keep(classes.join(shared, "h").select("h", "classes", "p.*"), "open")
        spans = spans.unionByName(_stretches(pieces, classes)).unionByName(_in_memory(open_))
        large, width = open_.where(F.col("classes") > BUCKET), width // 2
    return spans


def _stretches(pointers: DataFrame, classes: DataFrame) -> DataFrame:
    """The stretches of the pointers whose class has several."""
    return pointers.join(classes.where("n > 1").select("h", "k").hint("merge"), ["h", "k"], "left_semi").select(
        "d", "tag", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + SPAN).alias("stop"))


def _in_memory(contexts: DataFrame) -> DataFrame:
    """The repeated strings of buckets that a task takes whole."""
    ordered = contexts.where(F.col("classes") <= BUCKET).repartition("h").sortWithinPartitions("h")
    return map_arrow(ordered, _refine, _SPANS)


def removed_runs(spans: DataFrame) -> DataFrame:
    """(d, tag, runs): the maximal runs of every document that has any."""
    return map_arrow(spans.groupBy("d", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("asked")), _merged,
                     "d long, tag long, runs array<array<long>>")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    texts = _texts(docs, id_col, text_col)
    runs, _ = keep(removed_runs(repeated_spans(docs, id_col=id_col, text_col=text_col)), "runs")
    entries = runs.agg(F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0]
    changed, _ = keep(map_arrow(_joined(texts, runs.withColumnRenamed("runs", "asked"), entries), _kept,
                                "d long, tag long, n_removed long, n_spans long, kept_sha256 string"), "changed")
    whole = texts.select("id", "d", "tag", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("sha"))
    return whole.join(changed.dropDuplicates(["d", "tag"]), ["d", "tag"], "left").select(
        "id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


# Texts as hex digits, in blocks of 256 starts.
_SQL = """
with t as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
blocks as (select r, j, substr(x, 512 * j + 1, 910) as y from (select r, x, unnest(range(len(x) // 512 + 1)) as j from t)),
strings as (
  select r, 256 * j + i as i, md5(substr(y, 2 * i + 1, 400)) as s
  from (select r, j, y, unnest(range(least(256, greatest(len(y) // 2 - 199, 0)))) as i from blocks)),
starts as (select r, i from strings where s in (select s from strings group by s having count(*) > 1)),
marked as (select r, i, case when i - lag(i) over w <= 200 then 0 else 1 end as new from starts window w as (partition by r order by i)),
runs as (select r, min(i) as a, max(i) + 200 as b from (select r, i, sum(new) over (partition by r order by i) as run from marked) group by r, run),
pieces as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as after from runs),
kept as (
  select p.r, sum(b - a)::bigint as n_removed, count(*) as n_spans,
    string_agg(substr(x, 2 * after + 1, 2 * (a - after)), '' order by a) || substr(any_value(x), 2 * max(b) + 1) as k
  from pieces p join t on t.r = p.r group by p.r)
select doc_id, (len(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(k, x))) as kept_sha256
from t left join kept using (r)
"""


@query(_SQL)
def op13_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup(table(spark, sf, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")
