"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, hashed.  Its margin is a bias, a weight per term, and for every
pair of its terms the inner product of their factors, so that two terms that are harmless alone
can count together.  The pair sum is computed in one pass: half of (square of sum - sum of
squares).

Learned from a bounded sample of ``SAMPLE_ROWS`` distinct labelled texts; the ``TERMS`` hashed terms that
tell the labels apart best (G statistic) take part.  The score reads whole texts and nothing
else.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import drawn_texts, map_arrow, table, text_hash
from nimbusgrid.llm.registry import query

SAMPLE_ROWS = 16000
BUCKETS, TERMS, FACTORS = 1 << 20, 4096, 8
LEAST_G = 8.0  # less may be unrelated to the label (p > 0.005)
STEMS = (4, 5, 6, 7)
WEIGHT = 4.0  # of a toxic row against a clean one
THRESHOLD = 0.7
_CACHE_WORDS = 400_000
_TERM = re.compile(r"[^\W_]+")


def _stems(word: str) -> list[str]:
    """A term with its longer beginnings, marked: inflected forms share those."""
    return [word, *("^" + word[:k] for k in STEMS if len(word) > k)]


def _buckets(word: str) -> list[int]:
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in _stems(word)]


def words(text: str | None) -> set[str]:
    return set(_TERM.findall((text or "").lower()))


def terms(text: str | None) -> np.ndarray:
    """Hashes of the distinct terms of a text and of their beginnings, ascending."""
    return np.unique(np.array([b for w in words(text) for b in _buckets(w)], dtype=np.int64))


@dataclass(frozen=True)
class Machine:
    slot: np.ndarray  # bucket -> position of its weights, or -1
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, documents: list[np.ndarray]) -> np.ndarray:
        """``documents``: positions of the terms that take part."""
        out = np.full(len(documents), self.bias)
        sizes = np.array([len(d) for d in documents])
        full = np.flatnonzero(sizes)
        if len(full):
            flat = np.concatenate([documents[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            v = self.factors[flat]
            total = np.add.reduceat(v, starts, axis=0)
            squares = np.add.reduceat(v * v, starts, axis=0)
            out[full] += np.add.reduceat(self.linear[flat], starts) + 0.5 * (total * total - squares).sum(1)
        return out

    def slots(self, text: str | None, cache: dict[str, tuple]) -> np.ndarray:
        """Positions of the text's terms that take part; ``cache`` keeps those of frequent words."""
        found: set[int] = set()
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        for word in words(text):
            mine = cache.get(word)
            if mine is None:
                mine = cache[word] = tuple(s for s in self.slot[_buckets(word)].tolist() if s >= 0)
            if mine:
                found.update(mine)
        return np.array(sorted(found), dtype=np.int64)

    def score(self, texts: list[str | None], cache: dict[str, tuple] | None = None) -> np.ndarray:
        cache = {} if cache is None else cache
        margin = self.margin([self.slots(t, cache) for t in texts])
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _select(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets by G statistic of presence against label, the ``TERMS`` best."""
    both, hit = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in range(0, len(rows), 512):  # in slices, as a sample may hold many millions of terms
        some = rows[at:at + 512]
        flat = np.concatenate(some)
        both += np.bincount(flat, minlength=BUCKETS)
        hit += np.bincount(flat, weights=np.repeat(y[at:at + 512], [len(r) for r in some]), minlength=BUCKETS)
    n, pos = max(len(y), 1), max(y.sum(), 0.5)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    g = (part(hit, both * pos / n) + part(both - hit, both * (n - pos) / n)
         + part(pos - hit, (n - both) * pos / n) + part(n - pos - both + hit, (n - both) * (n - pos) / n))
    g[both < 3] = -1
    best = np.lexsort((np.arange(BUCKETS), -g))[:TERMS]
    return np.sort(best[2 * g[best] > LEAST_G])


def fit(rows: list[np.ndarray], labels: np.ndarray, *, epochs: int = 12, rate: float = 0.2, decay: float = 1e-4,
        seed: int = 11) -> Machine:
    """Logistic loss by AdaGrad over minibatches."""
    y = np.asarray(labels, dtype=float)
    chosen = _select(rows, y)
    slot = np.full(BUCKETS, -1, dtype=np.int64)
    slot[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(seed)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.01
    bias, linear = float(np.log(share / (1 - share))), np.zeros(len(chosen))
    factors = rng.normal(0, 0.02, (len(chosen), FACTORS))
    gb, gl, gf = 1e-2, np.full_like(linear, 1e-2), np.full_like(factors, 1e-2)
    data = [slot[r][slot[r] >= 0] for r in rows]
    for _ in range(epochs if len(chosen) else 0):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 64):
            pick = order[at:at + 64]
            machine = Machine(slot, bias, linear, factors)
            docs = [data[i] for i in pick]
            error = (1 / (1 + np.exp(-np.clip(machine.margin(docs), -30, 30))) - y[pick]) / len(pick)
            error = np.where(y[pick] > 0, WEIGHT * error, error)
            sizes = np.array([len(d) for d in docs])
            if not sizes.sum():
                continue
            flat, owner = np.concatenate(docs), np.repeat(np.arange(len(docs)), sizes)
            e = error[owner]
            total = np.zeros((len(docs), FACTORS))
            np.add.at(total, owner, factors[flat])
            used, place = np.unique(flat, return_inverse=True)
            dl = np.bincount(place, e, len(used)) + decay * linear[used]
            pulled = e[:, None] * (total[owner] - factors[flat])
            df = np.stack([np.bincount(place, pulled[:, k], len(used)) for k in range(FACTORS)], 1) + decay * factors[used]
            gl[used] += dl * dl
            gf[used] += df * df
            linear[used] -= rate * dl / np.sqrt(gl[used])
            factors[used] -= 0.3 * rate * df / np.sqrt(gf[used])
            gb += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(gb)
    return Machine(slot, bias, linear, factors)


def _training(batches: Iterator[pa.RecordBatch]):
    seen: set[tuple] = set()  # of drawn texts, so few
    for batch in batches:
        found = []
        for text, *key in zip(*(column.to_pylist() for column in batch.columns)):
            found.append(None if tuple(key) in seen else terms(text).astype("<u4").tobytes())
            seen.add(tuple(key))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1).cast(pa.int32()), batch.column(2)],
                                         ["terms", "label", "drawn"])


def train(labelled: DataFrame, *, text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
          hashed_as: str | None = None) -> Machine:
    """Fit on ``labelled``; rows without a label teach nothing, a null text is empty.

    At most ``sample_rows`` distinct texts teach, once with each of their labels.  One repeated
    ``n`` times weighs as many rows as ``n`` has binary digits, so copies count without dominating.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        body.alias("body"), F.col(label_col).cast("int").alias("label"),
        (F.col(hashed_as) if hashed_as else text_hash(body)).alias("hashed"))
    sample = drawn_texts(rows, "body", sample_rows, hashed_as="hashed").select("body", "label", "drawn")
    got = map_arrow(sample, _training, "terms binary, label int, drawn long").groupBy("label", "drawn").agg(
        F.min("terms").alias("terms"), F.count("*").alias("copies")).collect()
    got.sort(key=lambda r: (r.label, r.drawn))
    rows, labels = [], []
    for r in got:
        weight = r.copies.bit_length()
        rows += [np.frombuffer(r.terms, "<i4")] * weight  # not copied
        labels += [r.label] * weight
    return fit(rows, np.array(labels))


def predict(docs: DataFrame, machine: Machine, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``.

    Narrow.  A null or empty text scores by the bias alone; null and repeated ids are carried as
    they are; other columns are not read.
    """
    def run(batches):
        cache: dict[str, tuple] = {}
        for batch in batches:
            score = machine.score(batch.column(1).to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")), run,
                     f"id {kind}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """Whether a document's label is kept from learning; one with a null id has none to join."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


@query()
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = (table(spark, sf, "labels", "doc_id", "toxic").where("toxic is not null and doc_id is not null")
              .where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    hashed = docs.withColumn("_hashed", text_hash(F.coalesce("text", F.lit(""))))
    machine = train(hashed.join(labels, "doc_id"), hashed_as="_hashed")
    return predict(docs, machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
