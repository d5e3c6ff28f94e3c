"""Benchmark decontamination: a BM25 inverted index of the test items, searched with block-max WAND.

Every training text is cut into passages of ``2 * stride`` words, ``stride`` apart, ``stride``
being at least the longest item, so any item stands whole in one passage.  Each passage is a
query against the index, and all items that score at least ``RATIO`` of their own score are
retrieved:

1. an item's commonest terms that together stay under its threshold are set aside; a passage
   without any other term of the item cannot reach it;
2. the block-wise largest impacts of a passage's terms are summed, and only blocks of items whose
   sum reaches the least threshold in the block are opened;
3. items of open blocks are scored exactly.

A retrieved item counts when both its question and its answer (its last sentence; the second half
if there is one sentence) share at least ``OVERLAP`` of their word n-grams with the text around
the passage.

The index is sent to the executors, so its size is checked: items beyond ``INDEX_BYTES`` are
indexed in slices of at most that size, each a pass over the texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import map_arrow, table
from nimbusgrid.llm.registry import query

RATIO, OVERLAP, GRAM = 0.6, 0.5, 5
K1, B = 1.2, 0.75
BLOCK, MIN_STRIDE = 4, 64
INDEX_BYTES = 32 << 20
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item's last sentence are its answer, those before its question."""
    parts = [p for p in _SENTENCE.split(text.strip()) if words(p)]
    if len(parts) > 1:
        return words(" ".join(parts[:-1])), words(parts[-1])
    all_words = words(text)
    half = (len(all_words) + 1) // 2
    return all_words[:half], all_words[half:]


@dataclass
class Lists:
    """Values per term, one behind the other: ``where[start[t]:start[t + 1]]``."""

    start: np.ndarray
    where: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, terms: int, rows: dict[tuple[int, int], float]) -> Lists:
        keys = sorted(rows)
        first = np.array([k[0] for k in keys], dtype=np.int64)
        return cls(np.searchsorted(first, np.arange(terms + 1)), np.array([k[1] for k in keys], dtype=np.int64),
                   np.array([rows[k] for k in keys], dtype=np.float64))

    def expand(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in ``terms``, where, value) of all entries of the given terms."""
        sizes = self.start[terms + 1] - self.start[terms]
        owner = np.repeat(np.arange(len(terms)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.start[terms], sizes)
        return owner, self.where[at], self.value[at]


#: Tables of flags or sums by key are used while they have at most so many places per key asked; else keys are sorted.
_PLACES = 64


def _distinct(keys: np.ndarray, places: int) -> np.ndarray:
    """The distinct keys, ascending."""
    if places > _PLACES * len(keys):
        return np.unique(keys)
    seen = np.zeros(places, bool)
    seen[keys] = True
    return np.flatnonzero(seen)


def _among(keys: np.ndarray, some: np.ndarray, places: int) -> np.ndarray:
    """Which keys are in ``some``, which ascend."""
    if places > _PLACES * len(keys):
        return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys
    seen = np.zeros(places, bool)
    seen[some] = True
    return seen[keys]


def _summed(keys: np.ndarray, values: np.ndarray, some: np.ndarray, places: int) -> np.ndarray:
    """The sum of the values of each key in ``some``, which ascend."""
    if places > _PLACES * len(keys):
        inside = _among(keys, some, places)
        return np.bincount(np.searchsorted(some, keys[inside]), values[inside], len(some))
    return np.bincount(keys, values, places)[some]


class Index:
    """Impacts of the items' terms, by block, with each item's threshold."""

    def __init__(self, items: list[tuple[int, str]], ratio: float = RATIO, overlap: float = OVERLAP):
        items = sorted((x for x in items if x[0] is not None and words(x[1])), key=lambda x: (len(words(x[1])), x[0]))
        self.overlap = overlap
        self.ids = [i for i, _ in items]
        bags = [Counter(words(t)) for _, t in items]
        df = Counter(w for bag in bags for w in bag)
        self.terms = {w: k for k, w in enumerate(sorted(df))}
        mean = max(sum(sum(b.values()) for b in bags) / max(len(bags), 1), 1e-9)
        longest = max((sum(b.values()) for b in bags), default=0)
        self.stride = max(MIN_STRIDE, longest)
        self.blocks = -(-len(items) // BLOCK)
        impact: list[dict[int, float]] = []
        for bag in bags:
            norm = K1 * (1 - B + B * sum(bag.values()) / mean)
            impact.append({self.terms[w]: float(np.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm))
                           for w, n in bag.items()})
        self.own = np.array([sum(m.values()) for m in impact])
        self.threshold = ratio * self.own
        self.least = np.array([self.threshold[b * BLOCK:(b + 1) * BLOCK].min() for b in range(self.blocks)])
        top: dict[tuple[int, int], float] = {}
        telling: dict[tuple[int, int], float] = {}
        for i, m in enumerate(impact):
            spare = self.threshold[i]
            for t, v in sorted(m.items(), key=lambda x: (x[1], x[0])):
                top[t, i // BLOCK] = max(top.get((t, i // BLOCK), 0.0), v)
                spare -= v
                if spare <= 1e-9:
                    telling[t, i // BLOCK] = 1.0
        self.top, self.telling = Lists.build(len(self.terms), top), Lists.build(len(self.terms), telling)
        self.lists = Lists.build(len(self.terms), {(t, i): v for i, m in enumerate(impact) for t, v in m.items()})
        self.is_telling = np.diff(self.telling.start) > 0
        self.parts = [[self._numbers(p) for p in question_answer(t)] for _, t in items]

    def _numbers(self, some: list[str]) -> list[int]:
        return [self.terms.get(w, -1) for w in some]

    def search(self, text: str | None) -> Iterator[tuple[int, float, int]]:
        """(item, score over its own score, first word of the passage) above the thresholds."""
        found = words(text)
        numbers = np.fromiter(map(self.terms.get, found, repeat(-1)), np.int64, len(found))
        if not self.ids or not len(numbers):
            return
        hits = np.flatnonzero(numbers >= 0)
        some = hits[self.is_telling[numbers[hits]]]
        if not len(some):
            return
        passages = int(hits[-1]) // self.stride + 1
        window, term = np.divmod(self._pairs(some, numbers), len(self.terms))
        owner, block, _ = self.telling.expand(term)
        pairs = _distinct(window[owner] * self.blocks + block, passages * self.blocks)
        window, term = np.divmod(self._pairs(hits, numbers), len(self.terms))
        inside = _among(window, pairs // self.blocks, passages)
        window, term = window[inside], term[inside]
        owner, block, value = self.top.expand(term)
        bound = _summed(window[owner] * self.blocks + block, value, pairs, passages * self.blocks)
        keys = pairs[bound >= self.least[pairs % self.blocks] - 1e-9]
        if not len(keys):
            return
        inside = _among(window, keys // self.blocks, passages)
        window, term = window[inside], term[inside]
        owner, item, value = self.lists.expand(term)
        passage = window[owner]
        inside = _among(passage * self.blocks + item // BLOCK, keys, passages * self.blocks)
        scored, place = np.unique(passage[inside] * len(self.ids) + item[inside], return_inverse=True)
        score = np.bincount(place, value[inside], len(scored))
        for at in np.flatnonzero(score >= self.threshold[scored % len(self.ids)] - 1e-9):
            w, i = divmod(int(scored[at]), len(self.ids))
            if self._overlaps(i, numbers, w):
                yield i, float(score[at] / max(self.own[i], 1e-9)), w * self.stride

    def _pairs(self, at: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Distinct (passage, term), as passage * terms + term; a word is in two passages."""
        passage = at // self.stride
        both = np.concatenate([passage, np.maximum(passage - 1, 0)])
        return _distinct(both * len(self.terms) + np.concatenate([numbers[at], numbers[at]]), (int(passage.max()) + 1) * len(self.terms))

    def _overlaps(self, item: int, numbers: np.ndarray, passage: int) -> bool:
        near = numbers[max(0, (passage - 1) * self.stride):(passage + 3) * self.stride].tolist()
        for part in self.parts[item]:
            n = min(GRAM, len(part))
            if n:
                grams = {tuple(part[k:k + n]) for k in range(len(part) - n + 1)}
                seen = {tuple(near[k:k + n]) for k in range(len(near) - n + 1)}
                if len(grams & seen) < self.overlap * len(grams):
                    return False
        return True


def _slices(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items, in slices of at most about ``limit`` bytes."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).where("id is not null and body is not null")
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = int(-(-size // limit)) or 1
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("id", "body"), F.lit(count)) == k)
        yield [(r.id, r.body) for r in part.collect()]


MATCHES = "matches array<struct<item:long,score:double,word:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item", pa.int64()), ("score", pa.float64()), ("word", pa.int32())]))


def matches(docs: DataFrame, items: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", ratio: float = RATIO, overlap: float = OVERLAP,
            index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``keep`` columns of every row of ``docs`` with its ``matches``: best passage per item.

    Narrow.  A null or empty text has no matches; items without an id or a word take no part; equal
    items all match; repeated rows each get theirs; an empty table on either side gives no matches.
    """
    spark, names = docs.sparkSession, list(keep)
    carried = names if text_col in names else [*names, "_body"]
    at_text = carried.index(text_col) if text_col in names else len(names)
    out = docs.withColumn("_body", F.col(text_col)).select(*carried, F.array().cast(MATCHES.split(" ", 1)[1]).alias("matches"))
    kept = ", ".join(f"`{c}` {out.schema[c].dataType.simpleString()}" for c in carried)
    for part in _slices(items, item_id, item_text, index_bytes):
        shared = spark.sparkContext.broadcast(Index(part, ratio, overlap))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows = []
                for text, before in zip(batch.column(at_text).to_pylist(), batch.column(len(carried)).to_pylist()):
                    best: dict[int, tuple[float, int]] = {}
                    for i, score, at in index.search(text):
                        if score > best.get(i, (0.0, 0))[0]:
                            best[i] = score, at
                    mine = [{"item": index.ids[i], "score": s, "word": w} for i, (s, w) in best.items()]
                    rows.append(sorted([*before, *mine], key=lambda m: (m["item"], m["word"])))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, _MATCH_TYPE)],
                                                 [*carried, "matches"])

        out = map_arrow(out, run, f"{kept}, {MATCHES}")
    return out.drop("_body") if "_body" in carried else out


@query()
def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = matches(table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("matches", lambda m: m["item"].cast("string"))).alias("items"),
        F.array_max(F.transform("matches", lambda m: m["score"])).alias("best_score"))
