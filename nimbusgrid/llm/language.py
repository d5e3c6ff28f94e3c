"""Language identification by hierarchical discrimination.

First the family: softmax regression on hashed character trigrams.  Then, within the predicted
family, one linear support vector machine (squared hinge) for every pair of its languages; the
language with most pairwise wins is the prediction.  The score is the family's probability times
the mean pairwise probability of the winner.

Learned from a bounded sample of labelled texts: at most ``SAMPLE_ROWS`` in all, shared evenly by the
languages.  Prediction reads whole texts and nothing but the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import drawn_texts, map_arrow, once, table
from nimbusgrid.llm.registry import query

SAMPLE_ROWS = 6000
BUCKETS = 2048
UNDETERMINED = "und"
_SLICE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")

# Language families by ISO 639-1 code.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "indo-aryan": "hi bn ur pa mr gu ne si",
    "turkic": "tr az kk ky uz tk tt",
    "uralic": "fi et hu",
    "semitic": "ar he mt am",
    "sinitic": "zh",
    "austronesian": "id ms tl jv",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _add(counts: np.ndarray, texts: list[str], rows: list[int]) -> None:
    """Add the trigrams of texts to their rows; everything but letters is one blank."""
    joined = "  ".join(texts) + "  "
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = ((raw >= 97) & (raw <= 122)) | ((raw >= 0xC0) & (raw != 0xD7) & (raw != 0xF7))
    owner = np.repeat(np.array(rows, dtype=np.int64), [len(t) + 2 for t in texts])
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    symbols, owner = np.where(letter, raw, 32)[keep], owner[keep]
    if len(symbols) < 3:
        return
    s = symbols.astype(np.uint64)
    mixed = (s[:-2] * np.uint64(0x9E3779B1) + s[1:-1] * np.uint64(0x85EBCA77C2B2AE63)
             + s[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
    bucket = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(53)).astype(np.int64)
    same = owner[:-2] == owner[2:]
    key = owner[:-2][same] * BUCKETS + bucket[same]
    counts += np.bincount(key, minlength=counts.size).reshape(counts.shape)


def features(texts: list[str]) -> np.ndarray:
    """Square roots of trigram shares, one row per text, over the whole text."""
    counts = np.zeros((len(texts), BUCKETS))
    some, rows, held = [], [], 0
    for row, text in enumerate(texts):
        text = text.lower()
        for at in range(0, max(len(text), 1), _SLICE):
            some.append(text[at:at + _SLICE + 2])
            rows.append(row)
            held += len(some[-1])
            if held >= _SLICE:
                _add(counts, some, rows)
                some, rows, held = [], [], 0
    if some:
        _add(counts, some, rows)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def _adam(start: np.ndarray, gradient, steps: int = 200, rate: float = 0.1) -> np.ndarray:
    w = start.astype(np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        g = gradient(w).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Discriminator:
    families: list[str]
    languages: dict[str, list[str]]
    top: np.ndarray  # (BUCKETS + 1, families)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if has_letter(t)] if self.families else []
        if not rows:
            return langs, scores
        x = features([texts[i] for i in rows])
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        share = _softmax(x @ self.top)
        for f, name in enumerate(self.families):
            mine = np.flatnonzero(share.argmax(1) == f)
            codes = self.languages[name]
            wins, trust = np.zeros((len(mine), len(codes))), np.zeros((len(mine), len(codes)))
            for a, b in combinations(range(len(codes)), 2):
                margin = x[mine] @ self.pairs[codes[a], codes[b]]
                p = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
                wins[:, a] += margin >= 0
                wins[:, b] += margin < 0
                trust[:, a] += p
                trust[:, b] += 1 - p
            trust = trust / (len(codes) - 1) if len(codes) > 1 else np.ones_like(trust)
            best = (wins + 0.5 * trust).argmax(1) if len(mine) else []
            for at, (i, k) in enumerate(zip(mine, best)):
                langs[rows[i]], scores[rows[i]] = codes[k], share[i, f] * trust[at, k]
        return langs, np.clip(scores, 0, 1)


def fit(x: np.ndarray, langs: list[str]) -> Discriminator:
    codes = sorted(set(langs))
    if not codes:
        return Discriminator([], {}, np.zeros((BUCKETS + 1, 0)))
    languages: dict[str, list[str]] = {}
    for code in codes:
        languages.setdefault(family_of(code), []).append(code)
    families = sorted(languages)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    lang = np.array(langs)
    weight = np.array([1 / np.sum(lang == c) for c in codes])[np.searchsorted(codes, lang)]
    weight = (weight / weight.sum()).astype(np.float32)
    own = np.array([families.index(family_of(c)) for c in langs])
    hot = np.eye(len(families), dtype=np.float32)[own]
    top = _adam(np.zeros((x.shape[1], len(families))),
                lambda w: x.T @ ((_softmax(x @ w) - hot) * weight[:, None]) + 1e-5 * w)
    model = Discriminator(families, languages, top)
    for group in languages.values():
        for a, b in combinations(group, 2):
            rows = (lang == a) | (lang == b)
            y = np.where(lang[rows] == a, 1, -1).astype(np.float32)
            part, share = x[rows], weight[rows] / weight[rows].sum()
            model.pairs[a, b] = _adam(np.zeros(x.shape[1]), lambda w: part.T @ (
                -2 * y * np.maximum(0, 1 - y * (part @ w)) * share) + 1e-5 * w)
    return model


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in once(batches, 1, 2):
        texts = batch.column(0).to_pylist()
        for at in range(0, len(texts), 256):
            x = features(texts[at:at + 256]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1).slice(at, 256),
                                              batch.column(2).slice(at, 256)], ["x", "lang", "drawn"])


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Discriminator:
    """Fit on ``labelled``; rows without a language or a letter teach nothing.

    Every language teaches by at most ``sample_rows`` over their number of distinct texts, each
    once however often it is repeated, so no more than ``sample_rows`` reach the driver.
    """
    rows = labelled.select(F.col(text_col).alias("body"), F.col(lang_col).alias("tongue")).where(
        F.col("tongue").isNotNull() & F.col("body").rlike(r"\p{L}"))
    tongues = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col).distinct().count()
    if not tongues:
        return fit(np.zeros((0, BUCKETS), np.float32), [])
    sample = drawn_texts(rows, "body", max(1, sample_rows // tongues), "tongue").select("body", "tongue", "drawn")
    got = map_arrow(sample, _rows, "x binary, lang string, drawn long").groupBy("lang", "drawn").agg(
        F.min("x").alias("x")).collect()
    got.sort(key=lambda r: (r.lang, bytes(r.x)))
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), np.float16).reshape(len(got), BUCKETS).astype(np.float32)
    return fit(x, [r.lang for r in got])


def predict(docs: DataFrame, model: Discriminator, *, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` with the predicted language and score.

    Narrow.  ``und`` with score 0 where the text is null or has no letter; repeated rows and null
    ids are carried as they are.  ``lang_out`` and ``score_out`` must differ from ``keep``.
    """
    if {lang_out, score_out} & set(keep):
        raise ValueError("output columns clash with kept ones")
    at_text = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        for batch in batches:
            texts, langs, scores = batch.column(at_text).to_pylist(), [], []
            for at in range(0, len(texts), 256):
                some, score = model.predict(texts[at:at + 256])
                langs += some
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())],
                [*keep, lang_out, score_out])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    read = docs.select(*keep) if text_col in keep else docs.select(*keep, F.col(text_col).alias("_body"))
    return map_arrow(read, run,
                     f"{kept}{', ' if keep else ''}`{lang_out}` string, `{score_out}` double")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from learning; a null id always is."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query()
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
