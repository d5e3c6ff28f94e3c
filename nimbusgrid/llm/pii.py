"""Personal data: fixed patterns plus a semi-Markov conditional random field.

Base spans come from the four patterns.  The field adds spans the patterns miss (a phone number
without its plus, a card number with unusual separators).  It works on islands: runs of
neighbouring tokens that hold a digit or an ``@``; outside islands nothing can be personal data,
so leaving the rest of a text out of the dynamic program changes no result.  Within an island
every span of at most ``MAX_TOKENS`` tokens is scored as a whole (digit counts, shape, Luhn sum,
octets, separators) under every kind, and the program picks boundaries and kinds jointly, with
a weight for each pair of neighbouring labels.

The field is fitted on islands of a bounded sample of documents (``SAMPLE_DOCS`` documents,
``SAMPLE_ISLANDS`` islands) that the patterns label, and on rewritten copies of those findings.
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

from nimbusgrid.llm.common import map_arrow, sampled, table
from nimbusgrid.llm.registry import query

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_ISLANDS = 4000, 2000
MAX_TOKENS, MAX_CHARS = 5, 90
_BUCKETS = 2048
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Fixed patterns of the base findings; possessive or guarded so that no text makes them quadratic.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LIVE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    cursor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > cursor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            cursor = domain.end()
        at = text.find("@", max(at + 1, cursor))


def base_spans(text: str) -> list[Span]:
    """The pattern findings, by kind as listed, then start; code points, end exclusive."""
    found = list(_emails(text))
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def islands(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens with a digit or ``@``, one blank apart; token borders without punctuation."""
    run, last = [], -2
    for m in _LIVE.finditer(text):
        a, b = m.span()
        if run and a != last + 1:
            yield run
            run = []
        last = b
        while a < b and text[a] in "([{<\"'":
            a += 1
        while b > a and text[b - 1] in ".,;:!?)]}>\"'":
            b -= 1
        run.append((a, b))
    if run:
        yield run


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) % _BUCKETS


def _features(s: str, tokens: int) -> np.ndarray:
    digits = _NOT_DIGIT.sub("", s)
    shape = re.sub("[A-Za-z]+", "A", re.sub("[0-9]+", lambda m: str(min(len(m[0]), 9)), s))[:32]
    dots = s.split(".")
    names = [f"digits{min(len(digits), 24)}", f"tokens{tokens}", f"shape{shape}", f"ats{min(s.count('@'), 2)}",
             "marks" + "".join(sorted(set(s) - set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))),
             f"letters{any(c.isalpha() for c in s)}", f"plus{s[0] == '+'}", "span"]
    if 13 <= len(digits) <= 19:
        names.append(f"luhn{luhn(digits)}")
    if 9 <= len(digits) <= 15:
        names.append("length9-15")
    if len(dots) == 4 and all(p.isdigit() and p.isascii() for p in dots):
        names.append(f"octets{_octets(dots)}")
    if "@" in s:
        names.append(f"domain{bool(_DOMAIN.fullmatch(s.rpartition('@')[2]))}")
    return np.array([_hash(n) for n in names])


Segment = tuple[int, int, np.ndarray]


def lattice(text: str, run: list[tuple[int, int]]) -> list[Segment]:
    """Every span of a few tokens that could be personal data: first token, last token, features."""
    out = []
    for i in range(len(run)):
        for j in range(i, min(i + MAX_TOKENS, len(run))):
            s = text[run[i][0]:run[j][1]]
            if len(s) > MAX_CHARS and j > i:
                break
            if 0 < len(s) <= MAX_CHARS and ("@" in s or sum("0" <= c <= "9" for c in s) >= 7 or s.count(".") >= 3):
                out.append((i, j, _features(s, j - i + 1)))
    return out


@dataclass(frozen=True)
class Field:
    """Weights per (kind, feature) and per (label before, label); label 0 is "outside"."""

    spans: np.ndarray
    steps: np.ndarray

    def scores(self, segments: list[Segment]) -> list[np.ndarray]:
        return [self.spans[:, f].sum(1) for _, _, f in segments]


def _ends(segments: list[Segment], n: int) -> list[list[int]]:
    ends = [[] for _ in range(n)]
    for s, (_, j, _) in enumerate(segments):
        ends[j].append(s)
    return ends


def decode(field: Field, segments: list[Segment], n: int) -> list[tuple[int, int, int]]:
    """The best labelling of ``n`` tokens: (first token, last token, kind) of its spans."""
    scores, ends = field.scores(segments), _ends(segments, n)
    best = np.full((n + 1, len(KINDS) + 1), -np.inf)
    best[0, 0] = 0.0
    back: dict = {}
    for j in range(n):
        arrive = best[j] + field.steps[:, 0]
        best[j + 1, 0], back[j + 1, 0] = arrive.max(), (j, int(arrive.argmax()), -1)
        for s in ends[j]:
            i = segments[s][0]
            for k in range(len(KINDS)):
                arrive = best[i] + field.steps[:, k + 1]
                value = arrive.max() + scores[s][k]
                if value > best[j + 1, k + 1]:
                    best[j + 1, k + 1], back[j + 1, k + 1] = value, (i, int(arrive.argmax()), s)
    out, at, label = [], n, int(best[n].argmax())
    while at > 0:
        i, before, s = back[at, label]
        if s >= 0:
            out.append((i, at - 1, label - 1))
        at, label = i, before
    return out[::-1]


def _log_sum(x: np.ndarray) -> float:
    top = x.max()
    return top + np.log(np.exp(x - top).sum()) if np.isfinite(top) else -np.inf


def fit(examples: list[tuple[int, list[Segment], list[tuple[int, int, int]]]], *, epochs: int = 4,
        rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by AdaGrad; the expectations come from the forward-backward recursion."""
    labels = len(KINDS) + 1
    w, t = np.zeros((len(KINDS), _BUCKETS)), np.zeros((labels, labels))
    gw, gt = np.full_like(w, 1e-2), np.full_like(t, 1e-2)
    for _ in range(epochs):
        for n, segments, gold in examples:
            ends = _ends(segments, n)
            score = [w[:, f].sum(1) for _, _, f in segments]
            forward = np.full((n + 1, labels), -np.inf)
            forward[0, 0] = 0.0
            arcs = [(j, j + 1, 0, -1, 0.0) for j in range(n)]
            arcs += [(segments[s][0], j + 1, k + 1, s, score[s][k]) for j in range(n) for s in ends[j]
                     for k in range(len(KINDS))]
            arcs.sort(key=lambda a: a[1])
            for i, j, y, _, v in arcs:
                forward[j, y] = np.logaddexp(forward[j, y], _log_sum(forward[i] + t[:, y]) + v)
            backward = np.full((n + 1, labels), -np.inf)
            backward[n] = 0.0
            for i, j, y, _, v in sorted(arcs, key=lambda a: -a[0]):
                backward[i] = np.logaddexp(backward[i], t[:, y] + v + backward[j, y])
            total = _log_sum(forward[n])
            dw: dict[tuple[int, int], float] = {}
            dt = np.zeros_like(t)
            for i, j, y, s, v in arcs:
                share = np.exp(np.minimum(forward[i] + t[:, y] + v + backward[j, y] - total, 0.0))
                dt[:, y] -= share
                if s >= 0:
                    for f in segments[s][2]:
                        dw[y - 1, f] = dw.get((y - 1, f), 0.0) - share.sum()
            at, before, index = 0, 0, {(i, j): s for s, (i, j, _) in enumerate(segments)}
            for i, j, k in [*gold, (n, n, -1)]:
                while at < i:
                    dt[before, 0] += 1
                    at, before = at + 1, 0
                if k >= 0:
                    dt[before, k + 1] += 1
                    for f in segments[index[i, j]][2]:
                        dw[k, f] = dw.get((k, f), 0.0) + 1
                    at, before = j + 1, k + 1
            gt += dt * dt
            t += rate * (dt - decay * t) / np.sqrt(gt)
            for (k, f), g in dw.items():
                g -= decay * w[k, f]
                gw[k, f] += g * g
                w[k, f] += rate * g / np.sqrt(gw[k, f])
    return Field(w.astype(np.float32), t.astype(np.float32))


def _rewritten(kind: str, s: str) -> Iterator[tuple[str, bool]]:
    """Copies of a finding that the patterns miss, and near misses that are none."""
    digits = _NOT_DIGIT.sub("", s)
    if kind == "phone":
        yield s[1:], True
        yield f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", True
        yield digits[-7:], False
    if kind == "card":
        yield ".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), True
        yield digits[:-1] + str((int(digits[-1]) + 5) % 10), False
    if kind == "ip":
        yield ".".join(str(int(p) + 300) for p in s.split(".")), False
        yield s.rpartition(".")[0], False
    if kind == "email":
        yield s.replace("@", "@@"), False


def _example(text: str, run: list[tuple[int, int]], spans: dict[tuple[int, int], int]):
    segments = lattice(text, run)
    gold, at = [], 0
    for i, j, _ in segments:
        kind = spans.get((run[i][0], run[j][1]))
        if kind is not None and i >= at:
            gold.append((i, j, kind))
            at = j + 1
    return len(run), segments, gold


def _training(batches: Iterator[pa.RecordBatch]):
    """Islands of sampled texts with what the patterns find in them: (island, spans)."""
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            for run in islands(text or ""):
                if len(run) <= 40 and lattice(text, run):
                    a, b = run[0][0], run[-1][1]
                    inside = [f"{KINDS.index(k)}:{s - a}:{e - a}" for k, s, e in spans if a <= s and e <= b]
                    rows.append((text[a:b], ",".join(inside)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
            ["island", "spans"])


def train(docs: DataFrame, *, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_islands: int = SAMPLE_ISLANDS) -> Field:
    """Fit the field on the sample named in the module's text; no labelled rows are needed."""
    texts = docs.select(F.col(text_col).alias("body"))
    sample = sampled(texts, F.col("body"), sample_docs, texts.count())
    rows = (map_arrow(sample, _training, "island string, spans string").distinct()
            .orderBy(F.xxhash64("island"), "island", "spans").limit(sample_islands).collect())
    examples = []
    for island, spans in rows:
        marks = [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]
        for run in islands(island):
            examples.append(_example(island, run, {(s, e): k for k, s, e in marks}))
        for k, s, e in marks:
            for text, real in _rewritten(KINDS[k], island[s:e]):
                for run in islands(text):
                    examples.append(_example(text, run, {(run[0][0], run[-1][1]): k} if real else {}))
    return fit([x for x in examples if x[1]])


def spans_of(text: str, field: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by kind as listed, then start."""
    base = base_spans(text)
    covered = sorted((s, e) for _, s, e in base)
    found = [(*b, True) for b in base]
    for run in islands(text):
        segments = lattice(text, run)
        if not segments:
            continue
        for i, j, k in decode(field, segments, len(run)):
            s, e = run[i][0], run[j][1]
            if not any(s < y and x < e for x, y in covered):
                found.append((KINDS[k], s, e, False))
    return sorted(found, key=lambda f: (KINDS.index(f[0]), f[1]))


SPANS = "spans array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("base", pa.bool_())]))


def span_batch(batch: pa.RecordBatch, find) -> pa.RecordBatch:
    names = ("kind", "start", "end", "base")
    spans = [[dict(zip(names, f)) for f in find(text or "")] for text in batch.column(1).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN_TYPE)], ["id", "spans"])


def find_pii(docs: DataFrame, field: Field, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row of ``docs``.

    Narrow.  A null text counts as empty and has no spans; null and repeated ids are carried as
    they are; other columns are not read.  An empty table gives an empty result.
    """
    def run(batches):
        for batch in batches:
            yield span_batch(batch, lambda text: spans_of(text, field))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")), run,
                     f"id {kind}, {SPANS}").withColumnRenamed("id", id_col)


def span_text(base_only: bool = False):
    """``kind:start:end`` of the spans, comma-joined."""
    spans = F.filter("spans", lambda s: s["base"]) if base_only else F.col("spans")
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def span_count(kind: str):
    """Base spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


@query()
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = find_pii(docs, train(docs))
    return found.select(
        "doc_id", *[span_count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(base_only=True), 256).alias("base_sha256"), span_text().alias("spans"))
