"""Secret scan: fixed patterns plus a character convolutional network over every candidate.

Base findings come from the three patterns and stay.  Any other run of secret-like characters with
a letter or digit is a candidate: of 16 or more anywhere, of 6 or more near a word that announces
a secret.  The network reads the characters before
and of a candidate in windows (a long candidate has several; its score is the largest), and a
candidate over the threshold is added as kind ``learned``.

It is trained on the same class of candidates: every distinct one of all documents, in all its windows, those
over a base finding being positive.  Candidates are dealt out to at most ``PARTS`` groups by hash.  In
each epoch every group takes its steps from the shared weights in a task of its own, and the results are
averaged by their windows.  A held-out third calibrates the scores (a logistic curve) and sets the
threshold, the highest that keeps ``RECALL``; the network carries its recall and precision there.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm.common import discard, keep, map_arrow, table
from nimbusgrid.llm.pii import SPANS, Span, span_batch, span_count, span_text
from nimbusgrid.llm.registry import query

KINDS = ("assign", "access", "hex")
#: Groups that train side by side, and the windows that make another group worth while.
PARTS, PART_WINDOWS = 128, 2048
EPOCHS, RATE, SEED = 8, 0.02, 7
BEFORE, WINDOW = 24, 64
RECALL = 0.98
FLOOR = 0.9  # what the threshold exceeds where classes are clearly apart (tests); it binds nothing
_WIDTH, _FILTERS, _CODES = 5, 24, 97

# Fixed patterns of the base findings.
_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
_LONG, _SHORT = 16, 6
_RUNS = {n: re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}+" % n) for n in (_LONG, _SHORT)}
_WORDS = ("passw", "secret", "token", "api")
_CONTEXT = re.compile("(?ai)" + "|".join(_WORDS))
_ALNUM = re.compile("[A-Za-z0-9]")


def base_spans(text: str) -> list[Span]:
    """The pattern findings, by start, then kind as listed; code points, end exclusive."""
    found, lower = [], text.lower()
    if any(w in lower for w in _WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs of secret-like characters with a letter or digit; short ones near a word of context.

    The word ends at most ``BEFORE`` characters before the run, or inside it with a short run after.
    """
    context = [m.end() for m in _CONTEXT.finditer(text)]
    for m in _RUNS[_SHORT if context else _LONG].finditer(text):
        start, end = m.span()
        if end - start < _LONG:
            at = bisect.bisect_left(context, start - BEFORE)
            if at == len(context) or context[at] > max(start, end - _SHORT):
                continue
        if _ALNUM.search(text, start, end):
            yield start, end


def windows(text: str, start: int, end: int) -> list[str]:
    """The characters before and of a candidate, cut into windows of equal length."""
    step = WINDOW - BEFORE
    return [text[max(0, at - BEFORE):at].rjust(BEFORE) + text[at:min(at + step, end + 4)].ljust(step)
            for at in range(start, end, step)]


def _codes(texts: list[str]) -> np.ndarray:
    """0 for other characters, 1 to 95 for printable ASCII, 96 for line breaks."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").reshape(len(texts), WINDOW)
    return np.where((raw >= 32) & (raw < 127), raw - 31, np.where(raw == 10, 96, 0)).astype(np.int64)


@dataclass(frozen=True)
class Network:
    """A character lookup folded into one filter bank, max-pooling, one dense unit, a calibration."""

    filters: np.ndarray  # (_WIDTH, _CODES, _FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    recall: float = float("nan")  # of the held-out candidates at the threshold
    precision: float = float("nan")
    used: int = 0  # candidates trained on
    held: int = 0  # candidates held out

    def convolve(self, codes: np.ndarray) -> np.ndarray:
        width = codes.shape[1] - _WIDTH + 1
        out = np.repeat(np.repeat(self.bias[None, None, :], len(codes), 0), width, 1)
        for k in range(_WIDTH):
            out += self.filters[k][codes[:, k:k + width]]
        return out

    def margin(self, codes: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.convolve(codes).max(1), 0.0)
        return pooled @ self.dense + self.offset

    def score(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        margin = np.concatenate([self.margin(codes[i:i + 512]) for i in range(0, len(codes), 512)])
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))


_SHAPES = [(_WIDTH, _CODES, _FILTERS), (_FILTERS,), (_FILTERS,), (1,)]
_SIZES = [int(np.prod(shape)) for shape in _SHAPES]


def _begun(rng: np.random.Generator) -> list[np.ndarray]:
    """First weights, and the means Adam keeps of their gradients and squares."""
    p = [rng.normal(0, 0.1, _SHAPES[0]), np.zeros(_SHAPES[1]), rng.normal(0, 0.3, _SHAPES[2]), np.zeros(_SHAPES[3])]
    return [x.astype(np.float32) for x in (*p, *(np.zeros(shape) for shape in _SHAPES * 2))]


def _stepped(state: list[np.ndarray], step: int, codes: np.ndarray, labels: np.ndarray, share: float) -> tuple[list[np.ndarray], int]:
    """Weights and means after Adam's steps over the windows in order, 64 at a time; ``share`` of all are positive."""
    p, m, v = (list(state[i:i + 4]) for i in (0, 4, 8))
    for at in range(0, len(codes), 64):
        x, y = codes[at:at + 64], labels[at:at + 64]
        net = Network(p[0], p[1], p[2], float(p[3][0]))
        maps = net.convolve(x)
        where = maps.argmax(1)
        pooled = np.maximum(np.take_along_axis(maps, where[:, None, :], 1)[:, 0, :], 0)
        error = 1 / (1 + np.exp(-np.clip(pooled @ p[2] + p[3][0], -30, 30))) - y
        error *= np.where(y > 0, 0.5 / share, 0.5 / max(1 - share, 1e-3)) / len(x)
        back = error[:, None] * p[2][None, :] * (pooled > 0)
        grads = [np.zeros_like(p[0]), back.sum(0), pooled.T @ error, np.array([error.sum()])]
        columns = np.broadcast_to(np.arange(_FILTERS), where.shape)
        for k in range(_WIDTH):
            np.add.at(grads[0][k], (np.take_along_axis(x, where + k, 1), columns), back)
        step += 1
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            p[i] = (p[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return [*p, *m, *v], step


def _network(state: list[np.ndarray], **more) -> Network:
    return Network(state[0], state[1], state[2], float(state[3][0]), **more)


def _silent() -> Network:
    """Where there is nothing to tell apart: adds nothing."""
    return Network(np.zeros(_SHAPES[0], np.float32), np.zeros(_FILTERS, np.float32), np.zeros(_FILTERS, np.float32), -9.0, threshold=2.0)


def fit(codes: np.ndarray, labels: np.ndarray, *, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network for windows at hand: logistic loss by Adam on two thirds; calibration and threshold on the rest."""
    rng = np.random.default_rng(seed)
    if len(set(labels.tolist())) < 2:
        return _silent()
    order = rng.permutation(len(codes))
    held, used = order[::3], np.setdiff1d(order, order[::3], assume_unique=True)
    state, step, share = _begun(rng), 0, max(labels[used].mean(), 1e-3)
    for _ in range(epochs):
        rng.shuffle(used)
        state, step = _stepped(state, step, codes[used], labels[used], share)
    net = _network(state)
    margin, y = net.margin(codes[held]), labels[held]
    scale, shift = 1.0, 0.0
    for _ in range(400):  # logistic calibration
        error = 1 / (1 + np.exp(-np.clip(scale * margin + shift, -30, 30))) - y
        scale, shift = scale - 0.05 * float((error * margin).mean()), shift - 0.05 * float(error.mean())
    score = 1 / (1 + np.exp(-np.clip(scale * margin + shift, -30, 30)))
    positive = np.sort(score[y > 0])
    kept = float(positive[int((1 - RECALL) * len(positive))]) - 1e-6 if len(positive) else 1.0  # less what rounding may differ
    over = score >= kept
    recall, precision = (float((over & (y > 0)).sum() / n) if n else float("nan") for n in (len(positive), over.sum()))
    return _network(state, scale=scale, shift=shift, threshold=kept, recall=recall, precision=precision, used=len(used), held=len(held))


def _training(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        cut, marks = [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            base = base_spans(text)
            for s, e in candidates(text):
                step = WINDOW - BEFORE
                near = [(x, y) for _, x, y in base if s < y and x < e]
                cut.append(windows(text, s, e))
                marks.append([int(any(at < y and x < min(at + step, e) for x, y in near)) for at in range(s, e, step)])
        yield pa.RecordBatch.from_arrays([pa.array(cut, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int32()))], ["windows", "marks"])


def _coded(cut: pa.Array) -> np.ndarray:
    """The codes of windows, a byte each."""
    parts = [_codes(cut[at:at + 4096].to_pylist()).astype(np.uint8) for at in range(0, len(cut), 4096)]
    return np.concatenate(parts) if parts else np.zeros((0, WINDOW), np.uint8)


def _margins(batches: Iterator[pa.RecordBatch], net: Network):
    """The largest margin of each candidate's windows, with its label."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, sizes = _coded(batch.column(0).flatten()), batch.column(0).value_lengths().to_numpy()
        margin = np.concatenate([net.margin(codes[i:i + 512]) for i in range(0, len(codes), 512)])
        best = np.maximum.reduceat(margin, np.cumsum(sizes) - sizes)
        yield pa.RecordBatch.from_arrays([pa.array(best.astype(np.float64)), batch.column(1)], ["margin", "label"])


def _averaged(groups: DataFrame, share: float) -> list[np.ndarray]:
    """Weights after all epochs: every group's steps from the shared ones, averaged by windows."""
    rng = np.random.default_rng(SEED)
    state, step = _begun(rng), 0
    for epoch in range(EPOCHS):
        def run(group):  # runs within its epoch: what it closes over does not change before
            part = group.column("part")[0].as_py()
            group = group.sort_by([("key", "ascending"), ("label", "ascending")]).combine_chunks()
            codes = _coded(group.column("windows").combine_chunks().flatten())
            labels = group.column("marks").combine_chunks().flatten().to_numpy().astype(float)
            order = np.random.default_rng((SEED, epoch, part)).permutation(len(codes))
            after, at = _stepped(state, step, codes[order], labels[order], share)
            flat = np.concatenate([x.ravel() for x in after]).astype(np.float32).tobytes()
            return pa.table({"part": pa.array([part], pa.int32()), "windows": pa.array([len(codes)], pa.int64()),
                             "step": pa.array([at], pa.int64()), "state": pa.array([flat], pa.binary())})

        # the weights of at most PARTS groups, some 140 KB each
        found = sorted(groups.groupBy("part").applyInArrow(run, "part int, windows long, step long, state binary").collect())
        total, step = sum(r.windows for r in found), max(r.step for r in found)
        flat = sum(np.frombuffer(r.state, np.float32).astype(np.float64) * (r.windows / total) for r in found).astype(np.float32)
        cuts = np.split(flat, np.cumsum(_SIZES * 3)[:-1])
        state = [x.reshape(shape) for x, shape in zip(cuts, _SHAPES * 3)]
    return state


def _calibrated(scored: DataFrame) -> tuple[float, float]:
    """Scale and shift of the logistic curve for (margin, label): damped Newton steps, slightly drawn to 1 and 0."""
    ridge, at, best, rate = 1e-3, np.array([1.0, 0.0]), None, 1.0
    for _ in range(20):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(at[0])) * F.col("margin") + F.lit(float(at[1]))))
        q, m = 1 / (1 + F.exp(-z)), F.col("margin")
        error, w = q - F.col("label"), q * (1 - q)
        loss, *sums = scored.agg(*[F.avg(x) for x in (F.log1p(F.exp(z)) - z * F.col("label"), error * m, error, w * m * m, w * m, w)]).first()
        away = at - [1.0, 0.0]
        loss += ridge / 2 * float(away @ away)
        if best is None or loss <= best[0] + 1e-12:
            grad = np.array(sums[:2]) + ridge * away
            best, rate = (loss, at, np.linalg.solve(np.array([sums[2:4], sums[3:5]]) + ridge * np.eye(2), grad)), 1.0
            if np.abs(grad).max() < 1e-7:
                break
        else:
            rate /= 2
        at = best[1] - rate * best[2]
    return float(best[1][0]), float(best[1][1])


_FINE = 36  # bits of a score that ranks are taken by


def _ranked(scores: DataFrame, rank: int) -> float:
    """The score at ``rank`` from below (0 is the least), cut to 36 bits: three counts by 4,096 places and fewer."""
    place, found = scores.select((F.col("score") * (1 << _FINE)).cast("long").alias("place")), 0
    for shift in (24, 12, 0):
        digit = F.shiftright("place", shift) - found * 4096
        within = place.where(F.shiftright("place", shift + 12) == found) if shift < 24 else place
        for r in within.groupBy(digit.alias("digit")).count().orderBy("digit").collect():
            if rank < r["count"]:
                found = found * 4096 + r.digit
                break
            rank -= r["count"]
    return found / (1 << _FINE)


def train(docs: DataFrame, *, text_col: str = "text") -> Network:
    """Train on the distinct candidates of all texts but a third, which sets curve and threshold."""
    spark = docs.sparkSession
    found = map_arrow(docs.select(F.col(text_col).alias("body")), _training, "windows array<string>, marks array<int>").distinct()
    key = F.xxhash64("windows")  # equal windows stay on one side
    rows, path = keep(found.select("windows", "marks", F.array_max("marks").alias("label"), key.alias("key"),
                                   (F.pmod(key, F.lit(3)) == 0).alias("held")), "candidates")
    size, marked = F.size("windows"), F.aggregate("marks", F.lit(0), lambda a, x: a + x)
    held, used = rows.where("held"), rows.where("not held")
    count, cut, positive = used.agg(F.count("*"), F.sum(size), F.sum(marked)).first()
    if not positive or positive == cut:
        discard(spark, path)
        return _silent()
    parts = min(PARTS, -(-cut // PART_WINDOWS))
    groups = used.withColumn("part", F.pmod(F.shiftright("key", 8), F.lit(parts)).cast("int"))
    state = _averaged(groups, max(positive / cut, 1e-3))
    net = _network(state, used=count)
    scored, scored_path = keep(map_arrow(held.select("windows", "label"), lambda b: _margins(b, net), "margin double, label int"), "margins")
    n, m = scored.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    scale, shift, kept, recall, precision = 1.0, 0.0, 1.0, float("nan"), float("nan")
    if m:
        scale, shift = _calibrated(scored)
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(scale) * F.col("margin") + F.lit(shift)))
        scores = scored.select((1 / (1 + F.exp(-z))).alias("score"), "label")
        kept = _ranked(scores.where("label = 1"), int((1 - RECALL) * m)) - 1e-6  # less what rounding may differ
        over, right = scores.where(F.col("score") >= kept).agg(F.count("*"), F.sum("label")).first()
        recall, precision = right / m, right / over
    discard(spark, path, scored_path)
    return replace(net, scale=scale, shift=shift, threshold=kept, recall=recall, precision=precision, held=n)


def find_secrets(docs: DataFrame, network: Network, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row of ``docs``.

    Narrow; the candidates of a batch go through the network together.  A null text counts as
    empty and has no spans; null and repeated ids are carried as they are; other columns are not
    read.  An empty table gives an empty result.
    """
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            found = [(d, s, e) for d, t in enumerate(texts) for s, e in candidates(t)
                     if not any(s < y and x < e for _, x, y in base[d])]
            cut = [windows(texts[d], s, e) for d, s, e in found]
            scores = network.score(_codes([w for c in cut for w in c])) if cut else np.zeros(0)
            extra: dict[int, list] = {}
            at = 0
            for (d, s, e), c in zip(found, cut):
                if scores[at:at + len(c)].max() >= network.threshold:
                    extra.setdefault(d, []).append(("learned", s, e, False))
                at += len(c)
            rows = iter([sorted([*((*b, True) for b in base[d]), *extra.get(d, ())],
                                key=lambda f: (f[1], (*KINDS, "learned").index(f[0]))) for d in range(len(texts))])
            yield span_batch(batch, lambda _, rows=rows: next(rows))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")), run,
                     f"id {kind}, {SPANS}").withColumnRenamed("id", id_col)


@query()
def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = find_secrets(docs, train(docs))
    return found.select(
        "doc_id", *[span_count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(base_only=True), 256).alias("base_sha256"), span_text().alias("spans"))
