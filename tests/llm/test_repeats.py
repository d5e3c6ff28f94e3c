"""Suffix-array dedup against a table of all 200-byte strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbusgrid.llm import repeats

SCHEMA = "doc_id long, text string"


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **columns):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, value in columns.items():
        docs = docs.withColumn(name, value)
    return sorted((tuple(r) for r in repeats.dedup(docs).collect()), key=str)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus(seed, n=60):
    """Copies, copies with changed words, passages set in other texts at several depths, short texts."""
    rng = random.Random(seed)
    passage = [prose(rng, 80) for _ in range(3)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind < 0.7:
            p = rng.choice(passage)
            cut = rng.randrange(len(p) - 100)
            texts.append(prose(rng, rng.randrange(60)) + p[cut:cut + rng.randrange(150, 320)] + prose(rng, rng.randrange(60)))
        else:
            texts.append(prose(rng, rng.randrange(1, 120)))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, bucket", [(1, 4096), (2, 4096), (3, 2)])
def test_against_all_strings(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(repeats, "BUCKET", bucket)  # 2: nearly all buckets are dealt out by Spark
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_matches_of_exactly_one_string_and_one_byte_less(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("qwertz ") for _ in range(200))
    rows = [(1, prose(rng, 50) + "<" + shared + ">" + prose(rng, 50)), (2, "(" + shared + ")"), (3, shared[1:] + "!"), (4, "?" + shared[:-1])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[2] for r in got] == [200, 200, 0, 0]


def test_repeats_inside_a_text_and_periodic_texts(spark):
    rows = [(1, "=" * 1000), (2, "ab" * 300 + "c"), (3, "x" * 200), (4, "y" * 201), (5, "abc" * 66 + "ab"), (6, "é" * 150),
            (7, "".join(format(bin(i).count("1") % 2) for i in range(2048)))]
    assert run(spark, rows) == brute(rows)


def test_nulls_ids_and_clashing_names(spark):
    text = prose(random.Random(9), 100)
    rows = [(None, text), (0, text), (0, text + "."), (5, text), (5, text), (6, None), (7, ""), (8, "short"), (None, None)]
    extra = {c: F.lit("z") for c in ("id", "d", "tag", "body", "h", "k", "at", "low", "high", "asked", "runs", "n", "classes")}
    assert run(spark, rows, **extra) == brute(rows)
    assert run(spark, []) == []


def test_long_text_is_cut_into_pieces(spark, monkeypatch):
    rng = random.Random(10)
    text = prose(rng, 3000)
    rows = [(1, text), (2, prose(rng, 40) + text[5000:9000] + prose(rng, 40)), (3, text[700:1400] + text[700:1400])]
    want = [list(repeats.anchors(np.frombuffer(t.encode(), np.uint8))) for _, t in rows]
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(repeats, "PIECE", 512)
    for (_, t), whole in zip(rows, want):
        data = np.frombuffer(t.encode(), np.uint8)
        strings = lambda parts: {(int(h), int(a - x)) for p in parts for h, _, a, lo, hi in zip(*p) for x in range(lo, hi + 1)}
        assert strings(repeats.anchors(data)) == strings(whole)
        assert len({s for _, s in strings(whole)}) == len(data) - 199


def test_spans_of_large_and_small_buckets_agree(spark, monkeypatch):
    """One passage in many surroundings: a bucket that is too large for one task."""
    rng = random.Random(12)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 30) + f" {i} " + passage + f" {i} " + prose(rng, 30)) for i in range(80)]
    monkeypatch.setattr(repeats, "BUCKET", 16)
    assert run(spark, rows) == brute(rows)


def test_large_buckets_are_halved_and_not_dealt_out_by_string(spark, monkeypatch):
    """Classes of a large bucket make a few rows each, not one for every string."""
    rng = random.Random(13)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 30) + f" {i} " + passage + f" {i} " + prose(rng, 30)) for i in range(120)]
    made, kept = {}, repeats.keep

    def counted(df, label):
        out = kept(df, label)
        made.setdefault(label, []).append(out[0].count())
        return out

    monkeypatch.setattr(repeats, "BUCKET", 16)
    monkeypatch.setattr(repeats, "keep", counted)
    assert run(spark, rows) == brute(rows)
    contexts = made["contexts"][0]
    assert made["pieces"][0] <= 4 * contexts and all(n <= 3 * contexts for n in made["pieces"]) and made["pieces"][-1] < contexts
