"""Mixing against its definition, tokens against the library, shards against plain arrays."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nimbusgrid.llm import common, mixing, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated resharing, as the definition says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 500, "c": 40, None: 7}, {"x": 5},
                                   {f"s{i}": (i * 37) % 101 + 1 for i in range(20)}, {"a": 0, "b": 10}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def documents(n=600):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 90))), "hot" if rng.random() < 0.4 else f"s{i % 7}", i) for i in range(n)]
    return rows + [(n, None, "s1", 0), (n + 1, "a b c", None, 0), (None, "x y", "s2", 0), (3, rows[3][1], rows[3][2], 3)]


def test_mix_hits_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 4)
    frame = spark.createDataFrame(documents(), "doc_id long, text string, source string, target long")
    first = mixing.mix(frame).collect()
    assert len(first) == len(documents())
    taken, target, size = {}, {}, {}
    for r in first:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source], size[r.source] = r.target, r.source_size
        assert 0 <= r.copies <= 3
    longest = 90
    assert all(abs(taken[s] - target[s]) <= longest / 2 for s in target if size[s] > 0)
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_inclusion_is_the_fraction_due(spark):
    """Over many seeds a document is taken about as often as its source's rate says."""
    rows = spark.createDataFrame([(i, "w " * 10, "a" if i < 40 else "b") for i in range(80)], "doc_id long, text string, source string")
    counts = np.zeros(80)
    for seed in range(12):
        measured = mixing.measured(rows, seed=str(seed))
        for r in mixing.copies(measured, mixing.cuts(measured)).collect():
            counts[r.id] += r.copies
    assert abs(counts[:40].mean() / 12 - 80 * 5 / 7 / 40) < 0.05 and counts[40:].std() > 0


def test_longer_documents_are_likelier_and_words_add_up(spark):
    """Inclusion odds differ within a source, and the words they select add up to those due."""
    rows = spark.createDataFrame([(i, "w " * (2 if i % 2 else 60), "a" if i < 200 else "b") for i in range(400)],
                                 "doc_id long, text string, source string")
    short = long = 0
    for seed in range(6):
        measured = mixing.measured(rows, seed=f"t{seed}")
        for r in mixing.copies(measured, mixing.cuts(measured)).where("source = 'b'").collect():
            short, long = short + r.copies * (r.size == 2), long + r.copies * (r.size == 60)
    assert long > short + 20


REPEATS = {
    "half the ids null": [(None if i % 2 else i, f"{i} " + "w " * (i % 40), "abc"[i % 3]) for i in range(600)],
    "one id in a source": [(7 if i % 3 == 0 else i, f"{i} " + "w " * (i % 40), "abc"[i % 3]) for i in range(600)],
    "rows alike": [(1 if i % 3 else i, "w " * (9 if i % 3 else i % 40), "abc"[i % 3]) for i in range(600)],
    "no id nor text": [(None, None, None)] * 50 + [(None, "x y z", None)] * 300 + [(None, "x y z", "a")] * 20,
}


@pytest.mark.parametrize("case", sorted(REPEATS))
@pytest.mark.parametrize("bin_rows", [4, 4096])
def test_repeated_ids_come_near_target_and_equal_sql(spark, monkeypatch, case, bin_rows):
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(mixing, "BIN_ROWS", bin_rows)
    frame = spark.createDataFrame(REPEATS[case], "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(frame).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    assert all(abs(taken[s] - target[s]) <= 41 / 2 for s in target)
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    want = con.execute(mixing.ORACLE).fetchall()
    assert sorted(map(repr, want)) == sorted(repr((r.id, r.size, r.source_size, r.target, r.size * r.copies)) for r in got)
    documents = mixing.mixed_documents(frame).groupBy("doc_id", "text", "source").count().collect()
    assert sum(r["count"] for r in documents) == sum(r.copies for r in got)


def test_mixed_documents_keep_their_columns(spark):
    frame = spark.createDataFrame(documents(), "doc_id long, text string, source string, size long")
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    want = {(r.id, r.size): r.copies for r in mixing.mix(frame).collect()}
    got = out.groupBy("doc_id").count().collect()
    assert sum(r["count"] for r in got) == sum(r.copies for r in mixing.mix(frame).collect()) and want
    empty = frame.limit(0)
    assert mixing.mixed_documents(empty).count() == 0 and mixing.mix(empty).count() == 0


@pytest.mark.parametrize("n, top", [(1, 1), (7, 2), (513, 300), (5000, 49407), (4096, 3)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype("<u2")
    matrix = tokens.WaveletMatrix(tokens.pack(ids, np.array([[1, 0, n]])))
    assert matrix.ids().tolist() == ids.tolist()
    for i in [0, n - 1, *rng.integers(0, n, 20).tolist()]:
        assert matrix.access(i) == ids[i]
        token = int(ids[i])
        assert matrix.rank(token, i) == int((ids[:i] == token).sum())
        where = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(where)
        j = int(rng.integers(0, len(where)))
        assert matrix.select(token, j) == where[j]
        assert matrix.select(token, len(where)) == -1
    assert matrix.count(60000) == 0 and matrix.rank(1 << 20, n) == 0
    with pytest.raises(IndexError):
        matrix.access(n)
    with pytest.raises(ValueError):
        tokens.WaveletMatrix(b"nothing")


def test_encoder_is_the_library():
    from tokenizers import Tokenizer
    library, encode = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    rng = np.random.default_rng(1)
    odd = ["", " ", "\n\n", "don't it'S 're", "É'S ÀÉß naïve—x", "x²y ªº µm", "<|endoftext|> a<|startoftext|>b", "日本語 한국어", "\x01a\x85b\xa0c",
           "12ab34\tfoo", "éa ǅ İx Σας", "÷×", "a_b-c ''s", "a" * 3000, "1" * 500]
    odd += ["".join(map(chr, rng.integers(32, 400, rng.integers(1, 30)))) for _ in range(2000)]
    for text in odd:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHE_WORDS", 50)
    encode = tokens.Encoder(PATH)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    for i in range(40):
        text = " ".join(f"word{i}x{j}" for j in range(30))
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encode._cache) < 200


def test_token_output_rows(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    rows = [(9, "Hello there", 1), (2, None, 1), (4, "", 1), (4, "again and again", 1), (7, "long " * 3000, 1), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = tokens.token_output(docs, PATH, shard_tokens=50).orderBy("start").collect()
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in rows}
    assert [r.doc_id for r in got] == [None, 2, 4, 4, 7, 9]
    assert got[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in (ids[t] for _, t, _ in rows))
    assert tokens.token_output(docs.limit(0), PATH).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_token_query_against_the_library(spark):
    from tokenizers import Tokenizer
    library, sf = Tokenizer.from_file(PATH), "/root/testdata/sf0.001"
    start, want = 0, []
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = tokens.op6_token_output(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy(F.col("doc_id"))
    assert [tuple(r) for r in got.collect()] == want


def test_reading_shards_lets_go_of_the_words_that_writing_kept(monkeypatch):
    monkeypatch.setattr(tokens, "_STATE", {"tokenizer": object()})
    assert list(tokens._documents(iter([]))) == [] and not tokens._STATE


def test_a_worker_drops_what_other_operators_left_there(spark, monkeypatch):
    left = {"tokens": {"encoder": object()}, "other": {"words": object()}}
    monkeypatch.setattr(common, "WORKER_STATES", left)
    assert list(common._lean(lambda batches: batches, iter([1, 2]), "tokens")) == [1, 2]
    assert left["tokens"] and not left["other"]
    assert list(common._lean(lambda batches: batches, iter([]), None)) == [] and not left["tokens"]


def test_a_task_of_another_operator_finds_no_encoder_in_its_worker(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(40)], "doc_id long, text string").repartition(8)

    def left(batches):
        rows = sum(batch.num_rows for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([len(tokens._STATE)])], ["rows", "left"])

    tokens.write_shards(docs, PATH).collect()
    again = common.map_arrow(docs, left, "rows long, left long").collect()
    assert sum(r.rows for r in again) == 40 and not any(r.left for r in again)
