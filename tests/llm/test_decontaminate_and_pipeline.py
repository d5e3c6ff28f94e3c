"""Decontamination against scoring every passage with every item; the pipeline stage by stage."""

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from nimbusgrid.llm import decontaminate, jaccard, language, tokens

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def brute_scores(index, items, text):
    """All (item, passage) scores, without lists, bounds or blocks."""
    from collections import Counter
    bags = {i: Counter(decontaminate.words(t)) for i, t in items if decontaminate.words(t)}
    n, mean = len(bags), np.mean([sum(b.values()) for b in bags.values()])
    df = Counter(w for b in bags.values() for w in b)

    def impact(bag, w):
        norm = decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * sum(bag.values()) / mean)
        return np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * (decontaminate.K1 + 1) / (bag[w] + norm)

    words, s, out = decontaminate.words(text), index.stride, set()
    for p in range(0, len(words), s):
        passage = set(words[p:p + 2 * s])
        for i, bag in bags.items():
            if sum(impact(bag, w) for w in bag if w in passage) >= decontaminate.RATIO * sum(impact(bag, w) for w in bag) - 1e-9:
                out.add((i, p))
    return out


def sample(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["the", "of"] * 10
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 30))) + ". " + " ".join(
        rng.choice(vocabulary) for _ in range(rng.randrange(1, 9)))) for i in range(50)]
    texts = []
    for _ in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 400))]
        for _ in range(rng.randrange(0, 3)):
            item = rng.choice(items)[1].split()
            at = rng.randrange(len(body) + 1)
            body[at:at] = item if rng.random() < 0.5 else item[:len(item) // 2]
        texts.append(" ".join(body))
    return items, texts


@pytest.mark.parametrize("places", [0, 3, 64])
def test_tables_and_sorted_keys_agree(monkeypatch, places):
    items, texts = sample(7)
    want = [list(decontaminate.Index(items).search(t)) for t in texts]
    monkeypatch.setattr(decontaminate, "_PLACES", places)
    assert [list(decontaminate.Index(items).search(t)) for t in texts] == want and any(want)
    rng = np.random.default_rng(3)
    keys, values, some = rng.integers(0, 900, 70), rng.random(70), np.unique(rng.integers(0, 900, 40))
    assert np.array_equal(decontaminate._distinct(keys, 900), np.unique(keys))
    assert np.array_equal(decontaminate._among(keys, some, 900), np.isin(keys, some))
    assert np.allclose(decontaminate._summed(keys, values, some, 900), [values[keys == k].sum() for k in some])


@pytest.mark.parametrize("seed", [1, 2])
def test_wand_loses_nothing(monkeypatch, seed):
    items, texts = sample(seed)
    monkeypatch.setattr(decontaminate.Index, "_overlaps", lambda *a: True)
    index = decontaminate.Index(items)
    for text in texts:
        got = {(index.ids[i], p) for i, _, p in index.search(text)}
        want = brute_scores(index, items, text)
        assert got == want


def test_whole_items_are_found_and_halves_are_not(spark):
    items = [(1, "Which river runs through the old town of Brambleford? The Wend."), (2, "single sentence without any stop at all"),
             (3, None), (4, ""), (None, "nobody asked"), (5, "Which river runs through the old town of Brambleford? The Wend.")]
    docs = [(1, "filler " * 200 + items[0][1].upper() + " filler" * 300, 0), (2, "Which river runs through the old town of Brambleford?", 0),
            (3, None, 0), (4, "", 0), (5, "x " + items[1][1], 0), (5, "x " + items[1][1], 0), (None, items[0][1], 0), (6, "of the old town", 0)]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string, matches int"),
                                spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((r.doc_id or 0, [m.item for m in r.matches]) for r in got.collect())
    assert found == [(0, [1, 5]), (1, [1, 5]), (2, []), (3, []), (4, []), (5, [2]), (5, [2]), (6, [])]


def test_slices_of_the_index_change_nothing(spark):
    items, texts = sample(5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {r.doc_id: {m.item for m in r.matches} for r in decontaminate.matches(docs, bench).collect()}
    assert any(whole.values())
    for text_id, found in whole.items():  # every item that stands whole in a text is found
        flat = " " + " ".join(decontaminate.words(texts[text_id])) + " "
        assert {i for i, t in items if " " + " ".join(decontaminate.words(t)) + " " in flat} <= found
    parts = decontaminate.matches(docs, bench, index_bytes=1500, keep=("doc_id", "text"))
    assert parts.columns == ["doc_id", "text", "matches"] and parts.count() == len(texts)
    empty = bench.limit(0)
    assert decontaminate.matches(docs, empty).selectExpr("sum(size(matches))").first()[0] == 0
    assert decontaminate.matches(docs.limit(0), bench).count() == 0


@needs_tables
def test_pipeline_stage_by_stage(spark, tmp_path):
    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        sizes[name] = docs.count()
        if name == "language":
            kept = {r.doc_id for r in docs.collect()}
            assert all(r.doc_id in kept for r in before.collect() if r.text and len(r.text) > 200 and language.has_letter(r.text))
        if name == "near_duplicates":
            rows = {r.doc_id: frozenset(jaccard.shingles(r.text, 5).tolist()) for r in before.collect()}
            kept = {r.doc_id for r in docs.collect()}
            ids = sorted(rows)
            for i, b in enumerate(ids):  # links to smaller ids: gone if one is reachable
                linked = [a for a in ids[:i] if rows[a] and 100 * len(rows[a] & rows[b]) >= 80 * len(rows[a] | rows[b])]
                assert not linked or b not in kept
            assert {min(ids)} <= kept
        if name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            kept = {r.doc_id for r in docs.collect()}
            for r in before.collect():
                flat = " " + " ".join(decontaminate.words(r.text)) + " "
                whole = any(" " + " ".join(decontaminate.words(t)) + " " in flat for _, t in items)
                assert (r.doc_id in kept) != whole
    assert sizes["language"] >= sizes["near_duplicates"] >= sizes["decontaminate"] and sizes["tokens"] == sizes["mix"]
    assert corpus_pipeline.ORACLE_SQL is None


@needs_tables
def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(out.columns) and out.count() > 0


def test_pipeline_on_odd_documents(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "the quick brown fox of the wood and river", None, None, 0),
            (3, "the quick brown fox of the wood and river", None, None, 0), (None, "some words with no id at all", "en", "b", 0)]
    rows += [(10 + i, f"the text number {i} of the and with was that it for on", "en", "b", 0) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "nothing like it anywhere")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    ids = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert None in ids and 1 not in ids and 2 not in ids and 3 in ids
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    assert tokens.END_ID == 1


def test_pipeline_stages_carry_clashing_columns_and_choose_by_digest(spark):
    text = "the quick brown fox of the wood and river number {} was that it for on"
    rows = [(i, text.format(i), "en", "b", 60) for i in range(12)] + [(3, "of the wood and that it was " * 3 + "again", "en", "b", 7)]
    names = ("_body", "matches", "_lang", "_score", "_later", "_again", "_gone", "row", "id", "rep", "copies", "u", "Extra one")
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = plain.withColumns({c: F.concat(F.lit(f"{c} "), "text") for c in names})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, docs.repartition(3), SF).collect()
        want = stage(spark, plain.repartition(2), SF).collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in want) and got, name
        assert all(r[c] == f"{c} {r.text}" for r in got for c in names), name
    ids = [r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()]
    assert len(ids) == len(set(ids))
