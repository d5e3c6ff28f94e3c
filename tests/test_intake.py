"""One-pass intake against the two-step scan, and reading merged generations against compaction."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from nimbusgrid.operators.panel import keep_first
from nimbusgrid.sources import generations, intake, landing, records

GOOD = {"fecha": "2024-01-01", "indicativo": "X", "nombre": "N", "provincia": "P", "tmed": "10,5", "extra": 1}
KEYS = {"series": "s", "date": "day"}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "2024"
    folder.mkdir(parents=True)
    docs = {
        "data.json": json.dumps([GOOD, {**GOOD, "fecha": "bad"}, {**GOOD, "fecha": "1999-01-01"},
                                 {"fecha": "2024-01-02"}, {**GOOD, "tmed": "Ip"}], indent=4),
        "part_1_2.json": json.dumps([GOOD]), "object.json": json.dumps(GOOD),
        "broken.json": json.dumps([GOOD])[:40], "none.json": "[]", "blank.json": "", "notes.txt": json.dumps([GOOD]),
    }
    for name, text in docs.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


def test_one_pass_accounts_for_everything(spark, raw, tmp_path):
    seen = intake.take_in(spark, raw, str(tmp_path / "out"), start="2000-01-01")
    assert (seen.accepted, seen.rejected) == (2, 3)
    want = records.valid_records(records.scan_record_files(spark, raw), start="2000-01-01")
    assert sorted(map(repr, seen.records(spark).collect())) == sorted(map(repr, want.collect()))
    ledger = {(r.file.rsplit("/", 1)[1], r.reason): r for r in seen.ledger(spark).collect()}
    assert {k: r.records for k, r in ledger.items()} | {("blank.json", "not a list"): 1} == {
        ("data.json", "date"): 1, ("data.json", "identity"): 1, ("data.json", "before start"): 1,
        ("part_1_2.json", "partial batch"): 1, ("object.json", "not a list"): 1, ("broken.json", "unreadable"): 1,
        ("none.json", "no records"): 1, ("blank.json", "not a list"): 1}
    assert json.loads(ledger["data.json", "date"].example)["fecha"] == "bad"
    assert seen.skipped == sum(r.outcome == "skipped" for r in ledger.values())


def test_nothing_accepted_raises_after_writing_the_ledger(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{**GOOD, "fecha": None}]))
    with pytest.raises(ValueError, match="1 rejected"):
        intake.take_in(spark, str(tmp_path), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert intake.take_in(spark, str(tmp_path), str(tmp_path / "more"), pattern="a.json", require=False).accepted == 0


def turns(spark, n=700):
    rng, rows = random.Random(4), []
    for i in range(n):
        day = dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(800))
        turn = 0 if i < 400 else 1 + (i % 2)
        rows.append((rng.choice("AB") if turn == 1 else rng.choice("ABCD"), day, turn, i, f"part_{rng.randrange(3)}", rng.random()))
    rows += [("E", dt.date(2020, 5, 1), 2, n, "part_0", 1.0)] * 3 + [(None, dt.date(2020, 5, 1), 1, n + 1, "part_0", 1.0)]
    return spark.createDataFrame(rows, "s string, day date, t int, position long, batch_id string, value double").withColumn(
        "year", F.year("day"))


def whole(rows):
    kept = keep_first(rows, ["s", "year", "day"], [F.desc("t"), F.desc("batch_id"), F.desc("position")])
    return sorted(map(repr, kept.select("s", "day", "value", "year").collect()))


def merged(spark, root):
    return sorted(map(repr, generations.read(spark, root, **KEYS).select("s", "day", "value", "year").collect()))


def test_reader_equals_compaction_before_and_after(spark, tmp_path):
    rows, root = turns(spark), str(tmp_path)
    with pytest.raises(ValueError):
        generations.read(spark, root, **KEYS)
    assert generations.compact(spark, root, **KEYS) is None and generations.vacuum(spark, root, series="s") == []
    for turn in range(3):
        batch = rows.where(F.col("t") == turn).drop("t")
        generations.land(batch, root, turn)
        generations.land(batch, root, turn)  # again: replaced
        want = whole(rows.where(F.col("t") <= turn))
        assert merged(spark, root) == want
        assert generations.compact(spark, root, share=0.9, **KEYS) is not None
        assert merged(spark, root) == want
        generations.compact(spark, root, share=0.6, **KEYS)  # other pairs of the same turn
        assert merged(spark, root) == want
    generations.vacuum(spark, root, series="s")
    assert merged(spark, root) == whole(rows)
    with pytest.raises(ValueError):
        generations.land(rows.drop("t"), root, 2)


def test_only_pairs_over_the_rule_are_rewritten(spark, tmp_path):
    rows, root = turns(spark), str(tmp_path)
    generations.land(rows.where("t = 0").drop("t"), root, 0)
    generations.compact(spark, root, **KEYS)
    base = {(r.s, r.year): r["count"] for r in rows.where("t = 0").select("s", "year", "day").distinct().groupBy("s", "year").count().collect()}
    generations.land(rows.where("t = 1").drop("t"), root, 1)
    fresh = {(r.s, r.year): r["count"] for r in rows.where("t = 1").groupBy("s", "year").count().collect()}
    generations.compact(spark, root, share=0.9, **KEYS)
    due = {p for p, n in fresh.items() if p[0] and n > 0.9 * base.get(p, 0)}  # a row without a series stays open
    assert due and due != {p for p in fresh if p[0]}
    written = {(r.s, r.year) for r in spark.read.parquet(f"{root}/master").where("gen = 1").select("s", "year").distinct().collect()}
    assert written == due == {(r.s, r.year) for r in spark.read.parquet(f"{root}/pairs").where("gen = 1").collect()}
    assert merged(spark, root) == whole(rows.where("t < 2"))
    assert generations.vacuum(spark, root, series="s") == [f"{root}/landed/turn=0"]
    assert merged(spark, root) == whole(rows.where("t < 2"))


def test_untouched_pairs_are_not_shuffled(spark, tmp_path):
    """The master meets the touched pairs by broadcast; only the merge of touched pairs shuffles by day."""
    rows, root = turns(spark), str(tmp_path)
    generations.land(rows.where("t = 0").drop("t"), root, 0)
    generations.compact(spark, root, **KEYS)
    generations.land(landing.as_batch(rows.where("t = 1").drop("t", "batch_id", "position", "year"),
                                      F.col("day"), F.col("day"), F.lit(1).cast("bigint")), root, 1)
    plan = generations.read(spark, root, **KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
