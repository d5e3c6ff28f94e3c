"""State that batches maintain, against the same figures from all records."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbusgrid.operators import panel, quantiles, ranking
from nimbusgrid.sources import climatology, dayindex, landing

START, END = dt.date(2019, 12, 20), dt.date(2021, 3, 10)
KEYS = {"series": "s", "date": "day"}


def records(spark, seed, n=900):
    rng = random.Random(seed)
    span = (END - START).days
    rows = [(rng.choice("ABC"), START + dt.timedelta(rng.randrange(-100, span + 50)), i) for i in range(n)]
    return spark.createDataFrame(rows + [("A", None, n), ("D", dt.date(1969, 12, 31), n + 1), ("D", dt.date(1901, 1, 1), n + 2)],
                                 "s string, day date, i int")


@pytest.fixture
def index(spark, tmp_path):
    path, rows = str(tmp_path / "days"), records(spark, 1)
    for turn in (0, 1, 2, 1):
        dayindex.add_batch(rows.filter(F.col("i") % 3 == turn), path, str(turn), **KEYS)
    return path, rows


def test_coverage_from_the_index(spark, index):
    path, rows = index
    want = sorted(map(tuple, panel.coverage(rows, START, END, **KEYS).collect()))
    assert sorted(map(tuple, dayindex.coverage(dayindex.read_index(spark, path, series="s"), START, END, series="s").collect())) == want
    late = rows.filter(F.col("day") >= F.lit(START))
    got = dayindex.coverage(dayindex.read_index(spark, path, series="s"), START, END, since=START, series="s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, panel.coverage(late, START, END, **KEYS).collect()))


def test_fold_changes_nothing_and_may_be_cut_short(spark, index):
    path, rows = index
    before = sorted(map(tuple, dayindex.read_index(spark, path, series="s").collect()))
    dayindex.fold(spark, path, series="s")
    assert len(spark.read.parquet(path).select("batch").distinct().collect()) == 1
    assert sorted(map(tuple, dayindex.read_index(spark, path, series="s").collect())) == before
    dayindex.add_batch(rows.filter("i % 3 = 0"), path, "0", **KEYS)  # as if the fold had not deleted it
    assert sorted(map(tuple, dayindex.read_index(spark, path, series="s").collect())) == before


def test_gaps_and_missing_days(spark, index):
    path, rows = index
    seen = {(r.s, r.day) for r in rows.filter("day is not null").collect()}
    rng = random.Random(2)
    planned = [(s, a, a + dt.timedelta(rng.randrange(0, 70))) for s in "ABCDE" for a in (START + dt.timedelta(rng.randrange(500)) for _ in range(40))]
    windows = spark.createDataFrame(planned, "s string, window_start date, window_end date")
    got = dayindex.gaps(dayindex.read_index(spark, path, series="s"), windows, series="s")
    want = [p for p in planned if not any((p[0], p[1] + dt.timedelta(d)) in seen for d in range((p[2] - p[1]).days + 1))]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    days = [START + dt.timedelta(d) for d in range((END - START).days + 1)]
    empty = dayindex.missing_days(dayindex.read_index(spark, path, series="s"), START, END, **KEYS)
    assert sorted(map(tuple, empty.collect())) == sorted((s, d) for s in "ABCD" for d in days if (s, d) not in seen)


def test_exploded_windows_are_not_broadcast(spark, index, tmp_path):
    path, _ = index
    spark.createDataFrame([(s,) for s in "ABCDE"] + [(None,), ("A",)], "s string").write.parquet(f"{tmp_path}/series")
    planned = landing.request_windows(spark.read.parquet(f"{tmp_path}/series"), str(START), str(END), 1)
    got = dayindex.gaps(dayindex.read_index(spark, path, series="s"), planned, series="s")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    unknown = [r for r in got.collect() if r.s in (None, "E")]
    assert len(unknown) == planned.where("s is null or s = 'E'").count() > 0


def test_plans_read_the_index_only(spark, index, tmp_path):
    path, _ = index
    for df in (dayindex.coverage(dayindex.read_index(spark, path, series="s"), START, END, series="s"),
               dayindex.missing_days(dayindex.read_index(spark, path, series="s"), START, END, **KEYS)):
        assert df.inputFiles() and all("/days/batch=" in f for f in df.inputFiles())


def values(spark, seed, wrong=0.0):
    rng = random.Random(seed)
    days = [START + dt.timedelta(d) for d in range((END - START).days + 1)]
    rows = [(s, d, None if rng.random() < 0.1 else rng.randrange(0, 800) / 8 + wrong) for s in "AB" for d in days if rng.random() < 0.6]
    return spark.createDataFrame(rows, "s string, day date, v double")


def same_fill(spark, rows, state):
    dense = panel.densify(rows, START, END, **KEYS)
    want = panel.fill_with_mean(dense, ["v"], F.dayofyear("day"), series="s")
    want = panel.fill_with_mean(want, ["v"], F.month("day"), series="s")
    kept = climatology.read_state(spark, state, ["v"], series="s")
    got = climatology.fill(dense, kept, ["v"], START, END, **KEYS)
    a, b = ({(r.s, r.day): r.v for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys()
    assert all((a[x] is None) == (b[x] is None) and (a[x] is None or a[x] == pytest.approx(b[x], abs=1e-9)) for x in a)


def test_climatology_after_corrections(spark, tmp_path):
    rows, state = str(tmp_path / "rows"), str(tmp_path / "state")
    truth = values(spark, 3).cache()
    early = truth.filter("day < '2020-08-01'").withColumn("v", F.when(F.dayofmonth("day") < 4, None).otherwise(F.col("v") + 100))
    climatology.apply_batch(spark, early, rows, state, "a", ["v"], **KEYS)
    climatology.apply_batch(spark, truth.filter("day >= '2020-07-01'"), rows, state, "b", ["v"], **KEYS)
    climatology.apply_batch(spark, truth.filter("day < '2020-08-01'"), rows, state, "c", ["v"], **KEYS)
    stored = {(r.s, r.day): r.v for r in spark.read.parquet(rows).collect()}
    assert stored == {(r.s, r.day): r.v for r in truth.collect()}
    same_fill(spark, truth, state)
    climatology.fold(spark, state, ["v"], series="s")
    same_fill(spark, truth, state)


def test_repeated_and_interrupted_batches(spark, tmp_path, monkeypatch):
    rows, state = str(tmp_path / "rows"), str(tmp_path / "state")
    truth = values(spark, 4).cache()
    climatology.apply_batch(spark, truth.withColumn("v", F.col("v") * 2), rows, state, "a", ["v"], **KEYS)
    real = climatology.stage

    def lost(df, label):
        if label == "merged":
            raise RuntimeError("lost")
        return real(df, label)

    monkeypatch.setattr(climatology, "stage", lost)
    with pytest.raises(RuntimeError):  # the delta is written, the rows are not
        climatology.apply_batch(spark, truth, rows, state, "b", ["v"], **KEYS)
    monkeypatch.setattr(climatology, "stage", real)
    for _ in range(2):
        climatology.apply_batch(spark, truth, rows, state, "b", ["v"], **KEYS)
    same_fill(spark, truth, state)
    climatology.fold(spark, state, ["v"], series="s")
    climatology.apply_batch(spark, truth, rows, state, "b", ["v"], **KEYS)  # its delta is in the fold
    same_fill(spark, truth, state)
    climatology.apply_batch(spark, truth.limit(0), rows, state, "none", ["v"], **KEYS)
    same_fill(spark, truth, state)


def test_newest_row_of_a_batch_counts(spark, tmp_path):
    rows, state = str(tmp_path / "rows"), str(tmp_path / "state")
    day = dt.date(2020, 5, 5)
    batch = spark.createDataFrame([("A", day, 1.0, 1), ("A", day, 9.0, 2)], "s string, day date, v double, seq int")
    climatology.apply_batch(spark, batch, rows, state, "a", ["v"], newest_first=[F.desc("seq")], **KEYS)
    got = climatology.read_state(spark, state, ["v"], series="s").first()
    assert (got.sum_v, got.count_v) == (9.0, 1)


PROBABILITIES = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q99": 0.99, "high": 1.0}


def test_bracketed_quantiles_move_few_rows(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(int(g), float(x)) for g, x in zip(rng.integers(0, 2, 60_000), rng.normal(size=60_000))],
                                 "g int, x double").cache()
    moved = []
    got = quantiles.bracketed_quantiles(rows, "x", {"mid": 0.5}, by=["g"], moved=moved)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ranking.exact_quantiles(rows, "x", {"mid": 0.5}, by=["g"]).collect()))
    assert len(moved) == 1 and moved[0] < 0.05 * 60_000


@pytest.mark.parametrize("case", ["few", "ties", "skewed", "null group"])
def test_bracketed_quantiles_are_exact(spark, case):
    rng = random.Random(6)
    rows = {"few": [("a", 1.0), ("a", 2.0), ("b", None), ("c", 7.5)],
            "ties": [("a", float(rng.randrange(3))) for _ in range(5000)],
            "skewed": [("a", rng.random() ** 40) for _ in range(6000)] + [("b", 3.0)],
            "null group": [(None, rng.random()) for _ in range(3000)] + [("a", -1.0), ("a", None)]}[case]
    df = spark.createDataFrame(rows, "g string, x double").cache()
    got = {r.g: tuple(r)[1:] for r in quantiles.bracketed_quantiles(df, "x", PROBABILITIES, by=["g"]).collect()}
    for g, found in got.items():
        held = [x for h, x in rows if h == g and x is not None]
        assert found == pytest.approx([np.quantile(held, p) for p in PROBABILITIES.values()], abs=1e-12)
    assert set(got) == {g for g, x in rows if x is not None}


def test_missed_brackets_are_widened(spark, monkeypatch):
    """A sketch that is plainly wrong costs passes, not the result."""
    rows = spark.createDataFrame([(float(x),) for x in range(4000)], "x double").cache()
    monkeypatch.setattr(quantiles, "_ends", lambda p, margin: (F.lit(5000.0), F.lit(6000.0)) if margin < 1 else (F.lit(None).cast("double"),) * 2)
    moved = []
    got = quantiles.bracketed_quantiles(rows, "x", {"mid": 0.5}, moved=moved)
    assert got.first().mid == 1999.5 and len(moved) > 1
