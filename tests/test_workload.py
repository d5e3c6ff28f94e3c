"""Every registered query with a SQL check, against DuckDB on the smallest tables."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from nimbusgrid.workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


#: Read the published models: the smallest tables cover no station well enough to train on.
PUBLISHED = {"beats_mean", "boosting_blocks", "final_checks", "onestep_checks", "onestep_days", "rain_beats_rate",
             "rollout_actuals", "rollout_days", "training_rows", "week_checks"}


@pytest.mark.parametrize("name", sorted(set(driver.oracle_sql()) - PUBLISHED))
def test_query_matches_sql(spark, duck, name):
    same(driver.queries()[name](spark, SF), duck, name)


def same(df, duck, name):
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_published_query_matches_sql(spark, name):
    duckdb, sf = pytest.importorskip("duckdb"), SF.replace("0.001", "0.01")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    same(driver.queries()[name](spark, sf), con, name)


def test_entry(spark):
    assert driver.entry(spark).columns == ["user_id", "day", "value_est", "value", "value_roll_3", "value_roll_7"]


def test_queries_without_sql_are_the_models():
    assert set(QUERIES) - set(ORACLES) == {
        "fitted_models", "feature_importance", "final_forecast", "onestep_forecast", "recursive_forecast",
        "forecast_report", "rollout_drift", "stored_week"}


def test_merge_of_repeated_keys_holds_whole_tables(spark):
    got = driver.queries()["outer_merge_lines"](spark, SF)
    orders, lineitem = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    assert got.select("key").distinct().count() == orders.select("o_orderkey").union(lineitem.select("l_orderkey")).distinct().count()
    assert got.where("line IS NOT NULL").select("key", "line").distinct().count() == (
        lineitem.select("l_orderkey", "l_linenumber").distinct().count())
    assert got.where("line IS NULL").count() == orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey, "left_anti").count() > 0


@pytest.mark.parametrize("name", ["record_files", "stream_compaction", "subscription_scan"])
def test_written_files_have_bounded_rows(spark, duck, monkeypatch, name):
    from nimbusgrid.workload import landings
    monkeypatch.setattr(landings, "FILE_ROWS", 10)
    paths = []
    staged = landings.staging_path
    monkeypatch.setattr(landings, "staging_path", lambda *a: paths.append((a[1], staged(*a))) or paths[-1][1])
    df = driver.queries()[name](spark, SF)
    path = dict(paths)[{"record_files": "documents", "stream_compaction": "events", "subscription_scan": "subscriptions"}[name]]
    if name == "stream_compaction":
        held = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    else:
        held = spark.read.text(path).select(F.size(F.from_json("value", "array<map<string,string>>")).alias("count"))
    assert held.agg(F.max("count")).first()[0] <= 30  # about FILE_ROWS, dealt by hash
    same(df, duck, name)


@pytest.mark.parametrize("rows", [100, 20_000])
def test_files_are_as_many_as_rows_ask_for(spark, monkeypatch, rows):
    """Not as many as there are stations: these were a file each."""
    from nimbusgrid.workload import landings
    monkeypatch.setattr(landings, "FILE_ROWS", rows)
    records = spark.range(1500).selectExpr("if(id % 30 = 0, null, cast(id % 500 as string)) AS station", "cast(id as string) AS day")
    lists = landings._lists(records, ["station"], ["station", "day"]).selectExpr(
        "from_json(value, 'array<struct<station: string, day: string>>') AS found").cache()
    assert lists.count() <= 2 * -(-1500 // rows)
    back = lists.selectExpr("inline(found)")
    assert sorted(map(str, back.collect())) == sorted(map(str, records.collect()))
