import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from nimbusgrid import session
from nimbusgrid.plans.clean import build_clean_table
from nimbusgrid.sources import landing, reanalysis, records, storage, subscriptions
from nimbusgrid.streaming import landing as streaming

D = dt.date
GOOD = {"fecha": "2024-01-01", "indicativo": "X", "nombre": "N", "provincia": "P", "tmed": "10,5", "extra": 1}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "Station_X_N" / "2024"
    folder.mkdir(parents=True)
    docs = {
        "data_2024.json": json.dumps([GOOD, {**GOOD, "fecha": "bad"}, {**GOOD, "fecha": "1999-01-01"},
                                      {"fecha": "2024-01-02"}], indent=4),
        "part_1_2.json": json.dumps([{**GOOD, "nombre": "part"}]),
        "object.json": json.dumps({**GOOD, "nombre": "object"}),
        "broken.json": json.dumps([GOOD])[:40],
        "notes.txt": json.dumps([GOOD]),
    }
    for name, text in docs.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


def test_record_files(spark, raw):
    scanned = records.scan_record_files(spark, raw)
    (row,) = records.valid_records(scanned).collect()
    assert (row.fecha, row.nombre, row.tmed, row.prec) == (D(2024, 1, 1), "N", 10.5, None)
    assert records.rejected_records(scanned).filter("fecha is not null").count() == 2


def test_record_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD) + "\n" + json.dumps([GOOD, {**GOOD, "tmed": "Ip"}]) + "\n")
    rows = records.valid_records(records.scan_record_lines(spark, str(tmp_path))).collect()
    assert sorted(r.tmed for r in rows) == [0.05, 10.5, 10.5]


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError):
        records.require_rows(spark.createDataFrame([], records.RAW_SCHEMA))


def test_clean_table_round_trip(spark, raw, tmp_path):
    for fmt in ("parquet", "csv"):
        out = build_clean_table(spark, raw, str(tmp_path / fmt), fmt=fmt, start="2024-01-01",
                                end="2024-01-05", min_coverage=None)
        got = out.orderBy("fecha").collect()
        assert [r.tmed for r in got] == [10.5] * 5 and [r.tmed_est for r in got] == [0, 1, 1, 1, 1]


def test_request_windows(spark):
    stations = spark.createDataFrame([("X",)], "indicativo string")
    got = [tuple(r)[1:] for r in landing.request_windows(stations, "2009-01-01", "2010-03-31").orderBy("window_start").collect()]
    assert got == [(D(2009, 1, 1), D(2009, 6, 30)), (D(2009, 7, 1), D(2009, 12, 31)), (D(2010, 1, 1), D(2010, 3, 31))]
    # a window that would open on the last day itself is not planned
    assert landing.request_windows(stations, "2009-01-01", "2009-07-01").count() == 1
    assert landing.request_windows(stations).count() == 34
    assert landing.request_windows(stations, "2010-01-01", "2009-01-01").count() == 0
    late = [tuple(r)[1:] for r in landing.request_windows(stations, "2009-08-31", "2010-09-30").orderBy("window_start").collect()]
    assert late == [(D(2009, 8, 31), D(2010, 2, 27)), (D(2010, 2, 28), D(2010, 8, 27)), (D(2010, 8, 28), D(2010, 9, 30))]
    planned = landing.request_windows(stations, "2009-01-01", "2010-03-31")
    assert landing.gap_ledger(planned, planned.filter("window_start = '2009-07-01'")).count() == 2


def test_clamped_requests(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 6, 1)), (D(2025, 1, 1), D(2025, 6, 1))], "start date, end date")
    got = landing.clamp_request(df, today=F.lit("2024-03-01").cast("date")).collect()
    assert [tuple(r) for r in got] == [(D(2024, 1, 1), D(2024, 3, 1))]


def test_consolidate(spark, tmp_path, monkeypatch):
    parts, master = str(tmp_path / "parts"), str(tmp_path / "master")
    schema = "indicativo string, fecha date, v int"

    def land(rows, start, end):
        df = spark.createDataFrame(rows, schema)
        landing.land_batch(landing.as_batch(df, F.lit(start).cast("date"), F.lit(end).cast("date"), F.col("v").cast("bigint")), parts)

    land([("X", D(2024, 1, 1), 1), ("X", D(2024, 1, 1), 2), ("X", D(2024, 1, 2), 3)], "2024-01-01", "2024-06-30")
    land([("X", D(2024, 1, 2), 4)], "2024-07-01", "2024-12-31")
    real_delete = storage.delete_files

    def late_batch_arrives(session, files):
        land([("Z", D(2024, 7, 1), 7)], "2024-07-01", "2024-12-31")
        real_delete(session, files)

    monkeypatch.setattr(storage, "delete_files", late_batch_arrives)
    landing.consolidate(spark, parts, master)
    monkeypatch.setattr(storage, "delete_files", real_delete)
    def read():
        return {(r.indicativo, r.fecha): r.v for r in spark.read.parquet(master).collect()}
    assert read() == {("X", D(2024, 1, 1)): 2, ("X", D(2024, 1, 2)): 4}
    assert [r.indicativo for r in spark.read.parquet(parts).collect()] == ["Z"]  # the late batch only
    land([("X", D(2024, 1, 2), 9), ("X", D(2024, 1, 3), 1)], "2024-01-01", "2024-06-30")
    land([("X", D(2025, 1, 1), 5)], "2025-01-01", "2025-06-30")
    landing.consolidate(spark, parts, master, include_existing=True)
    assert read() == {("X", D(2024, 1, 1)): 2, ("X", D(2024, 1, 2)): 9, ("X", D(2024, 1, 3)): 1,
                      ("X", D(2025, 1, 1)): 5, ("Z", D(2024, 7, 1)): 7}


def test_reanalysis_decode(spark):
    schema = "indicativo string, start long, end long, step long, sunshine array<double>, precipitation array<double>, pressure array<double>, cloud array<double>"
    df = spark.createDataFrame([
        ("a", 1672531200, 1672704000, 86400, [3600.0, 7200.0, 9.0], [0.0, 5.0], [1013.0, 1010.0], [10.0, 80.0]),
        ("b", 1672531200, 1672704001, 86400, [3600.0], [-1.0], [1013.04], [101.0]),
        ("c", 1672531200, 1672531200, 86400, [3600.0], [0.0], [1.0], [1.0])], schema)
    got = sorted(tuple(r) for r in reanalysis.decode(df).collect())
    assert got == [("a", D(2023, 1, 1), 1.0, 0.0, 1013.0, 10.0), ("a", D(2023, 1, 2), 2.0, 5.0, 1010.0, 80.0),
                   ("b", D(2023, 1, 1), 1.0, 0.0, 1013.0, 100.0)]


def test_subscriptions(spark, tmp_path):
    path = tmp_path / "subs.json"
    assert subscriptions.load(spark, str(path)).count() == 0
    path.write_text("{not json")
    assert subscriptions.load(spark, str(path)).count() == 0
    path.write_text(json.dumps([{"telegram_id": "111", "station_code": "0076", "station_name": "A", "active": False,
                                 "created_at": "2024-01-01T10:00:00", "updated_at": "2024-01-01T10:00:00"}]))
    base = subscriptions.load(spark, str(path))
    at = dt.datetime(2024, 5, 1)
    changes = spark.createDataFrame([("111", "zz", "Z", at), ("222", "a", "A", at), ("222", "b", "B", at + dt.timedelta(1))],
                                    "telegram_id string, station_code string, station_name string, at timestamp")
    got = {r.telegram_id: r for r in subscriptions.upsert(base, changes).collect()}
    assert (got["111"].station_code, got["111"].active, got["111"].created_at) == ("zz", False, dt.datetime(2024, 1, 1, 10))
    assert got["111"].updated_at == at
    assert (got["222"].station_code, got["222"].active, got["222"].created_at) == ("b", True, at)
    table = str(tmp_path / "table")
    subscriptions.upsert(base, changes).write.parquet(table)
    again = spark.read.parquet(table)
    storage.replace_table(subscriptions.upsert(again, changes), table)
    assert spark.read.parquet(table).count() == 2


@pytest.mark.parametrize("text,expected", [(" 123 ", "123"), ("12a", None), ("", None), ("-1", None)])
def test_subscriber_id(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(subscriptions.clean_id(F.col("t"))).first()[0] == expected


def test_streams(spark, tmp_path):
    source, landed, master = (str(tmp_path / n) for n in ("in", "landed", "master"))
    (tmp_path / "in").mkdir()
    def arrive(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({**GOOD, **r}) for r in rows) + "\n")
    def catch_up():
        stream = streaming.record_stream(spark, source)
        streaming.land(stream, landed, str(tmp_path / "c1")).awaitTermination()
        typed = spark.readStream.schema(stream.schema).parquet(landed).select(
            F.year("fecha").alias("year"), "fecha", "indicativo", "tmed", "batch_id")
        streaming.compact_into(typed, master, str(tmp_path / "c2"), keys=["indicativo", "fecha"],
                               newest_first=["batch_id", "tmed"], partition_by="year").awaitTermination()
        return {(r.indicativo, r.fecha): r.tmed for r in spark.read.parquet(master).collect()}
    arrive("b1.json", [{"tmed": "1,0"}, {"tmed": "2,0", "fecha": "2023-05-01"}, {"fecha": "bad"}])
    assert catch_up() == {("X", D(2024, 1, 1)): 1.0, ("X", D(2023, 5, 1)): 2.0}
    arrive("b2.json", [{"tmed": "0,5"}, {"tmed": "7,0", "indicativo": "Y"}])
    assert catch_up() == {("X", D(2024, 1, 1)): 0.5, ("Y", D(2024, 1, 1)): 7.0, ("X", D(2023, 5, 1)): 2.0}
    assert catch_up() == {("X", D(2024, 1, 1)): 0.5, ("Y", D(2024, 1, 1)): 7.0, ("X", D(2023, 5, 1)): 2.0}


def test_shared_folder_follows_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.staging_path(spark, "x") != session.staging_path(spark, "x")


def _land(spark, folder, rows, batch):
    df = spark.createDataFrame(rows, "indicativo string, fecha string, v int").withColumn("fecha", F.col("fecha").cast("date"))
    landing.land_batch(df.withColumns({"batch_id": F.lit(batch), "year": F.year("fecha"),
                                       "position": F.lit(0).cast("bigint")}), folder)


@pytest.mark.parametrize("include_existing", [True, False])
def test_consolidate_keeps_what_did_not_land(spark, tmp_path, include_existing):
    parts, master = str(tmp_path / "parts"), str(tmp_path / "master")
    _land(spark, parts, [("A", "2020-01-01", 1), ("B", "2020-01-01", 2), ("A", "2021-05-05", 3)], "part_1")
    landing.consolidate(spark, parts, master)
    _land(spark, parts, [("A", "2020-01-02", 4), ("A", "2020-01-01", 5)], "part_0")
    landing.consolidate(spark, parts, master, include_existing=include_existing)
    want = {("A", "2020-01-01", 5), ("A", "2020-01-02", 4), ("B", "2020-01-01", 2), ("A", "2021-05-05", 3)}

    def rows():
        return {(r.indicativo, str(r.fecha), r.v) for r in spark.read.parquet(master).collect()}
    assert rows() == want
    landing.consolidate(spark, parts, master)  # nothing landed since: nothing happens
    assert rows() == want
    _land(spark, parts, [("A", "2020-01-03", 6)], "part_2")
    landing.consolidate(spark, parts, master, include_existing=include_existing)
    assert rows() == (want | {("A", "2020-01-03", 6)} if include_existing else
                      {("A", "2020-01-03", 6), ("B", "2020-01-01", 2), ("A", "2021-05-05", 3)})


def test_master_scan_is_pruned(spark, tmp_path):
    master = str(tmp_path / "master")
    spark.createDataFrame([(y, y) for y in range(2000, 2010)], "year int, v int").write.partitionBy("year").parquet(master)
    touched = spark.createDataFrame([(2003, 1), (2004, 1)], "year int, v int")
    for df in (landing.between(spark.read.parquet(master), "year", touched),
               streaming.master_part(spark, master, touched, "year")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "2003" in filters and "2004" in filters
        assert sorted(r.year for r in df.collect()) == [2003, 2004]


def test_stream_compaction_merges_micro_batches(spark, tmp_path):
    source, master = str(tmp_path / "in"), str(tmp_path / "master")
    schema = "user int, day string, at int"
    for rows in ([(1, "a", 1), (2, "a", 1)], [(1, "a", 3), (1, "b", 1)], [(1, "a", 2), (3, "c", 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = streaming.compact_into(stream, master, str(tmp_path / "check"), keys=["user", "day"], newest_first=["at"], partition_by="day")
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    got = {(r.user, r.day, r.at) for r in spark.read.schema(schema).parquet(master).collect()}
    assert got == {(1, "a", 3), (2, "a", 1), (1, "b", 1), (3, "c", 1)}
