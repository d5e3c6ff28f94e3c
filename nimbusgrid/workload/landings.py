"""Source, landing, subscription and streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.session import staging_path
from nimbusgrid.sources import generations, intake, landing, reanalysis, records, storage, subscriptions
from nimbusgrid.streaming import landing as streaming
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.formulas import _VALID, RAW_RECORDS, raw_records
from nimbusgrid.workload.registry import ORACLES, query
from nimbusgrid.workload.serving import _SUBSCRIPTIONS_SQL, _subscriptions

#: Rows of one written document or file, about.
FILE_ROWS = 20_000


def _pieces(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def _lists(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(value): JSON lists of about ``FILE_ROWS`` rows, so there are as many as the rows ask for, however many keys.

    The rows of a key stay together unless what is dealt to its list is more than ``FILE_ROWS``.
    """
    lists = _pieces(rows.count())
    numbered = rows.withColumn("_list", F.pmod(F.xxhash64(*keys or [F.lit(0)]), F.lit(lists)))
    large = numbered.groupBy("_list").count().where(F.col("count") > FILE_ROWS).select(
        F.col("_list").alias("_large"), F.ceil(F.col("count") / FILE_ROWS).alias("_pieces"))
    # at most one large list for every FILE_ROWS rows
    dealt = numbered.join(F.broadcast(large), F.col("_list") == F.col("_large"), "left").withColumn(
        "_piece", F.pmod(F.xxhash64(*columns), F.coalesce("_pieces", F.lit(1))))
    return dealt.groupBy("_list", "_piece").agg(F.to_json(F.collect_list(F.struct(*columns))).alias("value")).select("value")


_VALID_SQL = f"""WITH {RAW_RECORDS}
SELECT try_cast(fecha AS DATE) AS fecha, indicativo, nombre, provincia, altitud, tmed, prec, dir
FROM raw WHERE try_cast(fecha AS DATE) >= DATE '1996-01-01' AND indicativo IS NOT NULL"""


@query(_VALID_SQL)
def record_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records written as line-delimited JSON, scanned back and held to the contract."""
    path = staging_path(spark, "records")
    raw_records(spark, sf).write.json(path)
    scanned = records.scan_record_lines(spark, path)
    return records.valid_records(scanned, start="1996-01-01").select(*_VALID)


_PLANNED_SQL = """planned AS (SELECT s_suppkey, CAST(g.w AS DATE) AS window_start,
  least(CAST(g.w + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE), DATE '2001-07-31') AS window_end
  FROM supplier, generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 6 MONTH) g(w)
  WHERE g.w < TIMESTAMP '2001-07-31')"""


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = fr.table(spark, sf, "supplier").select("s_suppkey")
    return landing.request_windows(suppliers, fr.ORDER_START, fr.ORDER_END)


@query(f"WITH {_PLANNED_SQL} SELECT s_suppkey, window_start, window_end FROM planned")
def request_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _planned(spark, sf)


@query("""WITH planned AS (SELECT c_custkey, CAST(g.w AS DATE) AS window_start,
  least(CAST(g.w + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE), DATE '2001-07-31') AS window_end
  FROM customer, generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 6 MONTH) g(w)
  WHERE g.w < TIMESTAMP '2001-07-31')
SELECT c_custkey, window_start, window_end FROM planned ANTI JOIN (
  SELECT o_custkey AS c_custkey, make_date(year(o_orderdate), CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 7 END, 1)
    AS window_start FROM orders) USING (c_custkey, window_start)""")
def gap_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Half-year windows in which a customer ordered nothing."""
    day = F.col("o_orderdate")
    opened = F.make_date(F.year(day), F.when(F.month(day) < 7, 1).otherwise(7), F.lit(1))
    landed = fr.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), opened.alias("window_start"))
    customers = fr.table(spark, sf, "customer").select("c_custkey")
    planned = landing.request_windows(customers, fr.ORDER_START, fr.ORDER_END)
    return landing.gap_ledger(planned, landed, ["c_custkey", "window_start"])


@query(f"""WITH {_PLANNED_SQL}
SELECT s_suppkey, window_start, least(window_end, DATE '2000-03-15') AS window_end FROM planned
WHERE window_start <= DATE '2000-03-15'""")
def clamped_requests(spark: SparkSession, sf: str) -> DataFrame:
    return landing.clamp_request(_planned(spark, sf), "window_start", "window_end",
                                 today=F.lit("2000-03-15").cast("date"))


def _order_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = fr.table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_totalprice")
    month = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(7)
    opened = F.make_date(F.year("day"), month, F.lit(1))
    return landing.as_batch(rows, opened, F.date_sub(F.add_months(opened, 6), 1),
                            F.col("o_orderkey"))


@query("""SELECT o_custkey, CAST(year(day) AS INTEGER) AS year, day, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, day
    ORDER BY o_orderkey % 2 DESC, o_orderkey DESC) AS rn
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)) WHERE rn = 1""")
def landing_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as half-year batches, then compacted to one record per customer and day."""
    parts, master = staging_path(spark, "landing"), staging_path(spark, "master")
    landing.land_batch(_order_batches(spark, sf), parts)
    landing.consolidate(spark, parts, master, series="o_custkey", date="day")
    return spark.read.parquet(master).select(
        "o_custkey", "year", "day", "o_orderkey", "o_totalprice")


@query("""SELECT o_custkey, CAST(year(day) AS INTEGER) AS year, day, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, day
    ORDER BY o_orderkey % 3 DESC, o_orderkey % 2 DESC, o_orderkey DESC) AS rn
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)) WHERE rn = 1""")
def landing_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in three rounds, each compacted into the master the rounds before left."""
    parts, master = staging_path(spark, "landing"), staging_path(spark, "master")
    for turn in range(3):
        landing.land_batch(_order_batches(spark, sf).filter(F.col("o_orderkey") % 3 == turn), parts)
        landing.consolidate(spark, parts, master, series="o_custkey", date="day")
    return spark.read.parquet(master).select(
        "o_custkey", "year", "day", "o_orderkey", "o_totalprice")


def _generations(spark: SparkSession, sf: str, compacted: Sequence[int]) -> str:
    """Orders landed in three turns, some followed by a compaction of the pairs half renewed."""
    root = staging_path(spark, "generations")
    for turn in range(3):
        generations.land(_order_batches(spark, sf).filter(F.col("o_orderkey") % 3 == turn), root, turn)
        if turn in compacted:
            generations.compact(spark, root, share=0.5, series="o_custkey", date="day")
    return root


@query(ORACLES["landing_merge"])
def merge_on_read(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed in three turns, the first two compacted by rule, merged as they are read."""
    found = generations.read(spark, _generations(spark, sf, (0, 1)), series="o_custkey", date="day")
    return found.select("o_custkey", "year", "day", "o_orderkey", "o_totalprice")


@query("""WITH d AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) AS day,
  o_orderkey % 3 AS turn FROM orders),
p AS (SELECT o_custkey, year, count(DISTINCT day) FILTER (turn = 0) AS base, count(*) FILTER (turn = 1) AS fresh,
  count(DISTINCT day) FILTER (turn < 2) AS merged FROM d GROUP BY ALL)
SELECT o_custkey, year, 0 AS gen, base AS rows, 0 AS upto FROM p WHERE base > 0
UNION ALL SELECT o_custkey, year, 1, merged, 1 FROM p WHERE fresh > 0.5 * base""")
def compacted_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The customers and years that two compactions rewrote: all, then those half renewed."""
    return spark.read.parquet(f"{_generations(spark, sf, (0, 1))}/pairs").select("o_custkey", "year", "gen", "rows", "upto")


@query(f"""WITH {fr.COVERED_USERS},
placed AS (SELECT user_id, day, floor(value * 8 + 0.0003) / 8 AS value,
  row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM dense)
SELECT user_id, day, greatest(round_even(value * 700 / 3600.0::DOUBLE * 100, 0) / 100, 0) AS sol,
  CASE WHEN value IS NOT NULL THEN greatest(round_even((value - 5) * 10, 0) / 10, 0) END AS om_prec,
  round_even((value + 1000) * 10, 0) / 10 AS presion,
  CASE WHEN value IS NOT NULL THEN least(greatest(round_even(value * 1, 0) / 1, 0), 100) END AS nubes
FROM placed WHERE rn <= CASE WHEN user_id % 3 = 0 THEN 25 ELSE 30 END
  AND value IS NOT NULL
UNION ALL SELECT user_id, day, NULL, NULL, NULL, NULL FROM placed
WHERE rn <= CASE WHEN user_id % 3 = 0 THEN 25 ELSE 30 END AND value IS NULL""")
def reanalysis_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Parallel arrays per user on an epoch axis, some with a short axis, as daily rows."""
    rows = F.sort_array(F.collect_list(F.struct("day", "value")))  # 30 days per user
    days = fr.covered_users(spark, sf).withColumn(
        "value", F.floor(F.col("value") * 8 + 0.0003) / 8)
    values = days.groupBy("user_id").agg(rows.alias("r")).select(
        "user_id", F.col("r.value").alias("v"))
    first = 1704067200
    length = F.when(F.col("user_id") % 3 == 0, 25).otherwise(30)
    payload = values.select(
        "user_id", F.lit(first).cast("bigint").alias("start"),
        (F.lit(first) + length * 86400).cast("bigint").alias("end"),
        F.lit(86400).cast("bigint").alias("step"),
        F.transform("v", lambda x: x * 700).alias("sunshine"),
        F.transform("v", lambda x: x - 5).alias("precipitation"),
        F.transform("v", lambda x: x + 1000).alias("pressure"), F.col("v").alias("cloud"))
    return reanalysis.decode(payload, **fr.USER)


_CSV = ["fecha", "indicativo", "nombre", "provincia", "altitud", "tmed", "prec", "tmin", "tmax",
        "dir", "velmedia", "racha", "hrMedia"]


@query(f"WITH {fr.STATION_DAYS} SELECT {', '.join(chr(34) + c + chr(34) for c in _CSV)} FROM station_days")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The station table written as sorted CSV and scanned back with its schema."""
    days = fr.station_days(spark, sf).select(*_CSV)
    path = staging_path(spark, "csv")
    storage.write_table(days, path, "csv")
    return storage.read_table(spark, path, "csv", days.schema)


@query(f"""WITH {_SUBSCRIPTIONS_SQL},
changes AS (SELECT CAST(o_orderkey // 2 AS VARCHAR) AS telegram_id, 'NATION_' || (o_orderkey % 25) AS station_code,
  o_orderpriority AS station_name, o_orderdate AS moment FROM orders),
folded AS (SELECT telegram_id, station_code AS sc, station_name AS sn, first_at, moment AS last_at FROM (
  SELECT *, min(moment) OVER (PARTITION BY telegram_id) AS first_at, row_number() OVER (
    PARTITION BY telegram_id ORDER BY moment DESC, station_code DESC, station_name DESC) AS rn FROM changes)
  WHERE rn = 1)
SELECT telegram_id, coalesce(sc, station_code) AS station_code, coalesce(sn, station_name) AS station_name,
  coalesce(active, true) AS active, coalesce(created_at, first_at) AS created_at,
  coalesce(last_at, updated_at) AS updated_at FROM subs FULL JOIN folded USING (telegram_id)""")
def subscription_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two changes per id; some ids are known, the rest are new."""
    c = F.col
    changes = fr.table(spark, sf, "orders").select(
        F.expr("o_orderkey div 2").cast("string").alias("telegram_id"),
        F.concat(F.lit("NATION_"), (c("o_orderkey") % 25).cast("string")).alias("station_code"),
        c("o_orderpriority").alias("station_name"), c("o_orderdate").alias("at"))
    return subscriptions.upsert(_subscriptions(spark, sf), changes)


@query(_VALID_SQL)
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON records landed by a file stream that stops when it has caught up."""
    source, sink = staging_path(spark, "incoming"), staging_path(spark, "landed")
    raw_records(spark, sf).write.json(source)
    stream = streaming.record_stream(spark, source, start="1996-01-01")
    streaming.land(stream, sink, staging_path(spark, "stream")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink).select(*_VALID)


@query("""SELECT user_id, day, event_id, ts, value FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts, value, row_number() OVER (
    PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def stream_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Events streamed in as three micro-batches, each merged into the latest per (user, day)."""
    events, source = fr.table(spark, sf, "events"), staging_path(spark, "events")
    files = _pieces(events.count() // 3)
    for turn in range(3):
        events.filter(F.col("event_id") % 3 == turn).repartition(files).write.mode("append").parquet(source)
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(source)
              .select("user_id", F.col("ts").cast("date").alias("day"), "event_id", "ts", "value"))
    master = staging_path(spark, "latest")
    streaming.compact_into(
        stream, master, staging_path(spark, "stream"), keys=["user_id", "day"],
        newest_first=["ts", "event_id"], partition_by="day").awaitTermination()
    return spark.read.schema(stream.schema).parquet(master)


@query(_VALID_SQL)
def record_files(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records written as one JSON list per file, scanned back and held to the contract."""
    path = staging_path(spark, "documents")
    # A document holds some stations' records, or a part of many; partial batches and other shapes beside it are skipped.
    raw = raw_records(spark, sf)
    documents = _lists(raw, ["indicativo"], raw.columns)
    documents.write.option("maxRecordsPerFile", 1).text(path)
    scanned = records.scan_record_files(spark, path, pattern="*.txt")
    return records.valid_records(records.require_rows(scanned), start="1996-01-01").select(*_VALID)


def _intake(spark: SparkSession, sf: str) -> intake.Intake:
    """Raw records as lists in files, nations as objects beside them, taken in by one pass."""
    path = staging_path(spark, "documents")
    raw = raw_records(spark, sf)
    _lists(raw, ["indicativo"], raw.columns).write.option("maxRecordsPerFile", 1).text(path)
    objects = fr.table(spark, sf, "nation").select(F.to_json(F.struct("*")).alias("value"))
    objects.write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return intake.take_in(spark, path, staging_path(spark, "intake"), start="1996-01-01", pattern="*.txt")


@query(_VALID_SQL)
def intake_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records accepted by the pass that also writes the ledger."""
    return _intake(spark, sf).records(spark).select(*_VALID)


@query(f"""WITH {RAW_RECORDS},
judged AS (SELECT CASE WHEN try_cast(fecha AS DATE) IS NULL THEN 'date' WHEN indicativo IS NULL THEN 'identity'
  WHEN try_cast(fecha AS DATE) < DATE '1996-01-01' THEN 'before start' END AS reason FROM raw)
SELECT 'rejected' AS outcome, reason, count(*) AS records FROM judged WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'skipped', 'not a list', count(*) FROM nation
UNION ALL SELECT 'accepted', 'observed', count(*) FROM judged WHERE reason IS NULL
UNION ALL SELECT 'rejected', 'observed', count(*) FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT 'skipped', 'observed', count(*) FROM nation""")
def intake_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What was rejected and skipped by reason, and the counts observed while it was written."""
    seen = _intake(spark, sf)
    reasons = seen.ledger(spark).groupBy("outcome", "reason").agg(F.sum("records").alias("records"))
    observed = [F.struct(F.lit(o).alias("outcome"), F.lit("observed").alias("reason"), F.lit(n).cast("bigint").alias("records"))
                for o, n in (("accepted", seen.accepted), ("rejected", seen.rejected), ("skipped", seen.skipped))]
    return reasons.unionByName(spark.range(1).select(F.inline(F.array(*observed))))


@query(f"""WITH {_SUBSCRIPTIONS_SQL} SELECT telegram_id, station_code, station_name, active, created_at, updated_at
FROM subs""")
def subscription_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Subscriptions written as JSON lists and loaded back; a missing file loads as empty."""
    path = staging_path(spark, "subscriptions")
    _lists(_subscriptions(spark, sf), [], ["telegram_id", "station_code", "station_name", "active", "created_at", "updated_at"]
           ).write.option("maxRecordsPerFile", 1).text(path)
    missing = subscriptions.load(spark, f"{path}-missing")
    return subscriptions.load(spark, path).unionByName(missing)
