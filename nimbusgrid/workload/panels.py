"""Panel queries: coverage, densify, fill, audit, the whole clean panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.operators import features, panel, quality
from nimbusgrid.plans.clean import clean_panel as build_clean_panel
from nimbusgrid.sources import landing
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.registry import query

_LAST = "last_value({c} IGNORE NULLS) OVER (PARTITION BY {s} ORDER BY {d} " \
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FIRST = "first_value({c} IGNORE NULLS) OVER (PARTITION BY {s} ORDER BY {d} " \
         "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _last(c: str, s: str, d: str) -> str:
    return _LAST.format(c=c, s=s, d=d)


def _first(c: str, s: str, d: str) -> str:
    return _FIRST.format(c=c, s=s, d=d)


def _line_sql(name: str, source: str, s: str, d: str, cols: list[str], keep: str,
              limit: int) -> str:
    """CTEs that interpolate ``cols`` of ``source`` by row position."""
    q = [c.strip('"') for c in cols]
    known = ", ".join(
        f'{_last(f"CASE WHEN {c} IS NOT NULL THEN i END", s, d)} AS "pi_{n}", '
        f'{_last(c, s, d)} AS "pv_{n}", '
        f'{_first(f"CASE WHEN {c} IS NOT NULL THEN i END", s, d)} AS "ni_{n}", '
        f'{_first(c, s, d)} AS "nv_{n}"' for c, n in zip(cols, q))
    filled = ", ".join(
        f'CASE WHEN {c} IS NOT NULL THEN {c} WHEN i - "pi_{n}" <= {limit} THEN '
        f'CASE WHEN "nv_{n}" IS NULL THEN "pv_{n}" ELSE '
        f'("nv_{n}" - "pv_{n}") / ("ni_{n}" - "pi_{n}") * (i - "pi_{n}") + "pv_{n}" END END '
        f'AS {c}' for c, n in zip(cols, q))
    return f"""{name}_pos AS (SELECT *, row_number() OVER (PARTITION BY {s} ORDER BY {d}) AS i
  FROM {source}),
{name}_known AS (SELECT *, {known} FROM {name}_pos),
{name} AS (SELECT {s}, {d}, {keep}{filled} FROM {name}_known)"""


@query(f"""WITH {fr.COVERED_USERS},
{_line_sql("line", "dense", "user_id", "day", ["value"], "CASE WHEN value IS NULL THEN 1 ELSE 0 END AS value_est, ", 7)}
SELECT user_id, day, value_est, floor((value) * 1000000 + 0.5003) / 1000000 AS value,
  CASE WHEN count(value) OVER w3 = 3 THEN floor((avg(value) OVER w3) * 1000000 + 0.5003) / 1000000 END AS value_roll_3,
  CASE WHEN count(value) OVER w7 = 7 THEN floor((avg(value) OVER w7) * 1000000 + 0.5003) / 1000000 END AS value_roll_7
FROM line
WINDOW w3 AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  w7 AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def panel_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """Daily panel, coverage cut, calendar, flags, interpolation, rolling means."""
    flagged = panel.missing_flags(fr.covered_users(spark, sf), ["value"])
    filled = panel.interpolate(flagged, ["value"], **fr.USER)
    rolled = features.add_rolling(filled, ["value"], (3, 7), **fr.USER)
    return rolled.select("user_id", "day", "value_est", fr.r6("value"), fr.r6("value_roll_3"),
                         fr.r6("value_roll_7"))


@query("""SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days,
  floor((count(DISTINCT CAST(ts AS DATE)) / 29.0) * 1000000 + 0.5003) / 1000000 AS coverage FROM events GROUP BY 1""")
def coverage_ratio(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.coverage(fr.dated_events(spark, sf), fr.EVENT_START, fr.EVENT_END, **fr.USER)
    return out.select("user_id", "days", fr.r6("coverage"))


@query("""SELECT event_id, user_id, CAST(ts AS DATE) AS day, value FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY 1
  HAVING count(DISTINCT CAST(ts AS DATE)) / 29.0 >= 0.85)""")
def coverage_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = fr.dated_events(spark, sf).select("event_id", "user_id", "day", "value")
    return panel.keep_covered(events, fr.EVENT_START, fr.EVENT_END, **fr.USER)


@query(f"""WITH {fr.COVERED_USERS}
SELECT user_id, day, floor((value) * 1000000 + 0.5003) / 1000000 AS value,
  CASE WHEN value IS NULL THEN 1 ELSE 0 END AS value_est FROM dense""")
def densify_gaps(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.missing_flags(fr.covered_users(spark, sf), ["value"])
    return out.select("user_id", "day", fr.r6("value"), "value_est")


@query(f"""WITH {fr.COVERED_USERS}
SELECT user_id, day FROM grid ANTI JOIN user_days USING (user_id, day)""")
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar days of the covered series on which nothing was observed."""
    planned = fr.covered_users(spark, sf).select("user_id", "day")
    return landing.gap_ledger(planned, fr.dated_events(spark, sf), ["user_id", "day"])


@query(f"""WITH {fr.COVERED_USERS},
{_line_sql("line", "dense", "user_id", "day", ["value"], "", 2)}
SELECT user_id, day, floor((value) * 1000000 + 0.5003) / 1000000 AS value FROM line""")
def interpolate_limit(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.interpolate(fr.covered_users(spark, sf), ["value"], limit=2, **fr.USER)
    return out.select("user_id", "day", fr.r6("value"))


@query(f"""WITH {fr.COVERED_USERS}
SELECT user_id, day, floor((coalesce({_last("value", "user_id", "day")},
  {_first("value", "user_id", "day")})) * 1000000 + 0.5003) / 1000000 AS value FROM dense""")
def forward_backward_fill(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.fill_adjacent(fr.covered_users(spark, sf), ["value"], **fr.USER)
    return out.select("user_id", "day", fr.r6("value"))


@query(f"""WITH {fr.DENSE_REGIONS},
doy AS (SELECT region, day, coalesce(revenue,
  avg(revenue) OVER (PARTITION BY region, dayofyear(day))) AS revenue FROM dense),
moy AS (SELECT region, day, coalesce(revenue,
  avg(revenue) OVER (PARTITION BY region, month(day))) AS revenue FROM doy)
SELECT region, day, floor((revenue) * 1000000 + 0.5003) / 1000000 AS revenue FROM moy""")
def climatology_fill(spark: SparkSession, sf: str) -> DataFrame:
    dense = fr.dense_regions(spark, sf)
    by_day = panel.fill_with_mean(dense, ["revenue"], F.dayofyear("day"), series="region")
    by_month = panel.fill_with_mean(by_day, ["revenue"], F.month("day"), series="region")
    return by_month.select("region", "day", fr.r6("revenue"))


@query("""SELECT user_id, day, event_id, event_type, value FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, value, row_number() OVER (
    PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1""")
def first_per_day(spark: SparkSession, sf: str) -> DataFrame:
    first = panel.keep_first(fr.dated_events(spark, sf), ["user_id", "day"], ["ts", "event_id"])
    return first.select("user_id", "day", "event_id", "event_type", "value")


# --- the whole clean panel -----------------------------------------------------------------

_CONT = ["tmed", "tmin", "tmax", '"hrMedia"', "velmedia", "racha", "presion", "nubes", "sol"]
_MIN_COVERAGE = 0.55


def _mean_sql(name: str, source: str, part: str) -> str:
    cols = ", ".join(f"coalesce({c}, avg({c}) OVER (PARTITION BY indicativo, {part}(fecha))) "
                     f"AS {c}" for c in _CONT)
    return f"{name} AS (SELECT * REPLACE ({cols}) FROM {source})"


_FILLED = ", ".join(
    f"coalesce({_last(c, 'indicativo', 'fecha')}, {_first(c, 'indicativo', 'fecha')}, "
    f"{1013.0 if c == 'presion' else 0.0}) AS {c}" for c in _CONT)
_FLAGS = ", ".join(
    f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS "{c.strip(chr(34))}_est"'
    for c in [*_CONT, "prec", "dir"])
_KEEP = ", ".join(f'"{c.strip(chr(34))}_est"' for c in [*_CONT, "prec", "dir"])
_FLOATS = ["tmed", "prec", "tmin", "tmax", "dir", "velmedia", "racha", '"hrMedia"', "sol",
           "presion", "nubes"]
_BOUNDS = {'"hrMedia"': (0, 100), "sol": (0, 24), "nubes": (0, 100)}


def _clip_sql(c: str) -> str:
    if c in _BOUNDS:
        low, high = _BOUNDS[c]
        return f"least(greatest({c}, {low}), {high})"
    return c


CLEAN_SQL = f"""{fr.STATION_DAYS}, {fr.SKY_DAYS},
kept AS (SELECT indicativo FROM station_days GROUP BY 1
  HAVING count(DISTINCT fecha) / 2403.0 >= {_MIN_COVERAGE}),
grid AS (SELECT indicativo, CAST(g.d AS DATE) AS fecha FROM kept,
  generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 1 DAY) g(d)),
wide AS (SELECT indicativo, fecha, nombre, provincia, altitud, tmed, coalesce(prec, om_prec) AS prec,
    tmin, tmax, dir, velmedia, racha, "hrMedia", sol, presion, nubes
  FROM grid LEFT JOIN station_days USING (indicativo, fecha)
  LEFT JOIN sky_days USING (indicativo, fecha)),
flagged AS (SELECT *, {_FLAGS} FROM wide),
{_line_sql("line", "flagged", "indicativo", "fecha", _CONT,
           "nombre, provincia, altitud, coalesce(prec, 0) AS prec, dir, " + _KEEP + ", ", 7)},
{_mean_sql("doy", "line", "dayofyear")},
{_mean_sql("moy", "doy", "month")},
filled AS (SELECT * REPLACE ({_FILLED},
  coalesce({_last("try_cast(dir AS DOUBLE)", "indicativo", "fecha")},
    {_first("try_cast(dir AS DOUBLE)", "indicativo", "fecha")}, 0) AS dir,
  coalesce({_last("nombre", "indicativo", "fecha")}, {_first("nombre", "indicativo", "fecha")})
    AS nombre,
  coalesce({_last("provincia", "indicativo", "fecha")},
    {_first("provincia", "indicativo", "fecha")}) AS provincia,
  coalesce({_last("altitud", "indicativo", "fecha")}, {_first("altitud", "indicativo", "fecha")})
    AS altitud) FROM moy),
clean AS (SELECT * REPLACE ({", ".join(f"{_clip_sql(c)} AS {c}" for c in _BOUNDS)}) FROM filled)"""


def station_panel(spark: SparkSession, sf: str, min_coverage: float = _MIN_COVERAGE,
                  **options) -> DataFrame:
    return build_clean_panel(
        fr.station_days(spark, sf), fr.sky_days(spark, sf), start=fr.ORDER_START,
        end=fr.ORDER_END, min_coverage=min_coverage, **options)


@query(f"""WITH {CLEAN_SQL}
SELECT indicativo, fecha, nombre, provincia, altitud, {_KEEP},
  {", ".join(f"floor(({c}) * 1000000 + 0.5003) / 1000000 AS {c}" for c in _FLOATS)} FROM clean""")
def clean_panel(spark: SparkSession, sf: str) -> DataFrame:
    out = station_panel(spark, sf)
    flags = quality.estimate_columns(out)
    return out.select("indicativo", "fecha", "nombre", "provincia", "altitud", *flags,
                      *[fr.r6(c.strip('"')) for c in _FLOATS])


_SCORE = " + ".join(f'"{c.strip(chr(34))}_est"' for c in [*_CONT, "prec", "dir"])


@query(f"""WITH {CLEAN_SQL},
totals AS (SELECT {", ".join(f'avg("{c.strip(chr(34))}_est") * 100 AS {c}' for c in [*_CONT, "prec", "dir"])}
  FROM clean)
{" UNION ALL ".join(f"SELECT '{c.strip(chr(34))}' AS variable, floor(({c}) * 1000000 + 0.5003) / 1000000 AS estimated_pct FROM totals" for c in [*_CONT, "prec", "dir"])}""")
def estimated_share(spark: SparkSession, sf: str) -> DataFrame:
    return quality.estimated_share(station_panel(spark, sf)).select(
        "variable", fr.r6("estimated_pct"))


@query(f"""WITH {CLEAN_SQL}
SELECT nombre, floor((avg(({_SCORE}) / 11.0) * 100) * 1000000 + 0.5003) / 1000000 AS estimated_pct FROM clean GROUP BY 1
ORDER BY avg(({_SCORE}) / 11.0) DESC, nombre LIMIT 5""")
def worst_stations(spark: SparkSession, sf: str) -> DataFrame:
    scored = station_panel(spark, sf, keep_quality_score=True)
    return quality.worst_series(scored).select("nombre", fr.r6("estimated_pct"))


@query(f"""WITH {CLEAN_SQL}
SELECT count(DISTINCT indicativo) AS n_series, count(*) AS n_rows FROM clean""")
def panel_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dataset_summary(station_panel(spark, sf))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  least(greatest(l_quantity * 3 - 20, 0), 100) AS "hrMedia", least(greatest(l_quantity - 10, 0), 24) AS sol,
  CASE WHEN l_returnflag <> 'R' THEN least(greatest(l_tax * 2000 - 10, 0), 100) END AS nubes
FROM lineitem""")
def physical_bounds(spark: SparkSession, sf: str) -> DataFrame:
    rows = fr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * 3 - 20).alias("hrMedia"),
        (F.col("l_quantity") - 10).alias("sol"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax") * 2000 - 10).alias("nubes"))
    return quality.clip_physical(rows, k.PHYSICAL_BOUNDS)
