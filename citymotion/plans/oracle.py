"""DuckDB SQL mirror of :mod:`citymotion.plans.adapters` (CTE fragments).

Each constant is one ``name AS (...)`` CTE; :func:`with_ctes` joins the ones a
query needs.  Same constants as the adapters: corridor id = N{key % 10}_N{key
div 10}; calendar shift 348 months; coordinates from balances/dates.
"""

from __future__ import annotations

from citymotion.functions.geo import segment_distance_sql, utm_sql

TZ = "America/Toronto"


def corridor_sql(key: str) -> str:
    return f"('N' || CAST({key} % 10 AS VARCHAR) || '_N' || CAST({key} // 10 AS VARCHAR))"


def to_local_sql(ts: str) -> str:
    return f"timezone('{TZ}', ({ts}) AT TIME ZONE 'UTC')"


K = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"

OBS = f"""obs AS (
  SELECT {corridor_sql('user_id')} AS route_id, value AS travel_time_s, {K} AS sample_count,
         ts AS ts_utc, {to_local_sql('ts')} AS ts_local, event_id AS src_pos,
         CAST(year({to_local_sql('ts')}) AS INTEGER) AS year
  FROM events
  WHERE event_type <> 'error' AND user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL AND value > 0
)"""

INC = f"""inc AS (
  SELECT event_id AS collision_id, {corridor_sql('user_id')} AS route_id, ts AS ts_utc,
         {to_local_sql('ts')} AS ts_local, {K} > 50 AS is_injury,
         CAST(CASE WHEN {K} > 90 THEN 1 ELSE 0 END AS BIGINT) AS fatalities, value AS dist_to_route_m
  FROM events WHERE event_type = 'error'
)"""

INCSUM = """incsum AS (
  SELECT route_id, date_trunc('hour', ts_utc) AS ts_hour_utc, count(*) AS n_collisions,
         count(*) FILTER (WHERE coalesce(is_injury, false)) AS n_injury_collisions,
         count(*) FILTER (WHERE coalesce(CAST(fatalities AS DOUBLE), 0) > 0) AS n_fatal_collisions,
         min(dist_to_route_m) AS min_dist_to_route_m
  FROM inc WHERE route_id IS NOT NULL AND ts_utc IS NOT NULL GROUP BY 1, 2
)"""

WX = f"""wx_read AS (
  SELECT date_trunc('hour', ts) AS ts_utc, ts AS read_at, event_id AS src_pos,
         value / 10.0 - 15.0 AS temp_c, k AS rel_hum_pct,
         CASE WHEN k < 10 THEN NULL ELSE (k - 10) / 20.0 END AS precip_mm,
         value / 20.0 AS wind_spd_kmh, CASE WHEN k >= 60 THEN 'Rain' ELSE 'Clear' END AS weather_desc
  FROM (SELECT *, {K} AS k FROM events WHERE event_type = 'signup')
),
wx AS (
  SELECT ts_utc, {to_local_sql('ts_utc')} AS ts_local, temp_c, rel_hum_pct, precip_mm, wind_spd_kmh, weather_desc
  FROM (SELECT *, row_number() OVER (PARTITION BY ts_utc ORDER BY read_at DESC, src_pos DESC) AS rn FROM wx_read)
  WHERE rn = 1
)"""

RT = f"""rt AS (
  SELECT {corridor_sql('c_custkey')} AS route_id, CAST(c_acctbal AS DOUBLE) / 99.0 AS free_flow_s,
         CAST(100 + c_nationkey * 25 AS DOUBLE) AS length_m
  FROM customer WHERE c_acctbal >= 0
)"""

CAL = """cal AS (
  SELECT 'cal-' || substr(o_orderpriority, 1, 1) || o_orderstatus || '-' || strftime(start_date, '%Y%m%d') AS id,
         o_orderpriority || '/' || o_orderstatus || ' ' || strftime(start_date, '%Y-%m-%d') AS name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'public_holiday' WHEN '2-HIGH' THEN 'civic_holiday'
              WHEN '3-MEDIUM' THEN 'mega_event' WHEN '4-NOT SPECIFIED' THEN 'parade'
              ELSE CASE WHEN o_orderstatus = 'F' THEN 'shopping_peak' ELSE 'school_break' END END AS kind,
         start_date,
         CAST(start_date + CAST(floor(top / 100000.0) AS INTEGER) AS DATE) AS end_date,
         CAST(strftime(start_date, '%Y%m%d') AS BIGINT) * 100 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10
           + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS pos
  FROM (SELECT o_orderpriority, o_orderstatus, CAST(CAST(o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE) AS start_date,
               max(o_totalprice) AS top
        FROM orders GROUP BY 1, 2, 3)
)"""

# the same name as CAL, so that CIVIC reads it: one entry per order
ORDER_CAL = """cal AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS id, substr(o_orderpriority, 1, 1) || '-' || CAST(o_orderkey % 1000 AS VARCHAR) AS name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'public_holiday' WHEN '2-HIGH' THEN 'civic_holiday'
              WHEN '3-MEDIUM' THEN 'mega_event' WHEN '4-NOT SPECIFIED' THEN 'parade'
              ELSE CASE WHEN o_orderstatus = 'F' THEN 'shopping_peak' ELSE 'school_break' END END AS kind,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE) AS start_date,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE)
           + CAST(CASE WHEN o_orderkey % 997 = 0 THEN 18300 WHEN o_orderkey % 61 = 0 THEN 400 ELSE o_orderkey % 9 END AS INTEGER) AS end_date,
         o_orderkey * 7919 % 1000003 * 10000000 + o_orderkey AS pos
  FROM orders
)"""

CIVIC = """cal_days AS (
  SELECT c.*, CAST(t.d AS DATE) AS date
  FROM cal c, LATERAL unnest(generate_series(CAST(c.start_date AS TIMESTAMP), CAST(c.end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d)
),
feat AS (
  SELECT date,
         bool_or(kind = 'public_holiday') AS is_public_holiday,
         bool_or(kind = 'civic_holiday') AS is_civic_holiday,
         bool_or(kind IN ('public_holiday', 'civic_holiday')) AS is_holiday,
         bool_or(kind = 'school_break') AS is_school_break,
         bool_or(kind = 'mega_event') AS is_mega_event,
         bool_or(kind = 'parade') AS is_parade,
         bool_or(kind = 'shopping_peak') AS is_shopping_peak,
         count(*) AS n_civic_events,
         coalesce(string_agg(CASE WHEN kind IN ('public_holiday', 'civic_holiday') THEN name END, '|' ORDER BY pos), '') AS holiday_names,
         coalesce(string_agg(CASE WHEN kind IN ('mega_event', 'parade', 'shopping_peak', 'school_break') THEN name END, '|' ORDER BY pos), '') AS mega_event_names,
         string_agg(id, '|' ORDER BY pos) AS event_ids,
         array_to_string(list_sort(list_distinct(list(kind))), '|') AS event_kinds
  FROM cal_days GROUP BY date
),
spine AS (
  SELECT CAST(unnest(generate_series(
           CAST(make_date(CAST(min(year(start_date)) AS BIGINT), 1, 1) AS TIMESTAMP),
           CAST(make_date(CAST(max(year(end_date)) AS BIGINT), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM cal
),
civic AS (
  SELECT s.date,
         coalesce(f.is_public_holiday, false) AS is_public_holiday, coalesce(f.is_civic_holiday, false) AS is_civic_holiday,
         coalesce(f.is_holiday, false) AS is_holiday, coalesce(f.is_school_break, false) AS is_school_break,
         coalesce(f.is_mega_event, false) AS is_mega_event, coalesce(f.is_parade, false) AS is_parade,
         coalesce(f.is_shopping_peak, false) AS is_shopping_peak, coalesce(f.n_civic_events, 0) AS n_civic_events,
         coalesce(f.holiday_names, '') AS holiday_names, coalesce(f.mega_event_names, '') AS mega_event_names,
         coalesce(f.event_ids, '') AS event_ids, coalesce(f.event_kinds, '') AS event_kinds
  FROM spine s LEFT JOIN feat f USING (date)
)"""

FEST = """fest AS (
  SELECT 'ord-' || CAST(o.o_orderkey AS VARCHAR) AS event_id,
         CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE) AS d0,
         coalesce(CAST(CAST(ls.last_ship AS DATE) + INTERVAL 348 MONTH AS DATE),
                  CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE)) AS d1,
         o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS rc, o.o_orderstatus <> 'P' AS hc
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ls
       ON o.o_orderkey = ls.l_orderkey
),
evday AS (
  SELECT CAST(t.d AS DATE) AS date, count(*) AS n_events_active,
         count(*) FILTER (WHERE coalesce(rc, false)) AS n_events_road_close,
         count(*) FILTER (WHERE hc) AS n_events_with_coords
  FROM fest f, LATERAL unnest(generate_series(CAST(f.d0 AS TIMESTAMP), CAST(f.d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS t(d)
  WHERE f.d1 >= f.d0
  GROUP BY 1
)"""

PANEL = f"""panel AS (
  SELECT o.route_id, o.travel_time_s, o.sample_count, o.ts_utc, o.ts_local, o.src_pos, o.year,
         r.free_flow_s, r.length_m,
         date_trunc('hour', o.ts_utc) AS ts_hour_utc,
         w.temp_c AS wx_temp_c, w.rel_hum_pct AS wx_rel_hum_pct, w.precip_mm AS wx_precip_mm,
         w.wind_spd_kmh AS wx_wind_spd_kmh, w.weather_desc AS wx_weather_desc,
         CAST(o.ts_local AS DATE) AS date,
         c.is_public_holiday, c.is_civic_holiday, c.is_holiday, c.is_school_break, c.is_mega_event,
         c.is_parade, c.is_shopping_peak, c.n_civic_events,
         coalesce(c.holiday_names, '') AS holiday_names, c.mega_event_names, c.event_ids, c.event_kinds,
         coalesce(e.n_events_active, 0) AS n_events_active, coalesce(e.n_events_road_close, 0) AS n_events_road_close,
         coalesce(e.n_events_with_coords, 0) AS n_events_with_coords,
         coalesce(i.n_collisions, 0) AS n_collisions, coalesce(i.n_injury_collisions, 0) AS n_injury_collisions,
         coalesce(i.n_fatal_collisions, 0) AS n_fatal_collisions, i.min_dist_to_route_m,
         {to_local_sql("date_trunc('hour', o.ts_utc)")} AS ts_hour,
         CAST(hour(o.ts_local) AS BIGINT) AS hour, CAST(isodow(o.ts_local) - 1 AS BIGINT) AS dow,
         isodow(o.ts_local) IN (6, 7) AS is_weekend,
         o.travel_time_s - r.free_flow_s AS delay_s
  FROM obs o
  LEFT JOIN rt r ON o.route_id = r.route_id
  LEFT JOIN wx w ON date_trunc('hour', o.ts_utc) = w.ts_utc
  LEFT JOIN civic c ON CAST(o.ts_local AS DATE) = c.date
  LEFT JOIN evday e ON CAST(o.ts_local AS DATE) = e.date
  LEFT JOIN incsum i ON o.route_id = i.route_id AND date_trunc('hour', o.ts_utc) = i.ts_hour_utc
)"""

PANEL_DEPS = [OBS, INC, INCSUM, WX, RT, CAL, CIVIC, FEST, PANEL]


def _proj(prefix: str, lon: str, lat: str) -> str:
    e, n = utm_sql(lon, lat)
    return f"{e} AS {prefix}x, {n} AS {prefix}y"


VERTS = f"""verts AS (
  SELECT {corridor_sql('c.c_custkey')} AS route_id,
         row_number() OVER (PARTITION BY c.c_custkey ORDER BY o.o_orderkey) - 1 AS seq,
         CAST(-79.6 AS DOUBLE) + CAST(0.35 AS DOUBLE) * (c.c_acctbal + CAST(1000.0 AS DOUBLE)) / CAST(10999.0 AS DOUBLE)
           + CAST(0.01 AS DOUBLE) * (o.o_totalprice / CAST(599999.0 AS DOUBLE) - CAST(0.5 AS DOUBLE)) AS lon,
         CAST(43.58 AS DOUBLE) + CAST(0.008 AS DOUBLE) * c.c_nationkey
           + CAST(0.004 AS DOUBLE) * (CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) / CAST(2399.0 AS DOUBLE) - CAST(0.5 AS DOUBLE)) AS lat
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
pverts AS (SELECT route_id, seq, lon, lat, {_proj('', 'lon', 'lat')} FROM verts),
segs AS (
  SELECT a.route_id, a.x AS ax, a.y AS ay, coalesce(b.x, a.x) AS bx, coalesce(b.y, a.y) AS by
  FROM pverts a LEFT JOIN pverts b ON a.route_id = b.route_id AND b.seq = a.seq + 1
)"""

PTS = f"""pts AS (
  SELECT c_custkey AS collision_id,
         CAST(-79.6 AS DOUBLE) + CAST(0.35 AS DOUBLE) * (c_acctbal + CAST(1000.0 AS DOUBLE)) / CAST(10999.0 AS DOUBLE) AS lon,
         CAST(43.58 AS DOUBLE) + CAST(0.008 AS DOUBLE) * c_nationkey + CAST(0.003 AS DOUBLE) AS lat
  FROM customer
),
ppts AS (SELECT collision_id, lon, lat, {_proj('p', 'lon', 'lat')} FROM pts WHERE lon IS NOT NULL AND lat IS NOT NULL)"""

SNAP = f"""cand AS (
  SELECT p.collision_id, s.route_id, {segment_distance_sql('p.px', 'p.py', 's.ax', 's.ay', 's.bx', 's.by')} AS d
  FROM ppts p CROSS JOIN segs s
),
snap AS (
  SELECT collision_id, route_id, d AS dist_to_route_m
  FROM (SELECT *, row_number() OVER (PARTITION BY collision_id ORDER BY d, route_id) AS rn FROM cand WHERE d <= 150.0)
  WHERE rn = 1
)"""


def with_ctes(ctes: list[str], body: str) -> str:
    seen: list[str] = []
    for c in ctes:
        if c not in seen:
            seen.append(c)
    return "WITH " + ",\n".join(seen) + "\n" + body


def bucket_sql(ts: str, minutes: int) -> str:
    return f"(date_trunc('hour', {ts}) + to_minutes(CAST(floor(minute({ts}) / {minutes}) * {minutes} AS BIGINT)))"


def label_sql(ts_utc: str) -> str:
    return f"strftime({to_local_sql(ts_utc)}, '%Y-%m-%d %H:%M')"


def buckets_cte(minutes: int, name: str = "buckets") -> str:
    return f"""{name} AS (
  SELECT {bucket_sql('ts_utc', minutes)} AS bucket_utc, {label_sql(bucket_sql('ts_utc', minutes))} AS label, route_id,
         avg(CASE WHEN isnan(delay_s) THEN NULL ELSE delay_s END) AS value
  FROM panel GROUP BY 1, 2, 3
)"""


CLEAN = """clean AS (
  SELECT * EXCLUDE (rn, hour, dow, is_weekend, wx_precip_mm, is_public_holiday, is_civic_holiday, is_holiday, is_school_break,
                    is_mega_event, is_parade, is_shopping_peak),
         CAST(hour(ts_local) AS BIGINT) AS hour, CAST(isodow(ts_local) - 1 AS BIGINT) AS dow,
         isodow(ts_local) IN (6, 7) AS is_weekend,
         sin(2 * pi() * hour(ts_local) / 24.0) AS hour_sin, cos(2 * pi() * hour(ts_local) / 24.0) AS hour_cos,
         sin(2 * pi() * (isodow(ts_local) - 1) / 7.0) AS dow_sin, cos(2 * pi() * (isodow(ts_local) - 1) / 7.0) AS dow_cos,
         coalesce(is_public_holiday, false) AS is_public_holiday, coalesce(is_civic_holiday, false) AS is_civic_holiday,
         coalesce(is_holiday, false) AS is_holiday, coalesce(is_school_break, false) AS is_school_break,
         coalesce(is_mega_event, false) AS is_mega_event, coalesce(is_parade, false) AS is_parade,
         coalesce(is_shopping_peak, false) AS is_shopping_peak,
         travel_time_s IS NOT NULL AND delay_s IS NOT NULL AND coalesce(sample_count, 0) >= 0 AS obs_travel,
         wx_temp_c IS NOT NULL AS obs_weather, TRY_CAST(wx_precip_mm AS DOUBLE) AS wx_precip_mm
  FROM (SELECT *, row_number() OVER (PARTITION BY ts_local, route_id ORDER BY src_pos DESC) AS rn FROM panel)
  WHERE rn = 1
)"""


def normative_cte(train_year: int) -> str:
    return f"""fit AS (SELECT * FROM clean WHERE year = {train_year} AND obs_travel),
s0 AS (SELECT route_id, hour, dow, quantile_cont(delay_s, 0.85) AS thr0, count(*) AS n0, avg(delay_s) AS mean0 FROM fit GROUP BY 1, 2, 3),
s1 AS (SELECT route_id, hour, quantile_cont(delay_s, 0.85) AS thr1, count(*) AS n1, avg(delay_s) AS mean1 FROM fit GROUP BY 1, 2),
s2 AS (SELECT route_id, quantile_cont(delay_s, 0.85) AS thr2, count(*) AS n2, avg(delay_s) AS mean2 FROM fit GROUP BY 1),
norm AS (
  SELECT c.*, coalesce(CASE WHEN n0 >= 30 THEN thr0 END, CASE WHEN n1 >= 30 THEN thr1 END, thr2) AS delay_threshold,
         coalesce(CASE WHEN n0 >= 30 THEN mean0 END, CASE WHEN n1 >= 30 THEN mean1 END, mean2) AS baseline_delay_s
  FROM clean c LEFT JOIN s0 USING (route_id, hour, dow) LEFT JOIN s1 USING (route_id, hour) LEFT JOIN s2 USING (route_id)
),
normative AS (
  SELECT *, coalesce(obs_travel AND delay_s <= delay_threshold AND NOT coalesce(wx_precip_mm > 2.5, false), false) AS is_normative
  FROM norm
)"""
