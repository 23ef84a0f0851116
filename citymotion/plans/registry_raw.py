"""Registered queries of the split sources (ZIP members, dBase, shapefiles) and of small steps
that need raw files or written tables: surrogate ids, a panel without incidents, the
inventory, sorted tables, frame labels and the score over all features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.plans import adapters as A
from citymotion.plans import oracle as O
from citymotion.plans.registry import NORM_DEPS, ORACLE, PANEL_COLUMNS, PANEL_SRC, STEPS_CTE, TRAIN_YEAR, _COLL_SQL, _collision_rows, buckets, cleaned, normative, panel, register, vertices
from citymotion.plans.registry_io import placed_rows, scratch

# ---------------------------------------------------------------- S1, S2, P1-P4: archives of CSV members
# fixed values: archive of event_id % 3; the third name has no year
ARCHIVES = ("travel-time-2016.zip", "travel-time-2017-rest.zip", "travel-time-late.zip")
MEMBERS = 6


@register(
    "travel_zip_roundtrip",
    f"""SELECT {O.corridor_sql('user_id')} AS route_id, value AS travel_time_s, {O.K} AS sample_count, ts AS ts_utc, {O.to_local_sql('ts')} AS ts_local,
       CAST(CASE event_id % 3 WHEN 0 THEN 2016 WHEN 1 THEN 2017 ELSE year({O.to_local_sql('ts')}) END AS INTEGER) AS year
FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL AND value > 0""",
)
def q_travel_zip_roundtrip(spark, sf):
    """CSV parts packed into archives by tasks, then read member by member."""
    from citymotion.operators.ingest import normalize_travel_times
    from citymotion.sources.archives import pack_archives
    from citymotion.sources.common import list_files

    path = scratch(spark, "travel-zip")
    rows = A.travel_text_rows(A.table(spark, sf, "events")).withColumn("k", F.col("pos") % 3)
    text = rows.select("k", "resultId", F.col("timeInSeconds"), "count", "updated").repartition(MEMBERS)
    text.write.partitionBy("k").option("header", "true").csv(f"{path}/parts")
    parts = list_files(spark, f"{path}/parts", "*.csv", recursive=True).select("path")
    k = F.regexp_extract("path", "k=([0-9]+)", 1).cast("int")
    name = F.element_at(F.array(*[F.lit(a) for a in ARCHIVES]), k + 1)
    files = parts.select(F.concat(F.lit(f"{path}/zip/"), name).alias("archive"), "path", F.concat(F.lit("data/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("member"))
    pack_archives(files).write.format("noop").mode("overwrite").save()
    return normalize_travel_times(spark, f"{path}/zip").select("route_id", "travel_time_s", "sample_count", "ts_utc", "ts_local", "year")


# ---------------------------------------------------------------- S6, S7, P16: corridor attributes and polylines
SPLIT = 1 << 16  # small splits, so that these files are read by several tasks


def shape_archives(spark: SparkSession, routes: DataFrame, stored: bool) -> str:
    """``routes`` (attributes and ``points``) as shapefiles in archives; the folder."""
    from citymotion.sources.archives import pack_archives
    from citymotion.sources.shape_sink import write_shapefiles

    path = scratch(spark, "shapes")
    stems = write_shapefiles(routes, f"{path}/parts").select("stem").collect()  # a row per file
    files = [(f"{path}/zip/bluetooth-routes-{i}.zip", r["stem"] + s, f"routes{s}") for i, r in enumerate(stems) for s in (".shp", ".shx", ".dbf")]
    pack_archives(spark.createDataFrame(files, "archive string, path string, member string"), stored).write.format("noop").mode("overwrite").save()
    return f"{path}/zip"


POINTS = "array<struct<lon:double,lat:double>>"


@register("routes_dbf_roundtrip", O.with_ctes([O.RT], "SELECT route_id, free_flow_s, length_m FROM rt"))
def q_routes_dbf_roundtrip(spark, sf):
    """Deflated archives: each attribute table is one stream, decoded in blocks."""
    from citymotion.operators.ingest import normalize_routes

    c = A.corridors(spark, sf)
    routes = c.select(F.col("route_id").alias("resultId"), F.col("free_flow_s").alias("normalDriv"), "length_m", F.lit(None).cast(POINTS).alias("points"))
    return normalize_routes(spark, shape_archives(spark, routes.repartition(4), stored=False))


@register("route_vertices_roundtrip", O.with_ctes([O.VERTS], "SELECT route_id, seq, lon, lat FROM verts"))
def q_route_vertices_roundtrip(spark, sf):
    """Stored archives: record ranges and index ranges are read by several tasks a file."""
    from citymotion.sources.dbase import read_route_vertices

    lines = vertices(spark, sf).groupBy("route_id").agg(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))).alias("v"))
    routes = lines.select(F.concat(F.lit(" "), F.col("route_id"), F.lit(" ")).alias("resultId"), F.transform("v", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("points"))
    return read_route_vertices(spark, shape_archives(spark, routes.repartition(3), stored=True), "*.zip", split_bytes=SPLIT)


# ---------------------------------------------------------------- P12 surrogate ids
@register(
    "collisions_without_id",
    O.with_ctes(
        [_COLL_SQL, "numbered AS (SELECT *, row_number() OVER (ORDER BY collision_id) AS place FROM parsed WHERE year IN (1994, 1995, 1996))"],
        "SELECT place AS collision_id, ts_utc, year, hour, is_injury, fatalities FROM numbered WHERE located",
    ),
)
def q_collisions_without_id(spark, sf):
    """Files without ``_id``: numbers in file order, whatever way files are packed into tasks."""
    from citymotion.operators.ingest import parse_collisions
    from citymotion.sources.text_formats import read_collisions_csv

    path = scratch(spark, "collisions-no-id")
    rows = _collision_rows(spark, sf).withColumn("_key", F.col("_id").cast("long"))
    rows.repartitionByRange(5, "_key").sortWithinPartitions("_key").drop("_id", "_key").write.option("header", "true").csv(path)
    p = parse_collisions(read_collisions_csv(spark, path), years=[1994, 1995, 1996])
    return p.select("collision_id", "ts_utc", "year", "hour", "is_injury", "fatalities")


# ---------------------------------------------------------------- J6, A11, A12 on a calendar as large as a table
@register("civic_days_orders", O.with_ctes([O.ORDER_CAL, O.CIVIC], "SELECT * FROM civic"))
def q_civic_days_orders(spark, sf):
    from citymotion.operators.calendar import civic_days

    return civic_days(A.order_entries(spark, sf))


# ---------------------------------------------------------------- S9 panel without an incident table
NO_INCIDENTS = "0 AS n_collisions, 0 AS n_injury_collisions, 0 AS n_fatal_collisions, CAST(NULL AS DOUBLE) AS min_dist_to_route_m"


@register(
    "panel_without_collisions",
    O.with_ctes(O.PANEL_DEPS, f"SELECT {', '.join(c for c in PANEL_COLUMNS if c not in ('n_collisions', 'n_injury_collisions', 'n_fatal_collisions', 'min_dist_to_route_m'))}, {NO_INCIDENTS} FROM panel"),
)
def q_panel_without_collisions(spark, sf):
    from citymotion.operators.calendar import civic_days
    from citymotion.operators.panel import build_panel

    days = civic_days(A.calendar_entries(spark, sf))
    panel = build_panel(A.observations(spark, sf), A.corridors(spark, sf), A.weather(spark, sf), days, A.festival_events(spark, sf), None)
    return panel.select(*PANEL_COLUMNS)


# ---------------------------------------------------------------- S11 inventory
@register("raw_inventory", "SELECT o_orderstatus AS folder, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM orders GROUP BY 1")
def q_raw_inventory(spark, sf):
    """Files of a written folder, without marks and unfinished files, and their rows."""
    from citymotion.sources.common import open_output
    from citymotion.sources.preview import list_raw_files

    path = scratch(spark, "inventory")
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    orders.repartition("o_orderstatus").write.partitionBy("o_orderstatus").option("header", "true").csv(f"{path}/orders")
    for name in (".gitkeep", "orders/late.csv.partial"):
        with open_output(f"{path}/{name}") as out:
            out.write(b"x\n")
    folder = lambda c: F.regexp_extract(c, "o_orderstatus=([^/]+)/", 1)
    files = list_raw_files(spark, path, "orders").groupBy(folder("path").alias("folder")).agg(F.count("*").alias("n_files"))
    lines = spark.read.option("header", "true").csv(f"{path}/orders/o_orderstatus=*").groupBy(folder(F.col("_metadata.file_path")).alias("folder")).agg(F.count("*").alias("n_rows"))
    return files.join(lines, "folder").select("folder", "n_files", "n_rows")


# ---------------------------------------------------------------- O1, O3 sorted results
@register("weather_sorted", O.with_ctes([O.WX], "SELECT ts_utc, temp_c, row_number() OVER (ORDER BY ts_utc) - 1 AS place FROM wx"))
def q_weather_sorted(spark, sf):
    from citymotion.sources.sinks import write_table

    path = write_table(A.weather(spark, sf), scratch(spark, "weather-sorted"), order_by=["ts_utc"])
    return placed_rows(spark, path).select("ts_utc", "temp_c", "place")


@register(
    "frame_labels",
    O.with_ctes(O.PANEL_DEPS + [O.buckets_cte(60)], "SELECT bucket_utc, label, row_number() OVER (ORDER BY bucket_utc) - 1 AS place FROM (SELECT DISTINCT bucket_utc, label FROM buckets)"),
)
def q_frame_labels(spark, sf):
    from citymotion.operators.frames import frame_labels

    path = scratch(spark, "frame-labels")
    frame_labels(buckets(spark, sf, "h")).write.parquet(path)
    return placed_rows(spark, path).select("bucket_utc", "label", "place")


# ---------------------------------------------------------------- S10: a period of a stored panel
def _stored_period(spark, rows):
    from citymotion.operators.frames import congestion_buckets
    from citymotion.plans.registry_io import PERIOD
    from citymotion.sources.panel_store import read_period, write_panel

    path = write_panel(rows, scratch(spark, "panel-by-date"))
    read = read_period(spark, path, ["route_id", "ts_utc", "ts_local", "delay_s", "date"], *PERIOD)
    return congestion_buckets(read, metric="delay_s").withColumn("value", F.round("value", 6))


@register("stored_period_1h", ORACLE["congestion_period_1h"])
def q_stored_period(spark, sf):
    """Written by date and read through months, row-group statistics and five columns."""
    return _stored_period(spark, panel(spark, sf))


@register("stored_period_without_date", ORACLE["congestion_period_1h"])
def q_stored_period_without_date(spark, sf):
    """A stored panel without ``date``: its day comes from ``ts_local``, whose bounds reach the scan."""
    return _stored_period(spark, panel(spark, sf).drop("date"))


# ---------------------------------------------------------------- N7 over all features
# What each feature is compared with: the normative baseline, and nothing where there is none.
EXPECTED = {"travel_time_s": "free_flow_s + baseline_delay_s", "delay_s": "baseline_delay_s", "wx_temp_c": "wx_temp_c * 0.75", "wx_precip_mm": "CASE WHEN obs_weather THEN 0.125 END"}


def _all_scores_sql() -> str:
    from citymotion.operators.scoring import FEATURE_COLS

    d = lambda e: f"CAST({e} AS DOUBLE)"
    terms = [f"coalesce(({d(c)} - {d(EXPECTED.get(c, '0.5'))}) * ({d(c)} - {d(EXPECTED.get(c, '0.5'))}), 0.0)" for c in FEATURE_COLS]
    present = [f"CASE WHEN {d(c)} - {d(EXPECTED.get(c, '0.5'))} IS NULL THEN 0 ELSE 1 END" for c in FEATURE_COLS]
    return O.with_ctes(NORM_DEPS, f"SELECT route_id, ts_utc, round({' + '.join(terms)}, 5) AS score, CAST({' + '.join(present)} AS BIGINT) AS n_compared FROM normative")


@register("recon_score_features", _all_scores_sql())
def q_recon_score_features(spark, sf):
    from citymotion.operators.scoring import FEATURE_COLS, reconstruction_score

    rows = normative(spark, sf)
    for c in FEATURE_COLS:
        rows = rows.withColumn(f"_hat_{c}", F.expr(EXPECTED.get(c, "0.5")).cast("double"))
    hats = [f"_hat_{c}" for c in FEATURE_COLS]
    n = sum((F.col(c).isNotNull() & F.col(h).isNotNull()).cast("long") for c, h in zip(FEATURE_COLS, hats))
    return reconstruction_score(rows, FEATURE_COLS, hats).select("route_id", "ts_utc", F.round("score", 5).alias("score"), n.alias("n_compared"))


# ---------------------------------------------------------------- N2 with its option, N4 dense grid
# The derived calendar has entries on every day, so the flags are set by the day of the month.
FLAGS = {"is_holiday": "day(ts_local) % 7 = 0", "is_parade": "day(ts_local) % 11 = 3", "is_mega_event": "false", "is_shopping_peak": "false", "is_school_break": "NULL"}
_SPECIAL = "(" + " OR ".join(f"coalesce({c}, false)" for c in FLAGS) + ")"
_NORM_ORDINARY = (
    O.normative_cte(TRAIN_YEAR)
    .replace("AND obs_travel),", f"AND obs_travel AND NOT {_SPECIAL}),")
    .replace("coalesce(wx_precip_mm > 2.5, false), false)", f"coalesce(wx_precip_mm > 2.5, false) AND NOT {_SPECIAL}, false)")
    .replace("FROM clean", "FROM flagged")
)
_FLAGGED = f"flagged AS (SELECT * REPLACE ({', '.join(f'CAST({e} AS BOOLEAN) AS {c}' for c, e in FLAGS.items())}) FROM clean)"


@register(
    "normative_mask_ordinary",
    O.with_ctes(PANEL_SRC + [O.CLEAN, _FLAGGED, _NORM_ORDINARY], "SELECT route_id, ts_utc, round(delay_threshold, 6) AS delay_threshold, round(baseline_delay_s, 6) AS baseline_delay_s, is_normative FROM normative"),
)
def q_normative_mask_ordinary(spark, sf):
    """Days with a civic entry are neither fitted nor normative."""
    from citymotion.operators.scoring import normative_mask

    rows = cleaned(spark, sf).withColumns({c: F.expr(e).cast("boolean") for c, e in FLAGS.items()})
    n = normative_mask(rows, train_years=[TRAIN_YEAR], ordinary_calendar=True)
    return n.select("route_id", "ts_utc", F.round("delay_threshold", 6).alias("delay_threshold"), F.round("baseline_delay_s", 6).alias("baseline_delay_s"), "is_normative")


@register(
    "dense_grid",
    O.with_ctes(
        O.PANEL_DEPS
        + [
            STEPS_CTE,
            "places AS (SELECT route_id, x, CAST(floor(epoch(step_utc) / 300) AS BIGINT) AS k FROM steps)",
            "span AS (SELECT min(k) // 288 * 288 AS k0, (max(k) // 288 + 1) * 288 AS k1 FROM places)",
            "gaps AS (SELECT *, coalesce(lead(k) OVER (PARTITION BY route_id ORDER BY k), k1) - k - 1 AS gap FROM places, span)",
        ],
        """SELECT route_id, CAST(any_value(k1 - k0) AS BIGINT) AS n_steps, count(*) AS n_observed, CAST(min(k) - any_value(k0) AS BIGINT) AS n_before_first,
       CAST(max(gap) AS BIGINT) AS longest_gap, CAST(sum(gap * (gap + 1) / 2) AS BIGINT) AS sum_since, count(*) FILTER (WHERE k % 2 = 1) AS n_odd_places, round(sum(x), 5) AS sum_x
FROM gaps GROUP BY route_id""",
    ),
)
def q_dense_grid(spark, sf):
    """The whole grid (corridors x five-minute steps of all days), summed up per corridor."""
    from citymotion.operators.scoring import dense_grid, grid_summary, step_series

    return grid_summary(dense_grid(step_series(panel(spark, sf))), ["x"]).withColumn("sum_x", F.round("sum_x", 5))


# ---------------------------------------------------------------- T4, T5 with own state, over several micro-batches
DAYS = ((1, 10), (11, 20), (21, 31))  # a file stream's batches, in time order
ROW_GROUP = 4 << 20  # bytes; a batch's one file is read by as many tasks as its row groups allow


def _in_batches(spark, sf):
    """The events as a stream of several micro-batches (one written file each); the rows of a
    batch are dealt to all tasks before their text is parsed."""
    e = A.table(spark, sf, "events")
    path = scratch(spark, "event-batches")
    for low, high in DAYS:
        part = e.where(F.dayofmonth("ts").between(low, high))
        (part if low > 1 else part.unionByName(e.where("ts IS NULL"))).repartition(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path).repartition("event_id")


_CUT = "(SELECT date_trunc('millisecond', max(ts_utc)) - INTERVAL 2 HOUR FROM obs)"


@register(
    "stream_trailing_steps",
    O.with_ctes(
        [O.OBS, STEPS_CTE.replace("FROM panel", "FROM obs")],
        f"""SELECT e.route_id, e.step_utc AS window_end, count(*) AS n_steps, count(*) = 12 AS is_complete,
       round(avg(s.x), 6) AS mean_x, arg_min(s.x, s.step_utc) AS first_x, arg_max(s.x, s.step_utc) AS last_x
FROM steps e JOIN steps s ON e.route_id = s.route_id AND s.step_utc BETWEEN e.step_utc - INTERVAL 55 MINUTE AND e.step_utc
WHERE e.step_utc + INTERVAL 5 MINUTE <= {_CUT} GROUP BY 1, 2""",
    ),
)
def q_stream_trailing_steps(spark, sf):
    """Batch N6 from a stream; the state holds each step once."""
    from citymotion.plans.registry_io import drained
    from citymotion.streaming.stateful import trailing_steps_stream

    w = drained(trailing_steps_stream(A.observations(spark, sf, _in_batches(spark, sf))), "stream-steps")
    return w.select(
        "route_id", "window_end", "n_steps", "is_complete", F.round("mean_x", 6).alias("mean_x"),
        F.get("history", 0).alias("first_x"), F.get("history", F.size("history") - 1).alias("last_x"),
    )


@register("stream_upsert_rows", O.with_ctes([O.OBS], "SELECT route_id, ts_utc, max(src_pos) AS src_pos, arg_max(travel_time_s, src_pos) AS travel_time_s FROM obs GROUP BY ALL"))
def q_stream_upsert_rows(spark, sf):
    """Batch W2 as a table that micro-batches are merged into."""
    from citymotion.streaming.stateful import LatestTable, upsert_stream

    path = scratch(spark, "stream-upsert")
    rows = A.observations(spark, sf, _in_batches(spark, sf)).select("route_id", "ts_utc", "src_pos", "travel_time_s")
    table = LatestTable(spark, path, ["route_id", "ts_utc"], ["src_pos"], "ts_utc")
    upsert_stream(rows, table, path.rsplit("/", 1)[1], available_now=True).awaitTermination()
    return table.read()
