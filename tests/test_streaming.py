"""Batch-vs-stream equality for the streaming variants."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
LATE = dt.timedelta(hours=2)


def _run(spark, stream, name):
    from citymotion.streaming.streams import start

    out = tempfile.mkdtemp(prefix=f"cm-{name}-")
    q = start(stream, f"{name}_{os.getpid()}_{id(stream)}", out, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out)


def _as_stream(spark, df):
    d = tempfile.mkdtemp(prefix="cm-src-")
    df.write.mode("overwrite").parquet(d)
    return spark.readStream.schema(df.schema).parquet(d), df


def test_collision_hours_stream_matches_batch(spark):
    from citymotion.operators.summaries import collision_route_hour_summary
    from citymotion.plans import adapters as A
    from citymotion.streaming.streams import collision_hours_stream

    s, batch_in = _as_stream(spark, A.incidents(spark, SF))
    got = _run(spark, collision_hours_stream(s), "t2")
    cutoff = batch_in.agg(F.max("ts_utc")).first()[0] - LATE - dt.timedelta(hours=1)
    want = collision_route_hour_summary(batch_in).where(F.col("ts_hour_utc") <= F.lit(cutoff))
    assert got.count() > 0
    got = got.where(F.col("ts_hour_utc") <= F.lit(cutoff)).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bucket_mean_stream_matches_batch(spark):
    from citymotion.operators.frames import congestion_buckets
    from citymotion.plans import adapters as A
    from citymotion.streaming.streams import bucket_mean_stream

    obs = A.observations(spark, SF).withColumn("delay_s", F.col("travel_time_s") - 10.0)
    s, batch_in = _as_stream(spark, obs)
    got = _run(spark, bucket_mean_stream(s, 15), "t3")
    cutoff = batch_in.agg(F.max("ts_utc")).first()[0] - LATE - dt.timedelta(minutes=15)
    want = congestion_buckets(batch_in, freq="15min").where(F.col("bucket_utc") <= F.lit(cutoff))
    got = got.where(F.col("bucket_utc") <= F.lit(cutoff)).select(*want.columns)
    r = lambda df: df.withColumn("value", F.round("value", 9))
    assert got.count() > 0
    assert r(got).exceptAll(r(want)).count() == 0 and r(want).exceptAll(r(got)).count() == 0


def test_trailing_hour_and_dedupe_streams(spark):
    from citymotion.operators.normalize import keep_last
    from citymotion.plans import adapters as A
    from citymotion.streaming.streams import dedupe_last_stream, trailing_hour_stream

    obs = A.observations(spark, SF)
    dup = obs.unionByName(obs.withColumn("src_pos", F.col("src_pos") + 100000).withColumn("travel_time_s", F.col("travel_time_s") + 1))
    s, batch_in = _as_stream(spark, dup)
    got = _run(spark, dedupe_last_stream(s), "t5")
    cutoff = batch_in.agg(F.max("ts_utc")).first()[0] - LATE
    want = keep_last(batch_in, ["route_id", "ts_utc"], ["src_pos"], ["src_pos", "travel_time_s"]).where(F.col("ts_utc") < F.lit(cutoff))
    got = got.where(F.col("ts_utc") < F.lit(cutoff)).select(*want.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    s2, _ = _as_stream(spark, obs)
    t4 = _run(spark, trailing_hour_stream(s2), "t4")
    assert t4.count() > 0 and t4.agg(F.max("n_obs")).first()[0] >= 1


def test_enrich_stream_matches_batch_panel(spark):
    from citymotion.operators.calendar import civic_days
    from citymotion.operators.summaries import event_day_summary
    from citymotion.plans import adapters as A
    from citymotion.plans.registry import build_panel_df
    from citymotion.streaming.streams import enrich_stream

    obs = A.observations(spark, SF)
    s, _ = _as_stream(spark, obs)
    civic = civic_days(A.calendar_entries(spark, SF))
    ev = event_day_summary(A.festival_events(spark, SF))
    got = _run(spark, enrich_stream(s, A.corridors(spark, SF), A.weather(spark, SF), civic, ev), "t1")
    cols = ["route_id", "ts_utc", "free_flow_s", "wx_temp_c", "is_holiday", "event_ids", "n_events_active", "hour", "dow", "is_weekend", "delay_s"]
    want = build_panel_df(spark, SF).select(*cols)
    got = got.select(*cols)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_dedupe_first_stream(spark):
    from citymotion.plans import adapters as A
    from citymotion.streaming.streams import dedupe_first_stream

    obs = A.observations(spark, SF)
    dup = obs.unionByName(obs)
    s, batch_in = _as_stream(spark, dup)
    got = _run(spark, dedupe_first_stream(s).drop("event_time"), "t5a")
    assert got.count() == obs.select("route_id", "ts_utc").distinct().count()
