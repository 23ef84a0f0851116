"""Streams with own state: exact trailing steps (T4) and a latest-row table kept by upserts (T5)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from citymotion.operators.normalize import keep_last
from citymotion.operators.scoring import DAY, STEP_MINUTES, WINDOW_SIZE, _epoch_micros
from citymotion.session import ensure_checkpoint_dir, path_exists
from citymotion.sources.common import ship_package
from citymotion.streaming.streams import DEFAULT_LATENESS, with_event_time

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TRAILING = "route_id string, step long, n_steps long, mean_x double, history array<double>"


class Steps(NamedTuple):
    """Steps of some routes, a column each; ``x`` is NaN where there is no value."""

    route_id: np.ndarray
    step: np.ndarray
    us: np.ndarray
    src_pos: np.ndarray
    x: np.ndarray
    open: np.ndarray

    def taken(self, rows: np.ndarray) -> Steps:
        return Steps(*[c[rows] for c in self])


STEPS = pa.schema([("route_id", pa.string()), ("step", pa.int64()), ("us", pa.int64()), ("src_pos", pa.int64()), ("x", pa.float64()), ("open", pa.bool_())])
# Routes are dealt into so many groups a day: a call of the state interface handles a
# group's routes together, and its state has 299 steps a route at most.  A stream's checkpoint
# depends on it.
BUCKETS = 64
EMITTED = 10_000  # rows of windows handed over, or of new steps held, at once


class TrailingSteps(StatefulProcessor):
    """Per (bucket of routes, day): the latest observation of each route's steps that a window
    can still need.

    A step is final when the watermark reaches its end.  One timer waits for the earliest
    step that is open; it emits the windows of all final steps and drops what no later
    window needs, so the state is a ring of ``size`` steps a route and those within the
    lateness bound, each held once.  State is one binary value (an Arrow table) that is read
    and written once a call, and a call handles all routes of its bucket at once."""

    def __init__(self, size: int, step_s: int):
        self.size, self.step_ms, self.day_ms = size, step_s * 1000, DAY * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("steps", "steps binary")

    def _load(self) -> Steps | None:
        held = self.state.get() if self.state.exists() else None
        if held is None:
            return None
        with pa.ipc.open_stream(bytes(held[0])) as stream:
            return Steps(*[c.to_numpy(zero_copy_only=False) for c in stream.read_all().combine_chunks().columns])

    def _save(self, key, steps: Steps) -> None:
        """Write the state and wait for the earliest open step, or for the end of the day."""
        if not len(steps.step):
            self.state.clear()
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, STEPS) as out:
            out.write_batch(pa.record_batch([pa.array(c, t) for c, t in zip(steps, STEPS.types)], schema=STEPS))
        self.state.update((sink.getvalue().to_pybytes(),))
        waiting = steps.step[steps.open]
        self.handle.registerTimer((int(waiting.min()) + 1) * self.step_ms if len(waiting) else (int(key[1]) + 1) * self.day_ms)

    def _latest(self, parts: list[Steps]) -> Steps:
        """The latest row of each (route, step), a route's steps in order; of equal (us, src_pos)
        the first stays."""
        rows = Steps(*[np.concatenate(c) for c in zip(*parts)])
        route = pd.factorize(rows.route_id)[0]
        order = np.lexsort((~rows.src_pos, ~rows.us, rows.step, route))
        route, step = route[order], rows.step[order]
        return rows.taken(order[np.r_[True, (route[1:] != route[:-1]) | (step[1:] != step[:-1])]])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        parts, waiting = [], 0
        for batch in rows:
            new = Steps(*[batch[c].to_numpy(dtype=t) for c, t in zip(Steps._fields[:-1], (object, np.int64, np.int64, np.int64, np.float64))], ~batch["copy"].to_numpy(dtype=bool))
            new = new.taken((new.step + 1) * self.step_ms > watermark)  # else its window has been emitted
            if not len(new.step):
                continue
            if not parts and (held := self._load()) is not None:
                parts.append(held)
            parts.append(new)
            waiting += len(new.step)
            if waiting > len(parts[0].step) + EMITTED:  # no more than twice the state is held
                parts, waiting = [self._latest(parts)], 0
        if parts:
            self._save(key, self._latest(parts))
        return iter(())

    def _windows(self, steps: Steps, ends: np.ndarray) -> Iterator[pd.DataFrame]:
        """The windows that end at the rows ``ends`` of ``steps``."""
        step, route, x = steps.step, steps.route_id, steps.x
        first = np.maximum.accumulate(np.where(np.r_[True, route[1:] != route[:-1]], np.arange(len(step)), 0))
        known = ~np.isnan(x)
        values = x.astype(object)
        values[~known] = None
        for part in range(0, len(ends), EMITTED):
            at = ends[part : part + EMITTED]
            low, total, n = at.copy(), np.zeros(len(at)), np.zeros(len(at), dtype=np.int64)
            for back in range(self.size - 1, -1, -1):
                i = np.maximum(at - back, 0)
                inside = (at - back >= first[at]) & (step[i] > step[at] - self.size)
                low = np.where(inside, np.minimum(low, i), low)
                total = np.where(inside & known[i], total + x[i], total)
                n += inside & known[i]
            mean = np.full(len(at), None, dtype=object)
            mean[n > 0] = total[n > 0] / n[n > 0]
            history = [values[a : b + 1].tolist() for a, b in zip(low.tolist(), at.tolist())]
            yield pd.DataFrame({"route_id": route[at], "step": step[at], "n_steps": at - low + 1, "mean_x": mean, "history": history})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        steps = self._load()
        if steps is None:
            return
        due = steps.open & ((steps.step + 1) * self.step_ms <= watermark)
        yield from self._windows(steps, np.flatnonzero(due))
        over = watermark >= (int(key[1]) + 1) * self.day_ms
        steps = steps._replace(open=steps.open & ~due)
        self._save(key, steps.taken(steps.open | (not over) & (steps.step + self.size > watermark // self.step_ms)))

    def close(self) -> None:
        pass


def trailing_steps_stream(panel: DataFrame, value: str = "travel_time_s", *, size: int = WINDOW_SIZE, step_minutes: int = STEP_MINUTES, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """T4: the trailing window of ``size`` steps ending at every observed step, as batch N6 gives it:
    route_id, window_end, n_steps, is_complete, mean_x, history.

    Keys are (bucket of routes, UTC day); the last ``size - 1`` steps of a day are also sent to
    the next day's key, so a route's days are separate groups.  Needs the RocksDB state store.
    """
    spark = panel.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    step_s, reach = step_minutes * 60, (size - 1) * step_minutes * 60
    us = _epoch_micros(F.col("ts_utc"))
    step = F.floor(us / 1_000_000 / step_s).cast("long")
    rows = with_event_time(panel.where("ts_utc IS NOT NULL").select("route_id", "ts_utc", F.coalesce("src_pos", F.lit(-(1 << 63))).alias("src_pos"), F.col(value).cast("double").alias("x")), lateness)
    rows = rows.select("event_time", F.coalesce("route_id", F.lit("")).alias("route_id"), us.alias("us"), "src_pos", "x", step.alias("step"))
    day = F.floor(F.col("step") * step_s / DAY).cast("long")
    late = F.col("step") * step_s % DAY >= DAY - reach
    copies = F.when(late, F.array(F.struct(day.alias("day"), F.lit(False).alias("copy")), F.struct((day + 1).alias("day"), F.lit(True).alias("copy"))))
    rows = rows.withColumn("_k", F.explode(F.coalesce(copies, F.array(F.struct(day.alias("day"), F.lit(False).alias("copy")))))).select("*", "_k.day", "_k.copy").drop("_k")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("route_id"), F.lit(BUCKETS)))
    out = rows.groupBy("bucket", "day").transformWithStateInPandas(TrailingSteps(size, step_s), TRAILING, "Append", "EventTime")
    end = F.timestamp_seconds(F.col("step") * step_s)
    return out.select("route_id", F.convert_timezone(F.current_timezone(), F.lit("UTC"), end.cast("timestamp_ntz")).alias("window_end"), "n_steps", (F.col("n_steps") == size).alias("is_complete"), "mean_x", "history")


# ---------------------------------------------------------------- T5 upserts


class LatestTable:
    """The latest row of each key, kept as Parquet by ``merge`` of micro-batches.

    A batch rewrites only the days it touches: ``day=D/batch=N`` holds all rows of the day as
    of batch N, and a day's current version is its highest committed batch.  A batch counts
    once its commit is written, so readers never see half of one; a batch that is repeated
    after a failure overwrites its own folders, and one that was committed changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], day: str):
        self.spark, self.path, self.keys, self.order, self.day = spark, path.rstrip("/"), list(keys), list(order), day

    def _commits(self) -> set[int]:
        at = f"{self.path}-commits"
        return {r["batch"] for r in self.spark.read.schema("batch long").json(at).collect()} if path_exists(self.spark, at) else set()

    def _versions(self) -> dict[str, int]:
        """Current committed batch of each day; the driver sees one row per written folder."""
        done = self._commits()
        if not done:
            return {}
        found = self.spark.read.option("basePath", self.path).schema("day string, batch long").parquet(self.path).select("day", "batch").distinct().collect()
        out: dict[str, int] = {}
        for r in found:
            if r["batch"] in done:
                out[r["day"]] = max(out.get(r["day"], -1), r["batch"])
        return out

    def read(self, days: Sequence[str] | None = None) -> DataFrame | None:
        """The latest rows (of ``days``); None before the first commit."""
        versions = {d: b for d, b in self._versions().items() if days is None or d in days}
        if not versions:
            return None
        folders = [f"{self.path}/day={d}/batch={b}" for d, b in sorted(versions.items())]
        return self.spark.read.option("basePath", self.path).option("mergeSchema", "false").parquet(*folders).drop("day", "batch")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id in self._commits():
            return
        columns = batch.columns
        new = batch.withColumn("day", F.date_format(self.day, "yyyy-MM-dd")).where("day IS NOT NULL").persist()
        try:
            days = [r["day"] for r in new.select("day").distinct().collect()]
            if days:
                old = self.read(days)
                rows = new.select(*columns) if old is None else old.select(*columns).unionByName(new.select(*columns))
                last = keep_last(rows, self.keys, self.order).select(*columns)
                out = last.withColumns({"day": F.date_format(self.day, "yyyy-MM-dd"), "batch": F.lit(batch_id).cast("long")})
                out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(self.path)
        finally:
            new.unpersist()
        self.spark.createDataFrame([(batch_id,)], "batch long").coalesce(1).write.mode("append").json(f"{self.path}-commits")


def upsert_stream(panel: DataFrame, table: LatestTable, name: str, *, available_now: bool = False):
    """T5: keep-last per key as an upsert; rows are visible with their batch, however late they are."""
    ckpt = f"{ensure_checkpoint_dir(panel.sparkSession).rstrip('/')}/streams/{name}"
    w = panel.writeStream.queryName(name).foreachBatch(lambda batch, i: table.merge(batch, i)).option("checkpointLocation", ckpt)
    return (w.trigger(availableNow=True) if available_now else w).start()
