"""Streams over several micro-batches with rows on both sides of the lateness bound."""

import datetime as dt
import random
import uuid

import pandas as pd
import pytest

from citymotion.operators.normalize import keep_last
from citymotion.operators.scoring import step_series, trailing_windows
from citymotion.streaming import stateful
from citymotion.streaming.stateful import LatestTable, trailing_steps_stream, upsert_stream
from citymotion.streaming.streams import bucket_mean_stream, collision_hours_stream, dedupe_first_stream, start

SCHEMA = "route_id string, ts_utc timestamp_ntz, ts_local timestamp_ntz, travel_time_s double, src_pos long, is_injury boolean, fatalities long, dist_to_route_m double"
T0 = dt.datetime(2024, 5, 1, 22, 0)


def batches():
    """Three batches of minutes after T0; each later one has rows that are late within 2 h
    and rows that are later than that."""
    rnd = random.Random(7)
    times = [
        [rnd.randint(0, 180) for _ in range(60)],
        [rnd.randint(181, 420) for _ in range(60)] + [rnd.randint(70, 180) for _ in range(15)] + [5, 11, 50],
        [rnd.randint(421, 700) for _ in range(60)] + [rnd.randint(305, 420) for _ in range(15)] + [290, 100, 1, -200, -300],
    ]
    pos, out, watermark = 0, [], None
    for minutes in times:
        rows, seen = [], []
        for m in minutes:
            ts = T0 + dt.timedelta(minutes=m, seconds=rnd.randint(0, 59))
            late = watermark is not None and ts < watermark
            rows.append(((rnd.choice(["A_B", "C_D"]), ts, ts, rnd.choice([None, round(rnd.uniform(10, 90), 3)]), pos, pos % 3 == 0, pos % 2, float(pos)), late))
            seen.append(ts)
            pos += 1
        out.append(rows)
        watermark = max([t - dt.timedelta(hours=2) for t in seen] + ([watermark] if watermark else []))
    return out, watermark


def fed(spark, tmp_path, wanted=None):
    """A file stream with a batch per file, in order."""
    folder = str(tmp_path / f"in-{uuid.uuid4().hex}")
    for rows in wanted or [[r for r, _ in b] for b in batches()[0]]:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def drained(spark, stream, tmp_path):
    name = f"q{uuid.uuid4().hex}"
    q = start(stream, name, str(tmp_path / name), available_now=True)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def kept():
    parts, watermark = batches()
    assert all(sum(late for _, late in b) >= 3 for b in parts[1:])
    return [r for b in parts for r, late in b if not late], watermark


def hour_of(ts):
    return ts.replace(minute=0, second=0)


def kept_by_hour():
    """A window takes rows until the watermark passes its end; Spark judges a batch's rows by
    the watermark that was in force in the batch before."""
    parts, last = batches()
    out, dropped, bounds = [], 0, [None, None]
    for b in parts:
        for r, _ in b:
            late = bounds[-2] is not None and hour_of(r[1]) + dt.timedelta(hours=1) <= bounds[-2]
            dropped += late
            out += [] if late else [r]
        bounds.append(max([r[1] - dt.timedelta(hours=2) for r, _ in b] + ([bounds[-1]] if bounds[-1] else [])))
    assert bounds[-1] == last and dropped == 2
    return out, last


def test_trailing_steps_equal_batch(spark, tmp_path):
    rows, watermark = kept()
    got = drained(spark, trailing_steps_stream(fed(spark, tmp_path)), tmp_path)
    want = trailing_windows(step_series(spark.createDataFrame(rows, SCHEMA))).where(f"window_end + INTERVAL 5 MINUTES <= TIMESTAMP_NTZ'{watermark}'")
    pick = lambda df: sorted((r["route_id"], r["window_end"], r["n_steps"], r["is_complete"], r["history"], None if r["mean_x"] is None else round(r["mean_x"], 9)) for r in df.collect())
    assert pick(got) == pick(want)
    ends = {r["window_end"] for r in got.collect()}
    assert len(got.collect()) > 40 and {e.date() for e in ends} == {dt.date(2024, 5, 1), dt.date(2024, 5, 2)}


class OneState:
    """A state handle that counts what is read and written."""

    def __init__(self):
        self.held, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return self.held is not None

    def get(self):
        self.calls += 1
        return self.held

    def update(self, value):
        self.calls, self.held = self.calls + 1, value

    def clear(self):
        self.held = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark


@pytest.mark.parametrize("at_once", [7, 10_000])
def test_a_call_handles_all_routes_of_its_bucket(monkeypatch, at_once):
    monkeypatch.setattr(stateful, "EMITTED", at_once)
    rnd, day, seen, out = random.Random(3), 100, {}, {}
    state, steps = OneState(), stateful.TrailingSteps(12, 300)
    steps.init(state)
    for low, high, watermark in ((0, 40, 0), (20, 80, 30), (60, 288, 70), (0, 0, 289)):  # steps of a batch, watermark in it
        state.watermark = (day * 288 + watermark) * 300_000
        for step, (n, mean, history) in [((r.route_id, r.step), (r.n_steps, r.mean_x, r.history)) for f in steps.handleExpiredTimer((5, day), state, None) for r in f.itertuples(index=False)]:
            assert step not in out
            out[step] = n, None if mean is None or mean != mean else round(mean, 9), list(history)
        rows = []
        for i in range(400 if high else 0):
            step = day * 288 + rnd.randrange(low, high)
            row = f"R{rnd.randrange(9)}", step, step * 300_000_000 + rnd.randrange(3), rnd.randrange(4), rnd.choice([None, float(i)]), rnd.random() < 0.1
            rows.append(row)
            if step >= state.watermark // 300_000 and (row[:2] not in seen or row[2:4] > seen[row[:2]][:2]):
                seen[row[:2]] = (*row[2:5], not row[5])
        frame = pd.DataFrame(rows, columns=["route_id", "step", "us", "src_pos", "x", "copy"])
        before = state.calls
        list(steps.handleInputRows((5, day), iter([frame[:150], frame[150:]]) if rows else iter(()), state))
        assert state.calls <= before + 2
    want = {}
    for (route, step), held in seen.items():
        if held[3]:
            window = [seen[route, s][2] for s in range(step - 11, step + 1) if (route, s) in seen]
            known = [x for x in window if x is not None]
            want[route, step] = len(window), round(sum(known) / len(known), 9) if known else None, window
    assert out == want and len({r for r, _ in out}) == 9
    assert state.held is None and state.timers  # the day is over


def test_windows_of_hours_drop_only_what_is_too_late(spark, tmp_path):
    rows, watermark = kept_by_hour()
    got = drained(spark, collision_hours_stream(fed(spark, tmp_path)), tmp_path)
    want = {}
    for route, ts, _, _, _, injured, fatal, far in rows:
        hour = hour_of(ts)
        if hour + dt.timedelta(hours=1) <= watermark:
            n = want.setdefault((route, hour), [0, 0, 0, far])
            want[route, hour] = [n[0] + 1, n[1] + bool(injured), n[2] + (fatal > 0), min(n[3], far)]
    assert {(r["route_id"], r["ts_hour_utc"]): list(tuple(r)[2:]) for r in got.collect()} == want
    means = drained(spark, bucket_mean_stream(fed(spark, tmp_path), 60, "travel_time_s"), tmp_path)
    for r in means.collect():
        xs = [x[3] for x in rows if x[0] == r["route_id"] and hour_of(x[1]) == r["bucket_utc"] and x[3] is not None]
        assert r["value"] == (pytest.approx(sum(xs) / len(xs)) if xs else None)
    assert {(r["route_id"], r["bucket_utc"]) for r in means.collect()} == set(want)


def test_first_of_equal_keys_over_batches(spark, tmp_path):
    a = ("A_B", T0, T0, 1.0, 0, False, 0, 0.0)
    rows = [[a, ("A_B", T0 + dt.timedelta(hours=1), T0, 2.0, 1, False, 0, 0.0)], [("A_B", T0, T0, 9.0, 2, False, 0, 0.0), ("A_B", T0 + dt.timedelta(hours=9), T0, 3.0, 3, False, 0, 0.0)], [("A_B", T0 + dt.timedelta(hours=9), T0, 4.0, 4, False, 0, 0.0), ("A_B", T0 + dt.timedelta(hours=8), T0, 5.0, 5, False, 0, 0.0), ("C_D", T0 - dt.timedelta(hours=5), T0, 6.0, 6, False, 0, 0.0)]]
    got = drained(spark, dedupe_first_stream(fed(spark, tmp_path, rows)), tmp_path)
    assert sorted(r["src_pos"] for r in got.collect()) == [0, 1, 3, 5]  # 6 is beyond the bound


def latest(rows):
    return sorted(((r["route_id"], r["ts_utc"], r["src_pos"], r["travel_time_s"]) for r in rows), key=str)


def test_upserts_equal_batch_and_replays_change_nothing(spark, tmp_path):
    parts = [[r for r, _ in b] for b in batches()[0]]
    again = [(*r[:3], 1000.0 + k, 5000 + k, *r[5:]) for k, r in enumerate(parts[0][:20])]  # later rows of old keys
    older = [(*r[:3], -1.0, -1 - k, *r[5:]) for k, r in enumerate(parts[1][:5])]  # earlier positions change nothing
    parts.append(again + older)
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    want = latest(keep_last(whole, ["route_id", "ts_utc"], ["src_pos"]).collect())
    table = LatestTable(spark, str(tmp_path / "latest"), ["route_id", "ts_utc"], ["src_pos"], "ts_utc")
    assert table.read() is None
    upsert_stream(fed(spark, tmp_path, parts), table, f"u{uuid.uuid4().hex}", available_now=True).awaitTermination()
    assert latest(table.read().collect()) == want
    for i, p in enumerate(parts):  # every batch once more, out of order too
        table.merge(spark.createDataFrame(p, SCHEMA), len(parts) - 1 - i)
    assert latest(table.read().collect()) == want
    assert latest(table.read(["2024-05-01"]).collect()) == [r for r in want if r[1].date() == dt.date(2024, 5, 1)]


def test_a_batch_that_was_not_committed_is_not_read_and_is_overwritten(spark, tmp_path, monkeypatch):
    parts = [[r for r, _ in b] for b in batches()[0]]
    table = LatestTable(spark, str(tmp_path / "latest"), ["route_id", "ts_utc"], ["src_pos"], "ts_utc")
    table.merge(spark.createDataFrame(parts[0], SCHEMA), 0)
    before = latest(table.read().collect())
    broken = LatestTable(spark, table.path, table.keys, table.order, table.day)
    frame = spark.createDataFrame(parts[1], SCHEMA)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost before the commit")))
    with pytest.raises(RuntimeError, match="lost"):
        broken.merge(frame, 1)
    monkeypatch.undo()
    assert latest(table.read().collect()) == before
    table.merge(frame, 1)
    both = spark.createDataFrame(parts[0] + parts[1], SCHEMA)
    assert latest(table.read().collect()) == latest(keep_last(both, ["route_id", "ts_utc"], ["src_pos"]).collect())
