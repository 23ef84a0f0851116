"""Time-zone-safe time handling as native Column expressions.

Canonical model: two ``TIMESTAMP_NTZ`` columns per instant —
``ts_utc`` (the join key, never ambiguous) and ``ts_local`` (wall clock in
the city zone).  Nothing here reads or changes ``spark.sql.session.timeZone``.

Rules that matter:
* ``date_trunc`` on an NTZ column goes through the session zone, so hour
  floors are done by subtracting minutes/seconds instead.
* naive local wall times are localised with the policy "ambiguous hour ->
  NULL, non-existent (spring gap) -> first valid instant".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citymotion import LOCAL_TZ

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_hour(ts: str | Column) -> Column:
    """Floor an NTZ timestamp to the hour (stays NTZ; no session-zone cast)."""
    t = _c(ts)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), _seconds(t))


def _seconds(t: Column) -> Column:
    # seconds with microsecond fraction, as decimal(8,6)
    return F.extract(F.lit("SECOND"), t)


def floor_minutes(ts: str | Column, minutes: int) -> Column:
    """Floor an NTZ timestamp to a ``minutes`` bucket aligned on the hour.

    Valid for bucket sizes dividing 60 (5, 10, 15, 20, 30, 60).
    """
    if 60 % minutes:
        raise ValueError(f"bucket of {minutes} min does not divide an hour")
    t = _c(ts)
    hour_start = floor_hour(t)
    return hour_start + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.floor(F.minute(t) / F.lit(minutes)) * F.lit(minutes)).cast("int")
    )


def utc_to_local(ts_utc: str | Column, tz: str = LOCAL_TZ) -> Column:
    """UTC NTZ instant -> local wall clock NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts_utc))


def local_date(ts_utc: str | Column, tz: str = LOCAL_TZ) -> Column:
    """Local calendar date of a UTC instant."""
    return F.to_date(utc_to_local(ts_utc, tz))


def localize(ts_local: str | Column, tz: str = LOCAL_TZ) -> Column:
    """Naive local wall clock -> UTC NTZ instant (F1).

    Ambiguous (autumn overlap) wall times become NULL; wall times inside the
    spring gap move to the first valid instant (02:30 -> 03:00 local).
    Assumes whole-hour DST shifts on hour boundaries (true for the city zone).
    """
    n = _c(ts_local)
    u = F.convert_timezone(F.lit(tz), F.lit("UTC"), n)
    in_gap = F.convert_timezone(F.lit("UTC"), F.lit(tz), u) != n
    in_overlap = F.convert_timezone(F.lit("UTC"), F.lit(tz), u + F.expr("INTERVAL 1 HOUR")) == n
    return F.when(in_overlap, F.lit(None)).when(in_gap, floor_hour(u)).otherwise(u)


def instant_to_utc_ntz(ts: str | Column) -> Column:
    """A TIMESTAMP (LTZ) instant -> its UTC wall clock as NTZ, exact to the microsecond,
    independent of the session zone."""
    micros = F.unix_micros(_c(ts)).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), micros.cast("decimal(18,6)"))


def epoch_ms_to_utc_ntz(ms: str | Column) -> Column:
    """Epoch milliseconds -> UTC NTZ."""
    secs = _c(ms).cast("decimal(20,0)") / F.lit(1000)
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))


def parse_offset_timestamp(text: str | Column) -> Column:
    """ISO text with a UTC offset (``2017-01-01T00:05:00-05``) -> UTC NTZ; text without an
    offset is UTC, whatever the session zone; junk -> NULL."""
    t = F.trim(_c(text))
    has_zone = t.rlike(r"(?i)(z|utc|gmt|[0-9:][+-][0-9]{1,2}(:?[0-9]{2})?)$") & t.contains(":")
    day_only = t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    zoned = F.when(has_zone, t).when(day_only, F.concat(t, F.lit("T00:00:00Z"))).otherwise(F.concat(F.regexp_replace(t, r"([ T][0-9]{1,2}:[0-9]{2})$", "$1:00"), F.lit("Z")))
    return instant_to_utc_ntz(F.try_to_timestamp(zoned))


def parse_naive_local(text: str | Column, fmt: str | None = None) -> Column:
    """Naive text in a fixed pattern -> wall-clock NTZ (no zone applied).

    Reads the text as if it were UTC so the session zone never shifts it,
    then keeps the wall clock.
    """
    t = _c(text)
    if fmt is None:
        return t.try_cast("timestamp_ntz")
    parsed = F.try_to_timestamp(F.concat(t, F.lit(" Z")), F.lit(fmt + " X"))
    return instant_to_utc_ntz(parsed)


def is_weekend(ts: str | Column) -> Column:
    return F.weekday(_c(ts)).isin(5, 6)


FREQ_MINUTES = {"5min": 5, "15min": 15, "30min": 30, "h": 60, "1h": 60, "60min": 60}
# fixed values: interval option labels offered for congestion frames
INTERVAL_OPTIONS = {"5 min": "5min", "15 min": "15min", "30 min": "30min", "1 hour": "h"}


def bucket_start(ts: str | Column, freq: str) -> Column:
    """Floor to a 5/15/30/60-minute bucket."""
    try:
        minutes = FREQ_MINUTES[freq]
    except KeyError as exc:
        raise ValueError(f"unsupported freq {freq!r}; use one of {sorted(FREQ_MINUTES)}") from exc
    return floor_minutes(ts, minutes)
