"""Text coercions used by the raw-format normalisers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citymotion.functions.timez import instant_to_utc_ntz

# fixed values: event date/time layouts tried in order (Java pattern letters)
EVENT_DATETIME_FORMATS = (
    "MMM d, yyyy h:mm a",
    "MMMM d, yyyy h:mm a",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)
# fixed values: road-closure text meaning "no closure"
NO_CLOSURE_TEXT = ("", "none", "null")
NUMBER_PATTERN = r"-?[0-9]+(?:[.][0-9]+)?"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def yes_no(col: str | Column) -> Column:
    """YES / NO / Y / N (trimmed, any case) -> boolean; anything else -> NULL."""
    v = F.upper(F.trim(_c(col)))
    return F.when(v.isin("YES", "Y"), F.lit(True)).when(v.isin("NO", "N"), F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def first_number(col: str | Column) -> Column:
    """First number in messy text after removing thousands commas, as double."""
    hit = F.regexp_extract(F.regexp_replace(_c(col), ",", ""), NUMBER_PATTERN, 0)
    return F.nullif(hit, F.lit("")).try_cast("double")


def event_datetime(date_text: str | Column, time_text: str | Column) -> Column:
    """Wall-clock NTZ from organiser date + optional time text.

    Candidates are "date time" (when a time is given) then "date"; for each
    candidate the layouts are tried in order; the first success wins.
    """
    d = F.trim(_c(date_text))
    t = F.trim(F.coalesce(_c(time_text), F.lit("")))
    with_time = F.when(t != "", F.concat_ws(" ", d, t))
    # each layout parses the text as a UTC instant (suffix " Z"), the first hit wins, and the
    # instant is turned back into its wall clock once; the lambda keeps a single copy of the
    # layouts in small code, since two such columns in one generated method are too long to be compiled
    def first_hit(hit: Column, text: Column) -> Column:
        timed = F.when(text.contains(":"), text)  # the others fit no layout with a time
        return F.coalesce(hit, *[F.try_to_timestamp(timed if ":" in fmt else text, F.lit(fmt + " X")) for fmt in EVENT_DATETIME_FORMATS])

    texts = F.array(F.concat(with_time, F.lit(" Z")), F.concat(d, F.lit(" Z")))
    return instant_to_utc_ntz(F.aggregate(texts, F.lit(None).cast("timestamp"), first_hit))


def road_closed(col: str | Column) -> Column:
    """True unless the text is empty / none / null."""
    return ~F.lower(F.trim(F.coalesce(_c(col), F.lit("")))).isin(*NO_CLOSURE_TEXT)
