"""Text columns: tokenising and record rendering."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(line: Column) -> Column:
    """Split on single spaces; inner empty words stay, trailing ones go.

    An empty line holds one empty word, a line of spaces none.
    """
    trimmed = F.rtrim(line)
    blank = (line != "") & (trimmed == "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


# The texts below are fixed formats.


def timestamp_text(ts_ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.S`` in UTC, with trailing zeros of the fraction removed."""
    ts = F.timestamp_add("MILLISECOND", ts_ms, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    fraction = F.regexp_replace(F.date_format(ts, "SSS"), "0{1,2}$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("."), fraction)


def render_event(user: Column, url: Column, ts_ms: Column) -> Column:
    """Display text of an event record."""
    return F.concat(
        F.lit("Event{user='"), user, F.lit("', url='"), url,
        F.lit("', timestamp="), timestamp_text(ts_ms), F.lit("}"),
    )


def render_url_view_count(url: Column, pv: Column, start_ms: Column, end_ms: Column) -> Column:
    """Display text of a page-view count with its window."""
    return F.concat(
        F.lit("UrlViewCount{url='"), url, F.lit("', count="), pv.cast("string"),
        F.lit(", start="), timestamp_text(start_ms),
        F.lit(", end="), timestamp_text(end_ms), F.lit("}"),
    )


def render_login(user: Column, ip: Column, kind: Column, ts_ms: Column) -> Column:
    """Display text of a login record."""
    return F.concat(
        F.lit("LoginEventBean{userId='"), user, F.lit("', ipAddress='"), ip,
        F.lit("', eventType='"), kind, F.lit("', timestamp="), ts_ms.cast("string"), F.lit("}"),
    )
