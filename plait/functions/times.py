"""Dates and times from feeds and pages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_datetime(text: Column) -> Column:
    """ISO 8601 (zone optional: UTC) or RFC 2822 with or without a weekday, as a timestamp; else null."""
    value = F.trim(text)
    iso = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_timestamp(value))
    plain = F.regexp_replace(value, r"^[A-Za-z]{3,9},\s*", "")
    rest = [F.try_to_timestamp(plain, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm z", "d MMM yyyy HH:mm Z")]
    return F.coalesce(iso, *rest)


def valid_date(text: Column) -> Column:
    """A real calendar day written YYYY-MM-DD; else null."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))


def micros(moment: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone (UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def hours_apart(a: Column, b: Column) -> Column:
    return F.abs(micros(a) - micros(b)) / F.lit(3.6e9)


def days_apart(a: Column, b: Column) -> Column:
    return F.abs(micros(a) - micros(b)) / F.lit(8.64e10)


def fresh(published: Column, now: Column, hours: int) -> Column:
    """Not older than ``hours``; an unknown date is fresh."""
    return published.isNull() | (published >= now - F.make_dt_interval(hours=F.lit(hours)))


def guarded_date(page: Column, feed: Column, now: Column, hours: int) -> tuple[Column, Column]:
    """(published, source) from the page's and the feed's date.  The page's date wins unless it is stale and the feed's is not;
    both stale give source ``stale``, none gives nulls."""
    cutoff = now - F.make_dt_interval(hours=F.lit(hours))
    newest = F.greatest(page, feed)
    chosen = F.coalesce(page, feed)
    override = (chosen < cutoff) & (newest >= cutoff)
    source = F.when(newest.isNull(), F.lit(None)).when(newest < cutoff, "stale").when(override, "feed_override").when(page.isNotNull(), "page").otherwise("feed")
    return F.when(override | (newest < cutoff), newest).otherwise(chosen), source
