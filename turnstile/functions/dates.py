"""ISO text to date and time parts.

Timestamps are parsed as TIMESTAMP_NTZ, so results do not depend on the session zone.
"""

from __future__ import annotations

from functools import lru_cache
from zoneinfo import available_timezones

from pyspark.sql import Column, SparkSession, functions as F

from turnstile.functions.values import blank_to_null

# What is accepted once every "Z" is removed; offsets and longer fractions are not.
ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"


@lru_cache(maxsize=1)
def known_zones() -> tuple[str, ...]:
    """Every zone name of the tz database that Spark's JVM can convert, too."""
    java = SparkSession.getActiveSession()._jvm.java
    listed = java.lang.String.join("|", java.time.ZoneId.getAvailableZoneIds())
    return tuple(sorted(available_timezones() & set(listed.split("|"))))


def is_known_zone(zone: Column) -> Column:
    """False for unknown and missing zone ids. One literal, so the plan stays small."""
    listed = F.lit("|" + "|".join(known_zones()) + "|")
    found = listed.contains(F.concat(F.lit("|"), zone, F.lit("|"))) & ~zone.contains("|")
    return F.coalesce(found & (F.length(zone) > 0), F.lit(False))


def split_iso(c: Column, zone: Column | None = None) -> tuple[Column, Column]:
    """(date, time) text of an ISO timestamp.

    Text ending in ``Z`` is shifted to ``zone`` when that is a known zone id, otherwise
    it stays UTC. Text that does not parse is returned whole as the date, with no time.
    """
    bare = F.replace(c, F.lit("Z"), F.lit(""))
    stamp = F.when(
        c.contains("T") & bare.rlike(ISO_SHAPE),
        F.regexp_replace(bare, r"\.\d+$", "").try_cast("timestamp_ntz"),
    )
    if zone is not None:
        known = is_known_zone(zone)
        safe_zone = F.when(known, zone).otherwise("UTC")
        stamp = F.when(
            c.endswith("Z") & known, F.convert_timezone(F.lit("UTC"), safe_zone, stamp)
        ).otherwise(stamp)
    text = stamp.cast("string")
    date = F.coalesce(F.substring(text, 1, 10), c)
    return date, F.substring(text, 12, 8)


def split_filled(c: Column) -> tuple[Column, Column]:
    """``split_iso`` for fields where an empty string means no date at all."""
    return split_iso(blank_to_null(c))


def weekday_columns(date: Column) -> tuple[Column, Column, Column]:
    """(weekday name, 0=Sunday number, weekend flag); null unless a real yyyy-MM-dd date."""
    day = F.when(date.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), date.try_cast("date"))
    number = F.dayofweek(day) - 1
    return F.date_format(day, "EEEE"), number, number.isin(0, 6)
