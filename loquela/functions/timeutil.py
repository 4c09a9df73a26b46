"""Time arithmetic on integer microseconds, independent of the session time zone."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

#: Zones that exist in the public tz database; others are treated as unknown instead of raising in the JVM.
ZONES = sorted(z for z in available_timezones() if "/" in z or z == "UTC")


def known_zone(tz: Column) -> Column:
    """`tz` if it names a zone of the tz database, else null."""
    return F.when(tz.isin(*ZONES), tz)


def _shown(utc_us: Column, tz: Column) -> Column:
    """Wall time (as microseconds) that a clock of `tz` shows at the instant."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(utc_us), tz))


def resolve_wall(df: DataFrame, local: str, tz: str, out: str, status: str | None = None) -> DataFrame:
    """Add the one instant `out` at which clocks of column `tz` show the wall time `local` (microseconds).

    The candidates are the instants by the offset valid a day before and by the one valid a day after; one is right if
    a clock shows `local` at it. Null if the zone is unknown, if a clock change skips the wall time ('never') or if it
    occurs twice ('twice'); `status`, if given, says which. Built in stages, so that each step is computed once.
    """
    here = F.col(local)
    df = df.withColumn("_tzk", known_zone(F.col(tz)))
    for name, shift in (("_c1", -DAY_US), ("_c2", DAY_US)):
        df = df.withColumn(name, here - (_shown(here + shift, F.col("_tzk")) - (here + shift)))
    df = df.withColumn("_k1", _shown(F.col("_c1"), F.col("_tzk")) == here).withColumn("_k2", _shown(F.col("_c2"), F.col("_tzk")) == here)
    twice = F.col("_k1") & F.col("_k2") & (F.col("_c1") != F.col("_c2"))
    df = df.withColumn(out, F.when(twice, None).when(F.col("_k1"), F.col("_c1")).when(F.col("_k2"), F.col("_c2")).cast("long"))
    if status:
        found = F.when(F.col("_tzk").isNull(), "unknown_zone").when(twice, "twice").when(F.col("_k1") | F.col("_k2"), "resolved").otherwise("never")
        df = df.withColumn(status, found)
    return df.drop("_tzk", "_c1", "_c2", "_k1", "_k2")


def clock_parts(date: Column, time: Column) -> Column:
    """Wall microseconds of `YYYY-MM-DD` and `HH:MM[:SS]`; hour 24 belongs to the next day; null if malformed."""
    days = F.unix_date(F.when(F.length(F.trim(date)) >= 8, F.trim(date)).try_cast("date")).cast("long")
    part = lambda i: F.split_part(F.trim(time), F.lit(":"), F.lit(i)).try_cast("int")
    second = F.when(F.split_part(time, F.lit(":"), F.lit(3)) == "", 0).otherwise(part(3))
    h, mi, s = part(1), part(2), second
    good = h.between(0, 24) & mi.between(0, 59) & s.between(0, 59) & (F.split_part(time, F.lit(":"), F.lit(4)) == "")
    return F.when(good, (days * 86400 + h * 3600 + mi * 60 + s) * 1_000_000)
