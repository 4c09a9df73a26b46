"""Problem 1: mixed timestamp formats and time zones.

Every value is parsed once into fields by the one notation it fits (ISO, compact, numeric day and month, month name,
epoch). Only numeric dates have more than one reading, day first or month first. Which one holds is a property of the
source that wrote them, learnt by expectation-maximisation over a two-format mixture per source: a value that is a date
under one reading only contributes its whole likelihood to it, a value that is a date under both is shared out by the
current weights, until these settle. The statistics of EM are three counts per source, so the iterations run inside one
row (a JVM `aggregate` over a fixed sequence), with no driver loop and no shuffle beyond one partial-aggregated group-by.
The posterior of each reading (with a noise component) then picks it, or marks the value as ambiguous.

Defined results: null, empty, unreadable, impossible and zone-less values of unknown zone give a null instant with the
reason in `status`; wall times that occur twice or never at a clock change likewise. Repeated rows are all kept.
Extra columns of the input are dropped by the projection, so clashing names do no harm.
"""

from __future__ import annotations

import re
from calendar import monthrange
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquela.functions.timeutil import DAY_US, ZONES

#: Month names and their usual short forms, Italian and English.
MONTHS = {
    "gennaio": 1, "gen": 1, "january": 1, "jan": 1,
    "febbraio": 2, "feb": 2, "february": 2,
    "marzo": 3, "mar": 3, "march": 3,
    "aprile": 4, "apr": 4, "april": 4,
    "maggio": 5, "mag": 5, "may": 5,
    "giugno": 6, "giu": 6, "june": 6, "jun": 6,
    "luglio": 7, "lug": 7, "july": 7, "jul": 7,
    "agosto": 8, "ago": 8, "august": 8, "aug": 8,
    "settembre": 9, "set": 9, "sett": 9, "september": 9, "sep": 9, "sept": 9,
    "ottobre": 10, "ott": 10, "october": 10, "oct": 10,
    "novembre": 11, "nov": 11, "november": 11,
    "dicembre": 12, "dic": 12, "december": 12, "dec": 12,
}
#: Zone abbreviations with one customary offset, in minutes. IST is read as India's, BST as Britain's.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "JST": 540, "COT": -300, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420,
}

_TIME = r"(\d{1,2})[:.\-h](\d{2})(?:[:.\-](\d{2})(?:[.,](\d{1,9}))?)?(?:\s*([AaPp])\.?[Mm]\.?)?"
_ZONE = r"(?:\s*([A-Za-z]{1,5}))?(?:\s*([+\-]\d{1,2}(?::?\d{2})?))?(?:\s*\[?([A-Za-z]+(?:/[A-Za-z0-9_+\-]+)+|UTC)\]?)?"
_REST = rf"(?:{_TIME}{_ZONE})?"
PATTERNS = {
    "iso": rf"^(\d{{4}})[\-/.](\d{{1,2}})[\-/.](\d{{1,2}})(?:[T _,]+{_REST})?$",
    "compact": rf"^(\d{{4}})(\d{{2}})(\d{{2}})[T_ \-]?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d{{1,9}}))?(){_ZONE}$",
    "numeric": rf"^(\d{{1,2}})[\-/.](\d{{1,2}})[\-/.](\d{{4}}|\d{{2}})(?:[T _,]+{_REST})?$",
    "named": rf"^(?:[A-Za-zì]{{2,10}},? )?(\d{{1,2}})°? ([A-Za-z]{{3,10}})\.?,? (\d{{4}})(?:,?(?: ore| alle| at)? {_REST})?$",
    "us_named": rf"^(?:[A-Za-zì]{{2,10}},? )?([A-Za-z]{{3,10}})\.? (\d{{1,2}}),? (\d{{4}})(?:,?(?: ore| alle| at)? {_REST})?$",
}
_COMPILED = {k: re.compile(p, re.ASCII) for k, p in {**PATTERNS, "epoch": r"^\d{10}(?:\d{3}|\d{6}|\d{9})?$"}.items()}
_ZONE_SET = frozenset(ZONES)


_PARSED = "kind string, dmy long, mdy long, utc_dmy long, utc_mdy long, state_dmy string, state_mdy string"
_EPOCH0 = date(1970, 1, 1).toordinal()


def _wall(year: int, month: int | None, day: int, clock_us: int | None) -> int | None:
    if clock_us is None or month is None or not (1900 <= year <= 2200 and 1 <= month <= 12 and 1 <= day <= monthrange(year, month)[1]):
        return None
    return (date(year, month, day).toordinal() - _EPOCH0) * DAY_US + clock_us


def _clock(hour: str | None, minute: str | None, second: str | None, fraction: str | None, half: str | None) -> int | None:
    h, m, s = int(hour or 0), int(minute or 0), int(second or 0)
    if half:
        h = h % 12 + 12 * (half.lower() == "p") if 1 <= h <= 12 else 99
    if h > 24 or m > 59 or s > 59:
        return None
    return ((h * 60 + m) * 60 + s) * 1_000_000 + int((fraction or "")[:6].ljust(6, "0"))


def parse_value(raw: str) -> tuple:
    """kind, wall time day first, wall time month first, epoch, offset in minutes, zone unreadable, zone named.

    Notations with one order only have the same wall time in both places; an impossible date or time has none.
    """
    text = " ".join(raw.split())
    if _COMPILED["epoch"].match(text):
        scale = {10: 1_000_000, 13: 1000, 16: 1}.get(len(text))
        return ("epoch", None, None, int(text) * scale if scale else int(text) // 1000, None, False, None)
    for kind in PATTERNS:
        if m := _COMPILED[kind].match(text):
            break
    else:
        return (None,) * 5 + (False, None)
    a, b, c, *clock, abbr, off, name = m.groups()
    at = _clock(*clock)
    if kind in ("iso", "compact"):
        first = second = _wall(int(a), int(b), int(c), at)
    else:
        year = int(c) + 2000 * (len(c) == 2)
        if kind == "numeric":
            first, second = _wall(year, int(b), int(a), at), _wall(year, int(a), int(b), at)
        else:
            month, day = (b, a) if kind == "named" else (a, b)
            first = second = _wall(year, MONTHS.get(month.lower()), int(day), at)
    offset, bad = None, bool(name and name not in _ZONE_SET)
    if abbr:
        offset = ABBREVIATIONS.get(abbr.upper())
        bad = bad or offset is None
    if off:
        digits = off[1:].replace(":", "")
        hours, minutes = (int(digits[:-2]), int(digits[-2:])) if len(digits) > 2 else (int(digits), 0)
        offset = (hours * 60 + minutes) * (-1 if off[0] == "-" else 1)
        bad = bad or abs(offset) > 14 * 60 or minutes > 59
    return (kind, first, second, None, offset, bad, name)


def place(local_us: int | None, offset: int | None, zone: str | None) -> tuple[int | None, str]:
    """The instant of a wall time by its offset, else by its zone, and 'resolved', or why there is none."""
    if local_us is None:
        return None, "impossible"
    if offset is not None:
        return local_us - offset * 60_000_000, "resolved"
    if zone not in _ZONE_SET:
        return None, "unknown_zone"
    wall = datetime(1970, 1, 1) + timedelta(microseconds=local_us)
    tz = ZoneInfo(zone)
    early, late = (wall.replace(tzinfo=tz, fold=fold).utcoffset() for fold in (0, 1))
    if early != late:
        return None, "twice" if early > late else "never"
    return local_us - early // timedelta(microseconds=1), "resolved"


def _row(value: object, tz: object) -> tuple:
    if not isinstance(value, str) or not value.strip():
        return None, None, None, None, None, "null", "null"
    kind, dmy, mdy, epoch, offset, bad, name = parse_value(value)
    if epoch is not None:
        return kind, epoch, epoch, epoch, epoch, "resolved", "resolved"
    if kind is None or bad:
        return None, None, None, None, None, "unreadable", "unreadable"
    zone = name or tz
    utc_d, state_d = place(dmy, offset, zone)
    utc_m, state_m = place(mdy, offset, zone) if mdy != dmy else (utc_d, state_d)
    return kind, dmy, mdy, utc_d, utc_m, state_d, state_m


def _parse(values: pd.Series, zones: pd.Series) -> pd.DataFrame:
    rows = [_row(v, z) for v, z in zip(values, zones)]
    types = {"kind": "object", "dmy": "Int64", "mdy": "Int64", "utc_dmy": "Int64", "utc_mdy": "Int64", "state_dmy": "object", "state_mdy": "object"}
    return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=t) for i, (n, t) in enumerate(types.items())})


def parse(df: DataFrame, value: str, tz: str) -> DataFrame:
    """Add `_kind`, and under either reading, day first and month first, the wall time, the instant and its state.

    Notations differ too much for one JVM expression (the generated code passes the JVM's method limits), so the fields
    come from one Arrow-batched function; everything after it stays in the JVM.
    """
    df = df.withColumn("_p", F.pandas_udf(_parse, _PARSED)(F.col(value), F.col(tz)))
    names = ("kind", "dmy", "mdy", "utc_dmy", "utc_mdy", "state_dmy", "state_mdy")
    return df.withColumns({f"_{n}": F.col(f"_p.{n}") for n in names}).drop("_p")


def learn_orders(parsed: DataFrame, source: str, iterations: int = 40, prior: float = 0.01) -> DataFrame:
    """EM weight of day-first (`_w_dmy`) per source, from the numeric dates of all its rows.

    E-step: a value readable both ways gives `w` to day-first and `1 - w` to month-first. M-step: new weights from the
    summed responsibilities with a symmetric Dirichlet prior. A source with no decisive value stays at 0.5.
    """
    num = F.col("_kind") == "numeric"
    d, m = F.col("_dmy").isNotNull(), F.col("_mdy").isNotNull()
    counts = (
        parsed.filter(num & (d | m) & ~F.col("_dmy").eqNullSafe(F.col("_mdy")))
        .groupBy(F.col(source).alias("_src"))
        .agg(
            F.sum(F.when(d & ~m, 1.0).otherwise(0.0)).alias("_nd"),
            F.sum(F.when(m & ~d, 1.0).otherwise(0.0)).alias("_nm"),
            F.sum(F.when(m & d, 1.0).otherwise(0.0)).alias("_nb"),
        )
    )
    step = f"(_nd + _nb * w + {prior}D) / (_nd + _nm + _nb + {2 * prior}D)"
    return counts.select("_src", F.expr(f"aggregate(sequence(1, {iterations}), 0.5D, (w, i) -> {step})").alias("_w_dmy"))


def normalise(
    df: DataFrame, keys: list[str], value: str, tz: str, source: str, threshold: float = 0.8, noise: float = 0.02
) -> DataFrame:
    """Keys, `utc_us`, `posterior` and `status` of each row of `df`; exactly one row out for each row in."""
    base = df.select(*keys, F.col(value).alias("_raw"), F.col(tz).alias("_tz"), F.col(source).alias("_source"))
    parsed = parse(base, "_raw", "_tz")
    orders = learn_orders(parsed, "_source")
    joined = parsed.join(orders, parsed["_source"].eqNullSafe(orders["_src"]), "left").drop("_src")
    w = F.coalesce(F.col("_w_dmy"), F.lit(0.5))
    d, m = F.col("_dmy").isNotNull(), F.col("_mdy").isNotNull()
    like_d, like_m = F.when(d, w).otherwise(0.0), F.when(m, 1 - w).otherwise(0.0)
    same = F.col("_dmy").eqNullSafe(F.col("_mdy"))
    post = F.when((F.col("_kind") != "numeric") | same, 1.0).otherwise(F.greatest(like_d, like_m) / (like_d + like_m + noise))
    sure, day_first = post >= threshold, same | (like_d >= like_m)
    chosen = lambda a, b: F.when(day_first, F.col(a)).otherwise(F.col(b))
    return joined.select(
        *keys,
        F.when(sure, chosen("_utc_dmy", "_utc_mdy")).alias("utc_us"),
        F.when(F.col("_kind").isNotNull(), post).alias("posterior"),
        F.when(F.col("_kind").isNull() | same | sure, chosen("_state_dmy", "_state_mdy")).otherwise("ambiguous_order").alias("status"),
    )


def session_instants(sessions: DataFrame, wearers: DataFrame) -> DataFrame:
    """row_id, stem, wearer_id, duration_sec, utc_us, posterior and status of every session row."""
    zones = wearers.select("wearer_id", "tz")
    df = sessions.select("row_id", "stem", "wearer_id", "duration_sec", "recorded_at", "source_device").join(zones, "wearer_id", "left")
    return normalise(df, ["row_id", "stem", "wearer_id", "duration_sec"], "recorded_at", "tz", "source_device")


def night_instants(nights: DataFrame, wearers: DataFrame) -> DataFrame:
    """origin, row_id, utc_us, posterior and status of both times of every night; the wearer is the source."""
    zones = wearers.select("wearer_id", "tz")
    both = nights.select(
        F.col("night_id").alias("row_id"), "wearer_id",
        F.expr("stack(2, 'night_start', start_at, 'night_stop', stop_at) as (origin, at)"),
    )
    return normalise(both.join(zones, "wearer_id", "left"), ["origin", "row_id"], "at", "tz", "wearer_id")


def all_instants(sessions: DataFrame, nights: DataFrame, wearers: DataFrame) -> DataFrame:
    """origin, row_id, utc_us, posterior, status over both tables; unresolved values have a null instant."""
    left = session_instants(sessions, wearers).select(F.lit("session").alias("origin"), "row_id", "utc_us", "posterior", "status")
    return left.unionByName(night_instants(nights, wearers))
