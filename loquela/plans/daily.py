"""Queries on events, readings and days: blocks, conversations, coverage, windows, wearable documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.functions.timeutil import clock_parts
from loquela.operators import ranges, sequence
from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_EV = "(SELECT event_id, user_id, event_type, value, epoch(ts)::DOUBLE AS a, epoch(ts) + 30 AS b FROM events)"
_HR = """(SELECT wearer_id, reading_id, heart_rate, export_ms, hr_date, (epoch(hr_date::TIMESTAMP) / 60)::BIGINT + 60 * split_part(hr_time, ':', 1)::BIGINT + split_part(hr_time, ':', 2)::BIGINT AS minute
FROM helio_battito WHERE heart_rate BETWEEN 25 AND 230 AND hr_date IS NOT NULL AND hr_time IS NOT NULL)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of half a minute (start and end in seconds)."""
    a = (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", a.alias("a"), (a + 30).alias("b"))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plausible readings with their wall minute."""
    df = table(spark, sf_dir, "helio_battito").filter("heart_rate between 25 and 230")
    minute = F.floor(clock_parts(F.col("hr_date"), F.col("hr_time")) / 60_000_000).cast("long")
    return df.select("wearer_id", "reading_id", "heart_rate", "export_ms", "hr_date", minute.alias("minute")).filter("minute is not null")


@query(f"""WITH l AS (SELECT *, lag(b) OVER (PARTITION BY user_id ORDER BY a, event_id) AS p FROM {_EV}),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR a - p > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, event_id) AS block FROM l)
SELECT user_id, block::BIGINT AS block, count(*) AS n, round(min(a), 3) AS first_start, round(max(b), 3) AS last_end FROM i GROUP BY user_id, block""")
def continuous_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of rows at most 300 s after the end of the row before (inclusive)."""
    b = sequence.blocks_by_gap(_events(spark, sf_dir), ["user_id"], "a", "b", 300, "event_id")
    return b.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.round(F.min("a"), 3).alias("first_start"), F.round(F.max("b"), 3).alias("last_end"))


@query(f"""WITH l AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {_EV}),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR a - p >= 60 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, event_id) AS c FROM l)
SELECT user_id, c::BIGINT AS conversation, count(*) AS n, count(DISTINCT event_type) AS kinds, arg_min(event_type, (a, event_id)) AS opener, arg_max(event_type, (a, event_id)) AS closer FROM i GROUP BY user_id, c""")
def conversation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations (a new one 60 s or more after the latest end) with who opens and closes them."""
    c = sequence.conversations(_events(spark, sf_dir), ["user_id"], "a", "b", 60, "event_id")
    at = F.struct("a", "event_id")
    return c.groupBy("user_id", "conversation").agg(F.count("*").alias("n"), F.countDistinct("event_type").alias("kinds"), F.min_by("event_type", at).alias("opener"), F.max_by("event_type", at).alias("closer"))


@query(f"""WITH l AS (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS rn FROM {_EV} WINDOW w AS (PARTITION BY user_id ORDER BY a, event_id)),
i AS (SELECT *, sum(CASE WHEN rn = 1 OR event_type IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, event_id) AS run FROM l)
SELECT user_id, run::BIGINT AS run, min(event_type) AS event_type, count(*) AS n FROM i GROUP BY user_id, run""")
def equal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = sequence.same_value_runs(_events(spark, sf_dir), ["user_id"], ["a", "event_id"], "event_type")
    return r.groupBy("user_id", "run").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"))


@query("""SELECT stem, minute, round(sum(least(e, (minute + 1) * 60.0) - greatest(s, minute * 60.0)), 3) AS covered FROM
(SELECT stem, start_sec AS s, end_sec AS e, unnest(range(floor(start_sec / 60)::BIGINT, floor(end_sec / 60)::BIGINT + 1)) AS minute FROM segments WHERE end_sec > start_sec)
GROUP BY stem, minute HAVING sum(greatest(0, least(e, (minute + 1) * 60.0) - greatest(s, minute * 60.0))) > 0""")
def minute_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds of speech in each minute of each session."""
    c = ranges.minute_coverage(table(spark, sf_dir, "segments"), ["stem"], "start_sec", "end_sec")
    return c.select("stem", "minute", F.round("covered", 3).alias("covered"))


@query("""SELECT a.stem, count(*) AS pairs, round(sum(least(a.end_sec, b.end_sec) - greatest(a.start_sec, b.start_sec)), 3) AS shared FROM segments a JOIN segments b
ON a.stem = b.stem AND a.segment_id < b.segment_id AND a.start_sec < b.end_sec AND b.start_sec < a.end_sec GROUP BY a.stem""")
def overlapping_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds in which segments of a session overlap (bucketed range join)."""
    s = table(spark, sf_dir, "segments").filter("start_sec is not null and end_sec is not null and end_sec >= start_sec").select("stem", "segment_id", "start_sec", "end_sec")
    o = ranges.overlaps(s, s, ["stem"], "start_sec", "end_sec", 30.0).filter("segment_id < right_segment_id")
    return o.groupBy("stem").agg(F.count("*").alias("pairs"), F.round(F.sum("shared"), 3).alias("shared"))


@query(f"""SELECT wearer_id, floor(minute / 60)::BIGINT % 24 AS hour, count(*) AS n, sum(heart_rate)::BIGINT AS s1, sum(heart_rate * heart_rate)::BIGINT AS s2, min(heart_rate) AS low, max(heart_rate) AS high FROM {_HR} GROUP BY ALL""")
def hourly_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mergeable sums of the pulse by wearer and hour of the day."""
    r = _readings(spark, sf_dir)
    return r.groupBy("wearer_id", (F.floor(F.col("minute") / 60) % 24).cast("long").alias("hour")).agg(
        F.count("*").alias("n"), F.sum("heart_rate").alias("s1"), F.sum(F.col("heart_rate") * F.col("heart_rate")).alias("s2"), F.min("heart_rate").alias("low"), F.max("heart_rate").alias("high"),
    )


@query(f"""SELECT wearer_id, floor(minute / 5)::BIGINT AS slot, round(avg(heart_rate), 4) AS mean_rate, count(*) AS n FROM
(SELECT *, row_number() OVER (PARTITION BY wearer_id, minute ORDER BY export_ms DESC, reading_id) AS k FROM {_HR}) WHERE k = 1 GROUP BY ALL""")
def five_minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean pulse of each five minutes; of repeated minutes the newest export counts."""
    newest = F.row_number().over(Window.partitionBy("wearer_id", "minute").orderBy(F.desc("export_ms"), "reading_id"))
    one = _readings(spark, sf_dir).withColumn("k", newest).filter("k = 1")
    return one.groupBy("wearer_id", F.floor(F.col("minute") / 5).cast("long").alias("slot")).agg(F.round(F.avg("heart_rate"), 4).alias("mean_rate"), F.count("*").alias("n"))


@query(f"""WITH m AS (SELECT wearer_id, minute, avg(heart_rate) AS r FROM {_HR} GROUP BY ALL),
w AS (SELECT wearer_id, unnest([5 * (minute // 5) - 25, 5 * (minute // 5) - 20, 5 * (minute // 5) - 15, 5 * (minute // 5) - 10, 5 * (minute // 5) - 5, 5 * (minute // 5)]) AS start, r FROM m)
SELECT wearer_id, start // 1440 AS day, round(min(x), 4) AS resting FROM (SELECT wearer_id, start, avg(r) AS x FROM w GROUP BY ALL HAVING count(*) >= 20) GROUP BY ALL""")
def resting_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest mean of a 30-minute window (step 5 minutes) with 20 readings or more, by day."""
    m = _readings(spark, sf_dir).groupBy("wearer_id", "minute").agg(F.avg("heart_rate").alias("r"))
    base = (F.floor(F.col("minute") / 5) * 5).cast("long")
    starts = m.select("wearer_id", "r", F.explode(F.sequence(base - 25, base, F.lit(5))).alias("start"))
    means = starts.groupBy("wearer_id", "start").agg(F.avg("r").alias("x"), F.count("*").alias("n")).filter("n >= 20")
    return means.groupBy("wearer_id", F.floor(F.col("start") / 1440).cast("long").alias("day")).agg(F.round(F.min("x"), 4).alias("resting"))


@query(f"""WITH d AS (SELECT wearer_id, minute // 1440 AS day, heart_rate FROM {_HR}), days AS (SELECT DISTINCT wearer_id, day FROM d)
SELECT g.wearer_id, g.day, round(quantile_cont(d.heart_rate, 0.9), 4) AS p90, count(*) AS n FROM days g JOIN d ON d.wearer_id = g.wearer_id AND d.day BETWEEN g.day - 27 AND g.day GROUP BY ALL""")
def activation_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal 90th percentile of the pulse over 28 days, for every day (histograms by day are merged, not readings)."""
    d = _readings(spark, sf_dir).groupBy("wearer_id", F.floor(F.col("minute") / 1440).cast("long").alias("day"), "heart_rate").agg(F.count("*").alias("c"))
    spread = d.select("wearer_id", "heart_rate", "c", F.explode(F.sequence(F.col("day"), F.col("day") + 27)).alias("day"))
    days = d.select("wearer_id", "day").distinct()
    rolling = spread.groupBy("wearer_id", "day", "heart_rate").agg(F.sum("c").alias("c")).join(days, ["wearer_id", "day"], "left_semi")
    return rolling.groupBy("wearer_id", "day").agg(F.round(F.percentile("heart_rate", F.lit(0.9), F.col("c")), 4).alias("p90"), F.sum("c").alias("n"))


@query("""SELECT wearer_id, sleep_date, arg_max(night_id, (coalesce(deep_sleep_time, 0) + coalesce(shallow_sleep_time, 0) + coalesce(rem_time, 0), export_ms, night_id)) AS night_id, count(*) AS n FROM helio_notti GROUP BY ALL""")
def night_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest night of a date; revisions by later exports win ties."""
    slept = F.coalesce("deep_sleep_time", F.lit(0)) + F.coalesce("shallow_sleep_time", F.lit(0)) + F.coalesce("rem_time", F.lit(0))
    best = F.max_by("night_id", F.struct(slept.alias("s"), "export_ms", "night_id"))
    return table(spark, sf_dir, "helio_notti").groupBy("wearer_id", "sleep_date").agg(best.alias("night_id"), F.count("*").alias("n"))


@query("""SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS start, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY ALL""")
def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("""SELECT b - i * INTERVAL 15 SECONDS AS start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 15 SECONDS, ts) AS b, unnest(range(4)) AS i FROM events) GROUP BY ALL""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of 60-second windows that start every 15 seconds."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "60 seconds", "15 seconds").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("""WITH l AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR ts > p + INTERVAL 10 MINUTES THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM l)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 10 MINUTES AS stop, count(*) AS n FROM i GROUP BY user_id, k""")
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    s = e.groupBy(F.session_window("ts", "10 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("stop"), "n")


@query("""SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, event_type FROM events""")
def salvaged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of JSON objects salvaged from replies that fence them, talk around them and leave commas before closing brackets."""
    reply = F.concat(F.lit("Ecco:\n```json\n"), F.regexp_replace("props", r"\}\s*$", ",}"), F.lit("\n```\nfine"))
    return table(spark, sf_dir, "events").select("event_id", F.from_json(T.salvaged_object(reply), "k long")["k"].alias("k"), "event_type")
