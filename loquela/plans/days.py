"""Day documents and daily metrics: sessions laid out on days, segments, voices, turns, hours and pulse by who speaks.

The clean column `processed_at` stands for a session's start. Windows run over the sessions of a wearer or the segments of
a wearer's day, both bounded by recorded time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

CONTINUES_SEC, TURN_SEC = 300, 60

_SESSIONS = """(SELECT stem, min(wearer_id) AS wearer_id, min(epoch(processed_at::TIMESTAMP))::BIGINT AS t0, max(CASE WHEN duration_sec > 0 THEN duration_sec ELSE 0 END) AS dur,
max(coalesce(speech_sec, 0)) AS speech FROM sessions WHERE stem IS NOT NULL AND processed_at IS NOT NULL AND wearer_id IS NOT NULL GROUP BY stem)"""
_BLOCKS = f"""(SELECT *, (dense_rank() OVER (PARTITION BY wearer_id, day ORDER BY b) - 1)::BIGINT AS block FROM
(SELECT *, min(t0) OVER (PARTITION BY wearer_id, b) // 86400 AS day FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY wearer_id ORDER BY t0, stem) AS b FROM
(SELECT *, t0 - lag(t0 + dur) OVER (PARTITION BY wearer_id ORDER BY t0, stem) AS gap FROM {_SESSIONS}))))"""
_SEGMENTS = f"""(SELECT wearer_id, day, b.stem, idx, segment_id, coalesce(speaker, 'UNKNOWN') AS speaker, text, quality, coalesce(n_words, 0) AS n_words,
t0 - day * 86400 + start_sec AS s, t0 - day * 86400 + greatest(coalesce(end_sec, start_sec), start_sec) AS e
FROM (SELECT *, row_number() OVER (PARTITION BY stem, idx ORDER BY segment_id) AS k FROM segments WHERE start_sec IS NOT NULL AND idx IS NOT NULL) x JOIN {_BLOCKS} b ON x.stem = b.stem WHERE k = 1)"""
_TURNS = f"""(SELECT *, sum(CASE WHEN far THEN 1 ELSE 0 END) OVER (PARTITION BY wearer_id, day ORDER BY s, segment_id) AS turn FROM
(SELECT *, runs <> coalesce(lag(runs) OVER w, -1) OR s - max(e) OVER (PARTITION BY wearer_id, day, runs ORDER BY s, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= 60 AS far FROM
(SELECT *, sum(CASE WHEN speaker IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER w AS runs FROM
(SELECT *, lag(speaker) OVER w AS before FROM {_SEGMENTS} WINDOW w AS (PARTITION BY wearer_id, day ORDER BY s, segment_id)) WINDOW w AS (PARTITION BY wearer_id, day ORDER BY s, segment_id))
WINDOW w AS (PARTITION BY wearer_id, day ORDER BY s, segment_id)))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per session: its day (that of its block's start), its block of the day, and the gap to the session before.

    A session at most CONTINUES_SEC after the end of the one before continues its block, past midnight too.
    """
    df = table(spark, sf_dir, "sessions").filter("stem is not null and processed_at is not null and wearer_id is not null")
    at = F.unix_micros(F.to_timestamp("processed_at")) / 1_000_000
    one = df.groupBy("stem").agg(
        F.min("wearer_id").alias("wearer_id"), F.floor(F.min(at)).cast("long").alias("at"),
        F.max(F.when(F.col("duration_sec") > 0, F.col("duration_sec")).otherwise(0.0)).alias("dur"), F.max(F.coalesce("speech_sec", F.lit(0.0))).alias("speech"),
    )
    order = Window.partitionBy("wearer_id").orderBy("at", "stem")
    gap = F.col("at") - F.lag(F.col("at") + F.col("dur")).over(order)
    numbered = one.withColumn("gap", gap).withColumn("b", F.sum(F.when(F.col("gap").isNull() | (F.col("gap") > CONTINUES_SEC), 1).otherwise(0)).over(order))
    days = numbered.withColumn("day", F.floor(F.min("at").over(Window.partitionBy("wearer_id", "b")) / 86400).cast("long"))
    return days.withColumn("block", (F.dense_rank().over(Window.partitionBy("wearer_id", "day").orderBy("b")) - 1).cast("long"))


def day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed segments (repeated (stem, idx) once) with wearer, day and seconds of that day."""
    own = Window.partitionBy("stem", "idx").orderBy("segment_id")
    df = table(spark, sf_dir, "segments").filter("start_sec is not null and idx is not null")
    one = df.select("stem", "idx", "segment_id", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"), "text", "quality", F.coalesce("n_words", F.lit(0)).alias("n_words"), "start_sec", "end_sec")
    joined = one.withColumn("_k", F.row_number().over(own)).filter("_k = 1").drop("_k").join(blocks(spark, sf_dir).select("stem", "wearer_id", "day", "at"), "stem")
    begin = F.col("at") - F.col("day") * 86400
    end = F.greatest(F.coalesce("end_sec", "start_sec"), F.col("start_sec"))
    return joined.withColumn("s", begin + F.col("start_sec")).withColumn("e", begin + end).drop("start_sec", "end_sec", "at")


def _in_day() -> WindowSpec:
    return Window.partitionBy("wearer_id", "day").orderBy("s", "segment_id")


def day_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with the number of their turn: one voice, each less than TURN_SEC after the latest end of the turn's voice run."""
    df = day_rows(spark, sf_dir).withColumn("_before", F.lag("speaker").over(_in_day()))
    df = df.withColumn("runs", F.sum(F.when(F.col("speaker").eqNullSafe(F.col("_before")), 0).otherwise(1)).over(_in_day()))
    reach = F.max("e").over(Window.partitionBy("wearer_id", "day", "runs").orderBy("s", "segment_id").rowsBetween(Window.unboundedPreceding, -1))
    far = (F.col("runs") != F.coalesce(F.lag("runs").over(_in_day()), F.lit(-1))) | F.coalesce(F.col("s") - reach >= TURN_SEC, F.lit(False))
    return df.withColumn("_far", far.cast("int")).withColumn("turn", F.sum("_far").over(_in_day())).drop("_before", "_far")


@query(f"SELECT stem, wearer_id, day, block, round(gap, 3) AS gap_sec FROM {_BLOCKS}")
def day_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions on their days and blocks."""
    return blocks(spark, sf_dir).select("stem", "wearer_id", "day", "block", F.round("gap", 3).alias("gap_sec"))


@query(f"""SELECT wearer_id, day, block, min(t0) AS first_start, round(max(t0 + dur), 3) AS last_end, count(*) AS sessions, round(sum(speech), 3) AS speech_sec FROM {_BLOCKS} GROUP BY ALL""")
def day_block_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).groupBy("wearer_id", "day", "block").agg(
        F.min("at").alias("first_start"), F.round(F.max(F.col("at") + F.col("dur")), 3).alias("last_end"), F.count("*").alias("sessions"), F.round(F.sum("speech"), 3).alias("speech_sec"))


@query(f"""SELECT segment_id, wearer_id, day, (row_number() OVER (PARTITION BY wearer_id, day ORDER BY s, segment_id) - 1)::BIGINT AS day_idx, round(s, 3) AS day_sec,
printf('%02d:%02d:%02d', floor(s)::BIGINT // 3600, floor(s)::BIGINT // 60 % 60, floor(s)::BIGINT % 60) AS clock FROM {_SEGMENTS}""")
def day_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a day with running number, seconds of the day and clock (hours go on past 24)."""
    n = (F.row_number().over(_in_day()) - 1).cast("long")
    return day_rows(spark, sf_dir).select("segment_id", "wearer_id", "day", n.alias("day_idx"), F.round("s", 3).alias("day_sec"), T.hms(F.col("s")).alias("clock"))


@query(f"""SELECT wearer_id, day, speaker, round(sum(e - s), 3) AS seconds, sum(n_words)::BIGINT AS words, count(*) AS segments, count(DISTINCT stem) AS sessions FROM {_SEGMENTS} GROUP BY ALL""")
def day_voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voices of a day: seconds, words, segments and sessions."""
    return day_rows(spark, sf_dir).groupBy("wearer_id", "day", "speaker").agg(
        F.round(F.sum(F.col("e") - F.col("s")), 3).alias("seconds"), F.sum("n_words").alias("words"), F.count("*").alias("segments"), F.countDistinct("stem").alias("sessions"))


@query(f"""SELECT wearer_id, day, count(*) AS segments, count(DISTINCT stem) AS sessions, sum(n_words)::BIGINT AS words, round(sum(e - s), 3) AS speech_sec,
count(DISTINCT CASE WHEN speaker <> 'UNKNOWN' THEN speaker END) AS voices, sum(CASE WHEN quality = 'ok' THEN 1 ELSE 0 END)::BIGINT AS n_ok, sum(CASE WHEN quality = 'low' THEN 1 ELSE 0 END)::BIGINT AS n_low,
sum(CASE WHEN quality = 'unreliable' THEN 1 ELSE 0 END)::BIGINT AS n_unreliable FROM {_SEGMENTS} GROUP BY ALL""")
def day_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a day with the histogram of quality levels."""
    level = lambda q: F.sum(F.when(F.col("quality") == q, 1).otherwise(0)).alias(f"n_{q}")
    return day_rows(spark, sf_dir).groupBy("wearer_id", "day").agg(
        F.count("*").alias("segments"), F.countDistinct("stem").alias("sessions"), F.sum("n_words").alias("words"), F.round(F.sum(F.col("e") - F.col("s")), 3).alias("speech_sec"),
        F.countDistinct(F.when(F.col("speaker") != "UNKNOWN", F.col("speaker"))).alias("voices"), level("ok"), level("low"), level("unreliable"))


@query(f"""SELECT wearer_id, day, turn::BIGINT AS turn, min(speaker) AS speaker, round(min(s), 3) AS start_sec, round(max(e), 3) AS end_sec, count(*) AS segments, sum(n_words)::BIGINT AS words FROM {_TURNS} GROUP BY wearer_id, day, turn""")
def day_speaker_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a day as the metrics count them."""
    return day_turns(spark, sf_dir).groupBy("wearer_id", "day", "turn").agg(
        F.min("speaker").alias("speaker"), F.round(F.min("s"), 3).alias("start_sec"), F.round(F.max("e"), 3).alias("end_sec"), F.count("*").alias("segments"), F.sum("n_words").alias("words"))


@query(f"""SELECT wearer_id, day, speaker, round(sum(e - s) / 60, 3) AS minutes, sum(n_words)::BIGINT AS words, count(DISTINCT turn) AS turns, round(sum(e - s) / count(DISTINCT turn), 3) AS mean_turn_sec FROM {_TURNS} GROUP BY wearer_id, day, speaker""")
def day_voice_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per voice of a day: minutes, words, turns and mean length of a turn."""
    length = F.sum(F.col("e") - F.col("s"))
    return day_turns(spark, sf_dir).groupBy("wearer_id", "day", "speaker").agg(
        F.round(length / 60, 3).alias("minutes"), F.sum("n_words").alias("words"), F.countDistinct("turn").alias("turns"), F.round(length / F.countDistinct("turn"), 3).alias("mean_turn_sec"))


_MINUTES = f"""(SELECT wearer_id, day, m, count(DISTINCT speaker) AS voices, max(CASE WHEN speaker = subject_gid THEN 1 ELSE 0 END) AS own FROM
(SELECT g.wearer_id, day, speaker, subject_gid, unnest(range(floor(s / 60)::BIGINT, floor(e / 60)::BIGINT + 1)) AS m FROM {_SEGMENTS} g JOIN wearers w ON g.wearer_id = w.wearer_id WHERE speaker <> 'UNKNOWN') GROUP BY ALL)"""


def spoken_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of a day in which somebody known speaks: how many voices, and whether the wearer is among them."""
    df = day_rows(spark, sf_dir).filter("speaker <> 'UNKNOWN'").join(table(spark, sf_dir, "wearers").select("wearer_id", "subject_gid"), "wearer_id")
    minutes = F.explode(F.sequence(F.floor(F.col("s") / 60), F.floor(F.col("e") / 60)))
    spread = df.select("wearer_id", "day", "speaker", "subject_gid", minutes.alias("m")).distinct()
    own = F.max(F.when(F.col("speaker") == F.col("subject_gid"), 1).otherwise(0))
    return spread.groupBy("wearer_id", "day", "m").agg(F.count("*").alias("voices"), own.alias("own"))


@query(f"""SELECT wearer_id, day, (m // 60 % 24)::BIGINT AS hour, count(*) AS spoken, sum(CASE WHEN own = 1 AND voices = 1 THEN 1 ELSE 0 END)::BIGINT AS subject_only,
sum(CASE WHEN own = 1 AND voices > 1 THEN 1 ELSE 0 END)::BIGINT AS with_others, sum(CASE WHEN own = 0 THEN 1 ELSE 0 END)::BIGINT AS others_only FROM {_MINUTES} GROUP BY ALL""")
def day_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes by hour of the day in which the wearer speaks alone, with others, or others speak."""
    kind = lambda c, n: F.sum(F.when(c, 1).otherwise(0)).alias(n)
    own = F.col("own") == 1
    hour = F.pmod(F.floor(F.col("m") / 60), F.lit(24)).cast("long")
    return spoken_minutes(spark, sf_dir).groupBy("wearer_id", "day", hour.alias("hour")).agg(
        F.count("*").alias("spoken"), kind(own & (F.col("voices") == 1), "subject_only"), kind(own & (F.col("voices") > 1), "with_others"), kind(~own, "others_only"))


@query(f"""WITH r AS (SELECT wearer_id, (epoch(hr_date::TIMESTAMP) / 60)::BIGINT + 60 * split_part(hr_time, ':', 1)::BIGINT + split_part(hr_time, ':', 2)::BIGINT AS minute, avg(heart_rate) AS bpm
FROM helio_battito WHERE heart_rate BETWEEN 25 AND 230 AND hr_date IS NOT NULL AND hr_time IS NOT NULL GROUP BY ALL),
c AS (SELECT wearer_id, day * 1440 + m AS minute, CASE WHEN own = 1 THEN 'wearer' ELSE 'others' END AS class FROM {_MINUTES}),
j AS (SELECT r.wearer_id, coalesce(c.class, 'silence') AS class, bpm FROM r LEFT JOIN c ON r.wearer_id = c.wearer_id AND r.minute = c.minute)
SELECT wearer_id, class, count(*) AS minutes, CASE WHEN count(*) >= 5 THEN round(avg(bpm), 2) END AS mean_bpm FROM j GROUP BY ALL""")
def pulse_by_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean pulse of minutes in which the wearer speaks, others do, or nobody known does (a mean needs five minutes)."""
    from loquela.plans.daily import _readings

    beats = _readings(spark, sf_dir).groupBy("wearer_id", "minute").agg(F.avg("heart_rate").alias("bpm"))
    classes = spoken_minutes(spark, sf_dir).select("wearer_id", (F.col("day") * 1440 + F.col("m")).alias("minute"), F.when(F.col("own") == 1, "wearer").otherwise("others").alias("class"))
    joined = beats.join(classes, ["wearer_id", "minute"], "left").withColumn("class", F.coalesce("class", F.lit("silence")))
    return joined.groupBy("wearer_id", "class").agg(F.count("*").alias("minutes"), F.when(F.count("*") >= 5, F.round(F.avg("bpm"), 2)).alias("mean_bpm"))


@query("""SELECT DISTINCT wearer_id, d AS day FROM (SELECT wearer_id, hr_date AS d FROM helio_battito WHERE heart_rate IS NOT NULL UNION ALL SELECT wearer_id, sleep_date FROM helio_notti) WHERE d IS NOT NULL AND wearer_id IS NOT NULL""")
def days_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with pulse readings or a night."""
    beats = table(spark, sf_dir, "helio_battito").filter("heart_rate is not null").select("wearer_id", F.col("hr_date").alias("day"))
    nights = table(spark, sf_dir, "helio_notti").select("wearer_id", F.col("sleep_date").alias("day"))
    return beats.unionByName(nights).filter("day is not null and wearer_id is not null").distinct()


@query("""SELECT wearer_id, count(*) AS days, sum(n)::BIGINT AS minutes, sum(CASE WHEN n < 0.95 * 1440 THEN 1 ELSE 0 END)::BIGINT AS sparse_days FROM
(SELECT wearer_id, hr_date, count(DISTINCT left(hr_time, 5)) AS n FROM helio_battito WHERE heart_rate IS NOT NULL AND hr_date IS NOT NULL AND hr_time IS NOT NULL AND wearer_id IS NOT NULL GROUP BY ALL) GROUP BY wearer_id""")
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days per wearer, minutes with a reading, and days with fewer than 95 % of their minutes."""
    df = table(spark, sf_dir, "helio_battito").filter("heart_rate is not null and hr_date is not null and hr_time is not null and wearer_id is not null")
    n = df.groupBy("wearer_id", "hr_date").agg(F.countDistinct(F.substring("hr_time", 1, 5)).alias("n"))
    return n.groupBy("wearer_id").agg(F.count("*").alias("days"), F.sum("n").alias("minutes"), F.sum(F.when(F.col("n") < 0.95 * 1440, 1).otherwise(0)).alias("sparse_days"))


@query(f"""SELECT wearer_id, day, word, count(*) AS freq, count(DISTINCT speaker) AS voices FROM (SELECT wearer_id, day, speaker, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM {_SEGMENTS} WHERE text IS NOT NULL) GROUP BY ALL""")
def day_word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a day: how often, and by how many voices."""
    words = day_rows(spark, sf_dir).filter("text is not null").select("wearer_id", "day", "speaker", F.explode(T.words_letters(F.col("text"))).alias("word"))
    return words.groupBy("wearer_id", "day", "word").agg(F.count("*").alias("freq"), F.countDistinct("speaker").alias("voices"))


@query("""SELECT gid, string_agg(stem || '/' || label || ':' || secs, ',' ORDER BY stem, label) AS samples, count(*) AS n FROM
(SELECT m.global_id AS gid, m.stem, m.local_label AS label, round(coalesce(sum(s.duration_sec), 0))::BIGINT::VARCHAR AS secs FROM
(SELECT DISTINCT stem, local_label, global_id FROM speaker_map WHERE stem IS NOT NULL AND local_label IS NOT NULL AND global_id IS NOT NULL) m LEFT JOIN segments s ON s.stem = m.stem AND s.speaker = m.local_label GROUP BY ALL) GROUP BY gid""")
def voice_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of each voice in order: session, local label and seconds spoken under it."""
    m = table(spark, sf_dir, "speaker_map").select("stem", F.col("local_label").alias("speaker"), F.col("global_id").alias("gid")).na.drop().distinct()
    seconds = table(spark, sf_dir, "segments").groupBy("stem", "speaker").agg(F.sum("duration_sec").alias("s"))
    rows = m.join(seconds, ["stem", "speaker"], "left").withColumn("secs", F.round(F.coalesce("s", F.lit(0.0))).cast("long").cast("string"))
    sample = F.struct("stem", "speaker", F.concat("stem", F.lit("/"), "speaker", F.lit(":"), "secs").alias("line"))
    return rows.groupBy("gid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(sample)), lambda r: r["line"]), ",").alias("samples"), F.count("*").alias("n"))
