"""Attribution by time, packing, slow-down detection, sensor summaries, retention and index lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.operators import corpus, ranges
from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_SEG = "(SELECT stem, segment_id, speaker, start_sec, end_sec FROM segments WHERE start_sec IS NOT NULL AND end_sec >= start_sec AND speaker IS NOT NULL)"


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments").select("stem", "segment_id", "speaker", "start_sec", "end_sec")
    return s.filter("start_sec is not null and end_sec >= start_sec and speaker is not null")


@query(f"""WITH t AS (SELECT stem, segment_id AS owner, (start_sec + end_sec) / 2 AS mid FROM {_SEG})
SELECT t.stem, t.owner, arg_min(s.speaker, (s.start_sec, s.segment_id)) AS voice, count(*) AS candidates FROM t JOIN {_SEG} s ON s.stem = t.stem AND t.mid BETWEEN s.start_sec AND s.end_sec GROUP BY ALL""")
def voice_at_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who speaks at the middle of each segment: the first interval that holds it, closed at both ends."""
    s = _spoken(spark, sf_dir)
    points = s.select("stem", F.col("segment_id").alias("owner"), ((F.col("start_sec") + F.col("end_sec")) / 2).alias("mid"))
    held = ranges.points_in_intervals(points, s, ["stem"], "mid", "start_sec", "end_sec", 30.0)
    return held.groupBy("stem", "owner").agg(F.min_by("speaker", F.struct("start_sec", "segment_id")).alias("voice"), F.count("*").alias("candidates"))


@query(f"""WITH c AS (SELECT stem, unnest(range(0, floor(max(end_sec) / 30)::BIGINT + 1)) AS chunk FROM {_SEG} GROUP BY stem),
o AS (SELECT c.stem, c.chunk, s.speaker, sum(least(s.end_sec, (c.chunk + 1) * 30.0) - greatest(s.start_sec, c.chunk * 30.0)) AS shared FROM c JOIN {_SEG} s
ON s.stem = c.stem AND s.start_sec < (c.chunk + 1) * 30.0 AND s.end_sec > c.chunk * 30.0 GROUP BY ALL)
SELECT c.stem, c.chunk, coalesce(arg_max(o.speaker, (round(o.shared, 6), o.speaker)), 'UNKNOWN') AS speaker FROM c LEFT JOIN o ON o.stem = c.stem AND o.chunk = c.chunk GROUP BY ALL""")
def dominant_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label with most seconds in each half minute of a session; UNKNOWN where nobody speaks."""
    s = _spoken(spark, sf_dir)
    grid = s.groupBy("stem").agg(F.max("end_sec").alias("m")).select("stem", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("m") / 30).cast("long"))).alias("chunk"))
    cut = s.select("stem", "speaker", "start_sec", "end_sec", F.explode(ranges.buckets(F.col("start_sec"), F.col("end_sec"), 30.0)).alias("chunk"))
    shared = F.least(F.col("end_sec"), (F.col("chunk") + 1) * 30.0) - F.greatest(F.col("start_sec"), F.col("chunk") * 30.0)
    per = cut.withColumn("shared", shared).filter("shared > 0").groupBy("stem", "chunk", "speaker").agg(F.round(F.sum("shared"), 6).alias("shared"))
    best = per.groupBy("stem", "chunk").agg(F.max_by("speaker", F.struct("shared", "speaker")).alias("speaker"))
    return grid.join(best, ["stem", "chunk"], "left").select("stem", "chunk", F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"))


@query("""SELECT row_id, cost > 1.25 * before AS slow FROM (SELECT row_id, cost, median(cost) OVER (PARTITION BY source_device ORDER BY processed_at NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
FROM (SELECT row_id, source_device, processed_at, speech_sec / duration_sec AS cost FROM sessions WHERE duration_sec > 0 AND speech_sec IS NOT NULL)) WHERE before IS NOT NULL""")
def slow_downs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose cost is above 1.25 times the median of the device's earlier ones (a device has few sessions)."""
    s = table(spark, sf_dir, "sessions").filter("duration_sec > 0 and speech_sec is not null").select("row_id", "source_device", "processed_at", (F.col("speech_sec") / F.col("duration_sec")).alias("cost"))
    earlier = Window.partitionBy("source_device").orderBy(F.col("processed_at").asc_nulls_last(), "row_id").rowsBetween(Window.unboundedPreceding, -1)
    v = s.withColumn("v", F.array_sort(F.collect_list("cost").over(earlier))).withColumn("n", F.size("v")).filter("n > 0")
    middle = (F.get("v", F.floor((F.col("n") - 1) / 2).cast("int")) + F.get("v", F.floor(F.col("n") / 2).cast("int"))) / 2
    return v.select("row_id", (F.col("cost") > 1.25 * middle).alias("slow"))


@query("""SELECT event_type, n, round(v[1], 4) AS low, round(v[n // 2 + 1], 4) AS upper_median, round(v[n], 4) AS high, round(list_avg(v), 4) AS mean_value,
round(list_avg(v[1:greatest(1, n // 4)]), 4) AS first_quarter, round(list_avg(v[n - greatest(1, n // 4) + 1:n]), 4) AS last_quarter FROM
(SELECT event_type, count(*) AS n, list(value ORDER BY value) AS v FROM events WHERE value IS NOT NULL GROUP BY event_type)""")
def sensor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least, upper median, most, mean and the means of the lowest and highest quarter, by ranks (no list of a whole group)."""
    e = table(spark, sf_dir, "events").filter("value is not null").groupBy("event_type", "value").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("event_type").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    r = e.withColumn("hi", F.sum("c").over(upto)).withColumn("lo", F.col("hi") - F.col("c"))
    n = e.groupBy("event_type").agg(F.sum("c").alias("n"))
    q = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / 4).cast("long"))
    r = r.join(n, "event_type").withColumn("q", q)
    in_low = F.greatest(F.lit(0), F.least("hi", "q") - F.col("lo"))
    in_high = F.greatest(F.lit(0), F.col("hi") - F.greatest(F.col("lo"), F.col("n") - F.col("q")))
    half = F.floor(F.col("n") / 2).cast("long") + 1
    return r.groupBy("event_type").agg(
        F.max("n").alias("n"), F.round(F.min("value"), 4).alias("low"), F.round(F.max(F.when((F.col("lo") < half) & (half <= F.col("hi")), F.col("value"))), 4).alias("upper_median"),
        F.round(F.max("value"), 4).alias("high"), F.round(F.sum(F.col("value") * F.col("c")) / F.max("n"), 4).alias("mean_value"),
        F.round(F.sum(F.col("value") * in_low) / F.max("q"), 4).alias("first_quarter"), F.round(F.sum(F.col("value") * in_high) / F.max("q"), 4).alias("last_quarter"),
    )


@query("""SELECT stem, speaker FROM (SELECT stem, speaker, rank() OVER (PARTITION BY stem ORDER BY n DESC) AS r, count(*) OVER (PARTITION BY stem, n) AS ties FROM (SELECT stem, speaker, count(*) AS n FROM segments GROUP BY ALL)) WHERE r = 1 AND ties = 1""")
def clear_main_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label with most segments of each session; none on a tie."""
    n = table(spark, sf_dir, "segments").groupBy("stem", "speaker").agg(F.count("*").alias("n"))
    ranked = n.withColumn("r", F.rank().over(Window.partitionBy("stem").orderBy(F.desc("n")))).filter("r = 1")
    return ranked.withColumn("ties", F.count("*").over(Window.partitionBy("stem"))).filter("ties = 1").select("stem", "speaker")


@query("""SELECT row_id, CASE WHEN n_segments IS NULL OR n_segments = 0 THEN 'orphan' WHEN ingested_at < (SELECT max(ingested_at) FROM sessions) - INTERVAL 7 DAYS THEN 'expired' ELSE 'keep' END AS state FROM sessions""")
def retention_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which session files would go: without segments, older than a week before the newest, or kept."""
    s = table(spark, sf_dir, "sessions").select("row_id", "n_segments", "ingested_at")
    newest = table(spark, sf_dir, "sessions").agg(F.max("ingested_at").alias("newest")).scalar()
    state = F.when(F.col("n_segments").isNull() | (F.col("n_segments") == 0), "orphan").when(F.col("ingested_at") < newest - F.expr("INTERVAL 7 DAYS"), "expired").otherwise("keep")
    return s.select("row_id", state.alias("state"))


@query("""SELECT day, '| ' || day || ' | ' || n || ' | ' || stems || ' | ' || words || ' |' AS line FROM (SELECT left(processed_at, 10) AS day, count(*) AS n, count(DISTINCT stem) AS stems, sum(coalesce(n_words, 0))::BIGINT AS words FROM sessions WHERE processed_at IS NOT NULL GROUP BY ALL)""")
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of the index document per day."""
    s = table(spark, sf_dir, "sessions").filter("processed_at is not null").groupBy(F.substring("processed_at", 1, 10).alias("day"))
    d = s.agg(F.count("*").alias("n"), F.countDistinct("stem").alias("stems"), F.sum(F.coalesce("n_words", F.lit(0))).alias("words"))
    return d.select("day", F.format_string("| %s | %d | %d | %d |", "day", "n", "stems", "words").alias("line"))


@query()
def repeats_shortened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at most two successive copies of a sentence."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    return d.select("doc_id", T.keep_two_repeats(F.col("text")).alias("text"))


@query()
def recognition_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a session packed into chunks of at most 29 s of elapsed time, longer ones on their own."""
    return corpus.pack_by_time(table(spark, sf_dir, "segments"), 29.0)
