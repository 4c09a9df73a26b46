"""Further reports of the reference surface: voice bases, markers, windows, clips, budgets, gates and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.operators import identity, sequence
from loquela.plans.daily import _HR, _readings
from loquela.plans.registry import Registry
from loquela.plans.voices import _CENTROIDS, _COS
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: Discourse fillers of the daily metrics.
#: Filler words of the daily metrics.
FILLERS = ["cioè", "tipo", "praticamente", "insomma", "boh", "diciamo", "ecco", "comunque", "vabbè", "allora", "quindi", "niente", "senti", "guarda", "appunto", "magari"]
_FILLERS = ", ".join(f"'{w}'" for w in FILLERS)


def exclusive_quantile(ordered, n, p: float):
    """Quantile by (n + 1) * p with linear interpolation between neighbours, of a sorted array."""
    at = (n + 1) * p
    low = F.greatest(F.lit(1), F.least(F.floor(at).cast("int"), n - 1))
    a, b = F.get(ordered, low - 1), F.get(ordered, low)
    return a + (b - a) * (at - low)


_BASE = """(SELECT speaker AS gid, n, v[(n + 1) // 2] * 0.5 + v[(n + 2) // 2] * 0.5 AS med, q(v, n, 0.25) AS q1, q(v, n, 0.75) AS q3 FROM
(SELECT speaker, count(*) AS n, list(f0_mean_hz ORDER BY f0_mean_hz) AS v FROM segments WHERE f0_mean_hz BETWEEN 20 AND 1000 AND coalesce(duration_sec, 0) >= 0.8 AND quality IS DISTINCT FROM 'unreliable' AND speaker IS NOT NULL GROUP BY speaker HAVING count(*) >= 20))"""


def _q(p: float) -> str:
    low = f"greatest(1, least(floor((n + 1) * {p})::INT, n - 1))"
    return f"(v[{low}] + (v[{low} + 1] - v[{low}]) * ((n + 1) * {p} - {low}))"


_BASE_SQL = _BASE.replace("q(v, n, 0.25)", _q(0.25)).replace("q(v, n, 0.75)", _q(0.75))


def _voice_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments").filter((F.col("f0_mean_hz").between(20, 1000)) & (F.coalesce("duration_sec", F.lit(0.0)) >= 0.8) & ~F.col("quality").eqNullSafe(F.lit("unreliable")) & F.col("speaker").isNotNull())
    lists = s.groupBy(F.col("speaker").alias("gid")).agg(F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list("f0_mean_hz")).alias("v")).filter("n >= 20")
    return lists.select("gid", "n", exclusive_quantile(F.col("v"), F.col("n"), 0.5).alias("med"), exclusive_quantile(F.col("v"), F.col("n"), 0.25).alias("q1"), exclusive_quantile(F.col("v"), F.col("n"), 0.75).alias("q3"))


@query(f"SELECT gid, n, round(med, 4) AS med, round((q3 - q1) / 1.349, 4) AS scale FROM {_BASE_SQL}")
def voice_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and robust scale of each voice's pitch, by exclusive quantiles, from 20 segments on."""
    return _voice_base(spark, sf_dir).select("gid", F.col("n").cast("long").alias("n"), F.round("med", 4).alias("med"), F.round((F.col("q3") - F.col("q1")) / 1.349, 4).alias("scale"))


@query(f"""SELECT s.speaker AS gid, CASE WHEN z < -1.5 THEN -2 WHEN z < -0.5 THEN -1 WHEN z <= 0.5 THEN 0 WHEN z <= 1.5 THEN 1 ELSE 2 END::BIGINT AS level, count(*) AS n FROM
(SELECT s.speaker, (s.f0_mean_hz - b.med) / ((b.q3 - b.q1) / 1.349) AS z FROM segments s JOIN {_BASE_SQL} b ON b.gid = s.speaker WHERE s.f0_mean_hz BETWEEN 20 AND 1000 AND b.q3 > b.q1) s GROUP BY ALL""")
def style_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each voice speaks at each of five pitch levels of its own."""
    base = _voice_base(spark, sf_dir).filter("q3 > q1")
    s = table(spark, sf_dir, "segments").filter(F.col("f0_mean_hz").between(20, 1000)).select(F.col("speaker").alias("gid"), "f0_mean_hz")
    z = (F.col("f0_mean_hz") - F.col("med")) / ((F.col("q3") - F.col("q1")) / 1.349)
    level = F.when(z < -1.5, -2).when(z < -0.5, -1).when(z <= 0.5, 0).when(z <= 1.5, 1).otherwise(2)
    return s.join(base, "gid").groupBy("gid", level.cast("long").alias("level")).agg(F.count("*").alias("n"))


@query(f"""SELECT gid, sum(len(ws))::BIGINT AS words, sum(len(ss))::BIGINT AS sentences, round(sum(len(list_filter(ss, lambda s: s LIKE '%?'))) / sum(len(ss)), 4) AS question_share,
round(1000.0 * sum(len(list_filter(ws, lambda w: w IN ({_FILLERS})))) / sum(len(ws)), 4) AS fillers FROM
(SELECT speaker AS gid, regexp_extract_all(lower(text), '\\p{{L}}+') AS ws, list_filter(regexp_extract_all(text, '[^.?!…]+[.?!…]*'), lambda s: regexp_matches(s, '\\p{{L}}')) AS ss FROM segments WHERE text IS NOT NULL)
GROUP BY gid HAVING sum(len(ws)) > 0""")
def linguistic_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments").filter("text is not null").select(F.col("speaker").alias("gid"), T.words_letters(F.col("text")).alias("ws"), T.sentences(F.col("text")).alias("ss"))
    sized = s.select("gid", F.size("ws").alias("w"), F.size("ss").alias("s"), F.size(F.filter("ss", lambda x: x.endswith("?"))).alias("q"), F.size(F.filter("ws", lambda x: x.isin(*FILLERS))).alias("f"))
    out = sized.groupBy("gid").agg(F.sum("w").alias("words"), F.sum("s").alias("sentences"), F.sum("q").alias("q"), F.sum("f").alias("f")).filter("words > 0")
    return out.select("gid", "words", "sentences", F.round(F.try_divide("q", "sentences"), 4).alias("question_share"), F.round(1000.0 * F.col("f") / F.col("words"), 4).alias("fillers"))


@query("""WITH w AS (SELECT stem, unnest([15 * (floor(start_sec / 15)::BIGINT - 3), 15 * (floor(start_sec / 15)::BIGINT - 2), 15 * (floor(start_sec / 15)::BIGINT - 1), 15 * floor(start_sec / 15)::BIGINT]) AS start, speaker, coalesce(n_words, 0) AS n
FROM segments WHERE start_sec IS NOT NULL),
g AS (SELECT stem, start, CASE WHEN count(DISTINCT speaker) < 2 THEN sum(n) // 3 ELSE sum(n) END::BIGINT AS score FROM w WHERE start >= 0 GROUP BY ALL)
SELECT stem, start, score FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY score DESC, start) AS k FROM g) WHERE k = 1""")
def best_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute (steps of 15 s) with most words in each session; fewer than two voices count a third; first wins."""
    s = table(spark, sf_dir, "segments").filter("start_sec is not null")
    base = (F.floor(F.col("start_sec") / 15) * 15).cast("long")
    w = s.select("stem", F.explode(F.sequence(base - 45, base, F.lit(15))).alias("start"), "speaker", F.coalesce("n_words", F.lit(0)).alias("n")).filter("start >= 0")
    g = w.groupBy("stem", "start").agg(F.countDistinct("speaker").alias("v"), F.sum("n").alias("n"))
    score = F.when(F.col("v") < 2, F.floor(F.col("n") / 3)).otherwise(F.col("n")).cast("long")
    k = F.row_number().over(Window.partitionBy("stem").orderBy(F.desc("score"), "start"))
    return g.withColumn("score", score).withColumn("k", k).filter("k = 1").select("stem", "start", "score")


@query("""WITH a AS (SELECT speaker, stem, segment_id, duration_sec, row_number() OVER (PARTITION BY speaker, stem ORDER BY duration_sec DESC, segment_id) AS lap,
max(duration_sec) OVER (PARTITION BY speaker, stem) AS best FROM segments WHERE duration_sec BETWEEN 3 AND 12 AND speaker IS NOT NULL)
SELECT speaker, segment_id, k FROM (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY lap, best DESC, stem, segment_id) AS k FROM a) WHERE k <= 5""")
def clips_to_hear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five clips per voice, going round its sessions (best of each, then second best): a top-k report."""
    s = table(spark, sf_dir, "segments").filter(F.col("duration_sec").between(3, 12) & F.col("speaker").isNotNull()).select("speaker", "stem", "segment_id", "duration_sec")
    own = Window.partitionBy("speaker", "stem")
    a = s.withColumn("lap", F.row_number().over(own.orderBy(F.desc("duration_sec"), "segment_id"))).withColumn("best", F.max("duration_sec").over(own))
    k = F.row_number().over(Window.partitionBy("speaker").orderBy("lap", F.desc("best"), "stem", "segment_id")).cast("long")
    return a.withColumn("k", k).filter("k <= 5").select("speaker", "segment_id", "k")


@query(f"""WITH m AS (SELECT DISTINCT wearer_id, minute FROM {_HR}), l AS (SELECT *, lag(minute) OVER (PARTITION BY wearer_id ORDER BY minute) AS p FROM m),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR minute - p > 6 THEN 1 ELSE 0 END) OVER (PARTITION BY wearer_id ORDER BY minute) AS run FROM l)
SELECT wearer_id, min(minute) AS first_minute, max(minute) AS last_minute, count(*) AS n FROM i GROUP BY wearer_id, run""")
def minute_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of readings with holes of at most five missing minutes."""
    m = _readings(spark, sf_dir).select("wearer_id", "minute").distinct()
    before = F.lag("minute").over(Window.partitionBy("wearer_id").orderBy("minute"))
    runs = sequence.islands(m, ["wearer_id"], ["minute"], before.isNull() | (F.col("minute") - before > 6), "run")
    return runs.groupBy("wearer_id", "run").agg(F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute"), F.count("*").alias("n")).drop("run")


@query(f"""WITH r AS (SELECT wearer_id, floor(minute / 60)::BIGINT % 24 AS hour, heart_rate FROM {_HR}), o AS (SELECT wearer_id, median(heart_rate) AS whole FROM r GROUP BY ALL)
SELECT r.wearer_id, r.hour, round(CASE WHEN count(*) >= 30 THEN median(heart_rate) ELSE min(whole) END, 4) AS usual FROM r JOIN o USING (wearer_id) GROUP BY r.wearer_id, r.hour""")
def usual_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median pulse of each hour; the overall median where there are fewer than 30 readings."""
    r = _readings(spark, sf_dir).select("wearer_id", (F.floor(F.col("minute") / 60) % 24).cast("long").alias("hour"), "heart_rate")
    whole = r.groupBy("wearer_id").agg(F.median("heart_rate").alias("whole"))
    hours = r.groupBy("wearer_id", "hour").agg(F.count("*").alias("n"), F.median("heart_rate").alias("m"))
    return hours.join(whole, "wearer_id").select("wearer_id", "hour", F.round(F.when(F.col("n") >= 30, F.col("m")).otherwise(F.col("whole")), 4).alias("usual"))


@query("""SELECT o AS minute_offset, count(*) AS n, round(avg(b.value), 4) AS mean_value FROM (SELECT user_id, floor(epoch(ts) / 60)::BIGINT AS m, unnest(range(-10, 21)) AS o FROM events WHERE event_type = 'signup') a
JOIN (SELECT user_id, floor(epoch(ts) / 60)::BIGINT AS m, value FROM events) b ON a.user_id = b.user_id AND b.m = a.m + a.o GROUP BY ALL""")
def event_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value at each minute from 10 before to 20 after a sign-up of the same user (equi-join on the minute)."""
    minute = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).cast("long")
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value", minute.alias("m"))
    a = e.filter("event_type = 'signup'").select("user_id", "m", F.explode(F.sequence(F.lit(-10).cast("long"), F.lit(20).cast("long"))).alias("minute_offset"))
    joined = a.withColumn("m", F.col("m") + F.col("minute_offset")).join(e.select("user_id", "m", "value"), ["user_id", "m"])
    return joined.groupBy("minute_offset").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_value"))


@query("""SELECT row_id, round(cost, 4) AS cost, round(run, 3) AS running, run <= 36000 AS fits FROM (SELECT row_id, cost, sum(cost) OVER (PARTITION BY source_device ORDER BY processed_at, row_id) AS run FROM
(SELECT row_id, source_device, processed_at, 63 + (1 / 15.8 + 1 / 33.0) * duration_sec + coalesce(speech_sec, 0) / 3.86 AS cost FROM sessions WHERE duration_sec > 0))""")
def budgeted_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated cost of each session and whether it still fits the device's budget, in order."""
    cost = 63 + (F.lit(1 / 15.8) + 1 / 33.0) * F.col("duration_sec") + F.coalesce("speech_sec", F.lit(0.0)) / 3.86
    s = table(spark, sf_dir, "sessions").filter("duration_sec > 0").select("row_id", "source_device", "processed_at", cost.alias("c"))
    run = F.sum("c").over(Window.partitionBy("source_device").orderBy(F.col("processed_at").asc_nulls_last(), "row_id").rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("run", run).select("row_id", F.round("c", 4).alias("cost"), F.round("run", 3).alias("running"), (F.col("run") <= 36000).alias("fits"))


@query("""SELECT denoise_winner, count(*) AS n, round(avg(speech_ratio), 4) AS speech, round(avg(n_words / (duration_sec / 60)), 4) AS words_per_minute FROM sessions WHERE duration_sec > 0 AND speech_ratio > 0 AND speech_ratio <= 1 GROUP BY ALL""")
def variant_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the chosen audio variants compare."""
    s = table(spark, sf_dir, "sessions").filter("duration_sec > 0 and speech_ratio > 0 and speech_ratio <= 1")
    return s.groupBy("denoise_winner").agg(F.count("*").alias("n"), F.round(F.avg("speech_ratio"), 4).alias("speech"), F.round(F.avg(F.col("n_words") / (F.col("duration_sec") / 60)), 4).alias("words_per_minute"))


@query("""SELECT stem, count(*) AS segments, sum(coalesce(n_words, 0))::BIGINT AS words, round(sum(CASE WHEN quality = 'unreliable' THEN coalesce(n_words, 0) ELSE 0 END) / sum(coalesce(n_words, 0)), 4) AS bad_share
FROM segments GROUP BY stem HAVING count(*) >= 1 AND sum(coalesce(n_words, 0)) >= 5""")
def verified_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that pass the output gate (a segment, five words), with their word-weighted bad share."""
    n = F.coalesce("n_words", F.lit(0))
    s = table(spark, sf_dir, "segments").groupBy("stem").agg(F.count("*").alias("segments"), F.sum(n).alias("words"), F.sum(F.when(F.col("quality") == "unreliable", n).otherwise(0)).alias("bad"))
    return s.filter("segments >= 1 and words >= 5").select("stem", "segments", "words", F.round(F.col("bad") / F.col("words"), 4).alias("bad_share"))


@query("""SELECT stem, speaker, round(sum(greatest(0, end_sec - start_sec)), 3) AS seconds FROM segments WHERE speaker IS NOT NULL AND start_sec IS NOT NULL AND end_sec IS NOT NULL GROUP BY ALL""")
def speaking_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments").filter("speaker is not null and start_sec is not null and end_sec is not null")
    return s.groupBy("stem", "speaker").agg(F.round(F.sum(F.greatest(F.lit(0.0), F.col("end_sec") - F.col("start_sec"))), 3).alias("seconds"))


@query(f"""SELECT vec_id, best::BIGINT AS best FROM (SELECT e.vec_id, arg_max(c.label, {_COS.format(a='e.embedding', b='c.centroid')}) AS best FROM embeddings e, {_CENTROIDS} c GROUP BY e.vec_id)""")
def nearest_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identity whose centroid is most similar to each sample; the identities (one row each) travel as one array."""
    e = table(spark, sf_dir, "embeddings")
    c = identity.weighted_centroids(e, "label", "embedding", F.lit(1.0))
    known = c.agg(F.collect_list(F.struct("label", "centroid")).alias("known")).scalar()
    scored = e.select("vec_id", "embedding", known.alias("known")).select("vec_id", F.array_max(F.transform("known", lambda k: F.struct(identity.cosine(F.col("embedding"), k["centroid"]).alias("c"), k["label"].alias("label")))).alias("b"))
    return scored.select("vec_id", F.col("b.label").cast("long").alias("best"))


@query("""SELECT a.night_id, count(*) AS older FROM helio_notti a JOIN helio_notti b ON a.wearer_id = b.wearer_id AND a.sleep_date = b.sleep_date AND b.export_ms < a.export_ms GROUP BY a.night_id""")
def revised_nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights that a later export revised, with the number of older versions (a window, no self-join)."""
    n = table(spark, sf_dir, "helio_notti").filter("wearer_id is not null and sleep_date is not null and export_ms is not null")
    older = F.count("*").over(Window.partitionBy("wearer_id", "sleep_date").orderBy("export_ms").rangeBetween(Window.unboundedPreceding, -1))
    return n.select("night_id", older.alias("older")).filter("older > 0")


@query("""SELECT word, count(*) AS n FROM (SELECT word, lag(word) OVER (PARTITION BY segment_id ORDER BY pos) AS p FROM (SELECT segment_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM
(SELECT segment_id, list_filter(string_split_regex(trim(text), '\\s+'), lambda w: w <> '') AS ws FROM segments WHERE text IS NOT NULL)))
WHERE p IS NOT NULL AND regexp_matches(word, '^\\p{Lu}\\p{Ll}') AND NOT regexp_matches(p, '[.!?…:>\\])}♪*-]$') GROUP BY word""")
def proper_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised tokens inside a sentence."""
    w = table(spark, sf_dir, "segments").filter("text is not null").select("segment_id", F.posexplode(T.words_blank(F.col("text"))).alias("pos", "word"))
    p = F.lag("word").over(Window.partitionBy("segment_id").orderBy("pos"))
    inside = w.withColumn("p", p).filter(F.col("p").isNotNull() & F.col("word").rlike(r"^\p{Lu}\p{Ll}") & ~F.col("p").rlike(r"[.!?…:>\])}♪*-]$"))
    return inside.groupBy("word").agg(F.count("*").alias("n"))


@query("""SELECT m.gid, d.voice_name AS name FROM (SELECT DISTINCT global_id AS gid FROM speaker_map) m LEFT JOIN speakers_db d ON d.gid = m.gid""")
def synced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name of every cited voice, null where there is none."""
    cited = table(spark, sf_dir, "speaker_map").select(F.col("global_id").alias("gid")).distinct()
    return cited.join(table(spark, sf_dir, "speakers_db").select("gid", F.col("voice_name").alias("name")), "gid", "left")


@query("""SELECT left(processed_at, 10) AS day, count(*) AS sessions, count(DISTINCT stem) AS stems, round(sum(speech_sec), 2) AS speech, sum(coalesce(n_words, 0))::BIGINT AS words, min(processed_at) AS first_at, max(processed_at) AS last_at FROM sessions GROUP BY ALL""")
def day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "sessions")
    return s.groupBy(F.substring("processed_at", 1, 10).alias("day")).agg(
        F.count("*").alias("sessions"), F.countDistinct("stem").alias("stems"), F.round(F.sum("speech_sec"), 2).alias("speech"),
        F.sum(F.coalesce("n_words", F.lit(0))).alias("words"), F.min("processed_at").alias("first_at"), F.max("processed_at").alias("last_at"),
    )


@query("""SELECT CASE WHEN regexp_matches(source_filename, '\\d{4}-?\\d{2}-?\\d{2}[T_ -]?\\d{2}[-:]?\\d{2}[-:]?\\d{2}') THEN 'dated' WHEN source_filename IS NULL THEN 'none' ELSE 'other' END AS pattern, count(*) AS n, min(source_filename) AS first_name, max(source_filename) AS last_name FROM sessions GROUP BY ALL""")
def filename_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("source_filename")
    pattern = F.when(name.rlike(r"\d{4}-?\d{2}-?\d{2}[T_ -]?\d{2}[-:]?\d{2}[-:]?\d{2}"), "dated").when(name.isNull(), "none").otherwise("other")
    return table(spark, sf_dir, "sessions").groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"), F.min(name).alias("first_name"), F.max(name).alias("last_name"))


@query("""SELECT segment_id, right(coalesce(string_agg(text, ' ') OVER (PARTITION BY stem ORDER BY idx, segment_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), ''), 400) AS context FROM segments""")
def context_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 400 characters of the five texts before each segment."""
    w = Window.partitionBy("stem").orderBy("idx", "segment_id").rowsBetween(-5, -1)
    tails = table(spark, sf_dir, "segments").withColumn("_c", F.concat_ws(" ", F.collect_list("text").over(w)))
    return tails.select("segment_id", F.expr("right(_c, 400)").alias("context"))
