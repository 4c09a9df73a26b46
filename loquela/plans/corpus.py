"""Queries of the corpus index: words, frequencies, reports, quality, text functions and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquela.functions import text as T
from loquela.operators import alignment, publish, sequence
from loquela.operators import quality as Q
from loquela.operators.corpus import (
    bigrams,
    corpus_stats,
    estimated_tokens,
    llm_parts,
    speaker_blocks,
    word_counts,
    word_table,
)
from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: The words of the index in SQL: tokens between white space without punctuation at their ends.
INDEX = """list_filter(list_transform(list_filter(string_split_regex(trim(text), '\\s+'), lambda w: w <> ''), lambda w: lower(trim(trim(trim(w), '.,;:!?()[]{}"''«»…—-')))), lambda w: w <> '')"""
WORDS = f"(SELECT stem, speaker, idx, segment_id, unnest({INDEX}) AS word FROM segments WHERE text IS NOT NULL)"


@query(f"SELECT word, count(*) AS freq FROM {WORDS} GROUP BY word ORDER BY freq DESC, word LIMIT 50")
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent words of all segments (top-k report)."""
    words = word_table(table(spark, sf_dir, "segments"))
    return words.groupBy("word").agg(F.count("*").alias("freq")).orderBy(F.desc("freq"), "word").limit(50)


@query(f"SELECT stem, word, count(*) AS freq FROM {WORDS} GROUP BY stem, word")
def session_word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(word_table(table(spark, sf_dir, "segments")), ["stem"])


@query(f"""
WITH t AS (SELECT stem, idx, segment_id, {INDEX} AS ws FROM segments WHERE text IS NOT NULL),
p AS (SELECT stem, idx, segment_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM t),
n AS (SELECT stem, word AS w1, lead(word) OVER (PARTITION BY stem ORDER BY idx, segment_id, pos) AS w2 FROM p)
SELECT stem, w1, w2, count(*) AS freq FROM n WHERE w2 IS NOT NULL GROUP BY ALL""")
def session_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacent word pairs of a session, across segment ends."""
    return bigrams(table(spark, sf_dir, "segments"))


@query(f"""SELECT w.word, count(*) AS freq, count(DISTINCT w.stem) AS n_sessions FROM {WORDS} w
JOIN (SELECT stem FROM sessions WHERE processed_at >= '2025-06' GROUP BY stem) s USING (stem) GROUP BY w.word""")
def words_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies of the sessions processed since a date (pre-aggregated by session before the join)."""
    recent = table(spark, sf_dir, "sessions").filter("processed_at >= '2025-06'").select("stem").distinct()
    counts = word_counts(word_table(table(spark, sf_dir, "segments")), ["stem"]).join(recent, "stem")
    return counts.groupBy("word").agg(F.sum("freq").alias("freq"), F.count("*").alias("n_sessions"))


@query(f"""SELECT (SELECT count(*) FROM sessions) AS n_sessions, (SELECT count(*) FROM segments) AS n_segments,
(SELECT count(DISTINCT stem) FROM segments) AS n_stems, (SELECT count(*) FROM {WORDS}) AS n_words,
(SELECT count(DISTINCT word) FROM {WORDS}) AS n_distinct_words, (SELECT count(DISTINCT speaker) FROM segments) AS n_labels,
(SELECT round(sum(speech_sec) / 3600, 2) FROM sessions) AS speech_hours, (SELECT count(*) FROM speakers_db) AS n_voices""")
def corpus_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_stats(*(table(spark, sf_dir, n) for n in ("sessions", "segments", "speakers_db")))


@query("""SELECT stem, count(*) AS segments, sum(coalesce(n_words, 0))::BIGINT AS words,
sum(CASE WHEN quality IN ('low', 'unreliable') THEN 1 ELSE 0 END)::BIGINT AS suspects,
round(sum(CASE WHEN quality IN ('low', 'unreliable') THEN 1 ELSE 0 END) / count(*), 4) AS suspect_share FROM segments GROUP BY stem""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspect = F.when(F.col("quality").isin("low", "unreliable"), 1).otherwise(0)
    return table(spark, sf_dir, "segments").groupBy("stem").agg(
        F.count("*").alias("segments"), F.sum(F.coalesce("n_words", F.lit(0))).alias("words"), F.sum(suspect).alias("suspects"),
        F.round(F.sum(suspect) / F.count("*"), 4).alias("suspect_share"),
    )


@query("""SELECT stem, split_part(r, ':', 1) AS reason, count(*) AS n FROM
(SELECT stem, unnest(string_split(quality_reasons, ';')) AS r FROM segments WHERE quality_reasons IS NOT NULL) WHERE r <> '' GROUP BY ALL""")
def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the reasons (the part before a colon) per session."""
    found = table(spark, sf_dir, "segments").filter("quality_reasons is not null").select("stem", F.explode(F.split("quality_reasons", ";")).alias("r"))
    return found.filter("r <> ''").groupBy("stem", F.split_part("r", F.lit(":"), F.lit(1)).alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT stem, idx, segment_id, quality, n_words FROM segments WHERE quality IN ('low', 'unreliable')
ORDER BY CASE quality WHEN 'unreliable' THEN 0 ELSE 1 END, n_words NULLS FIRST, stem, idx, segment_id LIMIT 100""")
def worst_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worst segments first (top-k report)."""
    bad = table(spark, sf_dir, "segments").filter(F.col("quality").isin("low", "unreliable"))
    order = [F.when(F.col("quality") == "unreliable", 0).otherwise(1), F.col("n_words").asc_nulls_first(), "stem", "idx", "segment_id"]
    return bad.orderBy(*order).limit(100).select("stem", "idx", "segment_id", "quality", "n_words")


@query("""SELECT stem, speaker, count(*) AS segments, round(sum(coalesce(duration_sec, 0)), 3) AS seconds, sum(coalesce(n_words, 0))::BIGINT AS words,
round(sum(coalesce(duration_sec, 0)) / sum(sum(coalesce(duration_sec, 0))) OVER (PARTITION BY stem), 4) AS share FROM segments GROUP BY stem, speaker""")
def speaker_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.sum(F.coalesce("duration_sec", F.lit(0.0)))
    agg = table(spark, sf_dir, "segments").groupBy("stem", "speaker").agg(F.count("*").alias("segments"), seconds.alias("s"), F.sum(F.coalesce("n_words", F.lit(0))).alias("words"))
    total = F.sum("s").over(Window.partitionBy("stem"))
    return agg.select("stem", "speaker", "segments", F.round("s", 3).alias("seconds"), "words", F.round(F.try_divide(F.col("s"), total), 4).alias("share"))


@query("""SELECT stem, string_agg(DISTINCT speaker, '|' ORDER BY speaker) AS speakers, count(*) AS segments_count, sum(coalesce(n_words, 0))::BIGINT AS total_words,
round(max(end_sec), 3) AS last_end FROM segments GROUP BY stem""")
def session_document_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").groupBy("stem").agg(
        F.nullif(F.array_join(F.sort_array(F.collect_set("speaker")), "|"), F.lit("")).alias("speakers"), F.count("*").alias("segments_count"),
        F.sum(F.coalesce("n_words", F.lit(0))).alias("total_words"), F.round(F.max("end_sec"), 3).alias("last_end"),
    )


@query("SELECT stem, row_id, processed_at, n_words FROM sessions ORDER BY processed_at DESC NULLS LAST, row_id LIMIT 200")
def latest_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest sessions first (top-k report)."""
    return table(spark, sf_dir, "sessions").orderBy(F.col("processed_at").desc_nulls_last(), "row_id").limit(200).select("stem", "row_id", "processed_at", "n_words")


@query("""SELECT segment_id, stem, before_text, after_text FROM (SELECT segment_id, stem, quality,
coalesce(lag(text, 2) OVER w, '') || ' / ' || coalesce(lag(text) OVER w, '') AS before_text,
coalesce(lead(text) OVER w, '') || ' / ' || coalesce(lead(text, 2) OVER w, '') AS after_text
FROM segments WINDOW w AS (PARTITION BY stem ORDER BY idx, segment_id)) WHERE quality = 'unreliable'""")
def suspect_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two neighbours on each side of every unreliable segment."""
    w = Window.partitionBy("stem").orderBy("idx", "segment_id")
    at = lambda f, n: F.coalesce(f("text", n).over(w), F.lit(""))
    df = table(spark, sf_dir, "segments").select("segment_id", "stem", "idx", "quality", "text")
    both = df.withColumn("before_text", F.concat_ws(" / ", at(F.lag, 2), at(F.lag, 1))).withColumn("after_text", F.concat_ws(" / ", at(F.lead, 1), at(F.lead, 2)))
    return both.filter("quality = 'unreliable'").select("segment_id", "stem", "before_text", "after_text")


_INVENTED = Q.INVENTED.replace("'", "''")


@query(f"""SELECT doc_id, level, reasons FROM (SELECT doc_id, concat_ws(';', CASE WHEN n = 0 THEN 'testo_vuoto' END, CASE WHEN n > 0 AND n < 3 THEN 'pochi_parole:' || n END, made,
CASE WHEN loop THEN 'ripetizione_n3' END, CASE WHEN n > 0 AND s > 0 AND (n / s < 0.3 OR n / s > 6.0) THEN 'ritmo_fuori_scala:' || round(n / s, 1)::VARCHAR || 'wps' END) AS reasons,
CASE WHEN n = 0 OR loop OR made IS NOT NULL OR (n > 0 AND s > 0 AND (n / s < 0.3 OR n / s > 6.0)) THEN 'unreliable' WHEN n < 3 THEN 'low' ELSE 'ok' END AS level
FROM (SELECT doc_id, len(ws) AS n, coalesce(n_chars, 0) / 15.0 AS s, coalesce(g.most, 0) >= 4 AS loop,
CASE WHEN regexp_matches(said, '{Q.PROMPT}') THEN 'prompt_nel_testo' WHEN regexp_matches(said, '{_INVENTED}') OR (regexp_matches(said, '{Q.INVENTED_IF_LONG}') AND coalesce(n_chars, 0) / 15.0 >= 5) THEN 'allucinazione_tipica' END AS made
FROM (SELECT doc_id, n_chars, trim(coalesce(text, '')) AS said, regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}+') AS ws FROM documents) d
LEFT JOIN (SELECT doc_id AS id, max(c) AS most FROM (SELECT doc_id, gram, count(*) AS c FROM (SELECT doc_id, w1 || ' ' || w2 || ' ' || w3 AS gram FROM
(SELECT doc_id, word AS w1, lead(word) OVER w AS w2, lead(word, 2) OVER w AS w3 FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM
(SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS ws FROM documents WHERE text IS NOT NULL)) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE w3 IS NOT NULL)
GROUP BY ALL) GROUP BY doc_id) g ON g.id = d.doc_id))""")
def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on every document; its length at 15 characters a second stands for its duration."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.coalesce("n_chars", F.lit(0)) / 15.0).alias("s"))
    found = Q.reasons(F.col("text"), F.col("s"), F.lit(None).cast("double"), F.array().cast("array<double>"))
    return docs.withColumn("r", found).select("doc_id", Q.level(F.col("r")).alias("level"), F.array_join("r", ";").alias("reasons"))


@query("""WITH d AS (SELECT *, row_number() OVER (PARTITION BY stem, idx ORDER BY segment_id) AS k FROM segments WHERE idx IS NOT NULL),
m AS (SELECT stem, idx, speaker, text, lag(speaker) OVER (PARTITION BY stem ORDER BY idx) AS p, row_number() OVER (PARTITION BY stem ORDER BY idx) AS rn FROM d WHERE k = 1),
b AS (SELECT *, sum(CASE WHEN rn = 1 OR speaker IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY stem ORDER BY idx) AS block FROM m)
SELECT stem, block::BIGINT AS block, min(speaker) AS speaker, string_agg(text, ' ' ORDER BY idx) AS text, count(*) AS n FROM b GROUP BY stem, block""")
def speaker_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable text: successive segments of one label joined."""
    return speaker_blocks(table(spark, sf_dir, "segments"))


@query("""SELECT segment_id, printf('%02d:%02d:%02d,%03d', a // 3600000, a // 60000 % 60, a // 1000 % 60, a % 1000) || ' --> ' ||
printf('%02d:%02d:%02d,%03d', b // 3600000, b // 60000 % 60, b // 1000 % 60, b % 1000) AS times, '[' || coalesce(speaker, 'UNKNOWN') || '] ' || coalesce(text, '') AS line,
row_number() OVER (PARTITION BY stem ORDER BY start_sec, segment_id) AS n
FROM (SELECT *, (floor(start_sec) * 1000 + floor((start_sec - floor(start_sec)) * 1000))::BIGINT AS a, (floor(end_sec) * 1000 + floor((end_sec - floor(end_sec)) * 1000))::BIGINT AS b FROM segments WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL)""")
def subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "segments").filter("start_sec is not null and end_sec is not null")
    n = F.row_number().over(Window.partitionBy("stem").orderBy("start_sec", "segment_id")).cast("long")
    line = F.concat(F.lit("["), F.coalesce("speaker", F.lit("UNKNOWN")), F.lit("] "), F.coalesce("text", F.lit("")))
    return df.select("segment_id", F.concat(T.srt_time_cut(F.col("start_sec")), F.lit(" --> "), T.srt_time_cut(F.col("end_sec"))).alias("times"), line.alias("line"), n.alias("n"))


@query("""WITH t AS (SELECT segment_id, start_sec, end_sec, list_filter(string_split_regex(trim(text), '\\s+'), lambda w: w <> '') AS ws FROM segments
WHERE text IS NOT NULL AND start_sec IS NOT NULL AND end_sec IS NOT NULL AND trim(text) <> '')
SELECT segment_id, unnest(range(len(ws)))::BIGINT AS pos, unnest(ws) AS word, floor((start_sec + unnest(range(len(ws))) * (end_sec - start_sec) / len(ws)) * 1000 + 0.5)::BIGINT AS at_ms FROM t""")
def tokens_with_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens with times spread evenly over their segment (estimated, as no word times are given)."""
    return estimated_tokens(table(spark, sf_dir, "segments"))


@query(f"""SELECT word, count(*) AS freq_global, {", ".join(f"sum(CASE WHEN quality IS NOT DISTINCT FROM '{q}' THEN 1 ELSE 0 END)::BIGINT AS freq_{q}" for q in ("ok", "low", "unreliable"))}
FROM (SELECT quality, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM segments WHERE text IS NOT NULL) GROUP BY word""")
def word_frequency_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide word frequencies: all, and by quality level."""
    words = table(spark, sf_dir, "segments").filter("text is not null").select("quality", F.explode(T.words_letters(F.col("text"))).alias("word"))
    wide = words.groupBy("word").pivot("quality", ["ok", "low", "unreliable"]).count().fillna(0)
    total = words.groupBy("word").agg(F.count("*").alias("freq_global"))
    return total.join(wide, "word").select("word", "freq_global", *(F.col(q).alias(f"freq_{q}") for q in ("ok", "low", "unreliable")))


@query("""WITH RECURSIVE o AS (SELECT stem, idx::BIGINT AS idx, w, row_number() OVER (PARTITION BY stem ORDER BY idx) AS rn FROM
(SELECT stem, idx, len(list_filter(string_split_regex(trim(coalesce(text, '')), '\\s+'), lambda x: x <> '')) AS w, row_number() OVER (PARTITION BY stem, idx ORDER BY segment_id) AS k FROM segments WHERE stem IS NOT NULL AND idx IS NOT NULL) WHERE k = 1 AND w > 0),
r AS (SELECT stem, idx, w, rn, w AS acc, 0::BIGINT AS part FROM o WHERE rn = 1
UNION ALL SELECT o.stem, o.idx, o.w, o.rn, CASE WHEN r.acc + o.w > 800 THEN o.w ELSE r.acc + o.w END, CASE WHEN r.acc + o.w > 800 THEN r.part + 1 ELSE r.part END FROM r JOIN o ON o.stem = r.stem AND o.rn = r.rn + 1)
SELECT stem, part, min(idx) AS first_idx, max(idx) AS last_idx, sum(w)::BIGINT AS words FROM r GROUP BY stem, part""")
def llm_ready_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session's segments in parts of at most about 800 words, in order."""
    return llm_parts(table(spark, sf_dir, "segments"), 800)


@query("""SELECT doc_id, len(regexp_extract_all(lower(text), '\\p{L}+')) AS letters, len(list_filter(string_split_regex(trim(text), '\\s+'), lambda w: w <> '')) AS blanks,
len(regexp_extract_all(lower(regexp_replace(text, '[’''`]', ' ', 'g')), '[\\p{L}\\p{N}]+')) AS alnum, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_'']+')) AS reference,
len(list_filter(regexp_extract_all(text, '[^.?!…]+[.?!…]*'), lambda s: regexp_matches(s, '\\p{L}'))) AS sentences, left(sha1(text), 16) AS fingerprint FROM documents WHERE text IS NOT NULL""")
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by each tokeniser, sentences and the fingerprint of every document."""
    c = F.col("text")
    size = lambda f: F.size(f(c)).cast("long")
    df = table(spark, sf_dir, "documents").filter("text is not null")
    return df.select("doc_id", size(T.words_letters).alias("letters"), size(T.words_blank).alias("blanks"), size(T.words_alnum).alias("alnum"), size(T.words_reference).alias("reference"), size(T.sentences).alias("sentences"), T.fingerprint(c).alias("fingerprint"))


@query("""SELECT row_id, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS clock, CASE WHEN s >= 3600 THEN printf('%d h %02d min', s // 3600, s // 60 % 60)
WHEN s >= 60 THEN printf('%d min', s // 60) ELSE printf('%d s', s) END AS spoken FROM (SELECT row_id, round(duration_sec)::BIGINT AS s FROM sessions WHERE duration_sec > 0)""")
def duration_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "sessions").filter("duration_sec > 0").withColumn("s", F.round("duration_sec"))
    return df.select("row_id", T.hms(F.col("s")).alias("clock"), T.duration_words(F.col("s")).alias("spoken"))


@query("""SELECT gid, voice_name, CASE WHEN voice_name IS NULL THEN gid ELSE voice_name || ' (' || gid || ')' END AS label,
(SELECT string_agg(upper(left(p, 1)) || '.', ' ' ORDER BY i) FROM (SELECT unnest(string_split_regex(trim(voice_name), '\\s+')) AS p, generate_subscripts(string_split_regex(trim(voice_name), '\\s+'), 1) AS i)) AS short FROM speakers_db""")
def voice_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label 'Name (id)' and the name as initials."""
    name = F.col("voice_name")
    label = F.coalesce(F.concat(name, F.lit(" ("), F.col("gid"), F.lit(")")), F.col("gid"))
    return table(spark, sf_dir, "speakers_db").select("gid", "voice_name", label.alias("label"), T.initials(name, F.array().cast("array<string>")).alias("short"))


@query("""SELECT gid FROM (SELECT DISTINCT global_id AS gid FROM speaker_map UNION SELECT 'UNKNOWN') EXCEPT SELECT gid FROM speakers_db""")
def voices_without_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited voices (and UNKNOWN) that the identity table lacks."""
    cited = table(spark, sf_dir, "speaker_map").select(F.col("global_id").alias("gid")).union(spark.range(1).select(F.lit("UNKNOWN"))).distinct()
    return cited.join(table(spark, sf_dir, "speakers_db").select("gid"), "gid", "left_anti")


@query("SELECT gid FROM speakers_db d WHERE NOT EXISTS (SELECT 1 FROM speaker_map m WHERE m.global_id = d.gid)")
def unreferenced_voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities that no session cites: what pruning removes."""
    cited = table(spark, sf_dir, "speaker_map").select(F.col("global_id").alias("gid"))
    return table(spark, sf_dir, "speakers_db").select("gid").join(cited, "gid", "left_anti")


@query("""SELECT coalesce(a.stem, b.stem) AS stem, CASE WHEN b.stem IS NULL THEN 'only_sessions' WHEN a.stem IS NULL THEN 'only_segments' ELSE 'both' END AS state
FROM (SELECT DISTINCT stem FROM sessions) a FULL JOIN (SELECT DISTINCT stem FROM segments) b ON a.stem = b.stem""")
def session_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences both ways between indexed sessions and transcripts."""
    a = table(spark, sf_dir, "sessions").select("stem").distinct().withColumn("a", F.lit(1))
    b = table(spark, sf_dir, "segments").select("stem").distinct().withColumn("b", F.lit(1))
    state = F.when(F.col("b").isNull(), "only_sessions").when(F.col("a").isNull(), "only_segments").otherwise("both")
    return a.join(b, "stem", "full").select("stem", state.alias("state"))


@query("""SELECT segment_id, coalesce(m.gid, s.speaker) AS speaker, m.gid IS NOT NULL AS renamed FROM segments s LEFT JOIN
(SELECT stem, local_label, min(global_id) AS gid FROM speaker_map GROUP BY ALL) m ON s.stem = m.stem AND s.speaker = m.local_label""")
def relabelled_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with their label replaced through the map of their session."""
    m = table(spark, sf_dir, "speaker_map").groupBy("stem", F.col("local_label").alias("speaker")).agg(F.min("global_id").alias("gid"))
    return table(spark, sf_dir, "segments").select("segment_id", "stem", "speaker").join(m, ["stem", "speaker"], "left").select("segment_id", F.coalesce("gid", "speaker").alias("speaker"), F.col("gid").isNotNull().alias("renamed"))


@query("""SELECT source, count(*) AS n, sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END)::BIGINT AS empty, count(DISTINCT text) AS n_distinct, max(length(text)) AS longest FROM documents GROUP BY source""")
def source_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.when(F.col("text").isNull() | (F.col("text") == ""), 1).otherwise(0)
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum(empty).alias("empty"), F.countDistinct("text").alias("n_distinct"), F.max(F.length("text")).cast("long").alias("longest"))


@query("""WITH p AS (SELECT stem, unnest(ws) AS word, idx, segment_id, unnest(range(len(ws))) AS pos FROM
(SELECT stem, idx, segment_id, regexp_extract_all(lower(text), '\\p{L}+') AS ws FROM segments WHERE text IS NOT NULL)),
f AS (SELECT stem, row_number() OVER w AS rn, len(list_distinct(list(word) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))) AS t FROM p WINDOW w AS (PARTITION BY stem ORDER BY idx, segment_id, pos))
SELECT stem, round(avg(CASE WHEN rn >= 50 THEN t / 50 END), 4) AS mattr, count(*) AS n_words FROM f GROUP BY stem""")
def moving_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving-average type-token ratio (50 words) per session."""
    pos = table(spark, sf_dir, "segments").filter("text is not null").select("stem", "idx", "segment_id", F.posexplode(T.words_letters(F.col("text"))).alias("pos", "word"))
    return sequence.moving_type_token_ratio(pos, ["stem"], ["idx", "segment_id", "pos"], "word", 50)


@query("""SELECT speaker AS gid, count(*) AS n, round(median(f0_mean_hz), 4) AS f0, round(median(intensity_mean_db), 4) AS loudness, round(median(voiced_fraction), 4) AS voiced,
round(median(speech_rate_syl_per_sec), 4) AS rate, round(median(pause_ratio), 4) AS pauses FROM segments WHERE quality IS DISTINCT FROM 'unreliable' GROUP BY speaker""")
def prosody_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "segments").filter(~F.col("quality").eqNullSafe(F.lit("unreliable")))
    names = {"f0": "f0_mean_hz", "loudness": "intensity_mean_db", "voiced": "voiced_fraction", "rate": "speech_rate_syl_per_sec", "pauses": "pause_ratio"}
    return good.groupBy(F.col("speaker").alias("gid")).agg(F.count("*").alias("n"), *(F.round(F.median(c), 4).alias(k) for k, c in names.items()))


@query("""WITH v AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS w FROM documents WHERE text IS NOT NULL) WHERE w = lower(w)),
p AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{L}+|[^\\p{L}]+')) AS part, generate_subscripts(regexp_extract_all(text, '\\p{L}+|[^\\p{L}]+'), 1) AS pos FROM documents)
SELECT d.doc_id, coalesce(x.text, '') AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(CASE WHEN regexp_matches(part, '^\\p{Lu}') AND v.w IS NULL THEN upper(left(part, 1)) || '.' ELSE part END, '' ORDER BY pos) AS text
FROM p LEFT JOIN v ON v.w = lower(part) GROUP BY doc_id) x USING (doc_id)""")
def anonymised_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised words that never occur in lower case become initials."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return publish.anonymise(docs, "doc_id", "text", publish.lower_vocabulary(docs, "text"))


@query("""SELECT doc_id, CASE WHEN source IS NULL THEN 'insert' WHEN lang IS NULL THEN 'delete' ELSE 'update' END AS action FROM documents
WHERE (source IS NULL AND lang IS NOT NULL) OR (source IS NOT NULL AND lang IS NULL) OR (source IS NOT NULL AND lang IS NOT NULL AND trim(text) <> text)""")
def published_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a change-only sink writes, from a state of all trimmed texts with a source to that of all texts with a language."""
    docs = table(spark, sf_dir, "documents")
    previous = docs.filter("source is not null").select("doc_id", F.trim("text").alias("text"))
    return publish.changes(previous, docs.filter("lang is not null").select("doc_id", "text"), "doc_id", "text")


@query("""SELECT DISTINCT d.doc_id, n.w AS name FROM (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '\\p{L}+'), ' ') || ' ' AS t FROM documents WHERE text IS NOT NULL) d
JOIN (SELECT DISTINCT array_to_string(regexp_extract_all(lower(p_name), '\\p{L}+'), ' ') AS w FROM (SELECT 'pane nero' AS p_name UNION ALL SELECT 'Bicicletta' UNION ALL SELECT voice_name FROM speakers_db WHERE voice_name IS NOT NULL)) n
ON n.w <> '' AND contains(d.t, ' ' || n.w || ' ')""")
def names_to_hide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold the name of a voice, or one of two listed names, of one word or more (the guard before publication)."""
    names = table(spark, sf_dir, "speakers_db").select("voice_name").unionByName(spark.createDataFrame([("pane nero",), ("Bicicletta",)], "voice_name string"))
    return publish.names_in_texts(table(spark, sf_dir, "documents"), "doc_id", "text", names, "voice_name")


@query()
def neighbour_word_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word errors of each segment's text (hypothesis) against the text before it in its session (reference)."""
    before = F.lag("text").over(Window.partitionBy("stem").orderBy("idx", "segment_id"))
    df = table(spark, sf_dir, "segments").select("segment_id", "text", before.alias("_before")).filter("text is not null and _before is not null")
    hyp = df.select("segment_id", T.words_alnum(F.col("_before")).alias("ref"), T.words_alnum(F.col("text")).alias("hyp"))
    e = hyp.select("segment_id", alignment.word_errors(F.col("ref"), F.col("hyp")).alias("e"))
    return e.select("segment_id", "e.*")
