"""Queries of the llm problems 2, 3 and 6 to 9 over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquela.functions.timeutil import clock_parts, resolve_wall
from loquela.llm import byte_bpe, mixing, nearest_time, neighbours, truncation, turns
from loquela.operators import timestamps
from loquela.tables import table

TOLERANCE_US = 120_000_000


def stem_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stem, entity (wearer) and instant of each session that has one; re-ingested rows fold into one."""
    instants = timestamps.session_instants(table(spark, sf_dir, "sessions"), table(spark, sf_dir, "wearers"))
    known = instants.filter("stem is not null and utc_us is not null")
    return known.groupBy("stem").agg(F.min("wearer_id").alias("entity"), F.min("utc_us").alias("utc_us"))


def segment_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "segments").select("segment_id", "stem", "start_sec").filter(F.col("start_sec").isNotNull() & ~F.isnan("start_sec"))
    offset = F.round(F.col("start_sec") * 1_000_000).cast("long")
    return segments.join(stem_instants(spark, sf_dir), "stem").select("entity", (F.col("utc_us") + offset).alias("at"), F.col("segment_id").alias("id"))


def reading_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "helio_battito").filter("heart_rate is not null")
    zones = table(spark, sf_dir, "wearers").select("wearer_id", "tz")
    walls = readings.select("wearer_id", F.col("reading_id").alias("id"), clock_parts(F.col("hr_date"), F.col("hr_time")).alias("wall")).join(zones, "wearer_id")
    return resolve_wall(walls, "wall", "tz", "at").select(F.col("wearer_id").alias("entity"), "at", "id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.pairs(neighbours.nearest_vectors(table(spark, sf_dir, "speakers_db"), "voice_id", "centroid", 128))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = nearest_time.nearest_in_time(segment_times(spark, sf_dir), reading_times(spark, sf_dir), TOLERANCE_US)
    return matched.select(F.col("left_id").alias("segment_id"), F.col("right_id").alias("reading_id"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.speaker_turns(table(spark, sf_dir, "segments"), table(spark, sf_dir, "speaker_map"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), ["doc_id"])


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of the mixture with the parts of documents it holds."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all tokens each source reached, measured on the mixture."""
    return mixing.shares(p8_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.judge_ends(table(spark, sf_dir, "documents")).filter("truncated").select(F.col("id").alias("doc_id"))


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    return truncation.truncation_rates(truncation.judge_ends(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p6_found, p7_ids, p8_mix, p8_shares, p9_found, p9_rates)}
SQL: dict[str, str] = {}
