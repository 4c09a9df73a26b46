"""File sources and sinks: session documents, JSON lines (strict or tolerant), wearable exports, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = T.StructType([T.StructField("word", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("prob", T.DoubleType()), T.StructField("speaker", T.StringType())])
#: The prosody columns of a segment.
PROSODY = ["f0_mean_hz", "f0_std_hz", "f0_min_hz", "f0_max_hz", "f0_range_hz", "intensity_mean_db", "intensity_max_db", "voiced_fraction", "jitter_local", "shimmer_local", "speech_rate_syl_per_sec", "pause_ratio"]
SEGMENT = T.StructType(
    [T.StructField("idx", T.IntegerType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("duration_sec", T.DoubleType())]
    + [T.StructField(n, T.StringType()) for n in ("text", "speaker", "quality")]
    + [T.StructField("quality_reasons", T.ArrayType(T.StringType())), T.StructField("no_speech_prob", T.DoubleType())]
    + [T.StructField("prosody", T.StructType([T.StructField(p, T.DoubleType()) for p in PROSODY])), T.StructField("words", T.ArrayType(WORD))]
)
META = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("file", "stem", "processed_at")]
    + [T.StructField(n, T.DoubleType()) for n in ("total_duration_sec", "speech_duration_sec", "speech_ratio")]
    + [T.StructField("segments_count", T.IntegerType()), T.StructField("total_words", T.IntegerType())]
    + [T.StructField("speakers", T.ArrayType(T.StringType())), T.StructField("speaker_names", T.MapType(T.StringType(), T.StringType()))]
)
SESSION = T.StructType([T.StructField("meta", META), T.StructField("segments", T.ArrayType(SEGMENT))])


def session_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per session document, malformed files left out; `stem` falls back to the folder's name."""
    df = spark.read.schema(SESSION).option("mode", "DROPMALFORMED").option("multiLine", True).json(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return df.select(F.coalesce("meta.stem", folder).alias("stem"), "meta", "segments").filter(F.col("segments").isNotNull())


def document_segments(documents: DataFrame) -> DataFrame:
    """One row per segment; prosody stays null where it is absent, never 0."""
    rows = documents.select("stem", F.explode("segments").alias("s"))
    plain = [f for f in SEGMENT.fieldNames() if f not in ("prosody", "words")]
    return rows.select("stem", *(F.col(f"s.{f}").alias(f) for f in plain), *(F.col(f"s.prosody.{p}").alias(p) for p in PROSODY), F.col("s.words").alias("words"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False) -> DataFrame:
    """JSON lines; malformed ones are an error (strict) or are left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def export_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV rows of wearable exports with `export_ms` from the folder's name; the newest export is last."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)
    return df.withColumn("export_ms", F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)/[^/]*$", 1).try_cast("long"))


def glossary(spark: SparkSession, path: str) -> DataFrame:
    """One entry a line, comments and blanks left out."""
    lines = spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("entry"))
    return lines.filter("entry <> ''").distinct()


def annotated_reference(lines: DataFrame, order: str, line: str) -> DataFrame:
    """Words with their speaker from lines `[Name] words`; the name carries forward, `#` lines are comments."""
    from pyspark.sql import Window

    name = F.nullif(F.regexp_extract(line, r"^\s*\[([^\]]+)\]", 1), F.lit(""))
    rest = F.regexp_replace(F.col(line), r"^\s*\[[^\]]+\]", "")
    known = lines.filter(~F.coalesce(F.col(line).startswith("#"), F.lit(True))).withColumn("_name", name)
    speaker = F.last("_name", ignorenulls=True).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return known.select(order, speaker.alias("speaker"), F.posexplode(F.filter(F.split(F.trim(rest), r"\s+"), lambda w: w != "")).alias("pos", "word"))


def write_partitioned(df: DataFrame, path: str, keys: list[str]) -> None:
    """Idempotent write: only the partitions present in `df` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_json_lines(df: DataFrame, path: str, drop: tuple[str, ...] = ("words",)) -> None:
    df.drop(*drop).write.mode("overwrite").json(path)
