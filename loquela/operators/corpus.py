"""Operators of the corpus index."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.functions.text import index_words, words_blank
from loquela.operators.sequence import same_value_runs


def word_table(segments: DataFrame) -> DataFrame:
    """One row per word occurrence: stem and word (text columns are pruned away)."""
    return segments.filter("text is not null").select("stem", F.explode(index_words(F.col("text"))).alias("word"))


def word_counts(words: DataFrame, keys: list[str]) -> DataFrame:
    return words.groupBy(*keys, "word").agg(F.count("*").alias("freq"))


def bigrams(segments: DataFrame) -> DataFrame:
    """stem, w1, w2, freq of adjacent words in a session's order; a window by session, no self-join."""
    placed = segments.filter("text is not null").select("stem", "idx", "segment_id", F.posexplode(index_words(F.col("text"))).alias("pos", "w1"))
    after = F.lead("w1").over(Window.partitionBy("stem").orderBy("idx", "segment_id", "pos"))
    return placed.withColumn("w2", after).filter("w2 is not null").groupBy("stem", "w1", "w2").agg(F.count("*").alias("freq"))


def corpus_stats(sessions: DataFrame, segments: DataFrame, voices: DataFrame) -> DataFrame:
    """One row of counts; each part is an aggregate of one table."""
    words = word_table(segments).groupBy("word").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.count("*").alias("n_distinct_words"))
    parts = [
        sessions.agg(F.count("*").alias("n_sessions"), F.round(F.sum("speech_sec") / 3600, 2).alias("speech_hours")),
        segments.agg(F.count("*").alias("n_segments"), F.countDistinct("stem").alias("n_stems"), F.countDistinct("speaker").alias("n_labels")),
        words,
        voices.agg(F.count("*").alias("n_voices")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*(F.max(c).alias(c) for c in rows.columns))


def speaker_blocks(segments: DataFrame) -> DataFrame:
    """stem, block, speaker, text and n of runs of one label; repeated (stem, idx) count once."""
    own = Window.partitionBy("stem", "idx").orderBy("segment_id")
    unique = segments.filter("idx is not null").select("stem", "idx", "speaker", "text", "segment_id").withColumn("_k", F.row_number().over(own)).filter("_k = 1")
    runs = same_value_runs(unique, ["stem"], ["idx"], "speaker", "block")
    ordered = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("idx", "text"))))
    return runs.groupBy("stem", "block").agg(F.min("speaker").alias("speaker"), F.when(F.size(ordered) > 0, F.array_join(F.transform(ordered, lambda x: x["text"]), " ")).alias("text"), F.count("*").alias("n"))


def estimated_tokens(segments: DataFrame) -> DataFrame:
    """segment_id, pos, word and at_ms, times spread evenly."""
    timed = segments.filter("text is not null and start_sec is not null and end_sec is not null and trim(text) <> ''")
    df = timed.select("segment_id", "start_sec", "end_sec", words_blank(F.col("text")).alias("ws"))
    at = F.floor((F.col("start_sec") + F.col("pos") * (F.col("end_sec") - F.col("start_sec")) / F.col("n")) * 1000 + 0.5).cast("long")
    return df.select("segment_id", "start_sec", "end_sec", F.size("ws").alias("n"), F.posexplode("ws").alias("pos", "word")).select("segment_id", F.col("pos").cast("long").alias("pos"), "word", at.alias("at_ms"))


def _fold(rows: DataFrame, fold, schema: str) -> DataFrame:
    """A fold over the rows of each session in order (a session is bounded by a recording's length), Arrow-batched."""

    def run(table: pa.Table) -> pa.Table:
        ordered = table.sort_by([(c, "ascending") for c in table.column_names if c != "stem"])
        out = fold([r for r in ordered.to_pylist()])
        names = [c.split()[0] for c in schema.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]] for c in schema.split(", ")]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return rows.groupBy("stem").applyInArrow(run, schema)


def llm_parts(segments: DataFrame, size: int) -> DataFrame:
    """stem, part, first_idx, last_idx, words: greedy parts; one is closed before a segment that would take it above `size` words.

    Words are tokens between white space; blank texts are left out; repeated (stem, idx) count once (smallest segment_id).
    """
    own = Window.partitionBy("stem", "idx").orderBy("segment_id")
    spoken = segments.filter("stem is not null and idx is not null").select("stem", "idx", "segment_id", F.size(words_blank(F.coalesce("text", F.lit("")))).cast("long").alias("w"))
    rows = spoken.withColumn("_k", F.row_number().over(own)).filter("_k = 1 and w > 0").select("stem", F.col("idx").cast("long").alias("idx"), "w")

    def fold(found: list[dict]) -> list[tuple]:
        parts: list[list] = []
        for r in found:
            if parts and parts[-1][4] + r["w"] <= size:
                parts[-1][3:] = [r["idx"], parts[-1][4] + r["w"]]
            else:
                parts.append([r["stem"], len(parts), r["idx"], r["idx"], r["w"]])
        return parts

    return _fold(rows, fold, "stem string, part long, first_idx long, last_idx long, words long")


def pack_by_time(segments: DataFrame, limit: float) -> DataFrame:
    """stem, chunk, first_start, last_end, segments: greedy chunks of at most `limit` seconds from first start to last end.

    A segment longer than that closes the open chunk and is cut into pieces of `limit` seconds, each a chunk of its own.
    """
    rows = segments.filter("stem is not null and start_sec is not null and end_sec >= start_sec").select("stem", F.col("start_sec").cast("double").alias("a"), F.col("end_sec").cast("double").alias("b"))

    def fold(found: list[dict]) -> list[tuple]:
        chunks: list[list] = []
        open_ = False
        for r in found:
            stem, a, b = r["stem"], r["a"], r["b"]
            if b - a > limit:
                while a < b:
                    end = min(a + limit, b)
                    chunks.append([stem, len(chunks), a, end, 1])
                    a = end
                open_ = False
            elif open_ and b - chunks[-1][2] <= limit:
                chunks[-1][3:] = [b, chunks[-1][4] + 1]
            else:
                chunks.append([stem, len(chunks), a, b, 1])
                open_ = True
        return chunks

    return _fold(rows, fold, "stem string, chunk long, first_start double, last_end double, segments long")
