"""Speaker labels of transcripts: normal form, labels at the head of a text, and the voice behind a segment."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
_NAME = r"(?:GLOBAL|SPEAKER|SPK|S|G)[ _\-]?\d{1,12}"
#: Time marks that stand bare at the head of a text: `05:35 - ` and `00:25:44.815 `.
_BARE_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s+-(?=\s|$)|\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?(?=\s|$)"
_LABEL = rf"(?:>>\s*)?(?:\[\s*({_NAME})\s*\]|({_NAME})(?:\s*[:>]|\s+-(?=\s|$)))"
_SPAN = r"\[[^\[\]]*\]|\([^()]*\)|<[^<>]*>|\{[^{}]*\}|\*[^*\s][^*]*\*|♪[^♪]*♪|♪"
_HEAD = re.compile(rf"(?:\s|{_BARE_TIME}|(?!\[\s*{_NAME}\s*\])(?:{_SPAN}))*{_LABEL}", re.IGNORECASE)
_SPANS = re.compile(_SPAN)
_MARKS = re.compile(rf"(?:\s|{_BARE_TIME}|(?:>>\s*)?{_NAME}(?:\s*[:>]|\s+-(?=\s|$)))+", re.IGNORECASE)
_STAMP = re.compile(r"(?<!\S)\d{1,2}:\d{2}:\d{2}[.,]\d+(?!\S)")
_KEY = re.compile(r"\s*(?:(GLOBAL|G)|SPEAKER|SPK|S)[ _\-]?(\d{1,12})\s*", re.IGNORECASE)


@lru_cache(maxsize=100_000)
def label_key(label: str | None) -> str | None:
    """Normal form of a label: `GLOBAL_` and 8 digits, `SPEAKER_` and at least 2 digits, or None if it names nobody."""
    m = _KEY.fullmatch(label) if label else None
    if not m:
        return None
    return f"GLOBAL_{int(m[2]):08d}" if m[1] else f"SPEAKER_{int(m[2]):02d}"


def head_label(text: str | None) -> str | None:
    """The label at the head of a text in normal form, past time marks and annotations; None if there is none."""
    m = _HEAD.match(text) if text else None
    return label_key(m[1] or m[2]) if m else None


def bare_text(text: str) -> str:
    """The text without time marks, head labels and sound annotations."""
    out = _SPANS.sub(" ", text)
    if m := _MARKS.match(out):
        out = out[m.end() :]
    return _STAMP.sub(" ", out)


def _keys(speaker: pd.Series, text: pd.Series) -> pd.DataFrame:
    text_keys = [head_label(t) if isinstance(t, str) else None for t in text]
    return pd.DataFrame({"field": [label_key(s) if isinstance(s, str) else None for s in speaker], "head": text_keys}, dtype="object")


def label_fields(speaker: Column, text: Column) -> Column:
    """Struct of the normal forms of the speaker field and of the label at the head of the text (Arrow-batched)."""
    return F.pandas_udf(_keys, "field string, head string")(speaker, text)


def session_labels(speaker_map: DataFrame) -> DataFrame:
    """One row per session: stem and the map from local label to voice. Repeated rows fold; a session's labels are few."""
    clean = speaker_map.select("stem", F.upper(F.trim("local_label")).alias("label"), F.upper(F.trim("global_id")).alias("gid"))
    pairs = clean.filter("stem is not null and label is not null and gid is not null").repartition("stem").groupBy("stem", "label").agg(F.min("gid").alias("gid"))
    return pairs.groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct("label", "gid"))).alias("_labels"))


def place_voice(key: Column, labels: Column) -> Column:
    """The global id a label in normal form names: itself, or what the session's map says of it; null if neither."""
    return F.when(key.startswith("GLOBAL_"), key).otherwise(F.try_element_at(labels, key))


def voice_of(field: Column, head: Column, labels: Column) -> Column:
    """The global id named by the speaker field, else by the head of the text, else UNKNOWN."""
    return F.coalesce(place_voice(field, labels), place_voice(head, labels), F.lit(UNKNOWN))


def with_voice(segments: DataFrame, speaker_map: DataFrame, keep: list[str]) -> DataFrame:
    """`stem`, `keep` and `voice` of every segment; the text is read for its head label only.

    Joined by session alone, so what follows per session needs no second shuffle.
    """
    keyed = segments.select("stem", *keep, label_fields(F.col("speaker"), F.col("text")).alias("_k"))
    flat = keyed.select("stem", *keep, F.col("_k.field").alias("_field"), F.col("_k.head").alias("_head"))
    joined = flat.join(session_labels(speaker_map), "stem", "left")
    return joined.withColumn("voice", voice_of(F.col("_field"), F.col("_head"), F.col("_labels"))).drop("_field", "_head", "_labels")
