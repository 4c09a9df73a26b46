"""Problem 6: speech transcripts into clean speaker turns.

Every segment is cleaned in one Arrow-batched pass: time marks, head labels and sound annotations are cut, the remaining
tokens are classified as words or hesitations, and the labels of both places (the field and the head of the text) are
normalised and resolved to voices. Sessions are then ordered by time, and a gradient-boosted model decides for each pair
of neighbours whether a turn ends between them. Its verdict stands: nothing replaces it afterwards.

Both models are a few boosted trees fitted on the driver from at most `sample_sessions` sessions (first by hash of the
stem; a documented bound), and applied to all rows.

- Tokens: the corpus itself says which tokens are hesitations. A hesitation may stand between any two words, so the words
  on its sides also occur side by side without it, are of as many kinds as chance gives, and it lies inside sentences. Token types with
  such evidence are the positive examples, the others the negative ones (`ANCHORS` alone where the sample is too small to
  say anything); the trees learn from them what the *letters* of a hesitation look like and judge any token by its letters.
- Boundaries: features are what the labels in either place of the two segments say of each other (equal, different or
  nothing, for the four combinations of places), how many of the two are named at all, the gap and the number of words.
  The examples are neighbours whose own labels do not contradict each other, each shown with its labels in either
  place, in both or in none, since a label means the same wherever it stands.

Defined results: repeated (stem, idx) count once (smallest segment_id); segments without start or without words are left
out; null and empty texts have no words; equal starts are ordered by idx, then segment_id; a session with no words left
gives no turn; the voice of a turn is that of its first segment; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.functions.voices import UNKNOWN, bare_text, head_label, label_key, place_voice, session_labels
from loquela.llm.boosting import BoostedTrees

#: What a hesitation is, for samples too small to show it.
ANCHORS = ("ehm", "mmm", "uh")
#: Occurrences a type needs to speak for itself; shares of its occurrences that must be removable and inside a sentence;
#: how many different words it must have on either side, against those that as many places chosen by chance would have.
ENOUGH, REMOVABLE, INSIDE, VARIED = 12, 0.6, 0.6, 0.5
_EDGES, _SPOKEN, _STOP = re.compile(r"^[\W_]+|[\W_]+$"), re.compile(r"[^\W_]"), re.compile(r"[.!?…]\W*$")
SAMPLE_SESSIONS = 400
#: Verdicts on tokens that a worker remembers; more are worked out each time.
TOKEN_CACHE = 500_000


def letters(token: str) -> list[float]:
    """What the letters of a lower-case token look like: the features of the token model."""
    breath = sum(c in "hm" for c in token)
    vowels = sum(c in "aeiou" for c in token)
    after = bool(re.search(r"[hm][aeiou]", token))
    bright = sum(c in "io" for c in token)
    longest = max((len(m[0]) for m in re.finditer(r"(.)\1*", token)), default=0)
    return [len(token), breath, vowels, len(token) - breath - vowels, after, bright, longest, token[:1] in "hm" and len(token) > 1]


def hesitation_examples(texts: list[str]) -> dict[str, bool]:
    """Token types of the texts with enough occurrences: does one stand anywhere, between words that also meet without it?"""
    beside, count, seen = set(), Counter(), {}
    lines = []
    for text in texts:
        tokens = [t for t in bare_text(text).split() if _SPOKEN.search(t)]
        cores = [_EDGES.sub("", t).lower() for t in tokens]
        lines.append((tokens, cores))
        count.update(cores)
        beside.update(zip(cores, cores[1:]))
    for tokens, cores in lines:
        for i in range(1, len(cores) - 1):
            left, core, right = cores[i - 1 : i + 2]
            entry = seen.setdefault(core, [0, 0, 0, set(), set()])
            entry[0] += 1
            entry[1] += (left, right) in beside
            entry[2] += not _STOP.search(tokens[i - 1])
            entry[3].add(left)
            entry[4].add(right)
    share = np.array(list(count.values()), float) / max(sum(count.values()), 1)
    out = {}
    for core, n in count.items():
        times, removable, inside, lefts, rights = seen.get(core, (0, 0, 0, (), ()))
        if n >= ENOUGH and times:
            out[core] = removable >= REMOVABLE * times and inside >= INSIDE * times
            if out[core]:
                by_chance = float((1 - (1 - share) ** times).sum())
                out[core] = min(len(lefts), len(rights)) >= VARIED * by_chance
    return out


def token_model(texts: list[str] | None = None) -> BoostedTrees:
    """The token model from the texts of the sample."""
    examples = hesitation_examples(texts or [])
    plain = {c for t in texts or [] for c in (_EDGES.sub("", w).lower() for w in bare_text(t).split()) if len(c) > 4 or not set(c) <= set("aeiouhm")}
    known = {**dict.fromkeys(sorted(plain), False), **dict.fromkeys(["a", "o", "ho", "mia"], False), **examples, **dict.fromkeys(ANCHORS, True)}
    known.pop("", None)
    return BoostedTrees(rounds=30, depth=4).fit(np.array([letters(t) for t in known], float), np.array(list(known.values()), float))


class Speech:
    """Cleans texts; the token model's verdicts are kept per distinct token."""

    def __init__(self, model: BoostedTrees) -> None:
        self.model, self.known, self.verdicts = model, {}, {}

    def is_filler(self, token: str) -> bool:
        core = _EDGES.sub("", token).lower()
        if core not in self.known:
            verdict = bool(self.model.score(np.array([letters(core)], float))[0] > 0)
            if len(self.known) >= TOKEN_CACHE:
                return verdict
            self.known[core] = verdict
        return self.known[core]

    def words(self, text: str | None) -> list[str]:
        """The spoken words of a text."""
        if not text:
            return []
        out, verdicts = [], self.verdicts
        for token in bare_text(text).split():
            spoken = verdicts.get(token)
            if spoken is None:
                spoken = _SPOKEN.search(token) is not None and not self.is_filler(token)
                if len(verdicts) < TOKEN_CACHE:
                    verdicts[token] = spoken
            if spoken:
                out.append(token)
        return out


def _cleaner(model: BoostedTrees, with_text: bool):
    speech = Speech(model)

    def run(speaker: pd.Series, text: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in text]
        words = [speech.words(t) for t in texts]
        out = {"field": [label_key(s) if isinstance(s, str) else None for s in speaker], "head": [head_label(t) for t in texts], "n_words": [len(w) for w in words]}
        frame = pd.DataFrame(out).astype({"field": "object", "head": "object", "n_words": "int32"})
        if with_text:
            frame["words"] = [" ".join(w) for w in words]
        return frame

    return F.pandas_udf(run, "field string, head string, n_words int" + ", words string" * with_text)


def clean_segments(segments: DataFrame, speaker_map: DataFrame, tokens: BoostedTrees, with_text: bool = False) -> DataFrame:
    """stem, idx, segment_id, times, voice, the voice named in either place, n_words (and `words`) of the segments that count."""
    keys = ["stem", "idx", "segment_id", "start_sec", "end_sec"]
    fields = ["field", "head", "n_words"] + ["words"] * with_text
    timed = segments.filter(F.col("start_sec").isNotNull() & ~F.isnan("start_sec"))
    cleaned = timed.select(*keys, _cleaner(tokens, with_text)(F.col("speaker"), F.col("text")).alias("_c"))
    flat = cleaned.select(*keys, *(F.col(f"_c.{f}").alias(f) for f in fields)).filter("n_words > 0")
    joined = flat.join(session_labels(speaker_map), "stem", "left")
    named = joined.withColumns({p: place_voice(F.col(p), F.col("_labels")) for p in ("field", "head")}).drop("_labels")
    voiced = named.withColumn("voice", F.coalesce("field", "head", F.lit(UNKNOWN)))
    own = Window.partitionBy("stem", F.coalesce(F.col("idx").cast("long"), -F.col("segment_id"))).orderBy("segment_id")
    return voiced.withColumn("_n", F.row_number().over(own)).filter("_n = 1").drop("_n")


#: field against field, field against head, head against field, head against head (1 equal, -1 different, 0 not both there), segments named of the two, gap, words before and here.
FEATURES = ["f_ff", "f_fh", "f_hf", "f_hh", "f_before", "f_here", "f_gap", "f_words_before", "f_words"]


def boundary_features(cleaned: DataFrame) -> DataFrame:
    """Add FEATURES of each segment and the one before it in time, and `prev`, that one's voice (null at the first)."""
    order = Window.partitionBy("stem").orderBy("start_sec", "idx", "segment_id")
    before = lambda c: F.lag(c).over(order)
    df = cleaned.withColumns({"prev": before("voice"), "_pf": before("field"), "_ph": before("head"), "_pe": before("end_sec"), "_pn": before("n_words")})
    said = lambda a, b: F.when(F.col(a) == F.col(b), 1.0).when(F.col(a) != F.col(b), -1.0).otherwise(0.0)
    named = lambda a, b: F.coalesce(F.col(a), F.col(b)).isNotNull().cast("double")
    columns = [said("_pf", "field"), said("_pf", "head"), said("_ph", "field"), said("_ph", "head"), named("_pf", "_ph"), named("field", "head")]
    columns += [F.coalesce(F.col("start_sec") - F.col("_pe"), F.lit(0.0)), F.coalesce("_pn", F.lit(0)).cast("double"), F.col("n_words").cast("double")]
    return df.withColumns(dict(zip(FEATURES, columns))).drop("_pe", "_pn")


def _shown(pairs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Examples for the boundary model: each pair of neighbours with its labels in field, head, both or none.

    Two made-up neighbours, of one voice and of two, stand beside those of the sample, which may lack either kind.
    """
    made = pd.DataFrame({"a": ["A", "A"], "b": ["A", "B"], "gap": [1.0, 1.0], "before": [5.0, 5.0], "here": [5.0, 5.0]})
    rows = pd.concat([pairs, made], ignore_index=True)
    same = (rows["a"] == rows["b"]).to_numpy()
    x, y = [], []
    for (af, ah), (bf, bh) in product(product((True, False), repeat=2), repeat=2):
        said = lambda p, q: np.where(same, 1.0, -1.0) if p and q else np.zeros(len(rows))  # noqa: E731, B023
        a, b = af or ah, bf or bh
        fixed = [np.full(len(rows), float(v)) for v in (a, b)]
        x.append(np.column_stack([said(af, bf), said(af, bh), said(ah, bf), said(ah, bh), *fixed, rows["gap"], rows["before"], rows["here"]]))
        y.append(~same if a and b else np.full(len(rows), a or b))
    return np.concatenate(x).astype(float), np.concatenate(y).astype(float)


def fit_models(segments: DataFrame, speaker_map: DataFrame, sample_sessions: int = SAMPLE_SESSIONS) -> tuple[BoostedTrees, BoostedTrees]:
    """Token model and boundary model, from at most `sample_sessions` sessions (first by hash of the stem), 50 rows each on average."""
    stems = speaker_map.select("stem").filter("stem is not null").distinct().orderBy(F.xxhash64("stem"), "stem").limit(sample_sessions)
    columns = ["stem", "segment_id", "speaker", "text", "start_sec", "end_sec"]
    taken = segments.select(*columns).join(F.broadcast(stems), "stem", "left_semi").orderBy(F.xxhash64("segment_id"), "segment_id").limit(50 * sample_sessions)
    labels = session_labels(speaker_map.join(F.broadcast(stems), "stem", "left_semi"))
    rows = taken.join(F.broadcast(labels), "stem", "left").toPandas()
    texts = [t for t in rows["text"] if isinstance(t, str)]
    tokens = token_model(texts)
    speech, names = Speech(tokens), []
    for label, text, known in zip(rows["speaker"], rows["text"], rows["_labels"]):
        known = dict(known) if known is not None and known == known else {}
        keys = [label_key(label) if isinstance(label, str) else None, head_label(text) if isinstance(text, str) else None]
        said = {k if k.startswith("GLOBAL_") else known.get(k) for k in keys if k} - {None}
        names.append(next(iter(said)) if len(said) == 1 else None)
    rows["voice"], rows["words"] = names, [float(len(speech.words(t if isinstance(t, str) else None))) for t in rows["text"]]
    rows = rows[rows["start_sec"].notna() & (rows["words"] > 0)].sort_values(["stem", "start_sec", "segment_id"])
    last = rows.shift(1)
    pairs = pd.DataFrame({"a": last["voice"], "b": rows["voice"], "gap": (rows["start_sec"] - last["end_sec"]).fillna(0.0), "before": last["words"], "here": rows["words"]})
    pairs = pairs[(rows["stem"] == last["stem"]) & pairs["a"].notna() & pairs["b"].notna()]
    return tokens, BoostedTrees(rounds=12, depth=3).fit(*_shown(pairs.head(5 * sample_sessions)))


def speaker_turns(segments: DataFrame, speaker_map: DataFrame, models: tuple[BoostedTrees, BoostedTrees] | None = None, with_text: bool = False) -> DataFrame:
    """stem, speaker, first_idx, last_idx, n_words (and `turn_no`, `text`) of every turn."""
    tokens, boundaries = models or fit_models(segments, speaker_map)
    df = boundary_features(clean_segments(segments, speaker_map, tokens, with_text))
    ends = F.col("prev").isNull() | (boundaries.column([F.col(f) for f in FEATURES]) > 0)
    order = Window.partitionBy("stem").orderBy("start_sec", "idx", "segment_id")
    numbered = df.withColumn("turn_no", F.sum(ends.cast("int")).over(order))
    at = F.struct("start_sec", "idx", "segment_id")
    aggs = [
        F.min_by("voice", at).alias("speaker"),
        F.min_by("idx", at).cast("long").alias("first_idx"),
        F.max_by("idx", at).cast("long").alias("last_idx"),
        F.sum("n_words").cast("long").alias("n_words"),
    ]
    if with_text:
        pieces = F.array_sort(F.collect_list(F.struct("start_sec", "idx", "segment_id", "words")))
        aggs.append(F.array_join(F.transform(pieces, lambda p: p["words"]), " ").alias("text"))
    turns = numbered.groupBy("stem", "turn_no").agg(*aggs)
    return turns if with_text else turns.drop("turn_no")
