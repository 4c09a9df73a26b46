"""Word alignment and guarded corrections: sequential algorithms on one row's arrays, in Arrow-batched functions."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the guards: acoustic certainty and least similarity.
PROB_THRESHOLD, SIMILARITY = 0.90, 0.6


def edit_alignment(ref: list[str], hyp: list[str]) -> list[tuple[int | None, int | None]]:
    """Levenshtein alignment as pairs of places; of equally cheap paths, seen from the end, a match or substitution wins, then a deletion.

    The table is filled by anti-diagonals (each one numpy operation) and keeps only the move of each cell.
    """
    n, m = len(ref), len(hyp)
    codes = {w: k for k, w in enumerate(dict.fromkeys([*ref, *hyp]))}
    a, b = (np.array([codes[w] for w in ws], dtype=np.int64) for ws in (ref, hyp))
    move = np.full((n + 1, m + 1), 2, dtype=np.int8)  # 0 both, 1 reference only, 2 hypothesis only
    move[1:, 0] = 1
    older, old = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)  # by i, on the two diagonals before
    for d in range(1, n + m + 1):
        now = np.full(n + 1, d, dtype=np.int64)
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        if len(i):
            j = d - i
            costs = np.stack([older[i - 1] + (a[i - 1] != b[j - 1]), old[i - 1] + 1, old[i] + 1])
            move[i, j] = costs.argmin(0)
            now[i] = costs.min(0)
        older, old = old, now
    pairs: list[tuple[int | None, int | None]] = []
    at = [n, m]
    while any(at):
        step = move[at[0], at[1]]
        at = [at[0] - (step != 2), at[1] - (step != 1)]
        pairs.append((at[0] if step != 2 else None, at[1] if step != 1 else None))
    return pairs[::-1]


def error_counts(ref: list[str], hyp: list[str]) -> tuple[int, int, int, int]:
    """Substitutions, deletions, insertions, right words."""
    pairs = edit_alignment(ref, hyp)
    right = sum(i is not None and j is not None and ref[i] == hyp[j] for i, j in pairs)
    dele, ins = sum(j is None for _, j in pairs), sum(i is None for i, _ in pairs)
    return len(pairs) - right - dele - ins, dele, ins, right


def word_errors(ref: Column, hyp: Column) -> Column:
    """Struct of substitutions, deletions, insertions, right and wer of two word arrays."""

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [error_counts(list(x) if x is not None else [], list(y) if y is not None else []) for x, y in zip(a, b)]
        frame = pd.DataFrame(rows, columns=["substitutions", "deletions", "insertions", "right"])
        total = frame[["substitutions", "deletions", "right"]].sum(axis=1)
        frame["wer"] = (frame[["substitutions", "deletions", "insertions"]].sum(axis=1) / total.where(total > 0)).astype(float)
        return frame

    return F.pandas_udf(run, "substitutions int, deletions int, insertions int, right int, wer double")(ref, hyp)


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFC", text).lower() if c.isalnum() or c == "'")


def similarity(a: Column, b: Column) -> Column:
    """Ratio of matching blocks of two texts without punctuation (not an edit distance)."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, _plain(p or ""), _plain(q or "")).ratio() for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def align_probabilities(words: list[str], asr: list[tuple[str, float | None]]) -> list[float | None]:
    """For each word the least known probability of the recognised pieces that spell it, or None.

    A word that the next pieces do not spell leaves the place where it is, so the words after it can still be found there.
    """
    spelled = [_plain(piece) for piece, _ in asr]
    ends = np.cumsum([0] + [len(s) for s in spelled])
    whole, place, out = "".join(spelled), 0, []
    for word in words:
        key = _plain(word)
        upto = int(np.searchsorted(ends, ends[place] + len(key)))
        fits = bool(key) and whole.startswith(key, ends[place]) and upto < len(ends) and ends[upto] == ends[place] + len(key)
        known = [p for _, p in asr[place:upto] if p is not None] if fits else []
        out.append(min(known, default=None))
        place = upto if fits else place
    return out


def guard(df: DataFrame, raw: str, proposal: str, prob: str, protected: list[str] | None = None) -> DataFrame:
    """Add `blocked`: the first reason against a proposed word, or null.

    Rules in order: empty or several words, protected word, capital letter taken or lost, too far, acoustically certain.
    """
    a, b = F.trim(F.col(raw)), F.trim(F.coalesce(F.col(proposal), F.lit("")))
    capital = lambda c: F.substring(c, 1, 1).rlike(r"\p{Lu}")
    alike = similarity(F.col(raw), F.col(proposal))
    reason = (
        F.when((b == "") | b.rlike(r"\s"), "shape")
        .when(F.lower(a).isin(protected or [""]), "protected")
        .when(capital(a) != capital(b), "name")
        .when(F.col("_alike") < SIMILARITY, "distance")
        .when(F.col(prob) >= PROB_THRESHOLD, "certain")
    )
    return df.withColumn("_alike", alike).withColumn("blocked", reason).drop("_alike")


def turn_split(words: list[str], spoken: list[tuple], least: int = 2) -> list[tuple]:
    """(first, past last, voice, start) of the turns in a corrected text, from recognised (word, voice) or (word, voice, start).

    Corrected places take voice and time of the recognised places that the matching blocks set beside them; between blocks of
    equal words the places are spread in proportion, and what has nothing beside it takes the voice before. Then, as
    long as some run is shorter than `least` words, the first such run joins the run before it; at the head, the one behind.
    """
    if not words or not spoken:
        return [(0, len(words), "UNKNOWN", None)] if words else []
    starts = [s[2] if len(s) > 2 else None for s in spoken]
    blocks = SequenceMatcher(None, [_plain(w) for w in words], [_plain(s[0]) for s in spoken], autojunk=False).get_matching_blocks()
    beside = np.full(len(words), -1)
    i = j = 0
    for to_i, to_j, size in blocks:
        gap = to_j - j
        if gap and to_i > i:
            beside[i:to_i] = j + np.arange(to_i - i) * gap // (to_i - i)
        beside[to_i : to_i + size] = np.arange(to_j, to_j + size)
        i, j = to_i + size, to_j + size
    filled = np.maximum.accumulate(np.where(beside >= 0, np.arange(len(words)), -1))
    beside = np.where(filled >= 0, beside[np.maximum(filled, 0)], beside[beside >= 0][0] if (beside >= 0).any() else 0)
    voices = np.array([str(spoken[k][1]) for k in beside], dtype=object)
    edges = [0, *(np.flatnonzero(voices[1:] != voices[:-1]) + 1).tolist(), len(words)]
    while len(edges) > 2:
        short = next((k for k in range(len(edges) - 1) if edges[k + 1] - edges[k] < least), None)
        if short is None:
            break
        source = voices[edges[short] - 1] if short else voices[edges[1]]
        voices[edges[short] : edges[short + 1]] = source
        edges = [0, *(np.flatnonzero(voices[1:] != voices[:-1]) + 1).tolist(), len(words)]
    return [(p, q, voices[p], starts[beside[p]]) for p, q in zip(edges, edges[1:])]
