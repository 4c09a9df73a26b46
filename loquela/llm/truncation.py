"""Problem 9: text cut off by field limits or in transfer.

A backward character n-gram model is trained: for every place inside the fitted texts, the last 2, 3, 5, 8 and 12
characters (letters, digits and the sign of a tag, lower case, words parted by one blank) are a context, with counts of how often it occurs,
how often a word ends after it and how often a sentence does. The probabilities of an end after a text's final context
are interpolated from the shortest context to the longest one seen. One number decides about every text, the log-odds of
a cut against a natural end; it is the sum of

- the prior odds of a cut per language and source, from the share of its texts whose final context ends inside a word;
- the likelihood of going on, against that of ending here: usual rate of ends / probability of an end after the context.
  Where sentences carry end marks, an end without one is natural only at the rate `UNMARKED`, or where distinct texts are
  known to end alike (tags, closing lines), whose rate is added;
- the likelihood ratio of lying at a length limit of the source, from the texts that end inside a word against those
  that end in an end mark;
- what stands at the end: dots are more or less usual at cuts (ratio from the data); a mark in place of the rest, half a
  character or an open comma leave the natural end only `NEVER`, an end mark leaves the cut only that, unless a blank
  follows it up to the limit.

A text is a case if its log-odds are above 0, a threshold per language and source since the prior is theirs. With the
probabilities of the model made equal everywhere nothing but marks and limits is left (`tests/llm/test_truncation.py`).

The counts come from all distinct texts whose sentences or items have visible ends. Only contexts that end some text are
asked for, so only these are counted: a bitmap of the asked ones (`BITS` a context, `MOST_BITS` in all) goes to the tasks and
keeps nearly all others out of the shuffle; what else it lets through meets no text. The counts stay distributed and are
joined to the ends. Priors, limits, ends in common and all verdicts come from all texts too. Repeats of a text (but for
case and blanks) count once in them, so that copies of a cut text don't make its ending a usual one. Only the last `TAIL` characters of a text leave the JVM; its style and length are computed
there from the whole text.

Defined results: null, empty and blank texts are no cases; repeats are each a case; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquela.session import cut

ORDERS = (2, 3, 5, 8, 12)
#: Which of them may be an ending of its own.
OWN = (2, 4)
#: Bits of the bitmap for each context asked for, and at most (then it lets more through, and nothing is lost).
BITS, MOST_BITS = 16, 1 << 27
#: Characters of a text's end that the verdict looks at.
TAIL = 96
#: Occurrences a context needs to be kept, and weight of the shorter context in the interpolation.
SEEN, WEIGHT = 2, 3.0
#: Probability of a word's end below which a text ends inside a word for certain.
FRAGMENT = 0.02
#: Rate of natural ends without an end mark where end marks are usual; of what never stands at a natural end.
UNMARKED, NEVER = 5e-4, 1e-6
#: Rate at which a list item ends after any whole word, whatever stands before.
ITEM = 0.05
#: Texts at one length that may be a limit, and distinct texts that make an ending their own.
LIMIT_ROWS, OWN_END_ROWS = 3, 4
#: Share of its occurrences that end a text, from which an ending is one of its own (cuts alone end far less).
OWN_END = 0.1
LEAST_LIMIT = 40
CHARS_PER_WORD = 5.5
_RUN = re.compile(r"(?:[^\w#]|_)+")
_STOP = re.compile(r"[.!?…»\n]")
_MARKED = re.compile(r"\s*(?:\[(?:\.{2,}|…)\]|\((?:\.{2,}|…)\))\s*$")
_DOTS = re.compile(r"\s*(?:…|\.{2,})\s*$")
_PAD = max(ORDERS)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def body(text: str) -> tuple[str, str]:
    """The text without trailing blanks and marks of omission, and how it ends."""
    stripped = text.rstrip()
    if _MARKED.search(stripped):
        return _MARKED.sub("", stripped), "marked"
    if stripped.endswith("\ufffd"):
        return stripped.rstrip("\ufffd"), "broken"
    if _DOTS.search(stripped):
        return _DOTS.sub("", stripped), "dots" if stripped.endswith(".") else "ellipsis"
    last = stripped[-1:]
    if last.isalnum():
        return stripped, "word"
    return stripped, "open" if last in ",;:'’(-–&/" else "closed"


def _without(text: Column, signs: str) -> Column:
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text


def style(text: Column) -> Column:
    """'list' (the last line is an item), 'marked' (sentences have end marks) or 'plain', from the whole text."""
    last = F.substring_index(F.rtrim(text, F.lit(" \t\r\n")), "\n", -1)
    marks, words = (F.length(text) - F.length(_without(text, signs)) for signs in (".!?…", " \n"))
    upper = F.regexp_extract(text, r"\p{L}", 0).rlike(r"\p{Lu}")
    return F.when(last.rlike(r"^\s*[-•*]\s"), "list").when((marks * 40 >= words + 1) | ((marks == 0) & upper), "marked").otherwise("plain")


def stream(text: str) -> tuple[str, list[int]]:
    """Letters and digits of a text in lower case, words parted by one blank, and the places after which a sentence ends."""
    low, parts, stops, at, n = text.lower(), [], [], 0, 0
    for m in _RUN.finditer(low):
        if m.start() > at:
            parts.append(low[at : m.start()])
            n += m.start() - at + 1
            if _STOP.search(m[0]):
                stops.append(n - 1)
        at = m.end()
    if at < len(low):
        parts.append(low[at:])
    return " ".join(parts), stops


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), base, dtype=np.uint64)])[:n]


def context_hashes(streams: list[str], last_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (orders x places) of the contexts at all places after a letter or digit, the places in the joined text, and its codes."""
    joined = "".join("\0" * _PAD + s for s in streams) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        prefix = np.r_[np.uint64(0), np.cumsum(_mix((codes + np.uint64(1)) * np.uint64(0x94D049BB133111EB)) * _powers(_BASE, len(codes)))]
        inverse = _powers(_INVERSE, len(codes) + 1)
        if last_only:
            places = np.cumsum([len(s) + _PAD for s in streams])
        else:
            places = np.flatnonzero(codes > 32) + 1
        keys = np.array([_mix((prefix[places] - prefix[places - n]) * inverse[places - n] + np.uint64(n)) for n in ORDERS])
    return keys, places, codes


class EndModel:
    """Backward character n-grams: how often a word and a sentence end after a context."""

    def __init__(self, texts: list[str]) -> None:
        parts, self.texts = [], len(texts)
        streams, stops = [], []
        offset = 0
        for text in texts:
            s, ends = stream(text)
            if s:
                streams.append(s)
                stops.append(np.array(ends, dtype=np.int64) + offset + _PAD)
                offset += len(s) + _PAD
        for start in range(0, len(streams), 2000):
            some = streams[start : start + 2000]
            keys, places, codes = context_hashes(some)
            inside = codes[places] != 0  # the last place of a text is no example: what follows is not known
            keys, places = keys[:, inside], places[inside]
            base = sum(len(s) + _PAD for s in streams[:start])
            here = np.concatenate(stops[start : start + 2000]) - base if some else np.zeros(0, np.int64)
            word = (codes[places] == 32).astype(np.uint64)
            sentence = np.zeros(len(codes) + 1, dtype=np.uint64)
            sentence[here] = 1
            flags = word + sentence[places] * word * np.uint64(2)
            for row in keys:
                found, n = np.unique((row & ~np.uint64(3)) | flags, return_counts=True)
                parts.append((found, n))
        every = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        n = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        flag, (key, where) = every & np.uint64(3), np.unique(every & ~np.uint64(3), return_inverse=True)
        count = lambda w: np.bincount(where, w, len(key))
        total, words, ends = count(n), count(n * (flag > 0)), count(n * (flag == 3))
        keep = total >= SEEN
        self.key, self.n, self.words, self.ends = key[keep], total[keep].astype(np.float32), words[keep].astype(np.float32), ends[keep].astype(np.float32)
        places = max(float(total.sum()), 1.0)
        self.word_rate, self.end_rate = (float(words.sum()) + 1) / (places + 5), (float(ends.sum()) + 0.1) / (places + 5)

    def final(self, streams: list[str]) -> tuple[np.ndarray, ...]:
        """For the ends of the streams: probability that a word ends, that a sentence ends, occurrences and hashes of the two contexts of `OWN`."""
        keys, _, _ = context_hashes(streams, last_only=True)
        word, end = np.full(len(streams), self.word_rate), np.full(len(streams), self.end_rate)
        going, times = np.ones(len(streams), bool), []
        for row in keys:
            row = row & ~np.uint64(3)
            at = np.minimum(np.searchsorted(self.key, row), max(len(self.key) - 1, 0))
            going = going & (self.key[at] == row if len(self.key) else np.zeros(len(row), bool))
            n, w, e = (np.where(going, x[at] if len(self.key) else 0, 0).astype(float) for x in (self.n, self.words, self.ends))
            word, end = np.where(going, (w + WEIGHT * word) / (n + WEIGHT), word), np.where(going, (e + WEIGHT * end) / (n + WEIGHT), end)
            times.append(n)
        return word, end, *(times[i] for i in OWN), *(keys[i].view(np.int64) for i in OWN)


def _asked_for(ends: DataFrame) -> np.ndarray:
    """Bitmap (words of 64 bits, a power of two of them) of the contexts at the ends."""
    keys = ends.select(F.explode("keys").alias("key"))
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS * keys.count()).bit_length()))
    place = F.col("key").bitwiseAND(F.lit((bits - 1) << 2))  # the lowest two bits are not part of a context
    word = F.shiftright(place, 8)
    found = keys.groupBy(word.alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(key, 2) & 63 as int))")).alias("b")).toArrow()
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    bitmap[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return bitmap


def _counter(shared):
    """text -> key, n, words, ends of the contexts asked for, and a row without key for all contexts, with the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                texts = whole.column(0).slice(start, 500).to_pylist()
                keys, flags = _examples(texts)
                parts, few = [np.zeros(0, np.uint64)], flags.astype(np.uint64)
                for row in keys:
                    place = (row >> np.uint64(2)) & np.uint64(len(bitmap) * 64 - 1)
                    asked = (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                    parts.append((row[asked] & ~np.uint64(3)) | few[asked])
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                every = np.bincount(flags, minlength=4) * len(ORDERS)
                key = pa.array([None, *(found & ~np.uint64(3)).view(np.int64).tolist()], pa.int64())
                flag = found & np.uint64(3)
                columns = [np.r_[every.sum(), n], np.r_[every[1:].sum(), n * (flag > 0)], np.r_[every[3], n * (flag == 3)], np.r_[len(texts), np.zeros(len(n), np.int64)]]
                yield pa.RecordBatch.from_arrays([key, *(pa.array(c.astype(np.int64)) for c in columns)], names=["key", "n", "words", "ends", "texts"])

    return run


def _examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (orders x places) of the contexts inside the texts, and what comes after: 0 the word goes on, 1 it ends, 3 so does the sentence."""
    streams, stops, offset = [], [np.zeros(0, np.int64)], 0
    for s, ends in map(stream, texts):
        if s:
            streams.append(s)
            stops.append(np.array(ends, dtype=np.int64) + offset + _PAD)
            offset += len(s) + _PAD
    keys, places, codes = context_hashes(streams)
    inside = codes[places] != 0  # the last place of a text is no example: what follows is not known
    keys, places = keys[:, inside], places[inside]
    sentence = np.zeros(len(codes) + 1, dtype=np.int64)
    sentence[np.concatenate(stops)] = 1
    word = (codes[places] == 32).astype(np.int64)
    return keys, word + sentence[places] * word * 2


def counted_ends(texts: DataFrame, ends: DataFrame) -> tuple[DataFrame, float, int]:
    """The ends with their probabilities from the counts of all distinct texts, the rate of sentence ends and the number of texts counted."""
    shared = texts.sparkSession.sparkContext.broadcast(_asked_for(ends))
    distinct = texts.filter(style(F.col("text")) != "plain").groupBy(F.xxhash64("text")).agg(F.min("text").alias("text")).select("text")
    parts = distinct.mapInArrow(_counter(shared), "key long, n long, words long, ends long, texts long")
    counts = cut(parts.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n", "words", "ends", "texts"))))
    every = counts.filter("key is null").first() or {"n": 0, "words": 0, "ends": 0, "texts": 0}
    # As in `EndModel`.
    places = max(float(every["n"]), 1.0)
    word_rate, end_rate = (every["words"] + 1) / (places + 5), (every["ends"] + 0.1) / (places + 5)
    rows = ends.withColumn("_r", F.monotonically_increasing_id())
    met = rows.select("_r", F.posexplode("keys").alias("_o", "key")).join(counts.filter(f"n >= {SEEN}").drop("texts"), "key")
    wide = met.groupBy("_r").agg(*(F.max(F.when(F.col("_o") == o, F.col(c))).alias(f"_{c}{o}") for o in range(len(ORDERS)) for c in ("n", "words", "ends")))
    word, end, going, times = F.lit(word_rate), F.lit(end_rate), F.lit(True), []
    df = rows.join(wide, "_r", "left")
    for o in range(len(ORDERS)):
        n, w, e = (F.col(f"_{c}{o}") for c in ("n", "words", "ends"))
        going = going & n.isNotNull()
        df = df.withColumns({f"_g{o}": going, f"_pw{o}": F.when(going, (w + WEIGHT * word) / (n + WEIGHT)).otherwise(word), f"_pe{o}": F.when(going, (e + WEIGHT * end) / (n + WEIGHT)).otherwise(end)})
        going, word, end = F.col(f"_g{o}"), F.col(f"_pw{o}"), F.col(f"_pe{o}")
        times.append(F.when(going, n).otherwise(0).cast("double"))
    names = [c for c in ends.columns if c not in ("keys", "short", "long")]
    found = df.select(*names, word.alias("p_word"), end.alias("p_end"), times[OWN[0]].alias("short_times"), times[OWN[1]].alias("long_times"), "short", "long")
    return found, end_rate, every["texts"]


_FINAL_SCHEMA = "id long, folded long, source string, lang string, style string, chars int, bytes int, blank_tail boolean, how string, p_word double, p_end double, short_times double, long_times double, short long, long long"


def _finals(shared):
    """What the verdict needs of each text that is not blank; the tail is its last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [body(t) for t in batch.column("tail").to_pylist()]
            streams = [stream(t)[0] for t, _ in ends]
            numbers = shared.value.final(streams) if streams else [np.zeros(0)] * 4 + [np.zeros(0, np.int64)] * 2
            columns = batch.columns[:-1] + [pa.array([h for _, h in ends], pa.string()), *(pa.array(x) for x in numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1] + ["how", "p_word", "p_end", "short_times", "long_times", "short", "long"])

    return run


_END_SCHEMA = _FINAL_SCHEMA[: _FINAL_SCHEMA.index("p_word")] + "keys array<long>, short long, long long"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each text ends and the hashes of its final contexts; the tail is the last column."""
    for batch in batches:
        ends = [body(t) for t in batch.column("tail").to_pylist()]
        keys = context_hashes([stream(t)[0] for t, _ in ends], last_only=True)[0] if ends else np.zeros((len(ORDERS), 0), np.uint64)
        asked = pa.array((keys & ~np.uint64(3)).view(np.int64).T.tolist(), pa.list_(pa.int64()))
        columns = batch.columns[:-1] + [pa.array([h for _, h in ends], pa.string()), asked, *(pa.array(keys[i].view(np.int64)) for i in OWN)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1] + ["how", "keys", "short", "long"])


def length_limits(finals: DataFrame) -> DataFrame:
    """`measure`, `source` and `length` at which the texts of a source pile up, against lengths a tenth shorter and all longer ones; an empty source stands for texts without one.

    A limit in bytes may fall inside a character, so it stands with the three lengths below it.
    """
    found = []
    for measure, slack in (("chars", 0), ("bytes", 3)):
        sized = finals.filter(f"source is not null and {measure} >= {LEAST_LIMIT}").groupBy("source", measure).agg(F.count("*").alias("n"))
        sized = sized.withColumn("_log", F.round(1000 * F.log(measure)).cast("long"))
        around = Window.partitionBy("source").orderBy("_log")
        close = Window.partitionBy("source").orderBy(measure).rangeBetween(-slack, 0)
        piled = sized.withColumns({
            "at": F.sum("n").over(close),
            "below": F.coalesce(F.sum("n").over(around.rangeBetween(-105, -1 - 4 * slack)), F.lit(0)),
            "above": F.coalesce(F.sum("n").over(around.rangeBetween(1, Window.unboundedFollowing)), F.lit(0)),
        })
        limits = piled.filter((F.col("at") >= LIMIT_ROWS) & (F.col("at") >= 0.5 * F.col("below")) & (F.col("at") >= 2 * F.col("above")))
        if measure == "bytes":  # only the largest, as lengths in bytes spread where texts are limited in characters
            limits = limits.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy(F.desc(measure)))).filter("_n = 1 and above = 0")
        lengths = F.explode(F.sequence(F.col(measure) - slack, F.col(measure)))
        found.append(limits.select(F.lit(measure).alias("measure"), F.explode(F.array("source", F.lit(""))).alias("source"), lengths.alias("length")).distinct())
    return found[0].unionByName(found[1])


def judge_ends(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", model: EndModel | None = None) -> DataFrame:
    """id, source, lang, how, style, at_limit, fragment, log_odds and `truncated` of every text that is not blank."""
    raw = documents.select(F.col(key).cast("long").alias("id"), F.col(source).cast("string").alias("source"), F.lower(F.substring(F.trim(F.col(lang).cast("string")), 1, 2)).alias("lang"), F.col(text).alias("text"))
    texts = raw.filter(F.col("text").rlike(r"\S"))
    folded = F.xxhash64(F.lower(_without(F.col("text"), " \t\r\n\u00a0")))
    asked = texts.select("id", folded.alias("folded"), "source", "lang", style(F.col("text")).alias("style"), F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.expr("right(text, 1)").rlike(r"\s").alias("blank_tail"), F.expr(f"right(text, {TAIL})").alias("tail"))
    if model is None:
        finals, end_rate, n_counted = counted_ends(texts.select("text"), cut(asked.mapInArrow(_ends, _END_SCHEMA)))
        finals = cut(finals)
    else:
        finals, end_rate, n_counted = cut(asked.mapInArrow(_finals(documents.sparkSession.sparkContext.broadcast(model)), _FINAL_SCHEMA)), model.end_rate, model.texts

    distinct = finals.groupBy("source", "folded").agg(*(F.min(c).alias(c) for c in ("chars", "bytes", "how", "p_word", "lang")))
    limits = length_limits(finals)
    for measure in ("chars", "bytes"):
        some = limits.filter(F.col("measure") == measure).select(F.col("source").alias("_s"), F.col("length").alias("_l"), F.lit(True).alias(f"_{measure}"))
        finals, distinct = (d.join(some, (F.coalesce("source", F.lit("")) == F.col("_s")) & (F.col(measure) == F.col("_l")), "left").drop("_s", "_l") for d in (finals, distinct))
    at_limit = F.coalesce("_chars", "_bytes", F.lit(False))
    fragment = F.col("how").isin("word", "dots", "ellipsis") & (F.col("p_word") < FRAGMENT)
    finals, distinct = (d.withColumns({"at_limit": at_limit, "fragment": fragment}) for d in (finals, distinct))

    share = lambda c: F.sum(F.when(c, 1.0).otherwise(0.0))
    whole, closed = ~F.col("fragment") & F.col("how").isin("word", "closed", "dots"), F.col("how") == "closed"
    cell = distinct.groupBy("source", "lang").agg(share(F.col("fragment")).alias("inside"), F.count("*").alias("texts"))
    prior = cell.select(F.col("source").alias("_s"), F.col("lang").alias("_g"), ((F.col("inside") * CHARS_PER_WORD / (CHARS_PER_WORD - 1) + 0.5) / (F.col("texts") + 10.0)).alias("_p"))
    piled = distinct.groupBy("source").agg(*(share(c).alias(n) for n, c in (("fa", F.col("fragment") & F.col("at_limit")), ("f", F.col("fragment")), ("ca", closed & F.col("at_limit")), ("c", closed))))
    limit = piled.select(F.col("source").alias("_s"), F.log((F.col("fa") + 1) / (F.col("f") + 2) / ((F.col("ca") + 0.5) / (F.col("c") + 20))).alias("_limit"))
    dotted = F.col("how").isin("dots", "ellipsis")
    row = distinct.agg(share(F.col("fragment") & dotted).alias("fd"), share(F.col("fragment")).alias("f"), share(whole & dotted).alias("wd"), share(whole).alias("w")).first()
    dots = float(np.log(((row["fd"] or 0) + 1) / ((row["f"] or 0) + 20) / (((row["wd"] or 0) + 1) / ((row["w"] or 0) + 20))))

    # Where sentences carry marks, texts below their limit tell which ends without one are usual.
    everyone = float(distinct.count())
    scale = max(everyone / max(n_counted, 1), 1.0)
    free = finals.filter((F.col("how") == "word") & (F.col("style") == "marked") & ~F.col("at_limit"))
    endings = free.select("folded", F.explode(F.array(*(F.struct(F.col(n).alias("ending"), F.col(f"{n}_times").alias("times")) for n in ("short", "long")))).alias("e")).select("folded", "e.*").distinct()
    own = endings.groupBy("ending").agg(F.count("*").alias("n"), F.max("times").alias("times")).filter(f"n >= {OWN_END_ROWS}")
    own = own.select("ending", ((F.col("n") - 1) / (F.greatest(F.col("n"), F.col("times") * scale) + 4)).alias("rate")).filter(f"rate >= {OWN_END}")

    same = lambda a, b: F.coalesce(a, F.lit("\0")) == F.coalesce(b, F.lit("\0"))
    df = finals
    for n in ("short", "long"):
        df = df.join(own.select(F.col("ending").alias(n), F.col("rate").alias(f"_{n}")), n, "left")
    df = df.join(prior, same(F.col("source"), F.col("_s")) & same(F.col("lang"), F.col("_g")), "left").drop("_s", "_g")
    df = df.join(limit, same(F.col("source"), F.col("_s")), "left").drop("_s")
    how = F.col("how")
    bare = F.when(F.col("style") == "marked", F.lit(UNMARKED)).otherwise(1.0)
    natural = (
        F.when(how.isin("marked", "broken", "open"), F.lit(NEVER))
        .when(how.isin("dots", "ellipsis"), F.col("p_end"))
        .when(F.col("style") == "list", F.col("p_end") + ITEM * F.col("p_word"))
        .otherwise(F.col("p_end") * bare + F.coalesce(F.greatest("_short", "_long"), F.lit(0.0)))
    )
    going = F.log(F.lit(end_rate)) - F.log(F.greatest(natural, F.lit(1e-9)))
    closed_term = F.when(F.col("blank_tail") & F.col("at_limit"), F.lit(-float(np.log(NEVER)) / 2)).otherwise(F.log(F.lit(NEVER)))
    p = F.coalesce("_p", F.lit(0.05))
    odds = F.log(p / (1 - p)) + F.when(how == "closed", closed_term).otherwise(going + F.when(dotted, dots).otherwise(0.0)) + F.when(F.col("at_limit"), F.col("_limit")).otherwise(0.0)
    return df.select("id", "source", "lang", "how", "style", "at_limit", "fragment", odds.alias("log_odds"), (odds > 0).alias("truncated"))


def truncation_rates(judged: DataFrame) -> DataFrame:
    """How often each source truncates."""
    return judged.groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.col("truncated").cast("long")).alias("cut_texts")).withColumn("share", F.col("cut_texts") / F.col("texts"))
