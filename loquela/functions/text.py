"""Word, sentence and formatting functions as columns (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Punctuation cut from both ends of a word of the index.
EDGE_PUNCT = ".,;:!?()[]{}\"'«»…—-"
#: Patterns of recording times in file names, in the order they are tried, with the places of year, month, day, hour, minute, second.
NAME_TIMES = (
    (r"(\d{4})(\d{2})(\d{2})[ _T-]?(\d{2})(\d{2})(\d{2})", (1, 2, 3, 4, 5, 6)),
    (r"(\d{2})[-_.](\d{2})[-_.](\d{4})[ _T]+(\d{2})[-_.](\d{2})[-_.](\d{2})", (3, 2, 1, 4, 5, 6)),
    (r"(\d{4})[-_.](\d{2})[-_.](\d{2})[ _T]+(\d{2})[-_.](\d{2})[-_.](\d{2})", (1, 2, 3, 4, 5, 6)),
    (r"(\d{2})(\d{2})(\d{4})[ _T-]?(\d{2})(\d{2})(\d{2})", (3, 2, 1, 4, 5, 6)),
    (r"(\d{4})(\d{2})(\d{2})[ _T-]?(\d{2})(\d{2})(\d{2})?", (1, 2, 3, 4, 5, 6)),
)
LETTERS = r"\p{L}+"


def words_letters(text: Column) -> Column:
    """Maximal runs of letters of the lower-cased text (tokeniser of the quality rules and the daily metrics)."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def words_blank(text: Column) -> Column:
    """Tokens between white space."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")


def words_alnum(text: Column) -> Column:
    """Letters and digits after apostrophes became blanks (tokeniser of the error rates)."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(text, "[’'`]", " ")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def words_reference(text: Column) -> Column:
    """Letters, digits, underscores and inner apostrophes (tokeniser of reference corpora)."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_']+"), F.lit(0))


def index_word(token: Column) -> Column:
    """A token without punctuation at its ends, lower case."""
    return F.lower(F.trim(F.btrim(F.trim(token), F.lit(EDGE_PUNCT))))


def index_words(text: Column) -> Column:
    """The words of the index: tokens between white space, without punctuation at their ends, lower case."""
    return F.filter(F.transform(words_blank(text), index_word), lambda w: w != "")


def correction_word(token: Column) -> Column:
    """A token without any punctuation, lower case."""
    return F.lower(F.translate(token, EDGE_PUNCT, ""))


def sentences(text: Column) -> Column:
    """Stretches up to and with their end marks that hold a letter."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"[^.?!…]+[.?!…]*"), F.lit(0)), lambda s: s.rlike(r"\p{L}"))


def hms(seconds: Column) -> Column:
    """HH:MM:SS; hours go on past 24."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm with milliseconds rounded and carried (a day's subtitles)."""
    ms = F.round(seconds * 1000).cast("long")
    return _srt(F.floor(ms / 1000).cast("long"), ms % 1000)


def srt_time_cut(seconds: Column) -> Column:
    """HH:MM:SS,mmm with milliseconds cut off (a session's subtitles)."""
    whole = F.floor(seconds)
    return _srt(whole.cast("long"), F.floor((seconds - whole) * 1000).cast("long"))


def _srt(s: Column, ms: Column) -> Column:
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60, ms)


def duration_words(seconds: Column) -> Column:
    """Human duration: hours and minutes, minutes, or seconds."""
    s = F.round(seconds).cast("long")
    h, m = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long")
    return F.when(h > 0, F.format_string("%d h %02d min", h, m)).when(m > 0, F.format_string("%d min", m)).otherwise(F.format_string("%d s", s))


def dotted(number: Column) -> Column:
    """Thousands separated by dots."""
    return F.translate(F.format_number(number, 0), ",", ".")


def fingerprint(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def recording_time(name: Column) -> Column:
    """Time stamp in a recorder's file name by the first pattern that gives an existing time from 2010 to 2100; null if none does."""
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]{2,4}$", "")

    def read(pattern: str, places: tuple[int, ...]) -> Column:
        part = [F.regexp_extract(stem, pattern, i) for i in places]
        second = F.when(part[5] == "", "00").otherwise(part[5])
        at = F.try_to_timestamp(F.concat(*part[:5], second), F.lit("yyyyMMddHHmmss"))
        return F.when((part[0] != "") & F.year(at).between(2010, 2100), at)

    return F.coalesce(*(read(p, places) for p, places in NAME_TIMES))


def initials(name: Column, clear: Column) -> Column:
    """Each part of a name as its initial, unless it is in the array of clear parts."""
    short = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lit("."))
    return F.array_join(F.transform(words_blank(name), lambda p: F.when(F.array_contains(clear, F.lower(p)), p).otherwise(short(p))), " ")


def keep_two_repeats(text: Column) -> Column:
    """The text with at most two successive copies of a sentence kept (compared without case)."""
    parts = F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s != "")
    none = F.array(F.lit(None).cast("string"))
    beside = F.arrays_zip(parts.alias("s"), F.concat(none, parts).alias("a"), F.concat(none, none, parts).alias("b"))
    kept = F.transform(F.filter(beside, lambda x: x["s"].isNotNull() & ~F.coalesce((F.lower(x["s"]) == F.lower(x["a"])) & (F.lower(x["s"]) == F.lower(x["b"])), F.lit(False))), lambda x: x["s"])
    return F.array_join(kept, " ")


def salvaged_object(text: Column) -> Column:
    """The outermost JSON object in a reply: without fences around it and commas before a closing bracket; null if there is none."""
    inner = F.regexp_extract(F.regexp_replace(text, r"```[a-zA-Z]*", ""), r"(?s)\{.*\}", 0)
    return F.nullif(F.regexp_replace(inner, r",(\s*[}\]])", "$1"), F.lit(""))
