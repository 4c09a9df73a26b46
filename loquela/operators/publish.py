"""Publication: change-only sinks, content guard and initials for names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquela.functions.text import words_letters


def changes(previous: DataFrame, current: DataFrame, key: str, content: str) -> DataFrame:
    """key and action ('insert', 'update', 'delete') of what differs between two states, by content hash."""
    digest = lambda df, n: df.select(key, F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias(n))
    both = digest(previous, "old").join(digest(current, "new"), key, "full")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").when(F.col("old") != F.col("new"), "update")
    return both.select(key, action.alias("action")).filter("action is not null")


#: Characters of all distinct names together up to which the names are sent to every task.
BROADCAST_CHARS = 4_000_000


def names_in_texts(texts: DataFrame, key: str, text: str, names: DataFrame, name: str, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """key and name, once each, of every text that holds a name to hide as successive words: an equi-join on the whole name.

    The runs of words of a text that are as long as some name meet the names; neither the text nor names that only begin
    alike go with them. Few names are broadcast, so that no text is shuffled; many meet in a shuffle of keys and runs.
    """
    hidden = names.filter(F.col(name).isNotNull()).select(F.array_join(words_letters(F.col(name)), " ").alias("name")).filter("name <> ''").distinct()
    sizes = hidden.agg(F.sum(F.length("name")).alias("chars"), F.collect_set(F.size(F.split("name", " "))).alias("lengths")).first()
    hidden = hidden.hint("broadcast" if (sizes["chars"] or 0) <= broadcast_chars else "merge")
    return word_runs(texts, key, text, sizes["lengths"]).join(hidden, "name").select(key, "name").distinct()


def word_runs(texts: DataFrame, key: str, text: str, lengths: list[int]) -> DataFrame:
    """key and name: every distinct run of `lengths` successive words of each text."""
    words = texts.filter(F.col(text).isNotNull()).select(key, words_letters(F.col(text)).alias("_ws"))
    one = [F.col("_ws")] if 1 in lengths else []
    fit = F.filter(F.lit(sorted(set(lengths) - {1})).cast("array<int>"), lambda n: n <= F.size("_ws"))
    runs = F.flatten(F.transform(fit, lambda n: F.transform(F.sequence(F.lit(1), F.size("_ws") - n + 1), lambda i: F.array_join(F.slice("_ws", i, n), " "))))
    return words.select(key, F.explode(F.array_distinct(F.concat(*one, runs))).alias("name"))


def lower_vocabulary(texts: DataFrame, text: str) -> DataFrame:
    """Distinct words that occur in lower case somewhere."""
    tokens = F.regexp_extract_all(F.col(text), F.lit(r"\p{L}+"), F.lit(0))
    return texts.filter(F.col(text).isNotNull()).select(F.explode(tokens).alias("w")).filter(F.col("w") == F.lower("w")).distinct()


def anonymise(texts: DataFrame, key: str, text: str, clear: DataFrame) -> DataFrame:
    """key and text with capitalised words as initials, unless their lower-case form is in `clear` (column w).

    Two passes over the vocabulary, never over the pairs: the words to shorten are found by a join on the word, then
    each text is put together again from its pieces.
    """
    piece = F.regexp_extract_all(F.col(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    parts = texts.select(key, F.posexplode_outer(piece).alias("pos", "part"))
    keyed = parts.withColumn("w", F.when(F.col("part").rlike(r"^\p{Lu}"), F.lower("part")))
    known = clear.select(F.col("w"), F.lit(True).alias("clear")).distinct()
    joined = keyed.join(known, "w", "left")
    short = F.when(F.col("w").isNotNull() & F.col("clear").isNull(), F.concat(F.upper(F.substring("part", 1, 1)), F.lit("."))).otherwise(F.col("part"))
    rows = joined.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", short.alias("p"))))).alias("x"))
    return rows.select(key, F.array_join(F.transform("x", lambda r: r["p"]), "").alias(text))


def latest_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key, the first by `order` (upsert by key)."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", rank).filter("_n = 1").drop("_n")
