"""Problem 8: mixing sources to target weights.

The token streams of each source are packed into blocks of `block_tokens`; places in a source's stream come from sums per
(source, chunk of documents) and running sums within a chunk, so no task sees a whole source. The mixture has a quota of
blocks per source: its share of the total, or all it may give (`max_repeat` times its blocks) where that is less, the
rest going to the others in proportion. Output shards draw their source counts without replacement, so that these quotas
are met exactly (a multinomial draw would miss them, and could use a source more often than allowed): a seeded Feistel permutation
sends every place of the mixture to one of as many tickets, of which each source holds its quota in a row. A shard finds
its counts by looking at its own places alone, at any size alike, with no table of shards anywhere. The ticket's number within its
source, k, is use k // n of block permutation(k % n), a seeded permutation per use; slots and blocks are joined by that index.

Since each use runs through all blocks once, no block, and so no part of a document, is used more than `max_repeat`
times. Defined results: sources without a target, null sources, null and empty texts give no tokens; a source without
documents has share 0; a source's last block may be short; ties do not arise; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.llm.byte_bpe import VOCABULARY, encode
from loquela.session import cut

BLOCK_TOKENS, SHARD_SLOTS, CHUNKS, SEED = 512, 1024, 4096, 7


def quotas(shares: np.ndarray, caps: np.ndarray, total: int) -> np.ndarray:
    """Blocks per source: `total` by shares, none above its cap, what that leaves going to the others in proportion."""
    out, open_ = np.zeros(len(shares), dtype=np.int64), (shares > 0) & (caps > 0)
    left = min(total, int(caps.sum()))
    while left > 0 and open_.any():
        want = shares * open_ / (shares * open_).sum() * left
        full = open_ & (want >= caps)
        if not full.any():
            floor = np.floor(want).astype(np.int64)
            order = np.argsort(-(want - floor), kind="stable")
            floor[[i for i in order if open_[i]][: left - int(floor.sum())]] += 1
            return out + np.minimum(floor, caps)
        out[full] = caps[full]
        left -= int(caps[full].sum())
        open_ &= ~full
    return out


def shard_tickets(quota: np.ndarray, shard: int, shard_slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For the places of one shard in order: the source, and the number of the ticket within the source."""
    total = int(quota.sum())
    places = np.arange(shard * shard_slots, min((shard + 1) * shard_slots, total), dtype=np.int64)
    tickets = permute(places, total, seed) if total else places
    ends = np.cumsum(quota.astype(np.int64))
    source = np.searchsorted(ends, tickets, side="right")
    return source, tickets - (ends - quota)[source]


def shard_counts(quota: np.ndarray, shard: int, shard_slots: int, seed: int) -> np.ndarray:
    """Slots per source of one shard."""
    return np.bincount(shard_tickets(quota, shard, shard_slots, seed)[0], minlength=len(quota))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A seeded permutation of range(n), as a Feistel network that walks on while it is outside."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            mixed = (right + np.uint64((key * 4 + r + 1) % (1 << 62))) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        return (left << np.uint64(half)) | right

    with np.errstate(over="ignore"):
        out = once(index.astype(np.uint64))
        while (outside := out >= n).any():
            out[outside] = once(out[outside])
    return out.astype(np.int64)


def token_streams(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """source, doc_id, n, start (place of the first token in the source's stream) and, if asked, ids of every document with tokens."""
    wanted = documents.filter("source is not null and text is not null and text <> ''").join(targets.select("source"), "source", "left_semi")
    tokens = encode(wanted, ["source", "doc_id"], path=vocabulary).withColumn("n", F.size("ids").cast("long"))
    kept = ["ids"] * with_ids
    tokens = cut(tokens.select("source", "doc_id", "n", *kept).withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(CHUNKS))))
    sums = tokens.groupBy("source", "chunk").agg(F.sum("n").alias("s"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "chunk", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tokens.withColumn("in_chunk", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(bases, ["source", "chunk"])
        .select("source", "doc_id", "n", (F.col("base") + F.col("in_chunk")).alias("start"), *kept)
    )


def pack(streams: DataFrame, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """source, block, n_tokens and the pieces (doc_id, first and past-last token) of each block, in order."""
    b = F.lit(block_tokens)
    first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("n") - 1) / b)

    def piece(block):
        begin, end = F.greatest(F.lit(0), block * b - F.col("start")), F.least(F.col("n"), (block + 1) * b - F.col("start"))
        fields = [block.alias("block"), (F.col("start") + begin).alias("at"), F.col("doc_id"), begin.alias("from"), end.alias("to")]
        return F.struct(*fields, *[F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids")] * with_ids)

    # A document's ids are cut into its pieces before they are spread, so that no block gets a copy of all of them.
    pieces = streams.select("source", F.explode(F.transform(F.sequence(first.cast("long"), last.cast("long")), piece)).alias("p"))
    fields = ["at", "doc_id", "from", "to"] + ["ids"] * with_ids
    kept = F.struct(*(F.col(f"p.{f}").alias(f) for f in fields))
    return pieces.groupBy("source", F.col("p.block").alias("block")).agg(F.sum(F.col("p.to") - F.col("p.from")).alias("n_tokens"), F.array_sort(F.collect_list(kept)).alias("pieces"))


def mixture_slots(plan: pd.DataFrame, spark, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """shard, slot, source, use_no and block of every place of the mixture; `plan` has source, quota and blocks."""
    quota, blocks, sources = plan["quota"].to_numpy(np.int64), plan["blocks"].to_numpy(np.int64), plan["source"].tolist()
    total = int(quota.sum())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                s, k = shard_tickets(quota, shard, shard_slots, seed)
                use, block = k // np.maximum(blocks[s], 1), np.zeros(len(k), dtype=np.int64)
                for i, u in set(zip(s.tolist(), use.tolist())):
                    here = (s == i) & (use == u)
                    block[here] = permute(k[here] % blocks[i], int(blocks[i]), seed * 1_000_003 + i * 1009 + u)
                yield pd.DataFrame({"shard": shard, "slot": shard * shard_slots + np.arange(len(k)), "source": np.array(sources, object)[s], "use_no": use, "block": block})

    shards = -(-total // shard_slots)
    parts = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, shards, 1, parts).mapInPandas(run, "shard long, slot long, source string, use_no long, block long")


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, with_ids: bool = False, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per place of the mixture: shard, slot, source, use_no, block, n_tokens, pieces.

    `total_tokens` is the size of the mixture; by default, all tokens of the sources with a target. One row per target
    source (its tokens) goes to the driver, which is as many as `targets` has.
    """
    spark = documents.sparkSession
    streams = token_streams(documents, targets, vocabulary, with_ids)
    sizes = streams.groupBy("source").agg(F.sum("n").alias("tokens"))
    plan = targets.join(sizes, "source", "left").fillna(0, ["tokens"]).orderBy("source").toPandas()
    plan["blocks"] = -(-plan["tokens"] // block_tokens)
    total = int(plan["tokens"].sum()) if total_tokens is None else total_tokens
    plan["quota"] = quotas(plan["target_share"].to_numpy(float), (plan["blocks"] * plan["max_repeat"]).to_numpy(np.int64), -(-total // block_tokens))
    slots = mixture_slots(plan, spark, shard_slots, seed)
    return slots.join(pack(streams, block_tokens, with_ids), ["source", "block"]).select("shard", "slot", "source", "use_no", "block", "n_tokens", "pieces")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """What each target source reached in the mixture, from its rows."""
    used = mixture.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), F.count("*").alias("used_blocks"), (F.max("use_no") + 1).alias("most_uses"))
    rows = targets.join(used, "source", "left").fillna(0, ["used_tokens", "used_blocks", "most_uses"])
    rows = rows.withColumn("all_tokens", F.sum("used_tokens").over(Window.partitionBy(F.lit(1))))  # one row per target
    share = F.coalesce(F.try_divide("used_tokens", "all_tokens"), F.lit(0.0))
    return rows.select("source", "target_share", "max_repeat", "used_tokens", "used_blocks", "most_uses", share.alias("actual_share"), (share >= F.col("target_share") - 0.005).alias("reached"))
