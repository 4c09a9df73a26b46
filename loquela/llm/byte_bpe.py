"""Problem 7: encoding of the whole corpus with a public byte-level tokenizer.

A text is split by the tokenizer's pattern; each piece is encoded by a contiguous rank array: the part boundaries and
the ranks of adjacent pairs lie in two arrays, the smallest rank is looked for again and again, its boundary is deleted
and the ranks of its neighbours are refreshed. That is quadratic in the piece, so pieces above `LONG` bytes use the same
merges through a heap. Pieces repeat, so each worker keeps a bounded cache of encoded ones. The rank file (under 1 MB,
fixed) is read once by the driver and broadcast.

Defined results: null and empty texts have the empty list; texts of any length are encoded whole; strings that look like
special tokens are ordinary text; one row out for each row in, repeated rows included.
"""

from __future__ import annotations

import base64
import heapq
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = os.environ.get("LOQUELA_BPE_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 96
CACHE = 200_000
_NONE = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Encode one piece by repeated scans of its rank array."""
    bounds = list(range(len(piece) + 1))
    adjacent = [ranks.get(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
    while adjacent and (least := min(adjacent)) != _NONE:
        i = adjacent.index(least)
        del bounds[i + 1], adjacent[i]
        if i < len(adjacent):
            adjacent[i] = ranks.get(piece[bounds[i] : bounds[i + 2]], _NONE)
        if i:
            adjacent[i - 1] = ranks.get(piece[bounds[i - 1] : bounds[i + 1]], _NONE)
    return [ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long piece: a heap of (rank, place) over a linked list of parts."""
    n = len(piece)
    nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or nxt[nxt[i]] != end:
            continue
        gone = nxt[i]
        alive[gone], nxt[i] = False, end
        if end < n:
            prv[end] = i
            if (r := ranks.get(piece[i : nxt[end]])) is not None:
                heapq.heappush(heap, (r, i, nxt[end]))
        if prv[i] >= 0 and (r := ranks.get(piece[prv[i] : end])) is not None:
            heapq.heappush(heap, (r, prv[i], end))
    return [ranks[piece[i : nxt[i]]] for i in range(n) if alive[i]]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks, self.split, self.cache = ranks, regex.compile(pattern).findall, {}

    def piece(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        if (whole := self.ranks.get(raw)) is not None:
            return [whole]
        return merge_short(raw, self.ranks) if len(raw) <= LONG else merge_long(raw, self.ranks)

    def encode_into(self, text: str, out: array) -> None:
        cache = self.cache
        for word in self.split(text):
            ids = cache.get(word)
            if ids is None:
                ids = self.piece(word)
                if len(word) <= LONG:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.encode_into(text, out)
        return out.tolist()


#: One encoder per worker process and rank file.
_ENCODERS: dict[str, Encoder] = {}


def encode(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The `keep` columns and `ids` (array of int) of every row."""
    spark = df.sparkSession
    with open(path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path)
        if encoder is None:
            encoder = _ENCODERS[path] = Encoder(read_ranks(ranks.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                flat, offsets = array("i"), np.zeros(part.num_rows + 1, dtype=np.int32)
                for i, value in enumerate(part.column(len(keep)).to_pylist()):
                    if value:
                        encoder.encode_into(value, flat)
                    offsets[i + 1] = len(flat)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(flat, dtype=np.int32) if len(flat) else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], ids], names=[*keep, "ids"])

    source = df.select(*keep, F.col(text).alias("_text"))
    schema = source.drop("_text").schema.add("ids", T.ArrayType(T.IntegerType()))
    return source.mapInArrow(run, schema)
