"""Problem 2: the most similar vectors for every vector.

A hierarchical k-means tree is fitted on the driver from a bounded sample (a quarter of the distinct vectors, at most
`SAMPLE`, first by hash) and broadcast. It has a leaf for every `LEAF_ROWS` vectors of the table, as long as the sample has
`LEAF_SAMPLE` vectors for each, so leaves grow in number with the table, not in size. Best-bin-first traversal goes through a
priority queue, which opens one node at a time and scores only that node's children. The centre of an inner node is farther
from its vectors than that of a leaf; what the best node of a level lacks on average is added in the queue (`even`), so
that leaves under several branches are reached in order and not one branch after the other.

Every distinct vector lies in the first leaves of its traversal, as many for each, and two vectors meet if they share one.
How many is calibrated on `HELD_OUT` vectors kept out of the fit: brute force over the whole table gives their neighbours,
and leaves are added until `TARGET_RECALL` of these pairs meet.

To a leaf a vector goes with 16 bits an entry. Blocks of a leaf's vectors are multiplied with the others, and only the best k
of each vector go on to be merged. All leaves are not filled at once: they are dealt to as many passes as keep one pass
to about half the bytes of the vectors themselves (`PASS_BYTES` at least), and a pass leaves only the best k so far of each vector.
A crowded region has its share of the sample and so of the leaves.

Exact copies are folded first, so a group of copies of any size is one vector: of its ids the k + 1 smallest settle the
near copies of all its members, since equal similarities are ordered by id.

Defined results: vectors that are null, of another length, with null or non-finite entries, or all zero take no part;
similarities below `least` do not count; fewer than k neighbours are returned where there are fewer; no rows for an
empty table.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquela.session import cut, sweep

SAMPLE, LEAF_ROWS, LEAF_SAMPLE, BRANCHING, HELD_OUT, TARGET_RECALL = 65_536, 1024, 12, 64, 512, 0.997
#: Leaves looked at first in calibration; doubled until the target is met.
FIRST_LEAVES = 32
#: Bytes that the leaves of one pass may hold in any case, and of a row there besides its entries.
PASS_BYTES, ROW_BYTES = 128_000_000, 24


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], centres)
    return centres, (x @ centres.T).argmax(1)


class KMeansTree:
    """Hierarchical k-means over unit vectors. Node 0 is the root; `leaf[node]` numbers the leaves, -1 elsewhere; `lift` is added in the queue."""

    def __init__(self, x: np.ndarray, branching: int = BRANCHING, leaf_size: int = LEAF_SAMPLE, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.children: list[list[int]] = [[]]
        centres = [np.zeros(x.shape[1], dtype=np.float32)]
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if len(rows) <= (leaf_size if node == 0 else 2 * leaf_size):  # parts of two or three leaves are many and cost a node each
                continue
            centre, own = _kmeans(x[rows], min(branching, -(-len(rows) // leaf_size)), rng)
            used = np.unique(own)
            if len(used) < 2:
                continue
            for c in used:
                self.children.append([])
                centres.append(centre[c].astype(np.float32))
                self.children[node].append(len(centres) - 1)
                work.append((len(centres) - 1, rows[own == c]))
        self.centres = np.array(centres)
        self.leaf = np.full(len(centres), -1)
        ends = [n for n, c in enumerate(self.children) if not c]
        self.leaf[ends] = np.arange(len(ends))
        self.leaves = len(ends)
        self.lift = np.zeros(len(centres), dtype=np.float32)

    def even(self, x: np.ndarray) -> None:
        """Make the levels equal in the queue: by how much the best inner node of a level is on average farther from `x` than the best leaf."""
        if self.leaves < 2 or not len(x):
            return
        depth = np.zeros(len(self.leaf), dtype=np.int64)
        for node, children in enumerate(self.children):
            depth[children] = depth[node] + 1  # a child comes after its parent
        s = x.astype(np.float32) @ self.centres.T
        best = s[:, self.leaf >= 0].max(1).mean()
        for d in np.unique(depth[self.leaf < 0]):
            level = (depth == d) & (self.leaf < 0)
            self.lift[level] = best - s[:, level].max(1).mean()

    def visit(self, x: np.ndarray, n_leaves: int) -> list[list[int]]:
        """The first `n_leaves` leaves of each row's best-bin-first traversal; only the children of opened nodes are scored."""
        x, leaf = x.astype(np.float32), self.leaf.tolist()
        queues, found = [[(0.0, 0)] for _ in x], [[] for _ in x]
        waiting = range(len(x))
        while waiting:
            opened: dict[int, list[int]] = {}
            for i in waiting:
                queue, seen = queues[i], found[i]
                while queue and len(seen) < n_leaves:
                    node = heapq.heappop(queue)[1]
                    if leaf[node] < 0:
                        opened.setdefault(node, []).append(i)
                        break
                    seen.append(leaf[node])
            for node, rows in opened.items():
                children = self.children[node]
                near = -(x[rows] @ self.centres[children].T) - self.lift[children]
                # No more children of a node are needed than leaves are to be visited.
                keep = np.argpartition(near, n_leaves, axis=1)[:, :n_leaves] if n_leaves < len(children) else np.broadcast_to(np.arange(len(children)), near.shape)
                for i, values, places in zip(rows, np.take_along_axis(near, keep, 1).tolist(), keep.tolist()):
                    queue = queues[i]
                    for value, place in zip(values, places):
                        heapq.heappush(queue, (value, children[place]))
            waiting = [i for rows in opened.values() for i in rows]
        return found

    def calibrate(self, pairs: list[tuple[int, int]], x: np.ndarray, target: float = TARGET_RECALL, shared: bool = False) -> int:
        """Leaves to visit until the pairs (rows of `x`) meet: if either vector visits the first leaf of the other or, with `shared`, if both visit one leaf."""
        if not pairs:
            return 1
        most = min(FIRST_LEAVES, self.leaves)
        visits, n = self.visit(x, most), 1
        while n < self.leaves:
            if shared:
                met = sum(not set(visits[q][:n]).isdisjoint(visits[b][:n]) for q, b in pairs)
            else:
                met = sum(visits[b][0] in visits[q][:n] or visits[q][0] in visits[b][:n] for q, b in pairs)
            if met >= target * len(pairs):
                break
            n += 1
            if n > most:
                most = min(2 * most, self.leaves)
                visits = self.visit(x, most)
        return n

    def dump(self) -> bytes:
        buffer = io.BytesIO()
        flat = np.array([c for cs in self.children for c in cs], dtype=np.int64)
        np.savez(buffer, centres=self.centres, leaf=self.leaf, lift=self.lift, flat=flat, sizes=np.array([len(c) for c in self.children]))
        return buffer.getvalue()

    @classmethod
    def load(cls, data: bytes) -> KMeansTree:
        z, tree = np.load(io.BytesIO(data)), cls.__new__(cls)
        tree.centres, tree.leaf, tree.lift = z["centres"], z["leaf"], z["lift"]
        ends = np.cumsum(z["sizes"])
        tree.children = [z["flat"][e - s : e].tolist() for s, e in zip(z["sizes"], ends)]
        tree.leaves = int(tree.leaf.max()) + 1
        return tree


def _unit(raw: list[bytes] | pa.ChunkedArray, kind: type = np.float32) -> np.ndarray:
    """Unit rows (float64) from raw bytes of `kind`."""
    joined = b"".join(raw.to_pylist() if isinstance(raw, (pa.ChunkedArray, pa.Array)) else raw)
    n = len(raw)
    x = np.frombuffer(joined, dtype=kind).reshape(n, -1 if n else 1).astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True)) if n else x


def usable_vectors(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """`id`, `key` (digest of the vector) and `vec` (raw float32 bytes) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, vecs = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid or len(v) != dim or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float32) + np.float32(0)
                if np.isfinite(x).all() and x.any():
                    raw = x.tobytes()
                    ids.append(i)
                    keys.append(blake2b(raw, digest_size=16).digest())
                    vecs.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["id", "key", "vec"])

    sized = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.size("v") == dim)
    return sized.mapInArrow(run, "id long, key binary, vec binary")


def _coded(x: np.ndarray) -> list[bytes]:
    """Rows with 16 bits an entry in proportion to the largest, which `_unit` undoes: errors of a cosine are some 1e-6."""
    return [row.tobytes() for row in np.rint(x * (32767 / np.abs(x).max(1, keepdims=True))).astype(np.int16)]


def _router(tree, n_leaves: int):
    """uid, vec -> uid, the vector as coded and its leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = KMeansTree.load(tree.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                x = _unit(batch.column(1))
                leaves = pa.array(index.visit(x, n_leaves), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_coded(x), pa.binary()), leaves], names=["uid", "vec", "leaves"])

    return run


def exact_nearest(groups: DataFrame, queries: np.ndarray, uids: np.ndarray, k: int, least: float) -> pa.Table:
    """uid, other, cos and vec: the k nearest of a few queries among all rows, by brute force over each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            uid, vec = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=object)
            s = _unit(batch.column(1)) @ queries.T
            s[uid[:, None] == uids[None, :]] = -2
            r, c = np.nonzero(s >= least)
            owner, other, cos = _best_of(uids[c], uid[r], s[r, c], k)
            place = {u: i for i, u in enumerate(uid.tolist())}
            some = pa.table({"uid": owner, "other": other, "cos": cos, "vec": pa.array([vec[place[o]] for o in other.tolist()], pa.binary())})
            best = some if best is None else pa.concat_tables([best, some])
        if best is not None:
            yield from best.combine_chunks().to_batches()

    found = groups.select("uid", "vec").mapInArrow(run, "uid long, other long, cos double, vec binary")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("cos"), "other"))
    return found.withColumn("_n", rank).filter(f"_n <= {k}").drop("_n").toArrow()


def _best_of(owner: np.ndarray, other: np.ndarray, cos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest per owner, ties by smaller other."""
    order = np.lexsort((other, -cos, owner))
    owner, other, cos = owner[order], other[order], cos[order]
    first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0)) if len(owner) else np.zeros(0, np.int64)
    keep = np.arange(len(owner)) - begin < k
    return owner[keep], other[keep], cos[keep]


def _leaf_best(k: int, least: float):
    """The best k of the others in the leaf for each of its vectors.

    Only values of at least `least` are looked at, chunk by chunk of each vector against those behind it; the best of both are kept up.
    """

    def run(table: pa.Table) -> pa.Table:
        uid, x = table.column("uid").to_numpy(), _unit(table.column("vec"), np.int16).astype(np.float32)
        held, n, start = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), len(uid), 0
        while start < n - 1:
            end = min(n, start + max(64, min(1024, 4_000_000 // (n - start))))
            s = x[start:end] @ x[start:].T
            at = np.flatnonzero(s.ravel() >= least)
            r, c = np.divmod(at, n - start)
            ahead = c > r
            a, b, v = uid[start + r[ahead]], uid[start + c[ahead]], s.ravel()[at[ahead]]
            held = _best_of(np.r_[held[0], a, b], np.r_[held[1], b, a], np.r_[held[2], v, v], k)
            start = end
        return pa.table(dict(zip(("uid", "other", "cos"), held)))

    return run


def near_distinct(groups: DataFrame, k: int, least: float, sample: int = SAMPLE, leaves: int | None = None) -> DataFrame:
    """uid, other, cos: the up to k nearest distinct vectors of each, from rows of uid and vec (already cut)."""
    spark = groups.sparkSession
    n = groups.count()
    taken = groups.select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(max(1, min(sample, max(n // 4, 4 * HELD_OUT)))).toArrow()
    x = _unit(taken.column("vec")) if taken.num_rows else np.zeros((0, 1))
    held_out = min(HELD_OUT, len(x) // 4)
    fit = x[held_out:].astype(np.float32)
    tree = KMeansTree(fit, leaf_size=max(LEAF_SAMPLE, -(-len(fit) * LEAF_ROWS // max(n, 1))))
    tree.even(x[:held_out])
    if leaves is None:
        leaves = calibrated(tree, groups, x[:held_out], taken.column("uid").to_numpy()[:held_out], k, least) if held_out else tree.leaves
    shared = spark.sparkContext.broadcast(tree.dump())
    routed = groups.select("uid", "vec").mapInArrow(_router(shared, leaves), "uid long, vec binary, leaves array<int>")
    n_passes = passes(n, x.shape[1], leaves)
    if n_passes > 1:
        sweep(spark)
        routed = cut(routed)
    rank, best = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("cos"), "other")), None
    for p in range(n_passes):
        filled = routed.select("uid", "vec", F.explode(F.filter("leaves", lambda leaf: leaf % n_passes == p)).alias("leaf"))
        met = filled.groupBy("leaf").applyInArrow(_leaf_best(k, least), "uid long, other long, cos double")
        met = (met if best is None else best.unionByName(met)).repartition("uid").groupBy("uid", "other").agg(F.max("cos").alias("cos"))
        best = met.withColumn("_n", rank).filter(f"_n <= {k}").drop("_n")
        if n_passes > 1:
            sweep(spark)
            best = cut(best)
    return best


def passes(n: int, dim: int, leaves: int) -> int:
    """Passes over the leaves, each of about half as many bytes as the vectors have, or `PASS_BYTES`."""
    return max(1, -(-n * leaves * (2 * dim + ROW_BYTES) // max(PASS_BYTES, 2 * dim * n)))


def calibrated(tree: KMeansTree, groups: DataFrame, queries: np.ndarray, uids: np.ndarray, k: int, least: float) -> int:
    """Leaves to visit, from the exact neighbours in the whole table of queries that are not in the fit."""
    exact = exact_nearest(groups, queries, uids, k, least)
    place = {u: i for i, u in enumerate(uids.tolist())}
    pairs = list(zip((place[u] for u in exact.column("uid").to_pylist()), range(len(queries), len(queries) + exact.num_rows)))
    return tree.calibrate(pairs, np.concatenate([queries, _unit(exact.column("vec"))]) if exact.num_rows else queries, shared=True)


def nearest_vectors(df: DataFrame, key: str, vector: str, dim: int, k: int = 5, least: float = 0.70, sample: int = SAMPLE, leaves: int | None = None) -> DataFrame:
    """`id`, `other`, `cos`: the k most similar others of every row, ties by smaller id."""
    vectors = usable_vectors(df, key, vector, dim)
    ranked = vectors.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("id")))
    groups = ranked.filter(F.col("_n") <= k + 1).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min_by("vec", "id").alias("vec"))
    groups = cut(groups.withColumn("uid", F.get("ids", F.lit(0))))
    near = near_distinct(groups, k, least, sample, leaves)
    names = groups.select("uid", "ids")
    others = near.join(names.select(F.col("uid").alias("other"), F.col("ids").alias("other_ids")), "other").groupBy("uid").agg(
        F.flatten(F.collect_list(F.transform("other_ids", lambda i: F.struct((-F.least(F.col("cos"), F.lit(1.0))).alias("neg"), i.alias("id"))))).alias("far")
    )
    own = F.transform("ids", lambda i: F.struct(F.lit(-1.0).alias("neg"), i.alias("id")))
    empty = F.expr("cast(array() as array<struct<neg:double,id:bigint>>)")
    pool = names.join(others, "uid", "left").withColumn("pool", F.array_sort(F.concat(own, F.coalesce("far", empty))))
    member = pool.select(F.explode("ids").alias("id"), "pool")
    chosen = member.select("id", F.explode(F.slice(F.filter("pool", lambda c: c["id"] != F.col("id")), 1, k)).alias("c"))
    few = chosen.select("id", F.col("c.id").alias("other"), (-F.col("c.neg")).alias("cos"))
    crowded = groups.filter(F.size("ids") == k + 1).select("key", "ids")
    rest = vectors.select("id", "key").join(crowded, "key").filter(~F.array_contains("ids", F.col("id")))
    return few.unionByName(rest.select("id", F.explode(F.slice("ids", 1, k)).alias("other"), F.lit(1.0).alias("cos")))


def pairs(near: DataFrame) -> DataFrame:
    """voice_a < voice_b, once for each pair in which one is a near vector of the other."""
    return near.select(F.least("id", "other").alias("voice_a"), F.greatest("id", "other").alias("voice_b")).distinct()
