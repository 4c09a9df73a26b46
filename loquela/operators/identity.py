"""Voice identities: cosine, weighted centroids, pair summaries and merging."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquela.session import cut


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 if one has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def weighted_centroids(df: DataFrame, key: str, vector: str, weight: Column) -> DataFrame:
    """key, centroid and weight: sum of w * v over sum of w, by position (partial sums combine before the shuffle)."""
    rows = df.select(key, weight.cast("double").alias("_w"), F.posexplode(vector).alias("_p", "_v"))
    sums = rows.groupBy(key, "_p").agg(F.sum(F.col("_w") * F.col("_v")).alias("_s"), F.sum("_w").alias("_w"))
    ordered = F.array_sort(F.collect_list(F.struct("_p", (F.col("_s") / F.col("_w")).alias("x"))))
    return sums.groupBy(key).agg(F.transform(ordered, lambda s: s["x"]).alias("centroid"), F.max("_w").alias("weight"))


def centroid_pairs(centroids: DataFrame, key: str, pairs: DataFrame | None = None) -> DataFrame:
    """a, b and cosine of the pairs of centroids (given pairs, or all a < b of a small, checked table of identities)."""
    if pairs is None:
        left = centroids.select(F.col(key).alias("a"), F.col("centroid").alias("va"))
        right = centroids.select(F.col(key).alias("b"), F.col("centroid").alias("vb"))
        joined = left.join(right, F.col("a") < F.col("b"))
    else:
        joined = pairs.join(centroids.select(F.col(key).alias("a"), F.col("centroid").alias("va")), "a").join(centroids.select(F.col(key).alias("b"), F.col("centroid").alias("vb")), "b")
    return joined.select("a", "b", cosine(F.col("va"), F.col("vb")).alias("cos"))


def gray_zone(cos: Column, threshold: float, margin: float = 0.06) -> Column:
    """'gray' within the margin of the threshold, else 'same' or 'other'."""
    return F.when(F.abs(cos - threshold) <= margin, "gray").when(cos >= threshold, "same").otherwise("other")


def co_occurring_pairs(speaker_map: DataFrame) -> DataFrame:
    """a < b and in how many sessions both voices speak; pairs only within a session (its voices are few)."""
    voices = speaker_map.filter("stem is not null and global_id is not null").groupBy("stem").agg(F.sort_array(F.collect_set("global_id")).alias("v"))
    left = voices.select("stem", "v", F.explode("v").alias("a"))
    pairs = left.select("a", F.explode(F.filter("v", lambda x: x > F.col("a"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("sessions"))


def resolve_aliases(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """alias -> final target, by pointer jumping: `rounds` doublings follow any chain of fewer than 2 ** rounds steps; one that runs into a cycle ends there."""
    current = edges.select(F.col("alias"), F.col("target"))
    for _ in range(rounds):
        nxt = current.select(F.col("alias").alias("_a"), F.col("target").alias("_t"))
        step = current.join(nxt, current["target"] == nxt["_a"], "left").select("alias", F.coalesce("_t", "target").alias("target"), F.col("_t").isNotNull().alias("_moved"))
        step = cut(step)
        if step.filter("_moved and alias <> target").isEmpty():
            return step.drop("_moved")
        current = step.drop("_moved")
    return current


def absorb_weak(labels: list[str], seconds: dict[str, float], vectors: dict[str, np.ndarray | None], weak_seconds: float, threshold: float, sweeps: int | None = None) -> dict[str, str]:
    """label -> the label that stands for it. Clusters lighter than `weak_seconds` join the most similar one, of equal ones the heavier.

    A sweep goes through the clusters that were light at its start, lightest first. The label of the heavier of the two
    stays, but it takes the vector of the one that was chosen; a cluster's weight grows by the raw seconds of the one it takes
    in. Sweeps go on until one changes nothing (or for `sweeps`).
    """
    heir = {k: k for k in labels}

    def last(k: str) -> str:
        while heir[k] != k:
            k = heir[k]
        return k

    def alike(a: str, b: str) -> float:
        x, y = vectors.get(a), vectors.get(b)
        size = 0.0 if x is None or y is None else float(np.linalg.norm(x) * np.linalg.norm(y))
        return float(x @ y) / size if size else -1.0

    done = 0
    while sweeps is None or done < sweeps:
        done += 1
        weight = dict.fromkeys((k for k in labels if heir[k] == k), 0.0)
        for k in labels:
            weight[last(k)] += seconds[k]
        before = len(weight)
        for light in sorted((k for k in weight if weight[k] < weak_seconds), key=weight.get):
            if light not in weight:
                continue
            near = [(alike(light, k), w, k) for k, w in weight.items() if k != light and not min(w, weight[light]) >= weak_seconds]
            near = [n for n in near if n[0] >= threshold]
            if near:
                _, w, stays = max(near, key=lambda n: n[:2])
                if weight[light] > w:
                    light, stays = stays, light
                    vectors[light], vectors[stays] = vectors.get(stays), vectors.get(light)
                heir[light] = stays
                del weight[light]
                weight[stays] = w + seconds[light]
        if len(weight) == before:
            break
    return {k: last(k) for k in labels}


def merge_weak_clusters(df: DataFrame, weak_seconds: float = 90.0, threshold: float = 0.45, sweeps: int | None = None) -> DataFrame:
    """stem, label, target: weak clusters of a session absorbed by the most similar one.

    Input rows: stem, label, seconds, embedding. Sequential by nature; a session has few clusters. Null seconds count 0,
    null vectors are like none.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.drop_duplicates("label").sort_values("label")
        labels = rows["label"].tolist()
        seconds = dict(zip(labels, rows["seconds"].fillna(0.0).astype(float)))
        vectors = {k: None if v is None else np.asarray(v, float) for k, v in zip(labels, rows["embedding"])}
        heirs = absorb_weak(labels, seconds, vectors, weak_seconds, threshold, sweeps)
        return pd.DataFrame({"stem": pdf["stem"].iloc[0], "label": labels, "target": [heirs[k] for k in labels]})

    return df.groupBy("stem").applyInPandas(run, "stem string, label string, target string")
