"""Queries on voices and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquela.operators import identity
from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_COS = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / (sqrt(list_sum(list_transform({a}, lambda z: z::DOUBLE * z::DOUBLE))) * sqrt(list_sum(list_transform({b}, lambda z: z::DOUBLE * z::DOUBLE))))"
_CENTROIDS = """(SELECT label, list(x ORDER BY p) AS centroid FROM (SELECT label, p, sum(v::DOUBLE) / count(*) AS x FROM
(SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS p FROM embeddings) GROUP BY label, p) GROUP BY label)"""


@query(f"SELECT label::BIGINT AS label, round(list_sum(centroid), 4) AS total, len(centroid) AS dim FROM {_CENTROIDS}")
def voice_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted centroid of each identity (its sum stands for it in the comparison)."""
    c = identity.weighted_centroids(table(spark, sf_dir, "embeddings"), "label", "embedding", F.lit(1.0))
    total = F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x)
    return c.select(F.col("label").cast("long").alias("label"), F.round(total, 4).alias("total"), F.size("centroid").cast("long").alias("dim"))


@query(f"""SELECT a.label::BIGINT AS a, b.label::BIGINT AS b, round({_COS.format(a='a.centroid', b='b.centroid')}, 5) AS cos
FROM {_CENTROIDS} a JOIN {_CENTROIDS} b ON a.label < b.label""")
def identity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each pair of identities' centroids (there are ten)."""
    c = identity.weighted_centroids(table(spark, sf_dir, "embeddings"), "label", "embedding", F.lit(1.0))
    return identity.centroid_pairs(c, "label").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.round("cos", 5).alias("cos"))


@query("""SELECT a, b, count(*) AS sessions FROM (SELECT DISTINCT m.stem, m.global_id AS a, n.global_id AS b FROM speaker_map m JOIN speaker_map n ON m.stem = n.stem AND m.global_id < n.global_id) GROUP BY ALL""")
def voices_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of voices and the number of sessions in which both speak."""
    return identity.co_occurring_pairs(table(spark, sf_dir, "speaker_map"))


@query(f"""SELECT p.a, p.b, CASE WHEN abs(cos - 0.78) <= 0.06 THEN 'gray' WHEN cos >= 0.78 THEN 'same' ELSE 'other' END AS zone FROM
(SELECT p.a, p.b, {_COS.format(a='x.centroid', b='y.centroid')} AS cos FROM (SELECT DISTINCT m.global_id AS a, n.global_id AS b FROM speaker_map m JOIN speaker_map n ON m.stem = n.stem AND m.global_id < n.global_id) p
JOIN speakers_db x ON x.gid = p.a AND len(x.centroid) = 128 JOIN speakers_db y ON y.gid = p.b AND len(y.centroid) = 128) p WHERE cos IS NOT NULL AND NOT isnan(cos)""")
def voices_to_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone of the similarity of voices heard in one session."""
    voices = table(spark, sf_dir, "speakers_db").filter(F.size("centroid") == 128).select("gid", "centroid")
    length = identity.dot(F.col("centroid"), F.col("centroid"))
    usable = voices.filter((length > 0) & ~F.isnan(length))
    pairs = identity.co_occurring_pairs(table(spark, sf_dir, "speaker_map")).select("a", "b")
    return identity.centroid_pairs(usable, "gid", pairs).select("a", "b", identity.gray_zone(F.col("cos"), 0.78).alias("zone"))


@query("""SELECT gid, count(*) AS labels, count(DISTINCT stem) AS sessions FROM (SELECT DISTINCT stem, local_label, global_id AS gid FROM speaker_map) GROUP BY gid""")
def voice_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "speaker_map").select("stem", "local_label", F.col("global_id").alias("gid")).distinct()
    return pairs.groupBy("gid").agg(F.count("*").alias("labels"), F.countDistinct("stem").alias("sessions"))


@query("""SELECT 'GLOBAL_' || lpad((max(regexp_extract(gid, '(\\d+)$', 1)::BIGINT) + 1)::VARCHAR, 8, '0') AS next_gid FROM speakers_db""")
def next_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next id never used before."""
    most = F.max(F.regexp_extract("gid", r"(\d+)$", 1).cast("long"))
    return table(spark, sf_dir, "speakers_db").agg(F.concat(F.lit("GLOBAL_"), F.lpad((most + 1).cast("string"), 8, "0")).alias("next_gid"))


@query()
def merged_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak clusters of each session absorbed by the most similar one; the centroid of its voice stands for a label."""
    labels = table(spark, sf_dir, "speaker_map").distinct()
    voices = table(spark, sf_dir, "speakers_db").filter(F.size("centroid") == 128).select(F.col("gid").alias("global_id"), F.col("centroid").alias("embedding"))
    spoken = table(spark, sf_dir, "segments").groupBy("stem", F.col("speaker").alias("local_label")).agg(F.sum("duration_sec").alias("seconds"))
    rows = labels.join(voices, "global_id").join(spoken, ["stem", "local_label"], "left")
    return identity.merge_weak_clusters(rows.select("stem", F.col("local_label").alias("label"), F.coalesce("seconds", F.lit(0.0)).alias("seconds"), "embedding"))
