"""Relational queries on the business tables: rollups, pivots, ranking, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquela.plans.registry import Registry
from loquela.tables import table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY ALL""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(revenue, 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    per_order = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    joined = per_order.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    nations = t("nation").select("n_nationkey", "n_name")
    return joined.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice, k FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3""")
def top_orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three largest orders of each customer (top-k per group)."""
    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice").withColumn("k", k).filter("k <= 3")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def customers_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query("""SELECT l_linestatus, l_returnflag, count(*) AS n, grouping(l_linestatus)::BIGINT AS g1, grouping(l_returnflag)::BIGINT AS g2 FROM lineitem GROUP BY ROLLUP (l_linestatus, l_returnflag)""")
def shipping_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "lineitem").rollup("l_linestatus", "l_returnflag")
    return r.agg(F.count("*").alias("n"), F.grouping("l_linestatus").cast("long").alias("g1"), F.grouping("l_returnflag").cast("long").alias("g2"))
