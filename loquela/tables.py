"""Access to the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loquela.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the folder, as a lazy scan (filters and columns are pushed to parquet)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> None:
    """Register tables as temporary views, for plain `spark.sql` (the query surface of the corpus index)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
