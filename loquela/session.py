"""Spark session helpers: defaults for tests and benches, and lineage cuts that survive executor loss."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loquela")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOQUELA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per context, so that workers need no path of their own to it."""
    context = spark.sparkContext
    if getattr(context, "_loquela_shipped", False):
        return
    root = Path(__file__).parent
    archive = Path(context._temp_dir, "loquela_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"loquela/{file.relative_to(root)}")
    context.addPyFile(str(archive))
    context._loquela_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a folder of its own only where none is set and all tasks run in this process (tests)."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="loquela-checkpoint-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and read it back from there.

    Used where one result feeds several jobs. The files live in the folder that all executors share, so a lost
    executor costs nothing but its running tasks.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Give up the files of shuffles and checkpoints that nothing refers to any more; Spark does so when the driver's JVM collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
