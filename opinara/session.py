"""A local session for tests and benchmarks. On a cluster, use the session you have."""

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("opinara")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a cluster where it isn't installed. Call it once per session."""
    root = Path(__file__).parent
    folder = Path(tempfile.mkdtemp())  # on the driver only, until Spark has taken the file over
    archive = shutil.make_archive(str(folder / root.name), "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
