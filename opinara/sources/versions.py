"""Tables that are replaced without a gap: a reader sees the old rows or the new ones, never none or half of them.

A table is a folder with ``data``, one folder per version, and ``versions``, one small row per version that was published. A new
version is written beside the old one; only when that job has ended is its row appended, in one file that appears as a whole.
Readers take the version with the largest number. A write that fails leaves the table as it was.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinara.operators.small import small_table

_VERSIONS = "number long, version string"


def _published(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of published versions, or None for a table that isn't there."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True)
    try:
        there = files.load(f"{path}/versions").select("path").limit(1).count()
    except Exception as error:  # only a missing folder means that there is no table
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return spark.read.schema(_VERSIONS).parquet(f"{path}/versions") if there else None


def current_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and name of the version that readers see. Of two that were published at once under one number, the last by name."""
    published = _published(spark, path)
    found = published.agg(F.max(F.struct("number", "version")).alias("v")).head().v if published is not None else None
    return (found.number, found.version) if found else None


def current_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The published rows. A frame goes on reading the version it was made for."""
    found = current_version(spark, path)
    if found is None:
        raise FileNotFoundError(f"no published version of {path}")
    return spark.read.schema(schema).parquet(f"{path}/data/{found[1]}")


def publish_version(df: DataFrame, path: str, replace: bool = False, partition_by: list[str] | None = None) -> DataFrame:
    """Write the rows as a new version and let readers switch to it. A table that is there is only replaced on request.

    The rows may be computed from the version before. Folders of old versions stay until they are cleared out, as readers may
    still be at them.
    """
    spark = df.sparkSession
    before = current_version(spark, path)
    if before is not None and not replace:
        raise FileExistsError(f"PATH_ALREADY_EXISTS: {path}; pass replace=True to replace its rows")
    version = uuid.uuid4().hex
    df.write.partitionBy(*(partition_by or [])).parquet(f"{path}/data/{version}")
    row = small_table(spark, [((before[0] if before else 0) + 1, version)], _VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return spark.read.schema(df.schema).parquet(f"{path}/data/{version}")
