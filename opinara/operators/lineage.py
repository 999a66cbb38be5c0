"""Cutting lineage on storage that outlives an executor."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints. A local session without one uses a folder in its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet beside the checkpoints and go on from there. Columns are compressed, where a checkpoint holds every
    row as it is in memory. The rows come back in other partitions; a column without a type takes a checkpoint."""
    if any(isinstance(f.dataType, NullType) for f in df.schema):
        return cut_lineage(df)
    path = f"{checkpoint_folder(df.sparkSession)}/opinara/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
