"""Small tables out of given rows."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """Rows as part of the plan, so that the optimizer knows their exact size."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    columns = {field.name: [row[n] for row in rows] for n, field in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), fields)
