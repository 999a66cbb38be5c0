"""Binding costly columns, so that they are worked out once per row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with these columns fixed at this point of the plan.

    A later filter on a computed column is pushed below its projection by copying the whole
    expression, and through several stages the copies multiply. A generator of one row each is
    a point that such filters do not pass; plain columns still reach the scan.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*columns)))).select(*df.columns)
