"""File sources and sinks: CSV, JSON, text, Parquet, run folders and manifests."""

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from opinara.sources.schemas import conform

INPUT_PREFIXES = ("bank_reviews_topics_", "bank_reviews_sentiment_")
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """CSV with a header, in declared types. Columns are found by name; a missing one is null, and so
    is an empty value.

    Review text holds line breaks, so files are read whole (one task per file): write them in
    files of a moderate size, as ``write_csv`` does. Pass ``multi_line=False`` to let Spark split
    large files when no value holds a line break.
    """
    raw = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
    return conform(raw, schema)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 500_000) -> int:
    """CSV with a header; list columns become space-joined text. Returns the number of rows, which
    is counted while they are written."""
    flat = [
        F.array_join(f.name, " ").alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
        for f in df.schema
    ]
    options = CSV_OPTIONS | {"maxRecordsPerFile": rows_per_file}
    seen = Observation()
    counted = df.select(*flat).observe(seen, F.count(F.lit(1)).alias("n_rows"))
    counted.write.mode("overwrite").options(**options).csv(path)
    return seen.get["n_rows"]


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan with fewer partitions than there are cores, spread over all of them by key; a larger one
    as it is. For work per row that costs far more than moving the row, such as text."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def run_path(path: str, run_ts: str) -> str:
    """Folder of one run. The run time is given, never read from the clock inside a query."""
    return f"{path}/run_ts={run_ts}"


def list_files(spark: SparkSession, folder: str, pattern: str = "*", nested: bool = False) -> DataFrame:
    """Path and time of change of the files in a folder (``nested``: and in those below), without reading them."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=nested).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"))


def newest(listing: DataFrame, prefixes=INPUT_PREFIXES) -> DataFrame:
    """The newest path of the first prefix that has any; ties go to the last name."""
    name = F.element_at(F.split("path", "/"), -1)
    rank = reduce(
        lambda out, p: out.when(name.startswith(p[1]), p[0]), enumerate(prefixes), F
    )
    ranked = listing.select("path", "modified", rank.alias("_rank")).filter(F.col("_rank").isNotNull())
    best = F.max_by("path", F.struct(-F.col("_rank"), "modified", "path"))
    return ranked.agg(best.alias("path")).filter(F.col("path").isNotNull())


def newest_file(spark: SparkSession, folder: str, prefixes=INPUT_PREFIXES) -> str | None:
    found = newest(list_files(spark, folder, "*.csv"), prefixes).head()
    return found.path if found else None


def write_kpis(row: DataFrame, path: str) -> None:
    """One JSON object from a one-row table."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Report lines (line_no, value), a bounded number, as one text file in order."""
    lines.orderBy("line_no").coalesce(1).select("value").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a Parquet table and return it as read back."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folders_with_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the folders below a folder that hold data files, without reading those."""
    files = list_files(spark, f"{folder}/*", "part-*")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("dataset")).distinct()


def manifest(datasets: dict[str, DataFrame], folder: str) -> DataFrame:
    """Dataset name, row count and path. All counts come from one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(f"{folder}/{name}").alias("path")
        )
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, counted)
