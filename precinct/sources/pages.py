"""Tables laid out for paging: files in key order, and a directory that says where each begins.

The directory has one row per file: its first and last key, its rows, and how many rows come before it. A page, or the rows after a key, is looked
up there first, and only the files that hold it are opened, however deep it lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def write_pages(df: DataFrame, path: str, key: str, files: int | None = None, rows: int = 1_000_000) -> None:
    """The table in ranges of ``key`` (no two rows share one, none is null), at most ``rows`` to a file."""
    ranges = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    ranges.sortWithinPartitions(key).write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    found = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
    # one row per file
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    found.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/directory")


def _rows(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    # the schema is that of the whole table, also where no file is asked for
    table = spark.read.parquet(f"{path}/rows")
    return spark.read.schema(table.schema).parquet(*[f"{path}/rows/{f}" for f in files]) if files else table.limit(0)


def read_page(spark: SparkSession, path: str, key: str, page: int, size: int) -> DataFrame:
    """Rows of page ``page`` (from 1) in key order."""
    if page < 1 or size < 1:
        raise ValueError("page and size must be >= 1")
    low = (page - 1) * size
    directory = spark.read.parquet(f"{path}/directory")
    held = directory.where((F.col("start") < low + size) & (F.col("start") + F.col("n") > low)).orderBy("start").collect()
    skip = low - held[0]["start"] if held else 0
    return _rows(spark, path, [r["file"] for r in held]).orderBy(key).offset(skip).limit(size)


def read_after(spark: SparkSession, path: str, key: str, after, size: int) -> DataFrame:
    """The ``size`` rows that follow the key ``after``."""
    directory = spark.read.parquet(f"{path}/directory").where(F.col("last") > after)
    first = directory.orderBy("start").limit(1).collect()
    held = directory.where(F.col("start") < first[0]["start"] + first[0]["n"] + size).orderBy("start").collect() if first else []
    return _rows(spark, path, [r["file"] for r in held]).where(F.col(key) > after).orderBy(key).limit(size)
