"""Keyed upserts into a plain Parquet table, partitioned by a function of the key.

Only partitions that new keys fall into are read, and only those that already hold one of the keys are rewritten, by dynamic partition
overwrite; rows of the others are appended. Rows carry the number of the batch that wrote them: a batch that is run again finds its
own keys and gives the same table, and one that comes late leaves rows of later batches alone. For one writer at a time; versions,
concurrent writers and compaction are the business of a table format.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from precinct.session import few_or_shuffled, materialize

BATCH = "_batch"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 16, part: Column | None = None, sort: tuple[str, ...] = ()):
        """``part`` must depend on the key alone (default: its hash into ``parts``); ``sort`` orders the rows of a file."""
        self.spark, self.path, self.keys, self.sort = spark, path.rstrip("/"), list(keys), list(sort)
        # the number of parts is in the column's name, so a table can't be opened with another one
        self.column = f"part_of_{parts}" if part is None else "part"
        self.part = (part if part is not None else F.pmod(F.xxhash64(*keys), F.lit(parts))).cast("string")

    def _stored(self) -> DataFrame | None:
        try:
            schema = self.spark.read.parquet(self.path).schema
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if self.column not in schema.names:
            raise ValueError(f"{self.path} is not partitioned by {self.column}")
        # names of parts stay text
        return self.spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name == self.column else f for f in schema])).parquet(self.path)

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self, parts: Column | None = None) -> DataFrame:
        """The rows, or those of some parts: ``parts`` is a condition on the column ``part``, and only matching folders are read."""
        rows = self._stored()
        if rows is None:
            raise ValueError(f"{self.path} holds no rows")
        rows = rows.withColumnRenamed(self.column, "part")
        return (rows if parts is None else rows.where(parts)).drop("part", BATCH)

    def upsert(self, updates: DataFrame, order: Column | None = None, clustered: bool = False, unique: bool = False, batch: int = 0) -> None:
        """Insert new keys, replace known ones whole, except rows of later batches.

        A key that comes twice is an error, unless ``order`` says which row wins (largest); ``unique`` vouches for keys that
        need no check. ``clustered`` says that the updates already come grouped by part. No rows change nothing.
        """
        if order is not None:
            updates = updates.groupBy(*self.keys).agg(F.max_by(F.struct(*updates.columns), order).alias("_row")).select("_row.*")
        fresh, old = updates.withColumns({BATCH: F.lit(batch).cast("bigint"), self.column: self.part}), self._stored()
        if old is None and (unique or order is not None):
            return self._write(fresh, "append", clustered)
        fresh = materialize(fresh, "updates")
        if order is None and not unique and not fresh.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError(f"keys {self.keys} repeat")
        if old is None:
            return self._write(fresh, "append")
        if set(old.columns) != set(fresh.columns):
            raise ValueError(f"columns {sorted(updates.columns)} are not those of {self.path}")
        among = lambda names: F.col(self.column).isin([r[0] for r in names.distinct().collect()])
        old = old.where(among(fresh.select(self.column)))
        known = materialize(old.select(self.column, BATCH, *self.keys).join(few_or_shuffled(fresh.select(*self.keys)), self.keys, "left_semi"), "known")
        fresh = fresh.join(few_or_shuffled(known.where(F.col(BATCH) > batch).select(*self.keys)), self.keys, "left_anti")
        met = among(known.where(F.col(BATCH) <= batch).select(self.column))
        self._write(fresh.where(~met), "append")
        kept = old.where(met).join(few_or_shuffled(fresh.select(*self.keys)), self.keys, "left_anti")
        self._write(kept.unionByName(fresh.where(met)), "overwrite")

    def _write(self, rows: DataFrame, mode: str, clustered: bool = False) -> None:
        if not clustered:
            # AQE splits large parts and merges small ones to even files
            rows = rows.hint("rebalance", self.column)
        if self.sort:
            rows = rows.sortWithinPartitions(self.column, *self.sort)
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.column).parquet(self.path)
