"""Structured Streaming: micro-batch upserts and maintained monthly counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from precinct.functions.dates import month_floor
from precinct.functions.text import code_text, strip_space
from precinct.operators.copies import count_copies, expand_copies
from precinct.plans.build import build_incidents, split_incidents
from precinct.schemas import INCIDENT, INCIDENT_COLUMNS
from precinct.session import own_intermediates
from precinct.sources import files
from precinct.sources.keyed_table import KeyedTable


def read_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a table (a folder or a single file) as a stream, ``files_per_batch`` at a time, with their ``source``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern)
    # as a pattern the path may name a single file as well as a folder
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]").select("*", F.col("_metadata.file_path").alias("source"))


def upsert_stream(stream: DataFrame, table: KeyedTable, checkpoint: str, transform=None, order=None, unique: bool = False) -> StreamingQuery:
    """Upsert every micro-batch, for as long as there is new input, then stop.

    ``transform`` turns a batch of source rows into table rows. Keys must depend
    on the row alone, so a batch that is replayed after a failure changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with own_intermediates(batch.sparkSession):
            table.upsert(transform(batch) if transform else batch, order, unique=unique, batch=batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_incident_stream(spark: SparkSession, folder: str, example: str, encoding: str = "utf-8", files_per_batch: int = 1000) -> DataFrame:
    """Tab-separated incident files as they arrive; ``example`` is a file whose header all others share.

    The file's path is the ``source`` of its rows, so equal rows of different files stay apart, as in the batch job.
    """
    names = [n.strip() for n in files.header(spark, example, "\t", encoding)]
    position = {n: i for i, n in enumerate(names)}
    schema = ", ".join(f"_c{i} string" for i in range(len(names)))
    reader = spark.readStream.schema(schema).option("header", True).option("sep", "\t").option("encoding", encoding)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.option("quote", '"').option("escape", '"').csv(folder)
    columns = [strip_space(files.present(F.col(f"_c{position[src]}"))).alias(name) for src, name in INCIDENT_COLUMNS.items()]
    rows = rows.select(*columns, F.col("_metadata.file_path").alias("source"))
    return rows.withColumn("meshblock", code_text(F.col("meshblock")))


def incident_stream(stream: DataFrame, areas: DataFrame, blocks: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Raw incident rows into the incident table: build, validate, give ids, upsert.

    Ids come from the rows alone, so a replayed batch finds its own keys.
    """

    def to_rows(batch: DataFrame) -> DataFrame:
        raw = batch if "row_no" in batch.columns else batch.withColumn("row_no", F.lit(0))
        valid, _ = split_incidents(build_incidents(count_copies(raw, "row_no"), areas, blocks))
        return expand_copies(valid).select(*INCIDENT)

    return upsert_stream(stream, table, checkpoint, to_rows, unique=True)


def monthly_count_stream(stream: DataFrame, area: str, date: str, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keep (area, month) -> n up to date; state is one row per area and month."""
    counts = (
        stream.where(F.col(date).isNotNull())
        .groupBy(F.col(area).alias("area"), month_floor(F.col(date)).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        with own_intermediates(batch.sparkSession):
            table.upsert(batch, unique=True, batch=batch_id)

    return counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
