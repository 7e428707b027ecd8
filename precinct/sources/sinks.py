"""Writers: CSV export, rejects, GeoJSON layers, reports and metric samples."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from precinct.functions.dates import dates_as_text
from precinct.operators.ordering import number_rows
from precinct.schemas import METRIC
from precinct.sources.keyed_table import KeyedTable


def append_rows(df: DataFrame, path: str) -> None:
    """Plain insert."""
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; maps, arrays and structs as JSON text, dates as ISO days."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    flat = dates_as_text(df)
    flat = flat.select(
        *[(F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name)).alias(f.name) for f in flat.schema.fields]
    )
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("overwrite").json(path)


def feature_text(properties: list[str], geometry_type: Column, coordinates: Column) -> Column:
    """One GeoJSON Feature as text; Polygon and MultiPolygon differ in nesting only."""
    keep = {"ignoreNullFields": "false"}
    shape = F.when(geometry_type == "MultiPolygon", F.to_json(coordinates)).otherwise(F.to_json(coordinates[0]))
    geometry = F.when(coordinates.isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('{"type":"'), geometry_type, F.lit('","coordinates":'), shape, F.lit("}"))
    )
    return F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*properties), keep), F.lit(',"geometry":'), geometry, F.lit("}")
    )


def write_layer(layer: DataFrame, path: str, properties: list[str]) -> None:
    """One Feature per line, so the layer is written and read in parallel."""
    text = feature_text(properties, F.col("geometry_type"), F.col("coordinates"))
    layer.select(text.alias("value")).write.mode("overwrite").text(path)


def write_collection(layer: DataFrame, path: str, properties: list[str], order: list[Column]) -> None:
    """One FeatureCollection in the given order, written in parallel: its parts, put one after the other, are the document."""
    numbered = number_rows(layer, order, "_number")
    last = numbered.agg(F.max("_number")).first()[0]
    if last is None:
        rows = layer.sparkSession.createDataFrame([('{"type":"FeatureCollection","features":[]}',)], "value string")
    else:
        before = F.when(F.col("_number") == 1, '{"type":"FeatureCollection","features":[').otherwise(",")
        after = F.when(F.col("_number") == last, "]}").otherwise("")
        text = feature_text(properties, F.col("geometry_type"), F.col("coordinates"))
        rows = numbered.orderBy("_number").select(F.concat(before, text, after).alias("value"))
    rows.write.mode("overwrite").text(path)


def batch_numbers(df: DataFrame, order: list[Column], size: int, out: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in the given total order, from 1."""
    numbered = number_rows(df, order, "_number")
    return numbered.withColumn(out, (F.floor((F.col("_number") - 1) / size) + 1).cast("bigint")).drop("_number")


def write_layer_batches(layer: DataFrame, path: str, properties: list[str], order: list[Column], size: int) -> None:
    """One FeatureCollection file per batch of ``size`` features."""
    numbered = number_rows(layer, order, "_number")
    text = feature_text(properties, F.col("geometry_type"), F.col("coordinates"))
    rows = numbered.select((F.floor((F.col("_number") - 1) / size) + 1).cast("bigint").alias("batch"), "_number", text.alias("_text"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_number", "_text"))), lambda f: f["_text"])
    files = rows.groupBy("batch").agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(ordered, ","), F.lit("]}")).alias("value")
    )
    files.write.mode("overwrite").partitionBy("batch").text(path)


def incident_month() -> Column:
    """Part of an incident: its month."""
    return F.coalesce(F.date_format("victimisation_date", "yyyy-MM"), F.lit("undated"))


def save_tables(spark: SparkSession, out: str, areas: DataFrame, blocks: DataFrame, incidents: DataFrame, parts: int = 16) -> dict:
    """Upsert areas, then small areas, then incidents (without the helper name column).

    Incidents must come grouped by ``incident_month``.
    """
    tables = {
        "suburbs": KeyedTable(spark, f"{out}/suburbs", ["suburb_id"], parts),
        "meshblocks": KeyedTable(spark, f"{out}/meshblocks", ["id"], parts),
        # the id is a hash of the source row, so the month follows from the key
        "crimes": KeyedTable(spark, f"{out}/crimes", ["event_id"], part=incident_month(), sort=("suburb_id",)),
    }
    tables["suburbs"].upsert(areas, unique=True)
    tables["meshblocks"].upsert(blocks, unique=True)
    tables["crimes"].upsert(incidents.drop("AU2017_name"), clustered=True, unique=True)
    return tables


def record_metrics(spark: SparkSession, path: str, samples: list[tuple]) -> None:
    """Append samples (name, value, unit[, context]) to the metric table: one job and one file per call."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [(now, s[0], float(s[1]), s[2], {k: str(v) for k, v in ((s[3:] or ({},))[0] or {}).items()}) for s in samples]
    append_rows(spark.createDataFrame(rows, METRIC).coalesce(1), path)


def save_report(summary: DataFrame, details: DataFrame, path: str, total: DataFrame | None = None) -> None:
    """Summary, samples, and their number with the time of the report, as JSON."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    details.write.mode("overwrite").json(f"{path}/detailed_metrics")
    total = total if total is not None else details.agg(F.count(F.lit(1)).alias("total_metrics_collected"))
    total.withColumn("report_generated_at", F.lit(datetime.now(timezone.utc).isoformat())).write.mode("overwrite").json(f"{path}/report")
