"""The given tables seen as incident, concordance, census, point, layer and metric inputs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Customers whose polygons one task makes.
SPREAD = 1 << 14

DIVISIONS = ["Theft and Related Offences", "ROBBERY, EXTORTION AND RELATED OFFENCES", "08 Other", "Unlisted"]


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its declared schema, so planning reads no file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows that become many each, dealt over as many tasks as they need: a given file may be a single split."""
    tasks = -(-rows.count() // SPREAD)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def _txt(c: Column) -> Column:
    return c.cast("string")


def incidents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_incidents(table(spark, sf_dir, "orders"))


def as_incidents(orders: DataFrame) -> DataFrame:
    """Orders (a table or a stream) in the shape of raw incident rows."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    source = F.col("source") if "source" in orders.columns else F.lit("orders")
    division = F.when(key % 5 == 0, DIVISIONS[0]).when(key % 5 == 1, DIVISIONS[1]).when(key % 5 == 2, DIVISIONS[2]).when(key % 5 == 3, DIVISIONS[3])
    return orders.select(
        key.alias("row_no"),
        F.concat(F.lit(" Area. "), _txt(cust % 200), F.lit("  Unit ")).alias("area_unit"),
        F.when(key % 97 == 0, "unknown").when(key % 101 == 0, F.concat(F.lit("January "), _txt(F.when(key % 2 == 0, 9999).otherwise(1500))))
        .otherwise(F.date_format("o_orderdate", "MMMM yyyy")).alias("year_month"),
        _txt(cust).alias("meshblock"),
        division.alias("division"),
        F.col("o_orderpriority").alias("anzsoc_group"),
        source.alias("source"),
    )


def _place(key: Column) -> Column:
    slot = key % 150
    return F.concat(
        F.when(slot >= 140, "Zone ").otherwise("Place "), _txt(slot), F.when(key % 4 == 0, " (North)").otherwise("")
    )


def concordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    former = F.when(key % 200 < 190, "Area ").otherwise("Former Area ")
    return places.select(
        key.alias("row_no"),
        F.concat(former, _txt(key % 200), F.lit(" Unit")).alias("AU2017_name"),
        _txt(100000 + key % 150).alias("SA22023_code"),
        _place(key).alias("SA22023_name"),
        _place(key).alias("SA22023_name_ascii"),
        F.col("r_name").alias("REGC2023_name"),
        F.col("n_name").alias("TA2023_name"),
        _txt(F.when(key % 10 == 0, 4000000 + key).otherwise(key)).alias("MB2023_code"),
        _txt(key).alias("MB2013_code"),
        F.col("c_mktsegment").alias("UR2023_name"),
    )


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("row_no"),
        F.concat(F.lit("Place "), _txt(key % 120)).alias("area"),
        (2013 + 5 * (key % 7 % 3)).cast("int").alias("census_year"),
        (500 + 100 * F.col("p_size")).cast("bigint").alias("value"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        (F.lit(-47.0) + (key * 37 % 1300) / F.lit(100.0)).alias("lat"),
        F.when(key % 50 == 0, F.lit(0.0)).otherwise(F.lit(166.0) + (key * 91 % 1200) / F.lit(100.0)).alias("lng"),
    )


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of 4 to 8 corners around every customer's point: some with a hole, some in two parts."""
    key = F.col("c_custkey")
    base = spread(table(spark, sf_dir, "customer"), "c_custkey").select(
        key.alias("feature_id"), (4 + key % 5).cast("int").alias("n"),
        (F.lit(-47.0) + (key * 37 % 1300) / F.lit(100.0)).alias("lat"),
        (F.lit(166.0) + (key * 91 % 1200) / F.lit(100.0)).alias("lng"),
        F.explode(F.when(key % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("part"),
    )
    rings = base.withColumn("ring", F.explode(F.when(F.col("feature_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rings.withColumn("seq", F.explode(F.sequence(F.lit(0), F.col("n"))))
    hole = F.col("ring") == 1
    radius = F.when(hole, F.lit(0.01)).otherwise(F.lit(0.05))
    angle = F.lit(2 * math.pi) * (F.col("seq") % F.col("n")) / F.col("n")
    stretch = F.when(F.col("seq") == 1, F.lit(1.5)).otherwise(F.lit(0.7))
    x = F.col("lng") + F.col("part") * F.lit(0.5) + radius * F.cos(angle)
    y = F.col("lat") + F.when(hole, F.lit(0.001)).otherwise(F.lit(0.0)) + radius * F.sin(angle) * stretch
    return rows.select("feature_id", "part", "ring", "seq", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


def defective_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polygons with swapped or pinched corners, a missing last vertex, and rings where they must not be, here and there."""
    key, seq = F.col("feature_id"), F.col("seq")
    v = vertices(spark, sf_dir).withColumn("n", 4 + key % 5)
    swapped = F.when((key % 4 == 1) & (seq == 1), 2).when((key % 4 == 1) & (seq == 2), 1).otherwise(seq)
    v = v.withColumn("seq", F.when(F.col("ring") == 0, swapped).otherwise(seq).cast("int"))
    center = F.round(F.lit(166.0) + (key * 91 % 1200) / F.lit(100.0) + F.col("part") * F.lit(0.5) + F.lit(0.05), 6)
    level = F.round(F.lit(-47.0) + (key * 37 % 1300) / F.lit(100.0), 6)
    pinched = (key % 13 == 0) & (F.col("ring") == 0) & (F.col("seq") == 2)
    v = v.withColumns({"x": F.when(pinched, center).otherwise(F.col("x")), "y": F.when(pinched, level).otherwise(F.col("y"))})
    unclosed = (key % 7 == 0) & (F.col("seq") == F.col("n"))
    v = v.where(~unclosed).select("feature_id", "part", "ring", "seq", "x", "y")
    # holes beside their shell, holes in holes, and a second part that lies in the first: inside its hole where it has one
    own = v.where((F.col("part") == 0) & (F.col("ring") == 1))
    inner = lambda rows, share: rows.select(
        "feature_id", "part", "ring", "seq", F.round(F.col("cx") + (F.col("x") - F.col("cx")) * share, 6).alias("x"),
        F.round(F.col("cy") + (F.col("y") - F.col("cy")) * share, 6).alias("y"))
    cx, cy = F.lit(166.0) + (key * 91 % 1200) / F.lit(100.0), F.lit(-47.0) + (key * 37 % 1300) / F.lit(100.0) + F.lit(0.001)
    nested = inner(own.where(key % 5 == 0).withColumns({"ring": F.lit(2), "cx": cx, "cy": cy}), 0.5)
    within = v.where((F.col("part") == 0) & (F.col("ring") == 0) & (key % 17 == 0)).withColumns({"part": F.lit(2), "cx": cx, "cy": cy})
    moved = F.when((F.col("ring") == 1) & (key % 16 == 0), F.col("x") + F.lit(0.2)).otherwise(F.col("x"))
    return v.withColumn("x", F.round(moved, 6)).unionByName(nested).unionByName(inner(within, 0.05))


def projected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"), (F.lit(1100000.25) + (key * 37 % 1000) * 1000).alias("east"),
        (F.lit(4750000.5) + (key * 91 % 1500) * 1000).alias("north"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "view": "api_response_time_uncached", "click": "api_response_time_cached_avg", "purchase": "database_query_time",
        "signup": "memory_usage_peak", "error": "cache_hit_rate",
    }
    kind = F.col("event_type")
    name = F.coalesce(*[F.when(kind == k, v) for k, v in names.items()])
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "value", name.alias("metric_name"), (F.col("user_id") % 4).alias("endpoint"),
        F.col("ts").cast("timestamp").cast("double").alias("seconds"),
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(kind == "click", "hits").when(kind == "view", "misses").otherwise("other").alias("counter"),
        (F.col("event_id") * F.when(kind == "click", 3).otherwise(1)).alias("reading"),
    )
