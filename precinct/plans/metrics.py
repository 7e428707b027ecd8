"""Summaries and grades of recorded metric samples (metric_name, value, ts, id, context)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from precinct.functions.scores import GRADE_BANDS, grade
from precinct.functions.text import family
from precinct.operators.ordering import exact_quantiles
from precinct.session import materialize

MEDIAN = ("inclusive", 1, 2)
P95 = ("exclusive", 19, 20)


def summarise_metrics(metrics: DataFrame) -> DataFrame:
    """Per metric family: count, average, min, max, median and sample deviation (null for one value)."""
    named = metrics.select(family(F.col("metric_name")).alias("family"), F.col("value").cast("double").alias("value"))
    plain = named.groupBy("family").agg(
        F.count("value").alias("count"), F.avg("value").alias("average"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.when(F.count("value") >= 2, F.stddev_samp("value")).alias("std_dev"),
    )
    median = exact_quantiles(named, ["family"], "value", {"median": MEDIAN})
    return plain.join(median, "family", "left").select("family", "count", "average", "min", "max", "median", "std_dev")


def latency_stats(samples: DataFrame, by: str, value: str = "value", always_interpolate: bool = False) -> DataFrame:
    """Per endpoint or query: average, 95th percentile, min, max, sample size.

    The percentile uses position 0.95 * (n + 1); groups below 20 samples report
    their maximum unless ``always_interpolate``.
    """
    plain = samples.groupBy(by).agg(
        F.avg(value).alias("average"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("sample_size")
    )
    p95 = exact_quantiles(samples, [by], value, {"p95": P95})
    if not always_interpolate:
        enough = F.col("sample_size") >= 20
        return plain.join(p95, by, "left").withColumn("p95", F.when(enough, F.col("p95")).otherwise(F.col("max")))
    return plain.join(p95, by, "left")


def latest_values(metrics: DataFrame, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Last recorded value per metric name."""
    last = F.max_by(F.struct("value", ts), F.struct(ts, tie))
    return metrics.groupBy("metric_name").agg(last.alias("_l")).select("metric_name", F.col("_l.value").alias("value"), F.col(f"_l.{ts}").alias(ts))


def hit_rate(counters: DataFrame, ts: str = "ts", tie: str = "event_id", hits: str = "hits", misses: str = "misses") -> DataFrame:
    """Hits, misses and their rate between the first and last counter snapshot: one row.

    ``counters`` holds (counter, reading) snapshots; no row when nothing was asked.
    """
    order = F.struct(ts, tie)
    delta = F.max_by("reading", order) - F.min_by("reading", order)
    per = counters.groupBy("counter").agg(delta.alias("d"))
    at = lambda name: F.coalesce(F.max(F.when(F.col("counter") == name, F.col("d"))), F.lit(0)).cast("bigint")
    one = per.agg(at(hits).alias("hits"), at(misses).alias("misses"))
    one = one.withColumn("total_requests", F.col("hits") + F.col("misses"))
    rate = F.try_divide(F.col("hits").cast("double"), F.col("total_requests").cast("double")) * 100.0
    return one.withColumn("hit_rate_percent", rate).where(F.col("total_requests") > 0)


def throughput(samples: DataFrame, by: str | None = None, seconds: str = "seconds") -> DataFrame:
    """Records per second and per minute over the observed time span; ``seconds`` is epoch time."""
    keys = [by] if by else []
    span = F.max(seconds) - F.min(seconds)
    out = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"), span.cast("double").alias("total_time_seconds"))
    rate = F.try_divide(F.col("records").cast("double"), F.col("total_time_seconds"))
    return out.withColumns({"records_per_second": rate, "records_per_minute": rate * 60.0})


def grade_metrics(metrics: DataFrame, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """(subject, value, grade): mean api and database time, peak memory, latest hit and ingestion rate.

    A subject without samples has no row.
    """
    kind, name, value = family(F.col("metric_name")), F.col("metric_name"), F.col("value").cast("double")
    last = lambda part: F.max_by(F.when(name.contains(part), value), F.when(name.contains(part), F.struct(ts, tie)))
    wide = metrics.agg(
        F.avg(F.when(kind == "api", value)).alias("api_response"),
        last("cache_hit_rate").alias("cache_performance"),
        F.max(F.when(kind == "memory", value)).alias("memory_usage"),
        F.avg(F.when(kind == "database", value)).alias("database_performance"),
        last("ingestion_rate").alias("ingestion_performance"),
    )
    rows = [F.struct(F.lit(s).alias("subject"), F.col(s).alias("value"), grade(F.col(s), s).alias("grade")) for s in GRADE_BANDS]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where(F.col("value").isNotNull())


def performance_report(metrics: DataFrame, ts: str = "ts", tie: str = "event_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary per family, grades, number of samples)."""
    total = metrics.agg(F.count(F.lit(1)).alias("total_metrics_collected"))
    return materialize(summarise_metrics(metrics), "metric-summary"), grade_metrics(metrics, ts, tie), total
