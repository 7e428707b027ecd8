"""Per-area measures. Facts are read once into a counted cube; the rest is small.

``event_cube`` groups by area, date, code (and source name) with map-side combine, so an area
or code that holds a third of all rows shuffles only its partial counts. Every
measure below takes the cube (or any frame with a count column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from precinct.functions.dates import iso_day, month_end, month_floor, window_start
from precinct.functions.scores import percent_change, trend_class

RECENT_MONTHS = 3


def row_count(weight: str | None) -> Column:
    return F.sum(weight) if weight else F.count(F.lit(1))


def event_cube(
    incidents: DataFrame,
    area: str = "suburb_id",
    date: str = "victimisation_date",
    code: str = "offence_code",
    label: str = "AU2017_name",
    row_no: str = "row_no",
    weight: str | None = None,
) -> DataFrame:
    """(area, date, code, label) -> n and the number of the first row.

    Only numbers are aggregated, so Spark keeps to hash aggregation.
    """
    return (
        incidents.where(F.col(area).isNotNull() & (F.col(area) != ""))
        .groupBy(F.col(area).alias("area"), F.col(date).alias("date"), F.col(code).alias("code"), F.col(label).alias("label"))
        .agg(row_count(weight).alias("n"), F.min(row_no).alias("first_row"))
    )


def reference_date(df: DataFrame, date: str = "date") -> Column:
    """Last day of the latest month in the data, as a one-row scalar subquery."""
    return df.agg(month_end(F.max(date)).alias("reference")).scalar()


def monthly_counts(df: DataFrame, area: str, date: str, weight: str | None = None) -> DataFrame:
    """Incidents per (area, observed month); rows without a date are left out."""
    return (
        df.where(F.col(date).isNotNull())
        .groupBy(F.col(area).alias("area"), month_floor(F.col(date)).alias("month"))
        .agg(row_count(weight).alias("n"))
    )


def rolling_total(df: DataFrame, area: str, date: str, weight: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Incidents per area in the 365 days up to the reference date, that day's month included."""
    as_of = reference_date(df, date) if as_of is None else as_of
    inside = F.col(date) >= window_start(as_of)
    amount = F.col(weight) if weight else F.lit(1)
    total = F.coalesce(F.sum(F.when(inside, amount)), F.lit(0)).cast("bigint")
    return df.groupBy(F.col(area).alias("area")).agg(total.alias("total_12m"))


def _trend_columns(recency: Column, n: Column, is_month: Column) -> tuple[Column, Column, Column]:
    """Averages over the 3 latest and the 3 months before, and how many were seen (up to 6)."""
    mean = lambda low, high: F.coalesce(F.avg(F.when(is_month & recency.between(low, high), n)), F.lit(0.0))
    seen = F.count(F.when(is_month & (recency <= 2 * RECENT_MONTHS), 1))
    return mean(1, RECENT_MONTHS), mean(RECENT_MONTHS + 1, 2 * RECENT_MONTHS), seen


def _with_trend(df: DataFrame) -> DataFrame:
    """An area with a single observed month has no trend."""
    enough = F.col("_seen") >= 2
    recent, previous = F.col("recent_avg"), F.col("previous_avg")
    return df.withColumns(
        {
            "crime_trend": F.when(enough, trend_class(recent, previous)).otherwise("flat"),
            "trend_3m_change": F.when(enough, percent_change(recent, previous)).otherwise(F.lit(0.0)),
        }
    ).drop("_seen")


def trend(months: DataFrame) -> DataFrame:
    """Recent against previous observed months from (area, month, n)."""
    latest = Window.partitionBy("area").orderBy(F.desc("month"))
    ranked = months.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= 2 * RECENT_MONTHS)
    recent, previous, seen = _trend_columns(F.col("_r"), F.col("n"), F.lit(True))
    return _with_trend(ranked.groupBy("area").agg(recent.alias("recent_avg"), previous.alias("previous_avg"), seen.alias("_seen")))


def peak_months(months: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` busiest months of each area (ties: earlier month), in date order."""
    busiest = Window.partitionBy("area").orderBy(F.desc("n"), "month")
    kept = months.withColumn("_r", F.row_number().over(busiest)).where(F.col("_r") <= top)
    return kept.groupBy("area").agg(F.sort_array(F.collect_list(iso_day(F.col("month")))).alias("peak_crime_months"))


def breakdown(df: DataFrame, area: str, code: str, weight: str | None = None) -> DataFrame:
    """Map of code -> count per area, codes ascending, rows without a code left out.

    Counts are complete before the map is built, so a map holds one entry per
    distinct code (at most the two-digit and division codes).
    """
    counted = (
        df.where(F.col(code).isNotNull())
        .groupBy(F.col(area).alias("area"), F.col(code).alias("code")).agg(row_count(weight).alias("n"))
    )
    entries = F.array_sort(F.collect_list(F.struct("code", "n")))
    return counted.groupBy("area").agg(F.map_from_entries(entries).alias("crime_breakdown"))


def area_measures(cube: DataFrame, as_of: Column | None = None, top: int = 3) -> DataFrame:
    """All per-area measures in one pass over the cube.

    Grouping sets give the counts per month, per code and per source name
    together; both windows and the last aggregation then share one partitioning
    by area, whose rows are bounded by its months, codes and names.
    """
    as_of = reference_date(cube) if as_of is None else as_of
    sized = cube.withColumn("_n12", F.when(F.col("date") >= window_start(as_of), F.col("n")).otherwise(F.lit(0)))
    sized = sized.withColumn("month", month_floor(F.col("date")))
    area, month, code = F.col("area"), F.col("month"), F.col("code")
    label = F.col("label")
    rolled = sized.groupingSets([[area, month], [area, code], [area, label]], area, month, code, label).agg(
        F.sum("n").alias("n"), F.sum("_n12").alias("_n12"), F.min("first_row").alias("_first"),
        F.grouping("month").alias("_no_month"), F.grouping("code").alias("_no_code"), F.grouping("label").alias("_no_label"),
    )
    by_area = Window.partitionBy("area")
    in_months, in_codes, in_labels = F.col("_no_month") == 0, F.col("_no_code") == 0, F.col("_no_label") == 0
    is_month = in_months & F.col("month").isNotNull()
    # observed months come first in both orders
    rolled = rolled.withColumn("_kind", F.when(is_month, 0).otherwise(1))
    rolled = rolled.withColumns(
        {
            "_recency": F.row_number().over(by_area.orderBy("_kind", F.desc("month"))),
            "_busy": F.row_number().over(by_area.orderBy("_kind", F.desc("n"), "month")),
        }
    )
    recent, previous, seen = _trend_columns(F.col("_recency"), F.col("n"), is_month)
    peaks = F.collect_list(F.when(is_month & (F.col("_busy") <= top), iso_day(F.col("month"))))
    codes = F.collect_list(F.when(in_codes & F.col("code").isNotNull(), F.struct("code", "n")))
    out = rolled.groupBy("area").agg(
        F.sum(F.when(in_months, F.col("_n12"))).cast("bigint").alias("total_12m"),
        F.sum(F.when(in_months, F.col("n"))).cast("bigint").alias("total_all"),
        recent.alias("recent_avg"), previous.alias("previous_avg"), seen.alias("_seen"),
        F.sort_array(peaks).alias("peak_crime_months"),
        F.map_from_entries(F.array_sort(codes)).alias("crime_breakdown"),
        F.min_by(F.when(in_labels, label), F.when(in_labels, F.col("_first"))).alias("label"),
    )
    return _with_trend(out)


def block_counts(incidents: DataFrame, block: str, area: str, row_no: str, weight: str | None = None) -> DataFrame:
    """Incidents and first area per small area; empty codes are left out."""
    per_area = (
        incidents.where(F.col(block).isNotNull() & (F.col(block) != ""))
        .groupBy(F.col(block).alias("id"), F.col(area).alias("_area"))
        .agg(row_count(weight).alias("_n"), F.min(row_no).alias("_first"))
    )
    return per_area.groupBy("id").agg(
        F.min_by("_area", "_first").alias("suburb_id"), F.sum("_n").cast("bigint").alias("crime_count")
    )


def by_frequency(counts: DataFrame, count: str, key: str) -> DataFrame:
    """Most frequent first, ties by key."""
    return counts.orderBy(F.desc(count), key)
