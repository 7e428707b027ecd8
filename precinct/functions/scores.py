"""Rates, trend classes and grades."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Largest stored 12-month count, trend band, fallback population.
SMALLINT_MAX = 32767
TREND_UP = 1.1
TREND_DOWN = 0.9
DEFAULT_POPULATION = 10000

# Grade thresholds, best first. "low" grades small values best.
GRADE_BANDS = {
    "api_response": ("low", (50.0, 100.0, 200.0)),
    "cache_performance": ("high", (95.0, 85.0, 70.0)),
    "memory_usage": ("low", (1024.0, 2048.0, 4096.0)),
    "database_performance": ("low", (10.0, 50.0, 100.0)),
    "ingestion_performance": ("high", (100000.0, 50000.0, 25000.0)),
}
GRADES = ("EXCELLENT", "GOOD", "FAIR", "POOR")


def rate_per_1000(total: Column, population: Column) -> Column:
    return F.when(population > 0, total / population * F.lit(1000.0)).otherwise(F.lit(0.0))


def percent_change(recent: Column, previous: Column) -> Column:
    return F.when(previous > 0, (recent - previous) / previous * F.lit(100.0)).otherwise(F.lit(0.0))


def trend_class(recent: Column, previous: Column) -> Column:
    return (
        F.when(recent > previous * F.lit(TREND_UP), "up")
        .when(recent < previous * F.lit(TREND_DOWN), "down")
        .otherwise("flat")
    )


def cap_smallint(total: Column) -> Column:
    return F.least(total, F.lit(SMALLINT_MAX)).cast("smallint")


def finite_or_null(c: Column) -> Column:
    """NaN and both infinities become null."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def grade(value: Column, subject: str) -> Column:
    """One of EXCELLENT, GOOD, FAIR, POOR; null stays null."""
    direction, bands = GRADE_BANDS[subject]
    out = F.when(value.isNull(), None)
    for label, bound in zip(GRADES, bands):
        out = out.when((value < bound) if direction == "low" else (value >= bound), label)
    return out.otherwise(GRADES[-1])
