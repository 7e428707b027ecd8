"""Filtered, paged reads of the stored tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from precinct.functions.dates import month_bounds
from precinct.schemas import AREA_DETAIL, AREA_SUMMARY, BLOCK, EVENT_MODEL
from precinct.sources.keyed_table import KeyedTable

# Parameter -> (column, comparison).
AREA_FILTERS = {
    "region": ("region", "eq"),
    "name": ("name", "eq"),
    "council": ("council", "eq"),
    "crime_trend": ("crime_trend", "eq"),
    "min_safety_score": ("safety_score", "ge"),
    "min_crime_rate": ("crime_rate_per_1000", "ge"),
    "max_crime_rate": ("crime_rate_per_1000", "le"),
    "min_total_crimes": ("total_crimes_12m", "ge"),
    "max_total_crimes": ("total_crimes_12m", "le"),
}
INCIDENT_FILTERS = {
    "offence_category": ("offence_category", "eq"),
    "offence_code": ("offence_code", "eq"),
    "offence_description": ("offence_description", "eq"),
    "suburb_id": ("suburb_id", "eq"),
    "start_date": ("victimisation_date", "from_day"),
    "end_date": ("victimisation_date", "to_day"),
    "month": ("victimisation_date", "month"),
}
# These live on the area table and are reached through the area id.
INCIDENT_AREA_FILTERS = {"district": "council", "area_unit": "AU2017_name", "location_type": "location_type"}
AREA_PAGE = 500
INCIDENT_PAGE = 1000


def _predicate(column: str, how: str, value) -> Column:
    c = F.col(column)
    if how == "eq":
        return c == value
    if how == "ge":
        return c >= value
    if how == "le":
        return c <= value
    if how == "from_day":
        return c >= F.to_date(F.lit(value))
    if how == "to_day":
        return c <= F.to_date(F.lit(value))
    first, after = month_bounds(value)
    return (c >= first) & (c < after)


def apply_filters(df: DataFrame, known: dict[str, tuple[str, str]], params: dict) -> DataFrame:
    """All given parameters together; absent (None) ones do not filter."""
    unknown = set(params) - set(known)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    tests = [_predicate(*known[k], v) for k, v in params.items() if v is not None]
    return df.where(reduce(and_, tests)) if tests else df


def paginate(df: DataFrame, key: str, page: int, size: int, largest: int, after=None) -> DataFrame:
    """Page ``page`` (from 1) in key order.

    For long walks pass the last key seen as ``after``: the next page is then a
    pushed-down range filter and a top-n, whatever its depth.
    """
    if page < 1 or not 1 <= size <= largest:
        raise ValueError(f"page must be >= 1 and page size 1..{largest}")
    if after is not None:
        return df.where(F.col(key) > after).orderBy(key).limit(size)
    return df.orderBy(key).offset((page - 1) * size).limit(size)


def query_areas(areas: DataFrame, page: int = 1, page_size: int = 50, after=None, columns=None, **params) -> DataFrame:
    kept = apply_filters(areas, AREA_FILTERS, params)
    return paginate(kept, "suburb_id", page, page_size, AREA_PAGE, after).select(*(columns or AREA_SUMMARY))


def query_area(areas: DataFrame, suburb_id: str, columns=None) -> DataFrame:
    """Detail of one area; no row when it is unknown."""
    return areas.where(F.col("suburb_id") == suburb_id).select(*(columns or AREA_DETAIL))


def query_incidents(
    incidents: DataFrame, areas: DataFrame | None = None, page: int = 1, page_size: int = 100, after=None, columns=None, **params
) -> DataFrame:
    area_params = {INCIDENT_AREA_FILTERS[k]: params.pop(k) for k in list(params) if k in INCIDENT_AREA_FILTERS}
    area_params = {k: v for k, v in area_params.items() if v is not None}
    kept = apply_filters(incidents, INCIDENT_FILTERS, params)
    if area_params:
        if areas is None:
            raise ValueError(f"{sorted(area_params)} need the area table")
        tests = [F.col(k) == v for k, v in area_params.items()]
        kept = kept.join(areas.where(reduce(and_, tests)).select("suburb_id"), "suburb_id", "left_semi")
    return paginate(kept, "event_id", page, page_size, INCIDENT_PAGE, after).select(*(columns or EVENT_MODEL))


def month_parts(month: str | None = None, start_date: str | None = None, end_date: str | None = None) -> Column | None:
    """Condition on the stored parts (months, or ``undated``) that can hold rows of the dates; None for all."""
    if month is None and start_date is None and end_date is None:
        return None
    low, high = max(month or "", (start_date or "")[:7]), min(month or "9999-99", (end_date or "9999-99")[:7])
    return (F.col("part") != "undated") & F.col("part").between(low, high)


def query_stored_incidents(table: KeyedTable, areas: DataFrame | None = None, **params) -> DataFrame:
    """``query_incidents`` on the stored table; only the folders of months that can match are read."""
    dates = {k: params.get(k) for k in ("month", "start_date", "end_date")}
    return query_incidents(table.read(month_parts(**dates)), areas, **params)


def query_blocks(blocks: DataFrame, suburb_id: str) -> DataFrame:
    return blocks.where(F.col("suburb_id") == suburb_id).select(*BLOCK)


def area_reports(areas: DataFrame, *suburb_ids: str) -> DataFrame:
    """Report address and status, and widget code, of the given areas (default: all)."""
    if suburb_ids:
        areas = areas.where(F.col("suburb_id").isin(*suburb_ids))
    return areas.select("suburb_id", F.col("report_url").alias("pdf_url"), F.lit("not_purchased").alias("status"), F.col("widget_embed_code").alias("embed_code"))
