"""k nearest neighbours within a radius, by equi-joins on a grid of several levels.

A single grid fails when points crowd: one cell may hold a third of them, and
its pairs grow with the square. Here every point searches on a cell size that
fits its surroundings:

* cells halve from the radius down to 3 m, below the 10 m the ranking can tell apart;
* points with identical coordinates are one site that keeps its k + 1 smallest ids;
* a site finds its finest cell with more than k points. That cell's diagonal
  bounds the distance of the k-th neighbour, so only cells within that distance
  (or the radius, if smaller) are searched, one level up.

Candidates per site therefore stay near k per cell at any density down to that
scale, and the result is exact: nothing is capped. Distances rank by their
value rounded to 10 m and then by id, so different coordinates within 5 m of
each other all have to compete; identical ones do not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from precinct.functions.geo import EARTH_KM, haversine_km, usable_coordinates

_SLACK = 1.001
_FINEST_KM = 0.003
_KM_PER_DEGREE = math.radians(1.0) * EARTH_KM


def _levels(radius_km: float) -> int:
    return max(1, int(math.floor(math.log2(max(radius_km / _FINEST_KM, 2.0)))) + 1)


def _cell_km(radius_km: float) -> str:
    return f"({radius_km * _SLACK!r}D / pow(2D, _level))"


def _row_height(radius_km: float) -> str:
    """Height of a grid row in degrees of latitude."""
    return f"({_cell_km(radius_km)} / {_KM_PER_DEGREE!r}D)"


def _lng_reach(theta: str, lat: str) -> str:
    """Largest longitude difference (degrees) of a circle of angle theta; null if it holds a pole."""
    inside = f"{theta} + abs(radians({lat})) < {math.pi / 2!r}D"
    return f"(case when {inside} then degrees(asin(sin({theta}) / cos(radians({lat})))) end)"


def _row_of(lat: str) -> str:
    return f"floor(({lat} + 90D) / _height)"


def _columns_in_row(radius_km: float) -> str:
    """Number of cells in ``_row``: as many as keep each at least one reach wide."""
    edge = "(greatest(abs(_row * _height - 90D), abs((_row + 1) * _height - 90D)) + _height)"
    reach = _lng_reach(f"({_cell_km(radius_km)} / {EARTH_KM!r}D)", edge)
    return f"cast(greatest(1, coalesce(floor(360D / ({reach} * {_SLACK!r}D)), 1)) as bigint)"


def _column_of(lng: str) -> str:
    return f"floor(({lng} + 180D) / 360D * _cols)"


def _own_cells(sites: DataFrame, radius_km: float, lat: str, lng: str) -> DataFrame:
    """Each site once per level, with its cell and the cell's diagonal in km."""
    levels = ", ".join(str(i) for i in range(_levels(radius_km)))
    low, high = "(_row * _height - 90D)", "((_row + 1) * _height - 90D)"
    equatorward = f"(case when {low} * {high} <= 0 then 0D else least(abs({low}), abs({high})) end)"
    width_km = f"({360.0 * _KM_PER_DEGREE!r}D / _cols * cos(radians({equatorward})))"
    return (
        sites.selectExpr("*", f"explode(array({levels})) as _level")
        .selectExpr("*", f"{_row_height(radius_km)} as _height")
        .selectExpr("*", f"{_row_of(lat)} as _row")
        .selectExpr("*", f"{_columns_in_row(radius_km)} as _cols")
        .selectExpr(
            "*", f"pmod({_column_of(lng)}, _cols) as _col",
            f"sqrt(pow({width_km}, 2) + pow(_height * {_KM_PER_DEGREE!r}D, 2)) * {_SLACK!r}D as _diagonal",
        )
    )


def _search_cells(sites: DataFrame, radius_km: float) -> DataFrame:
    """Cells that can hold a point within ``_reach`` km of the site, on the finest level as wide as that."""
    finest = _levels(radius_km) - 1
    angle = f"(_reach * {_SLACK!r}D / {EARTH_KM!r}D)"
    level = f"floor(log2({radius_km * _SLACK!r}D / _reach))"
    near = f"sequence({_column_of('(_lng - _span)')}, {_column_of('(_lng + _span)')})"
    wrapped = f"array_distinct(transform({near}, c -> pmod(c, _cols)))"
    return (
        sites.selectExpr("*", f"cast(greatest(0, least({finest}, {level})) as int) as _level")
        .selectExpr("*", f"{_row_height(radius_km)} as _height", f"{_lng_reach(angle, '_lat')} as _span")
        .selectExpr(
            "*", f"explode(sequence(greatest(0L, {_row_of(f'(_lat - degrees({angle}))')}), "
            f"least(floor(180D / _height), {_row_of(f'(_lat + degrees({angle}))')}))) as _row",
        )
        .selectExpr("*", f"{_columns_in_row(radius_km)} as _cols")
        .selectExpr("*", f"explode(case when _span is null then sequence(0L, _cols - 1) else {wrapped} end) as _col")
    )


def nearest_pairs(
    points: DataFrame, radius_km: float = 10.0, k: int = 10, id: str = "id", lat: str = "lat", lng: str = "lng",
    candidate: Column | None = None,
) -> DataFrame:
    """(id, neighbour_id, distance_km, rank) for the k nearest within the radius.

    ``candidate`` says which points may be neighbours (all usable ones by default).
    """
    candidate = F.lit(True) if candidate is None else candidate
    usable = points.where(usable_coordinates(F.col(lat), F.col(lng))).select(
        F.col(id).alias("_id"), F.col(lat).cast("double").alias("_lat"), F.col(lng).cast("double").alias("_lng"), candidate.alias("_cand")
    )
    # Identical coordinates: only the k + 1 smallest ids of a site can be asked for.
    at_site = Window.partitionBy("_lat", "_lng").orderBy("_id")
    kept = usable.where("_cand").withColumn("_r", F.row_number().over(at_site)).where(F.col("_r") <= k + 1)
    cells = _own_cells(kept.select(F.col("_id").alias("_nid"), F.col("_lat").alias("_nlat"), F.col("_lng").alias("_nlng")), radius_km, "_nlat", "_nlng")
    key = ["_level", "_row", "_col"]
    crowded = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > k).select(*key)
    sites = usable.select("_lat", "_lng").distinct()
    bound = (
        _own_cells(sites, radius_km, "_lat", "_lng").join(crowded, key)
        .groupBy("_lat", "_lng").agg(F.min("_diagonal").alias("_diagonal"))
    )
    # whatever shows the same rounded distance as the bound still competes
    reach = F.least(F.lit(float(radius_km)), F.coalesce(F.round("_diagonal", 2) + 0.005 + 1e-9, F.lit(float(radius_km))))
    search = sites.join(bound, ["_lat", "_lng"], "left").select("_lat", "_lng", reach.alias("_reach"))
    found = _search_cells(search, radius_km).select("_lat", "_lng", "_reach", *key)
    pairs = found.join(cells.select("_nid", "_nlat", "_nlng", *key), key)
    pairs = pairs.withColumn("_d", haversine_km(F.col("_lat"), F.col("_lng"), F.col("_nlat"), F.col("_nlng")))
    pairs = pairs.where((F.col("_d") <= radius_km) & (F.col("_d") <= F.col("_reach")))
    pairs = pairs.withColumn("_shown", F.round("_d", 2))
    closest = Window.partitionBy("_lat", "_lng").orderBy("_shown", "_nid")
    pairs = pairs.withColumn("_r", F.row_number().over(closest)).where(F.col("_r") <= k + 1)
    per_site = pairs.groupBy("_lat", "_lng").agg(F.array_sort(F.collect_list(F.struct("_shown", "_nid"))).alias("_near"))
    # Each point drops itself from its site's list and keeps k.
    listed = usable.join(per_site, ["_lat", "_lng"]).withColumn(
        "_near", F.slice(F.filter("_near", lambda n: n["_nid"] != F.col("_id")), 1, k)
    )
    return listed.select("_id", F.posexplode("_near").alias("_p", "_m")).select(
        F.col("_id").alias(id), F.col("_m._nid").alias("neighbour_id"), F.col("_m._shown").alias("distance_km"),
        (F.col("_p") + 1).cast("int").alias("rank"),
    )
