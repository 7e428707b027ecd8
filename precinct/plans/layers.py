"""Polygon layer preparation: reproject, centroids, optional thinning, order and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from precinct.operators.polygons import centroids, collect_layer, explode_layer, reproject, simplify
from precinct.session import materialize, shuffled
from precinct.sources.sinks import write_collection, write_layer, write_layer_batches


def sort_layer(layer: DataFrame, column: str, tie: str) -> DataFrame:
    """Ascending by a column, nulls last; an unknown column is an error."""
    if column not in layer.columns:
        raise ValueError(f"no column {column} to sort by")
    return layer.orderBy(F.col(column).asc_nulls_last(), tie)


def prepare_layer(layer: DataFrame, feature_id: str, epsg: int = 4326, tolerance: float | None = None) -> DataFrame:
    """The layer in WGS84 with ``latitude`` / ``longitude`` of its centroids, thinned if asked.

    ``layer`` has ``geometry_type`` and nested ``coordinates`` besides its own columns.
    """
    properties = [c for c in layer.columns if c not in ("coordinates", "row_no")]
    vertices = explode_layer(layer, feature_id)
    if epsg != 4326:
        vertices = reproject(vertices, epsg)
    vertices = materialize(vertices, "vertices")
    centres = centroids(vertices)
    shapes = collect_layer(simplify(vertices, tolerance) if tolerance is not None else vertices)
    out = layer.select(*properties)
    for part in (centres, shapes):
        out = out.join(shuffled(part.withColumnRenamed("feature_id", feature_id)), feature_id, "left")
    return out.select(*properties, "longitude", "latitude", "coordinates")


def write_prepared(layer: DataFrame, path: str, feature_id: str, sort: str | None = None, batch: int | None = None, lines: bool = True) -> None:
    """One set of Feature lines, or one FeatureCollection, in parts or with ``batch`` features to a file."""
    properties = [c for c in layer.columns if c not in ("coordinates", "geometry_type")]
    if sort is not None and sort not in layer.columns:
        raise ValueError(f"no column {sort} to sort by")
    order = ([F.col(sort).asc_nulls_last()] if sort else []) + [F.col(feature_id)]
    if batch is None and not lines:
        write_collection(layer, path, properties, order)
    elif batch is None:
        write_layer(sort_layer(layer, sort, feature_id) if sort else layer, path, properties)
    else:
        write_layer_batches(layer, path, properties, order, batch)
