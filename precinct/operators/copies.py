"""Counted representation of repeated source rows.

Incident files carry few distinct rows compared with their length. Grouping
them first (map-side, so a row repeated a billion times shuffles once per
task) lets every later step work on distinct rows with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COPIES_PER_CHUNK = 1 << 16
COPIES_PER_PIECE = 16


def count_copies(raw: DataFrame, row_no: str, source: str = "source") -> DataFrame:
    """Distinct source rows with ``copies``, their first ``row_no`` and a content hash.

    Rows are copies of each other if all columns but ``row_no`` agree. ``source``, the file or load a row came from, is one of
    them: equal rows of two loads are different incidents, and loading a source again finds its own.
    """
    keys = [c for c in raw.columns if c != row_no]
    if source not in keys:
        raise ValueError(f"rows need a column {source}, or equal rows of two loads would share ids")
    counted = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min(row_no).alias(row_no))
    return counted.withColumn("source_key", F.sha2(F.to_json(F.struct(*keys)), 256))


def _cut(rows: DataFrame, start: str, stop: str, size: int) -> DataFrame:
    """Split each row's copies [start, stop) into rows of at most ``size`` copies."""
    cut = rows.withColumn("_at", F.expr(f"explode(sequence({start}, {stop} - 1, {size}L))"))
    return cut.withColumns({"_from": F.col("_at"), "_to": F.expr(f"least(_at + {size}L, {stop})")}).drop("_at")


def expand_copies(counted: DataFrame, out: str = "event_id", cluster: Column | None = None) -> DataFrame:
    """One row per copy; the id depends on content and copy number only.

    A hot row is cut into chunks that are spread over tasks, so no task writes
    all of its copies. With ``cluster`` the rows come out grouped by that value
    for a partitioned write: small pieces of the counted rows are shuffled for
    it, never the single copies.
    """
    whole = counted.withColumns({"_from": F.lit(0).cast("bigint"), "_to": F.col("copies")})
    pieces = _cut(whole, "_from", "_to", COPIES_PER_CHUNK)
    if cluster is None:
        pieces = pieces.repartition("source_key", "_from")
    else:
        pieces = _cut(pieces, "_from", "_to", COPIES_PER_PIECE).withColumn("_cluster", cluster)
        pieces = pieces.hint("rebalance", "_cluster").drop("_cluster")
    rows = pieces.withColumn("_copy", F.expr("explode(sequence(_from, _to - 1))"))
    ident = F.sha2(F.concat_ws("#", "source_key", F.col("_copy").cast("string")), 256)
    return rows.withColumn(out, ident).drop("_from", "_to", "_copy", "copies", "source_key")
