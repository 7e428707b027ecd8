"""The three tables: incidents, areas, small areas; and the job that writes them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from precinct.functions.dates import month_from_name
from precinct.functions.geo import multipolygon_wkt
from precinct.functions.scores import cap_smallint, finite_or_null, rate_per_1000
from precinct.functions.text import clean_text, offence_code, slugify
from precinct.operators.copies import count_copies, expand_copies
from precinct.operators.dims import area_dimension, attach_population, code_remap, last_row_wins, remap
from precinct.operators.measures import area_measures, block_counts, event_cube
from precinct.operators.ordering import dense_rank_desc, exact_quantiles
from precinct.operators.polygons import explode_layer, validity
from precinct.operators.spatial import nearest_pairs
from precinct.operators.validation import AREA_RULES, BLOCK_RULES, INCIDENT_RULES, split_valid, with_errors
from precinct.schemas import AREA, BLOCK, INCIDENT, NEIGHBOURS
from precinct.session import few_or_shuffled, materialize, own_intermediates, shuffled
from precinct.sources import files
from precinct.sources.sinks import incident_month, save_tables, write_rejects


def build_incidents(raw: DataFrame, areas: DataFrame, blocks: DataFrame) -> DataFrame:
    """Clean, look up, re-code and project raw rows; rows of unknown areas are left out.

    ``areas`` and ``blocks`` come from ``area_dimension`` and ``code_remap``.
    Columns of ``raw`` beyond the source ones (row number, copies) are kept.
    """
    source = {"area_unit", "territorial_authority", "meshblock", "year_month", "division", "anzsoc_group"}
    extra = [c for c in raw.columns if c not in source]
    keyed = raw.withColumn("area_key", clean_text(F.col("area_unit")))
    matched = keyed.join(areas.select("area_key", "suburb_id"), "area_key").where(F.col("suburb_id") != "")
    coded = remap(matched, blocks, "meshblock", "meshblock_code")
    return coded.select(
        *extra, "suburb_id", month_from_name(F.col("year_month")).alias("victimisation_date"),
        offence_code(F.col("division")).alias("offence_code"), F.col("division").alias("offence_category"),
        F.col("anzsoc_group").alias("offence_description"), "meshblock_code", F.col("area_key").alias("AU2017_name"),
    )


def incident_cube(raw: DataFrame, areas: DataFrame) -> DataFrame:
    """Event cube straight from raw rows, for measures that need no single incident.

    Raw rows are counted by area text, month text and division first, map-side, so that only partial counts are shuffled; the few
    groups that are left are then cleaned, looked up and coded.
    """
    counted = raw.groupBy("area_unit", "year_month", "division").agg(F.count(F.lit(1)).alias("copies"), F.min("row_no").alias("row_no"))
    matched = counted.withColumn("area_key", clean_text(F.col("area_unit"))).join(areas.select("area_key", "suburb_id"), "area_key")
    rows = matched.where(F.col("suburb_id") != "").select(
        "suburb_id", month_from_name(F.col("year_month")).alias("victimisation_date"), offence_code(F.col("division")).alias("offence_code"),
        F.col("area_key").alias("AU2017_name"), "row_no", "copies")
    return event_cube(rows, weight="copies")


def split_incidents(incidents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected records) of counted incidents, evaluated once.

    Valid rows stay counted. Of the rejected ones every single record comes out, with its id and what is wrong with it. Ids start
    from the content hash, so the rules for ids are tried on that.
    """
    checked = materialize(with_errors(incidents.withColumn("event_id", F.col("source_key")), INCIDENT_RULES).drop("event_id"), "checked-incidents")
    valid = checked.where(F.size("errors") == 0).drop("errors")
    bad = expand_copies(checked.where(F.size("errors") > 0))
    return valid, bad.select(F.struct(*INCIDENT).alias("original_record"), "errors")


def layer_dimension(layer: DataFrame, key: str) -> DataFrame:
    """key -> lat, lng, geometry (WKT, null when invalid); the last feature of a key wins."""
    last = materialize(last_row_wins(layer, key, "row_no", ["lat", "lng", "coordinates"]), "layer")
    sound = validity(explode_layer(last, key))
    # the text stands in the row already: only the verdict is joined
    text = multipolygon_wkt(F.col("coordinates"), F.size("coordinates") > 1)
    return last.join(shuffled(sound), last[key] == sound["feature_id"], "left").select(F.col(key), "lat", "lng", F.when(F.col("is_valid"), text).alias("geometry"))


def build_areas(
    cube: DataFrame, areas: DataFrame, layer: DataFrame | None = None, as_of: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid area rows, rejected area rows) from the event cube.

    ``areas`` is the area dimension with ``population`` (see ``attach_population``),
    ``layer`` is (name, lat, lng, geometry), see ``layer_dimension``.
    """
    if "population" not in areas.columns:
        areas = attach_population(areas, None)
    measures = area_measures(cube, as_of)
    joined = measures.withColumnRenamed("area", "group_id").join(
        areas, F.col("label") == F.col("area_key"), "left"
    )
    joined = joined.withColumns(
        {
            "suburb_id": F.coalesce("suburb_id", "group_id"), "AU2017_name": F.col("label"),
            "name": F.coalesce("name", "label"),
            "council": F.coalesce("council", F.lit("")), "location_type": F.coalesce("location_type", F.lit("")),
        }
    )
    if layer is None:
        located = joined.withColumns({"lat": F.lit(None).cast("double"), "lng": F.lit(None).cast("double"), "geometry": F.lit(None).cast("string")})
    else:
        located = joined.join(layer.select(F.col("name"), "lat", "lng", "geometry"), "name", "left")
    empty = F.lit("")
    rows = located.withColumns(
        {
            "slug": slugify(F.col("name")), "safety_score": F.lit(0.0),
            "crime_rate_per_1000": rate_per_1000(F.col("total_12m"), F.col("population")),
            "total_crimes_12m": cap_smallint(F.col("total_12m")), "rank_in_region": F.lit(0),
            "report_url": empty, "widget_embed_code": empty, "summary_text": empty,
            "tags": F.array().cast("array<string>"), "nearby_suburbs": F.array().cast(NEIGHBOURS),
        }
    ).select(*AREA)
    valid, rejected = split_valid(materialize(rows, "areas"), AREA_RULES)
    ranked = dense_rank_desc(valid.drop("rank_in_region"), "region", "crime_rate_per_1000", "rank_in_region")
    numbers = ["crime_rate_per_1000", "trend_3m_change", "lat", "lng", "safety_score"]
    ranked = ranked.withColumns({c: finite_or_null(F.col(c)) for c in numbers})
    ranked = ranked.fillna(0, subset=[*numbers, "total_crimes_12m", "rank_in_region"])
    ranked = ranked.withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
    return ranked.select(*AREA), rejected


def attach_nearby(areas: DataFrame, radius_km: float = 25.0, k: int = 3) -> DataFrame:
    """Fill ``nearby_suburbs`` with the k nearest areas within the radius, nearest first."""
    pairs = nearest_pairs(areas, radius_km, k, "suburb_id", "lat", "lng", candidate=F.coalesce(F.col("slug") != "", F.lit(False)))
    shown = areas.select(F.col("suburb_id").alias("neighbour_id"), "slug", "name", "region")
    entry = F.struct("rank", F.struct(F.col("neighbour_id").alias("suburb_id"), "slug", "name", "region", "distance_km").alias("e"))
    lists = (
        pairs.join(shown, "neighbour_id").groupBy("suburb_id")
        .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda n: n["e"]).cast(NEIGHBOURS).alias("nearby_suburbs"))
    )
    out = areas.drop("nearby_suburbs").join(lists, "suburb_id", "left")
    return out.withColumn("nearby_suburbs", F.coalesce("nearby_suburbs", F.array().cast(NEIGHBOURS)))


def build_blocks(
    incidents: DataFrame, layer: DataFrame | None = None, row_no: str = "row_no", weight: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) small-area rows: count, first area, centroid and geometry.

    ``layer`` is (id, lat, lng, geometry). A block missing from it keeps 0 / 0;
    one that is in it keeps whatever the layer says.
    """
    counted = block_counts(incidents, "meshblock_code", "suburb_id", row_no, weight)
    known = incidents.select("suburb_id").distinct()
    counted = counted.join(known, "suburb_id", "left_semi")
    if layer is None:
        rows = counted.withColumns({"lat": F.lit(0.0), "lng": F.lit(0.0), "geometry": F.lit(None).cast("string")})
    else:
        shape = layer.select("id", F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), "geometry", F.lit(True).alias("_hit"))
        rows = counted.join(shuffled(shape), "id", "left")
        fill = lambda c: finite_or_null(F.when(F.col("_hit"), F.col(c)).otherwise(F.lit(0.0)))
        rows = rows.withColumns({"lat": fill("_lat"), "lng": fill("_lng")})
    return split_valid(materialize(rows.select(*BLOCK), "blocks"), BLOCK_RULES)


def area_statistics(areas: DataFrame) -> DataFrame:
    """Quartiles of rate and 12-month total, plus count, sum and mean: one row."""
    both = areas.selectExpr(
        "stack(2, 'rate', cast(crime_rate_per_1000 as double), 'total', cast(total_crimes_12m as double)) as (measure, value)"
    )
    quartiles = exact_quantiles(both, ["measure"], "value", {f"p{25 * p}": ("inclusive", p, 4) for p in (1, 2, 3)})
    plain = both.groupBy("measure").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum"), F.avg("value").alias("mean"))
    of = lambda measure, column: F.max(F.when(F.col("measure") == measure, F.col(column)))
    return plain.join(quartiles, "measure", "left").agg(
        F.coalesce(of("total", "n"), F.lit(0)).alias("n_areas"), of("total", "sum").cast("bigint").alias("total_crimes"),
        of("rate", "mean").alias("mean_rate"),
        *[of(m, f"p{p}").alias(f"{m}_p{p}") for m in ("rate", "total") for p in (25, 50, 75)],
    )


@dataclass
class Inputs:
    """Paths of one load. Census and layers may be missing.

    ``source`` names the load in the ids of its incidents; by default each file's path does.
    """

    incidents: str
    concordance: str
    census: str | None = None
    area_layer: str | None = None
    block_layer: str | None = None
    encoding: str | None = None
    layer_lines: bool = False
    source: str | None = None


def run_build(
    spark: SparkSession, inputs: Inputs, out: str, nearby: bool = True, parts: int = 16, radius_km: float = 25.0, k: int = 3
) -> dict:
    """Read the sources, build the three tables and upsert them; rejects go to JSON.

    The incident file is read once, into distinct rows with counts; everything
    after that works on reduced tables in the shared folder, which go when the job has ended.
    """
    with own_intermediates(spark):
        return _run_build(spark, inputs, out, nearby, parts, radius_km, k)


def _run_build(spark: SparkSession, inputs: Inputs, out: str, nearby: bool, parts: int, radius_km: float, k: int) -> dict:
    concordance = files.read_concordance(spark, inputs.concordance)
    areas = materialize(area_dimension(concordance), "area-dimension")
    blocks = few_or_shuffled(materialize(code_remap(concordance), "block-remap"))
    census = materialize(files.read_census(spark, inputs.census), "census") if inputs.census else None
    sized = materialize(attach_population(areas, census), "area-population")
    area_layer = layer_dimension(files.read_area_layer(spark, inputs.area_layer, lines=inputs.layer_lines), "name") if inputs.area_layer else None
    block_layer = layer_dimension(files.read_block_layer(spark, inputs.block_layer, lines=inputs.layer_lines), "id") if inputs.block_layer else None

    counted = count_copies(files.read_incidents(spark, inputs.incidents, inputs.encoding, inputs.source), "row_no")
    incidents, bad_incidents = split_incidents(build_incidents(counted, areas, blocks))
    cube = materialize(event_cube(incidents, weight="copies"), "cube")

    suburbs, bad_areas = build_areas(cube, sized, area_layer)
    if nearby:
        suburbs = attach_nearby(materialize(suburbs, "ranked"), radius_km, k)
    meshblocks, bad_blocks = build_blocks(incidents, block_layer, weight="copies")
    events = expand_copies(incidents, cluster=incident_month()).select(*INCIDENT)
    tables = save_tables(spark, out, suburbs.select(*AREA), meshblocks, events, parts)
    for name, rejected in (("crimes", bad_incidents), ("suburbs", bad_areas), ("meshblocks", bad_blocks)):
        write_rejects(rejected, f"{out}/rejected/{name}")
    return tables
