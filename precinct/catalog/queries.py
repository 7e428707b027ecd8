"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from precinct.catalog import views
from precinct.functions.dates import dates_as_text, iso_day, month_from_name
from precinct.functions.geo import NZTM2000
from precinct.functions.scores import rate_per_1000
from precinct.functions.text import clean_text, contains_either, map_as_text, offence_code, slugify, text_as_counts
from precinct.operators import dims, measures, polygons
from precinct.operators.copies import count_copies, expand_copies
from precinct.operators.ordering import dense_rank_desc, number_rows
from precinct.operators.spatial import nearest_pairs
from precinct.operators.validation import AREA_RULES, BLOCK_RULES, INCIDENT_RULES, reject_reasons, split_valid, summary
from precinct.plans import build, layers, metrics as metric_plans, serving
from precinct.schemas import INCIDENT, METRIC
from precinct.session import few_or_shuffled, materialize, scratch_path, shuffled
from precinct.sources import files, pages, sinks
from precinct.sources.keyed_table import KeyedTable
from precinct.streaming import incremental

# The areas of the test tables lie far apart, so their neighbours are looked for in a wider circle.
WIDE_KM = 150.0


@lru_cache(maxsize=4)
def _dims(spark, d):
    """Area dimension and code remap (plans only, no data is held)."""
    c = views.concordance(spark, d)
    return dims.area_dimension(c), dims.code_remap(c)


def _sized(spark, d) -> DataFrame:
    """Area dimension with population."""
    areas = materialize(_dims(spark, d)[0], "area-dimension")
    return materialize(dims.attach_population(areas, views.census(spark, d)), "area-population")


def _counted(spark, d) -> DataFrame:
    """Matched incidents as distinct rows with copies."""
    areas, blocks = _dims(spark, d)
    return build.build_incidents(count_copies(views.incidents_raw(spark, d), "row_no"), areas, few_or_shuffled(materialize(blocks, "block-remap")))


def _incidents(spark, d) -> DataFrame:
    return expand_copies(build.split_incidents(_counted(spark, d))[0]).select(*INCIDENT)


def _stored(spark, d) -> KeyedTable:
    """The incident table as the job stores it: in parts by month."""
    table = KeyedTable(spark, scratch_path(spark, "crimes"), ["event_id"], part=sinks.incident_month(), sort=("suburb_id",))
    valid = build.split_incidents(_counted(spark, d))[0]
    table.upsert(expand_copies(valid, cluster=sinks.incident_month()).select(*INCIDENT).drop("AU2017_name"), clustered=True, unique=True)
    return table


def _reduced(spark, d) -> DataFrame:
    """Event cube from one scan of the raw rows."""
    return build.incident_cube(views.incidents_raw(spark, d), _dims(spark, d)[0])


def _cube(spark, d) -> DataFrame:
    return materialize(_reduced(spark, d), "cube")


def _layer(spark, d) -> DataFrame:
    """Area layer: place name, point of the customer, polygon."""
    c = views.concordance(spark, d).select(F.col("row_no").alias("id"), F.col("SA22023_name_ascii").alias("name"))
    shapes = polygons.collect_layer(views.vertices(spark, d))
    return c.join(shuffled(views.points(spark, d)), "id").join(shuffled(shapes), F.col("id") == F.col("feature_id")).select(
        F.col("id").alias("row_no"), "name", "lat", "lng", "coordinates"
    )


def _block_layer(spark, d) -> DataFrame:
    """Small-area layer keyed by the new code; customers of every ninth key have no shape."""
    c = views.concordance(spark, d).select(F.col("row_no").alias("key"), F.col("MB2023_code").alias("code"))
    p = views.points(spark, d).withColumnRenamed("id", "key")
    shapes = polygons.collect_layer(views.vertices(spark, d))
    joined = c.join(shuffled(p), "key").join(shuffled(shapes), F.col("key") == F.col("feature_id"))
    return joined.select(
        F.col("key").alias("row_no"), F.col("code").alias("id"), "lat", "lng",
        F.when(F.col("key") % 9 != 0, F.col("coordinates")).alias("coordinates"),
    )


def _areas(spark, d, shapes: bool = False) -> tuple[DataFrame, DataFrame]:
    layer = build.layer_dimension(_layer(spark, d), "name") if shapes else None
    return build.build_areas(_cube(spark, d), _sized(spark, d), layer)


def _located_areas(spark, d) -> DataFrame:
    """Areas with coordinates but without shapes, for lookups and neighbours."""
    spots = dims.last_row_wins(_layer_points(spark, d), "name", "row_no", ["lat", "lng"]).withColumn("geometry", F.lit(None).cast("string"))
    return build.build_areas(_cube(spark, d), _sized(spark, d), spots)[0]


def _layer_points(spark, d) -> DataFrame:
    c = views.concordance(spark, d).select(F.col("row_no").alias("id"), F.col("SA22023_name_ascii").alias("name"))
    return c.join(shuffled(views.points(spark, d)), "id").withColumnRenamed("id", "row_no")


def _flat(df: DataFrame) -> DataFrame:
    """Area rows with maps and lists as text."""
    codes = F.array_join(F.transform(F.map_entries("crime_breakdown"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    near = F.array_join(F.transform("nearby_suburbs", lambda n: n["suburb_id"]), ",")
    flat = {
        "crime_breakdown": codes, "peak_crime_months": F.array_join("peak_crime_months", ","), "nearby_suburbs": near,
        "total_crimes_12m": F.col("total_crimes_12m").cast("bigint"), "rank_in_region": F.col("rank_in_region").cast("bigint"),
    }
    if "tags" in df.columns:
        flat["tags"] = F.array_join("tags", ",")
    return df.withColumns(flat)


# ---------------------------------------------------------------- text, codes, dates


def clean_text_areas(spark, d):
    return views.incidents_raw(spark, d).select("row_no", clean_text(F.col("area_unit")).alias("area"))


def slugify_names(spark, d):
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    parts = views.table(spark, d, "part").select(F.col("p_partkey").alias("id"), slugify(name).alias("slug"))
    places = views.concordance(spark, d).select((-1 - F.col("row_no")).alias("id"), slugify(F.col("SA22023_name")).alias("slug"))
    return parts.unionByName(places)


def incident_codes(spark, d):
    return views.incidents_raw(spark, d).select("row_no", offence_code(F.col("division")).alias("code"))


def month_parse(spark, d):
    return views.incidents_raw(spark, d).select("row_no", iso_day(month_from_name(F.col("year_month"))).alias("month"))


# ---------------------------------------------------------------- incidents and dimensions


def incidents_built(spark, d):
    return _incidents(spark, d).withColumn("victimisation_date", iso_day(F.col("victimisation_date")))


def incidents_unmatched(spark, d):
    raw = views.incidents_raw(spark, d).withColumn("area_key", clean_text(F.col("area_unit")))
    return dims.unmatched(raw, _dims(spark, d)[0], "area_key")


def last_wins_dim(spark, d):
    return _dims(spark, d)[0]


def meshblock_remap(spark, d):
    raw = views.incidents_raw(spark, d).select("row_no", "meshblock")
    return dims.remap(raw, few_or_shuffled(materialize(_dims(spark, d)[1], "block-remap")), "meshblock", "meshblock_code")


def area_block_list(spark, d):
    return dims.area_blocks(views.concordance(spark, d))


def mapping_fanout(spark, d):
    c = views.concordance(spark, d)
    there = dims.mapping_fanout(c, "AU2017_name", "SA22023_name_ascii").withColumn("direction", F.lit("old to new"))
    back = dims.mapping_fanout(c, "SA22023_name_ascii", "AU2017_name").withColumn("direction", F.lit("new to old"))
    return there.unionByName(back)


def area_counts(spark, d):
    return _reduced(spark, d).agg(F.countDistinct("label").alias("n_names"), F.countDistinct("area").alias("n_areas"))


# ---------------------------------------------------------------- measures


def rolling_12m(spark, d):
    return measures.rolling_total(_cube(spark, d), "area", "date", "n")


def _months(spark, d):
    return measures.monthly_counts(_reduced(spark, d), "area", "date", "n")


def monthly_counts(spark, d):
    return _months(spark, d).withColumn("month", iso_day(F.col("month")))


def trend_3m(spark, d):
    return measures.trend(_months(spark, d))


def peak_months(spark, d):
    return measures.peak_months(_months(spark, d)).withColumn("peak_crime_months", F.array_join("peak_crime_months", ","))


def breakdown_map(spark, d):
    m = measures.breakdown(_reduced(spark, d), "area", "code", "n")
    text = F.transform(F.map_entries("crime_breakdown"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return m.select("area", F.array_join(text, ",").alias("codes"))


def area_measures(spark, d):
    m = measures.area_measures(_cube(spark, d))
    text = F.transform(F.map_entries("crime_breakdown"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return m.withColumns({"crime_breakdown": F.array_join(text, ","), "peak_crime_months": F.array_join("peak_crime_months", ",")})


def _names(spark, d):
    return _dims(spark, d)[0].select("area_key", "name_orig")


def population_exact(spark, d):
    exact = dims.first_row_wins(views.census(spark, d).where(F.col("census_year") == 2023), "area", "row_no", ["value"])
    return _names(spark, d).join(exact, F.col("name_orig") == F.col("area"), "left").select("area_key", F.col("value").alias("population"))


def population_fuzzy(spark, d):
    return dims.attach_population(_names(spark, d), views.census(spark, d)).select("area_key", "name_orig", "population")


def _rated(spark, d):
    """Area, region and rate, without the rest of the area table."""
    m = measures.area_measures(_cube(spark, d)).select("area", "label", "total_12m", "crime_trend", "trend_3m_change")
    m = m.join(_sized(spark, d).select("area_key", "name", "region", "population"), F.col("label") == F.col("area_key"))
    return materialize(m.withColumn("crime_rate_per_1000", rate_per_1000(F.col("total_12m"), F.col("population"))), "rated")


def rate_rank(spark, d):
    return dense_rank_desc(_rated(spark, d), "region", "crime_rate_per_1000", "rank_in_region").select(
        "area", "region", "crime_rate_per_1000", F.col("rank_in_region").cast("bigint").alias("rank_in_region")
    )


def area_flagship(spark, d):
    """Areas ranked by incident rate in their region, with trend."""
    ranked = dense_rank_desc(_rated(spark, d), "region", "crime_rate_per_1000", "rank_in_region")
    return ranked.select(
        "area", "name", "region", "population", "total_12m", "crime_rate_per_1000", "crime_trend", "trend_3m_change",
        F.col("rank_in_region").cast("bigint").alias("rank_in_region"),
    )


# ---------------------------------------------------------------- tables


def areas_built(spark, d):
    return _flat(_areas(spark, d, shapes=True)[0])


def meshblocks_built(spark, d):
    layer = build.layer_dimension(_block_layer(spark, d), "id")
    return build.build_blocks(materialize(_counted(spark, d), "incidents"), layer, weight="copies")[0]


def areas_with_nearby(spark, d):
    near = build.attach_nearby(materialize(_located_areas(spark, d), "areas"), WIDE_KM, 3)
    return near.select("suburb_id", F.posexplode("nearby_suburbs").alias("pos", "n")).select(
        "suburb_id", "pos", F.col("n.suburb_id").alias("near_id"), "n.slug", "n.name", "n.region", "n.distance_km"
    )


def _nearest(spark, d, radius, k):
    return nearest_pairs(materialize(views.points(spark, d), "points"), radius, k).select(
        "id", "neighbour_id", "distance_km", F.col("rank").cast("bigint").alias("rank")
    )


def nearby_topk(spark, d):
    return _nearest(spark, d, 25.0, 3)


def nearby_default(spark, d):
    return _nearest(spark, d, 10.0, 10)


def area_statistics(spark, d):
    stats = build.area_statistics(materialize(_areas(spark, d)[0], "areas"))
    return stats.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes])


# ---------------------------------------------------------------- reads


def filter_areas_page(spark, d):
    return serving.query_areas(
        _areas(spark, d)[0], page=2, page_size=10, region="ASIA", min_crime_rate=0.5, max_total_crimes=5000,
        columns=["suburb_id", "name", "crime_rate_per_1000", "crime_trend"],
    )


def filter_incidents_month(spark, d):
    found = serving.query_stored_incidents(_stored(spark, d), page=2, page_size=25, month="1997-03", offence_code="8")
    return found.withColumn("victimisation_date", iso_day(F.col("victimisation_date")))


def filter_incidents_council(spark, d):
    found = serving.query_stored_incidents(
        _stored(spark, d), _areas(spark, d)[0], district="NATION_7", start_date="1996-02-01", end_date="1997-06-01", page_size=1000
    )
    return found.select("event_id", "suburb_id", iso_day(F.col("victimisation_date")).alias("victimisation_date"))


def area_detail(spark, d):
    return _flat(serving.query_area(_located_areas(spark, d), "100050"))


def meshblocks_of_area(spark, d):
    blocks = build.build_blocks(materialize(_counted(spark, d), "incidents"), weight="copies")[0]
    return serving.query_blocks(blocks, "100050").select("id", "suburb_id", "crime_count")


def area_reports(spark, d):
    return serving.area_reports(_areas(spark, d)[0])


# ---------------------------------------------------------------- validation, upsert, files


def _flawed_incidents(spark, d):
    inc = _incidents(spark, d).withColumn("_k", F.conv(F.substring("event_id", 1, 4), 16, 10).cast("int"))
    return inc.withColumns(
        {
            "suburb_id": F.when(F.col("_k") % 10 == 0, "").otherwise(F.col("suburb_id")),
            "offence_category": F.when(F.col("_k") % 15 == 0, F.repeat(F.lit("x"), 201)).otherwise(F.col("offence_category")),
        }
    ).drop("_k")


def validate_incidents_split(spark, d):
    return summary(_flawed_incidents(spark, d), INCIDENT_RULES)


def _rejected(spark, d) -> DataFrame:
    """Rejected records where every fiftieth raw row has an over-long group."""
    raw = views.incidents_raw(spark, d)
    raw = raw.withColumn("anzsoc_group", F.when(F.col("row_no") % 50 == 0, F.repeat(F.lit("x"), 501)).otherwise(F.col("anzsoc_group")))
    areas, blocks = _dims(spark, d)
    return build.split_incidents(build.build_incidents(count_copies(raw, "row_no"), areas, few_or_shuffled(materialize(blocks, "block-remap"))))[1]


def _reject_counts(rejected: DataFrame) -> DataFrame:
    each = rejected.select("original_record.*", F.explode("errors").alias("e"))
    return each.groupBy("suburb_id", "offence_code", F.concat_ws(":", "e.field", "e.rule").alias("what")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids"))


def rejects_of_build(spark, d):
    return _reject_counts(_rejected(spark, d))


def rejects_written(spark, d):
    """The same records through the reject files."""
    path, rejected = scratch_path(spark, "rejects"), _rejected(spark, d)
    sinks.write_rejects(rejected, path)
    return _reject_counts(spark.read.schema(rejected.schema).json(path))


def validate_areas_reasons(spark, d):
    """Customers as area rows, with values out of range."""
    c = views.points(spark, d).join(views.table(spark, d, "customer"), F.col("id") == F.col("c_custkey"))
    rows = c.select(
        F.col("id").cast("string").alias("suburb_id"), F.col("c_name").alias("name"), slugify(F.col("c_name")).alias("slug"),
        F.when(F.col("id") % 20 == 0, F.lit(float("nan"))).when(F.col("id") % 21 == 0, F.lit(None)).otherwise(F.col("lat") * 2.1).alias("lat"),
        (F.col("lng") + 5).alias("lng"), F.col("c_acctbal").alias("crime_rate_per_1000"),
        F.when(F.col("id") % 17 == 0, "sideways").otherwise("up").alias("crime_trend"), F.col("c_acctbal").cast("bigint").alias("population"),
    )
    return reject_reasons(split_valid(rows, AREA_RULES)[1])


def validate_blocks(spark, d):
    p = views.table(spark, d, "part")
    rows = p.select(
        F.when(F.col("p_partkey") % 30 == 0, "").otherwise(F.col("p_partkey").cast("string")).alias("id"), F.col("p_brand").alias("suburb_id"),
        (F.col("p_size") - 3).cast("bigint").alias("crime_count"), (F.col("p_retailprice") / 12).alias("lat"), (F.col("p_retailprice") / 6).alias("lng"),
    )
    return reject_reasons(split_valid(rows, BLOCK_RULES)[1])


def upsert_snapshot(spark, d):
    """Customers, then suppliers' and nations' balances upserted on top by key, twice."""
    t = KeyedTable(spark, scratch_path(spark, "keyed"), ["id"], 8)
    t.upsert(views.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount")))
    updates = views.table(spark, d, "orders").select(
        (F.col("o_custkey") * 2).alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("_o")
    )
    best = updates.groupBy("id").agg(F.max_by("amount", "_o").alias("amount"))
    for _ in range(2):
        t.upsert(best)
    return t.read()


def _write_tsv(spark, d, meshblock=None) -> str:
    path = scratch_path(spark, "incidents-tsv")
    raw = views.incidents_raw(spark, d)
    # the writer keeps blanks so that the reader has something to trim
    raw.select(
        F.col("area_unit").alias("Area Unit"), F.lit("").alias("Territorial Authority"), (F.col("meshblock") if meshblock is None else meshblock).alias("Meshblock"),
        F.col("year_month").alias(" Year Month "), F.col("division").alias("ANZSOC Division"), F.col("anzsoc_group").alias("ANZSOC Group"),
    ).write.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def tsv_scan(spark, d):
    """Incidents written as a tab-separated file, some blocks as missing in one way or another, and read back, counted per distinct row."""
    markers = F.element_at(F.array(*[F.lit(x) for x in files.MISSING]), (F.col("row_no") % len(files.MISSING) + 1).cast("int"))
    df = files.read_incidents(spark, _write_tsv(spark, d, F.when(F.col("row_no") % 41 == 0, markers).otherwise(F.col("meshblock"))))
    return df.groupBy("area_unit", "year_month", "meshblock", "division", "anzsoc_group").agg(F.count(F.lit(1)).alias("n"))


def _area_features(spark, d) -> DataFrame:
    """The area layer with the columns of its features."""
    return _layer(spark, d).select(
        F.col("row_no").alias("id"), F.col("name").alias("SA22023__2"), F.col("lat").alias("latitude"), F.col("lng").alias("longitude"),
        F.when(F.size("coordinates") > 1, "MultiPolygon").otherwise("Polygon").alias("geometry_type"), "coordinates",
    )


def _block_features(spark, d) -> DataFrame:
    return _block_layer(spark, d).select(
        F.col("row_no").alias("key"), F.col("id").alias("MB2023_V1_"), F.col("lat").alias("latitude"), F.col("lng").alias("longitude"),
        F.lit("MultiPolygon").alias("geometry_type"), "coordinates",
    )


def geojson_layer(spark, d):
    """The polygon layer written as Feature lines and read back as WKT."""
    path = scratch_path(spark, "layer")
    sinks.write_layer(_area_features(spark, d), path, ["id", "SA22023__2", "latitude", "longitude"])
    back = files.read_layer(spark, path, {"id": "double", "SA22023__2": "string", "latitude": "double", "longitude": "double"}, lines=True)
    wkt = polygons.layer_wkt(polygons.explode_layer(back.withColumn("id", F.col("id").cast("bigint")), "id"))
    return back.select(F.col("id").cast("bigint").alias("id"), F.col("SA22023__2").alias("name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).join(
        shuffled(wkt.withColumnRenamed("feature_id", "id")), "id"
    )


def _block_lines(spark, d, path: str) -> None:
    """The small-area layer as Feature lines."""
    sinks.write_layer(_block_features(spark, d), path, ["MB2023_V1_", "latitude", "longitude"])


def block_layer_scan(spark, d):
    """The small-area layer written as Feature lines and read back."""
    path = scratch_path(spark, "blocks")
    _block_lines(spark, d, path)
    back = files.read_block_layer(spark, path, lines=True)
    return back.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("lat"), 6).alias("lat"), F.round(F.max("lng"), 6).alias("lng"))


def appended_rows(spark, d):
    """Customers inserted in two loads."""
    path, customers = scratch_path(spark, "appended"), views.table(spark, d, "customer")
    for odd in (0, 1):
        sinks.append_rows(customers.where(F.col("c_custkey") % 2 == odd).select("c_nationkey", "c_acctbal"), path)
    back = files.scan_table(spark, path, ["c_nationkey", "c_acctbal"])
    return back.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def csv_export(spark, d):
    """The area table exported as CSV and read back, with its counts as a map again."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(_areas(spark, d)[0], path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    counts, peaks = text_as_counts(F.col("crime_breakdown")), F.from_json("peak_crime_months", "array<string>")
    codes = F.array_join(F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return back.select(
        "suburb_id", "name", F.col("population").cast("bigint").alias("population"), F.col("total_crimes_12m").cast("bigint").alias("total_crimes_12m"),
        codes.alias("crime_breakdown"), F.array_join(peaks, ",").alias("peak_crime_months"), "crime_trend")


def stored_columns(spark, d):
    """Two columns of the stored incidents."""
    return _stored(spark, d).read().select("suburb_id", "offence_code").groupBy("suburb_id", "offence_code").agg(F.count(F.lit(1)).alias("n"))


def limited_lookup(spark, d):
    return files.scan_limited(_areas(spark, d)[0], ["suburb_id", "AU2017_name"], 10, suburb_id="100050")


def incident_pages(spark, d):
    """A deep page of the incidents laid out by id, and the rows that follow its last one."""
    path = scratch_path(spark, "pages")
    pages.write_pages(materialize(_incidents(spark, d), "incidents"), path, "event_id", files=8, rows=2000)
    page = pages.read_page(spark, path, "event_id", 30, 50)
    rest = pages.read_after(spark, path, "event_id", page.agg(F.max("event_id")).first()[0] or "", 70)
    named = lambda rows, which: rows.select(F.lit(which).alias("which"), "event_id", "suburb_id", "offence_code")
    return named(page, "page").unionByName(named(rest, "after"))


def crimes_stored(spark, d):
    """The stored incident table, which has no helper column."""
    crimes = _stored(spark, d).read()
    if "AU2017_name" in crimes.columns:
        raise ValueError("the helper column was stored")
    return crimes.select("event_id", "suburb_id", iso_day(F.col("victimisation_date")).alias("victimisation_date"), "offence_code", "meshblock_code")


def full_build_blocks(spark, d):
    return build.build_blocks(materialize(_counted(spark, d), "incidents"), weight="copies")[0].select("id", "suburb_id", "crime_count")


def category_frequency(spark, d):
    """Categories by how often they occur, with their place."""
    cube = _counted(spark, d).groupBy(F.coalesce("offence_category", F.lit("")).alias("category")).agg(F.sum("copies").alias("n"))
    ordered = materialize(measures.by_frequency(cube, "n", "category"), "frequency")
    return number_rows(ordered, [F.desc("n"), F.col("category")], "place")


def breakdown_text(spark, d):
    """Counts per code as JSON text and back."""
    m = measures.breakdown(_reduced(spark, d), "area", "code", "n").select("area", map_as_text(F.col("crime_breakdown")).alias("text"))
    return m.select("area", "text", F.size(text_as_counts(F.col("text"))).cast("bigint").alias("n_codes"))


def name_matches(spark, d):
    """How many census names hold an area's name or are held by it, through the lookup by substrings."""
    names = _names(spark, d).select("name_orig").distinct()
    census = views.census(spark, d).select(F.col("area")).distinct()
    pairs = dims.containment_pairs(names, "name_orig", census, "area").where(contains_either(F.col("name_orig"), F.col("area")))
    return pairs.groupBy("name_orig").agg(F.count(F.lit(1)).alias("n"))


def orders_days(spark, d):
    days = dates_as_text(views.table(spark, d, "orders").select("o_orderdate"))
    return days.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))


def _whole_job(spark, d) -> dict:
    """The tables of the whole job, from sources written as files: delimited ones, and both layers as FeatureCollections."""
    base = scratch_path(spark, "full")
    c = views.concordance(spark, d)
    # one file in row order: the order of rows is part of the input
    c.orderBy("row_no").drop("row_no").coalesce(1).write.option("header", True).csv(f"{base}/concordance")
    s = views.census(spark, d)
    s.orderBy("row_no").select(F.col("area").alias("Area"), F.col("census_year").alias("Census year"), F.col("value").alias("Value")).coalesce(1).write.option("header", True).csv(f"{base}/census")
    sinks.write_collection(_area_features(spark, d), f"{base}/areas", ["SA22023__2", "latitude", "longitude"], [F.col("id")])
    sinks.write_collection(_block_features(spark, d), f"{base}/blocks", ["MB2023_V1_", "latitude", "longitude"], [F.col("key")])
    inputs = build.Inputs(
        incidents=_write_tsv(spark, d), concordance=f"{base}/concordance", census=f"{base}/census", area_layer=f"{base}/areas",
        block_layer=f"{base}/blocks", encoding="utf-8",
    )
    return build.run_build(spark, inputs, f"{base}/out", parts=4, radius_km=WIDE_KM)


def full_build(spark, d):
    """The whole job's area table with its neighbours."""
    return _flat(_whole_job(spark, d)["suburbs"].read()).drop("AU2017_name")


def full_build_tables(spark, d):
    """The whole job's other two tables: small areas, and incidents counted by their columns."""
    tables = _whole_job(spark, d)
    crimes = tables["crimes"].read()
    text = F.concat_ws(":", *[F.coalesce(x, F.lit("")) for x in (iso_day(F.col("victimisation_date")), F.col("offence_code"), F.col("offence_category"), F.col("offence_description"))])
    nothing = F.lit(None).cast("double")
    counted = crimes.groupBy(F.lit("crimes").alias("stored"), F.col("meshblock_code").alias("id"), "suburb_id", text.alias("text")).agg(F.count(F.lit(1)).alias("n"))
    blocks = tables["meshblocks"].read().select(F.lit("meshblocks").alias("stored"), "id", "suburb_id", F.col("crime_count").alias("n"), "lat", "lng", F.col("geometry").alias("text"))
    return blocks.unionByName(counted.withColumns({"lat": nothing, "lng": nothing}))


# ---------------------------------------------------------------- metrics


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def metric_summary(spark, d):
    return _rounded(metric_plans.summarise_metrics(views.metrics(spark, d)))


def metric_samples(spark, d):
    """Samples appended to the metric table and read back."""
    path = scratch_path(spark, "samples")
    rows = views.metrics(spark, d).select(F.col("ts").cast("string").alias("timestamp"), "metric_name", F.col("value").cast("double").alias("value"))
    sinks.append_rows(rows.select("*", F.lit("ms").alias("unit"), F.expr("map('endpoint', 'x')").alias("context")), path)
    back = spark.read.schema(METRIC).parquet(path)
    return back.groupBy("metric_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def metric_recorded(spark, d):
    """The mean of every metric recorded as a sample of its own, and read back."""
    path = scratch_path(spark, "recorded")
    means = views.metrics(spark, d).groupBy("metric_name").agg(F.round(F.avg("value"), 6).alias("value"), F.count(F.lit(1)).alias("n")).collect()
    for m in means:  # one row for each of five metrics
        sinks.record_metrics(spark, path, [(m["metric_name"], m["value"], "ms", {"samples": m["n"]})])
    back = spark.read.schema(METRIC).parquet(path)
    return back.select("metric_name", "value", "unit", F.col("context")["samples"].alias("samples"))


def metric_report(spark, d):
    """The saved report, read back."""
    path, samples = scratch_path(spark, "report"), views.metrics(spark, d)
    told, _, total = metric_plans.performance_report(samples)
    sinks.save_report(told, samples, path, total)
    back, head = spark.read.json(f"{path}/summary"), spark.read.json(f"{path}/report")
    return _rounded(back.select("family", "count", "average")).withColumn("total_metrics_collected", F.lit(head.first()["total_metrics_collected"]))


def metric_p95_exclusive(spark, d):
    return _rounded(metric_plans.latency_stats(views.metrics(spark, d), "metric_name", always_interpolate=True))


def endpoint_latency(spark, d):
    return _rounded(metric_plans.latency_stats(views.metrics(spark, d), "endpoint"))


def user_latency(spark, d):
    events = views.table(spark, d, "events").select("user_id", "value")
    return _rounded(metric_plans.latency_stats(events, "user_id"))


def metric_latest(spark, d):
    return metric_plans.latest_values(views.metrics(spark, d)).select("metric_name", "value")


def metric_grades(spark, d):
    return _rounded(metric_plans.grade_metrics(views.metrics(spark, d)))


def throughput(spark, d):
    return _rounded(metric_plans.throughput(views.metrics(spark, d), "metric_name"), 3)


def hit_rate(spark, d):
    return _rounded(metric_plans.hit_rate(views.counters(spark, d)))


# ---------------------------------------------------------------- geometry


def polygon_centroid(spark, d):
    return _rounded(polygons.centroids(views.vertices(spark, d)), 8)


def polygon_wkt(spark, d):
    return polygons.layer_wkt(views.vertices(spark, d))


def reproject_tm(spark, d):
    lng, lat = NZTM2000.to_lnglat(F.col("east"), F.col("north"))
    return _rounded(views.projected_points(spark, d).select("id", lng.alias("lng"), lat.alias("lat")), 8)


def ring_validity(spark, d):
    return polygons.validity(materialize(views.defective_vertices(spark, d), "vertices"))


def simplify_layer(spark, d):
    return polygons.simplify(materialize(views.vertices(spark, d), "vertices"), 0.03)


def sorted_batches(spark, d):
    """Layer rows in name order, cut into batches of 100."""
    layer = views.concordance(spark, d).select(F.col("row_no").alias("id"), F.col("SA22023_name").alias("name"))
    return sinks.batch_numbers(layer, [F.col("name").asc_nulls_last(), F.col("id")], 100)


def sorted_layer(spark, d):
    """The whole layer written in name order; the place of every row in its files."""
    layer = views.concordance(spark, d).select(F.col("row_no").alias("id"), F.col("SA22023_name").alias("name"))
    path = scratch_path(spark, "sorted")
    layers.sort_layer(layer, "name", "id").write.parquet(path)
    back = spark.read.parquet(path).select("id", "name", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    return number_rows(back, [F.col("file"), F.col("at")], "position").select("id", "name", "position")


def layer_collection(spark, d):
    """The layer in name order as one FeatureCollection, and read back in its order."""
    path = scratch_path(spark, "collection")
    layers.write_prepared(_area_features(spark, d), path, "id", sort="SA22023__2", lines=False)
    back = files.read_layer(spark, path, {"id": "double", "SA22023__2": "string", "latitude": "double", "longitude": "double"})
    points = F.aggregate(F.flatten("coordinates"), F.lit(0).cast("bigint"), lambda n, ring: n + F.size(ring))
    return number_rows(back.withColumn("n_points", points), [F.col("row_no")], "position").select(
        "position", F.col("id").cast("bigint").alias("id"), F.col("SA22023__2").alias("name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), "n_points")


def prepared_layer(spark, d):
    """Centroids added to the area layer, as the layer job does."""
    layer = _layer(spark, d).select(
        F.col("row_no").alias("id"), "name", F.lit("Polygon").alias("geometry_type"), "coordinates"
    )
    out = layers.prepare_layer(layer, "id")
    return _rounded(out.select("id", "name", "longitude", "latitude", F.size("coordinates").cast("bigint").alias("n_parts")), 8)


# ---------------------------------------------------------------- streams


def stream_monthly_counts(spark, d):
    schema = views.SCHEMAS["orders"]
    base = scratch_path(spark, "stream")
    t = KeyedTable(spark, f"{base}/counts", ["area", "month"], 8)
    stream = incremental.read_stream(spark, f"{d}/orders.parquet", schema).withColumn("area", F.col("o_custkey") % 200)
    incremental.monthly_count_stream(stream, "area", "o_orderdate", t, f"{base}/checkpoint").awaitTermination()
    return t.read().withColumn("month", iso_day(F.col("month")))


def stream_upsert(spark, d):
    """Orders upserted by customer as they arrive: the latest order of each customer."""
    schema = views.SCHEMAS["orders"]
    base = scratch_path(spark, "stream")
    t = KeyedTable(spark, f"{base}/latest", ["o_custkey"], 8)
    stream = incremental.read_stream(spark, f"{d}/orders.parquet", schema).select("o_custkey", "o_orderkey", "o_totalprice")
    incremental.upsert_stream(stream, t, f"{base}/checkpoint", order=F.col("o_orderkey")).awaitTermination()
    return t.read()


def _streamed_incidents(spark, d, orders: str, files_per_batch: int) -> DataFrame:
    """Incidents of a stream of order files, counted; their ids hold the files' paths, so only their number is told."""
    base = scratch_path(spark, "stream")
    areas, blocks = (few_or_shuffled(materialize(x, "dimension")) for x in _dims(spark, d))
    t = KeyedTable(spark, f"{base}/incidents", ["event_id"], part=sinks.incident_month())
    stream = views.as_incidents(incremental.read_stream(spark, orders, views.SCHEMAS["orders"], files_per_batch=files_per_batch))
    incremental.incident_stream(stream, areas, blocks, t, f"{base}/checkpoint").awaitTermination()
    rows = t.read().withColumn("victimisation_date", iso_day(F.col("victimisation_date")))
    return rows.groupBy(*[c for c in INCIDENT if c != "event_id"]).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids"))


def stream_incidents(spark, d):
    """Orders as raw incidents through the incident stream."""
    return _streamed_incidents(spark, d, f"{d}/orders.parquet", 1000)


def stream_incidents_batches(spark, d):
    """The same from several files, a micro-batch each."""
    path = scratch_path(spark, "orders")
    # small row groups, so that a batch of one file is read by many tasks
    views.table(spark, d, "orders").repartition(3).write.option("parquet.block.size", 4 << 20).parquet(path)
    return _streamed_incidents(spark, d, path, 1)


QUERIES = {
    f.__name__: f
    for f in (
        area_flagship, clean_text_areas, slugify_names, incident_codes, month_parse, incidents_built, incidents_unmatched,
        last_wins_dim, meshblock_remap, area_block_list, mapping_fanout, area_counts, rolling_12m, monthly_counts, trend_3m,
        peak_months, breakdown_map, area_measures, population_exact, population_fuzzy, rate_rank, areas_built, meshblocks_built,
        areas_with_nearby, nearby_topk, nearby_default, area_statistics, filter_areas_page, filter_incidents_month,
        filter_incidents_council, area_detail, meshblocks_of_area, area_reports, validate_incidents_split, rejects_of_build, rejects_written,
        validate_areas_reasons, validate_blocks, upsert_snapshot, tsv_scan, geojson_layer, full_build, metric_summary,
        metric_p95_exclusive, endpoint_latency, user_latency, metric_latest, metric_grades, throughput, hit_rate,
        polygon_centroid, polygon_wkt, reproject_tm, ring_validity, simplify_layer, sorted_batches, prepared_layer,
        stream_monthly_counts, stream_upsert, stream_incidents, stream_incidents_batches, block_layer_scan, appended_rows, csv_export,
        stored_columns, limited_lookup, crimes_stored, full_build_blocks, category_frequency, breakdown_text, name_matches, orders_days,
        metric_samples, metric_report, sorted_layer, layer_collection, full_build_tables, metric_recorded, incident_pages,
    )
}
