import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from precinct import session
from precinct.functions.dates import month_from_name
from precinct.operators.dims import area_dimension, code_remap
from precinct.plans import build, layers, metrics, serving
from precinct.schemas import AREA_DETAIL, AREA_SUMMARY, DETAIL_MODEL, METRIC, SUMMARY_MODEL
from precinct.session import scratch_path
from precinct.sources import files, pages, sinks
from precinct.sources.keyed_table import KeyedTable
from precinct.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()))


def pairs(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string")


def test_upsert_twice_changes_nothing(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 4)
    assert not t.exists()
    t.upsert(pairs(spark, (1, "a"), (2, "b")))
    for _ in range(2):
        t.upsert(pairs(spark, (2, "B"), (3, "c")))
        assert rows(t.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_keeps_the_last_of_a_key(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y")], "id int, o int, v string")
    t.upsert(df, order=F.col("o"))
    assert rows(t.read()) == [(1, 3, "z")]


def test_replayed_and_late_batches(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    first, second = pairs(spark, (1, "a"), (2, "b"), (3, "c")), pairs(spark, (2, "B"), (4, "d"))
    t.upsert(first, batch=0)
    t.upsert(second, batch=1)
    want = [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    for df, batch in ((second, 1), (first, 0)):  # run again; the older one must not undo the newer one
        t.upsert(df, batch=batch)
        assert rows(t.read()) == want


def test_a_run_that_stopped_between_its_writes(spark, tmp_path, monkeypatch):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], part=F.col("id") % 2)
    t.upsert(pairs(spark, (1, "a"), (3, "c")))
    more, write = pairs(spark, (1, "A"), (2, "b"), (5, "e")), t._write

    def stops(df, mode, *args):
        if mode == "overwrite":
            raise RuntimeError
        write(df, mode, *args)

    monkeypatch.setattr(t, "_write", stops)
    with pytest.raises(RuntimeError):
        t.upsert(more)
    monkeypatch.undo()
    t.upsert(more)
    assert rows(t.read()) == [(1, "A"), (2, "b"), (3, "c"), (5, "e")]


def test_untouched_parts_are_not_rewritten(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], part=F.col("id") % 2)
    files = lambda part: sorted(f for f in os.listdir(tmp_path / f"t/part={part}") if f.endswith(".parquet"))
    t.upsert(pairs(spark, (1, "a"), (2, "b")))
    even, odd = files(0), files(1)
    t.upsert(pairs(spark, (3, "c")))  # a new key: appended
    assert files(0) == even and len(files(1)) == 2 and set(odd) < set(files(1))
    t.upsert(pairs(spark, (1, "A")))  # a known one: its part alone is written anew
    assert files(0) == even and not set(odd) & set(files(1))
    assert rows(t.read()) == [(1, "A"), (2, "b"), (3, "c")]


def test_no_rows_change_nothing(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 4)
    t.upsert(spark.createDataFrame([], "id int, v string"))
    assert not t.exists()
    t.upsert(pairs(spark, (1, "a")))
    t.upsert(spark.createDataFrame([], "id int, v string"))
    assert rows(t.read()) == [(1, "a")]


def test_repeated_keys_are_an_error(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    t.upsert(pairs(spark, (1, "a")))
    with pytest.raises(ValueError):
        t.upsert(pairs(spark, (2, "b"), (2, "c")))
    assert rows(t.read()) == [(1, "a")]


def test_other_number_of_parts_is_an_error(spark, tmp_path):
    KeyedTable(spark, str(tmp_path / "t"), ["id"], 2).upsert(pairs(spark, (1, "a")))
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), ["id"], 3).read()


def test_other_columns_are_an_error(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 2)
    t.upsert(pairs(spark, (1, "a")))
    with pytest.raises(ValueError):
        t.upsert(pairs(spark, (1, "a")).withColumnRenamed("v", "w"))
    t.upsert(pairs(spark, (1, "b")).select("v", "id"))
    assert rows(t.read().select("id", "v")) == [(1, "b")]


def read_folders(df):
    """Folders of the files that a scan opens."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan()
    while "AdaptiveSparkPlan" in scan.nodeName():
        scan = scan.executedPlan()
    (leaf,) = [scan.collectLeaves().apply(i) for i in range(scan.collectLeaves().size())]
    return leaf.metrics().apply("numPartitions").value()


def test_a_month_reads_one_folder(spark, tmp_path):
    days = [(f"e{i}", "1", dt.date(2023, 1 + i % 4, 1)) for i in range(40)] + [("u", "1", None)]
    df = spark.createDataFrame(days, "event_id string, suburb_id string, victimisation_date date")
    t = KeyedTable(spark, str(tmp_path / "t"), ["event_id"], part=sinks.incident_month())
    t.upsert(df)
    assert sorted(f for f in os.listdir(tmp_path / "t") if f.startswith("part=")) == [f"part=2023-0{i}" for i in range(1, 5)] + ["part=undated"]
    got = serving.query_stored_incidents(t, month="2023-03", columns=["event_id"])
    assert got.count() == 10 and read_folders(t.read(serving.month_parts("2023-03"))) == 1
    some = serving.query_stored_incidents(t, start_date="2023-02-15", end_date="2023-04-01", columns=["event_id"])
    assert some.count() == 20 and read_folders(t.read(serving.month_parts(None, "2023-02-15", "2023-04-01"))) == 3
    assert serving.query_stored_incidents(t, columns=["event_id"]).count() == 41
    assert serving.query_stored_incidents(t, month="2020-01", columns=["event_id"]).isEmpty()


def test_a_deep_page_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(5000).select(F.format_string("%06d", (F.col("id") * 7919) % 5000).alias("key"), F.col("id").alias("v")).repartition(6)
    pages.write_pages(df, path, "key", files=10, rows=300)

    opened = lambda rows: len(rows.inputFiles())
    page = pages.read_page(spark, path, "key", 40, 100)
    assert [r.key for r in page.collect()] == [f"{i:06d}" for i in range(3900, 4000)] and 1 <= opened(page) <= 2
    after = pages.read_after(spark, path, "key", "003999", 100)
    assert [r.key for r in after.collect()] == [f"{i:06d}" for i in range(4000, 4100)] and 1 <= opened(after) <= 3
    assert [r.key for r in pages.read_page(spark, path, "key", 50, 100).collect()] == [f"{i:06d}" for i in range(4900, 5000)]
    assert pages.read_page(spark, path, "key", 51, 100).count() == 0 and pages.read_after(spark, path, "key", "004999", 10).count() == 0
    assert sorted(pages.read_page(spark, path, "key", 1, 5000).columns) == ["key", "v"]
    with pytest.raises(ValueError):
        pages.read_page(spark, path, "key", 0, 10)


def square(x, y, s=0.1):
    return [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]


def feature(i, **more):
    shape = {"type": "Polygon", "coordinates": [square(170 + i % 7, -40)]} if i % 5 else None
    return {"type": "Feature", "properties": {"name": f"n{i}", "latitude": float(i)} | more, "geometry": shape}


@pytest.mark.parametrize("indent, separators", [(None, (",", ":")), (None, (", ", ": ")), (2, (",", ": "))])
def test_a_collection_is_read_in_parallel(spark, tmp_path, indent, separators):
    doc = {"type": "FeatureCollection", "name": "x", "crs": {"type": "name"}, "features": [feature(i, note='say "Feature", "type": {[') for i in range(1000)], "bbox": [1, 2]}
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps(doc, indent=indent, separators=separators))
    wanted = {"name": "string", "latitude": "double"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 6))
    try:
        df = files.read_layer(spark, str(path), wanted)
        assert df.rdd.getNumPartitions() > 1
        got = df.orderBy("row_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.name, r.latitude) for r in got] == [(f"n{i}", float(i)) for i in range(1000)]
    assert [r.geometry_type for r in got[:6]] == [None, "Polygon", "Polygon", "Polygon", "Polygon", None]
    assert got[1].coordinates == [[[[float(v) for v in p] for p in square(171, -40)]]]


@pytest.mark.parametrize("odd", [
    {"type": "FeatureCollection", "features": [{k: f[k] for k in ("properties", "geometry", "type")} for f in map(feature, range(20))]},  # the type comes last
    {"type": "FeatureCollection", "features": [feature(i, kind="Feature") for i in range(20)]},  # a property of that value
    {"type": "FeatureCollection", "features": [{"id": i, **feature(i)} for i in range(20)]},
])
def test_other_collections_are_read_whole(spark, tmp_path, odd):
    path = tmp_path / "odd.geojson"
    path.write_text(json.dumps(odd))
    got = files.read_layer(spark, str(path), {"name": "string"}).orderBy("row_no").collect()
    assert [r.name for r in got] == [f"n{i}" for i in range(20)]


def test_a_collection_without_features(spark, tmp_path):
    path = tmp_path / "none.geojson"
    path.write_text('{"type": "FeatureCollection", "features": []}')
    assert files.read_layer(spark, str(path), {"name": "string"}).count() == 0


def test_a_collection_in_parts(spark, tmp_path):
    data = [(i, f"n{(i * 7) % 50:02d}", "Polygon", [[[[float(v) for v in p] for p in square(170, -40)]]] if i % 3 else None) for i in range(50)]
    layer = spark.createDataFrame(data, "id int, name string, geometry_type string, coordinates array<array<array<array<double>>>>").repartition(4)
    layers.write_prepared(layer, str(tmp_path / "c"), "id", sort="name", lines=False)
    parts = sorted(p for p in os.listdir(tmp_path / "c") if p.startswith("part"))
    doc = json.loads("".join((tmp_path / "c" / p).read_text() for p in parts))
    assert doc["type"] == "FeatureCollection" and [f["properties"]["name"] for f in doc["features"]] == [f"n{i:02d}" for i in range(50)]
    back = files.read_layer(spark, str(tmp_path / "c"), {"name": "string"}).orderBy("row_no").collect()
    assert [r.name for r in back] == [f"n{i:02d}" for i in range(50)]
    layers.write_prepared(layer.limit(0), str(tmp_path / "e"), "id", lines=False)
    assert files.read_layer(spark, str(tmp_path / "e"), {"name": "string"}).count() == 0


HEAD = "Area Unit\tTerritorial Authority\t Meshblock\tYear Month\tANZSOC Division\tANZSOC Group\tOther\n"
BODY = "St. Māori \tX\t0016901\tMay 2023\t08 Theft\tg\t1\nSt. Māori \tX\t0016901\tMay 2023\t08 Theft\tg\t2\n"


@pytest.mark.parametrize("encoding,body", [("utf-8", BODY), ("utf-16", BODY), ("iso-8859-1", BODY.replace("ā", "é"))])
def test_encodings(spark, tmp_path, encoding, body):
    path = tmp_path / "in.tsv"
    path.write_bytes((HEAD + body).encode(encoding))
    assert files.detect_encoding(spark, str(path)) == encoding
    got = files.read_incidents(spark, str(path)).collect()
    assert [r.area_unit for r in got] == [body.split("\t")[0].strip()] * 2 and {r.meshblock for r in got} == {"16901"}
    assert len({r.row_no for r in got}) == 2


def test_missing_header_is_an_error(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("a\tb\n1\t2\n")
    with pytest.raises(ValueError):
        files.read_incidents(spark, str(tmp_path / "in.tsv"), "utf-8")


def test_file_order_holds_across_splits(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Area,Census year,Value\n" + "".join(f"a{i},2023,{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_census(spark, str(path))
        assert df.rdd.getNumPartitions() > 1
        assert [r.value for r in df.orderBy("row_no").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def collection(features):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": p, "geometry": g and {"type": g[0], "coordinates": g[1]}} for p, g in features]})


def test_layers_from_feature_collections(spark, tmp_path):
    f = tmp_path / "areas.geojson"
    f.write_text(collection([
        ({"SA22023__2": "A", "latitude": 1.0, "longitude": 2.0}, ("Polygon", [square(2, 1)])),
        ({"SA22023__2": "A", "latitude": 1.5, "longitude": 2.5}, ("MultiPolygon", [[square(3, 1)], [square(5, 1)]])),
        ({"SA22023__2": "", "latitude": 1.0, "longitude": 2.0}, None),
        ({"SA22023__2": "B", "latitude": 9.0, "longitude": 9.0}, ("Polygon", [[[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]])),
    ]))
    got = {r.name: r for r in build.layer_dimension(files.read_area_layer(spark, str(f)), "name").collect()}
    assert set(got) == {"A", "B"} and got["A"].lat == 1.5 and got["A"].geometry.startswith("MULTIPOLYGON (((3 1, 3.1 1")
    assert got["B"].lat == 9.0 and got["B"].geometry is None
    g = tmp_path / "blocks.geojson"
    g.write_text(collection([({"MB2023_V1_": c, "latitude": 1.0, "longitude": 2.0}, None) for c in ("0016901", "abc", None)]))
    assert [r.id for r in files.read_block_layer(spark, str(g)).collect()] == ["16901"]


def test_layer_job_with_batches(spark, tmp_path):
    data = [(i, f"n{(i * 7) % 10}", "Polygon", [[[[float(v) for v in p] for p in square(170 + i, -40)]]]) for i in range(10)]
    layer = spark.createDataFrame(data, "id int, name string, geometry_type string, coordinates array<array<array<array<double>>>>")
    out = layers.prepare_layer(layer, "id", tolerance=0.001)
    r = out.where("id = 3").collect()[0]
    assert r.longitude == pytest.approx(173.05) and r.latitude == pytest.approx(-39.95, abs=1e-3)
    layers.write_prepared(out, str(tmp_path / "b"), "id", sort="name", batch=4)
    names = []
    for b in (1, 2, 3):
        (part,) = [p for p in os.listdir(tmp_path / f"b/batch={b}") if p.startswith("part")]
        doc = json.loads((tmp_path / f"b/batch={b}" / part).read_text())
        names += [f["properties"]["name"] for f in doc["features"]]
        assert doc["type"] == "FeatureCollection" and doc["features"][0]["geometry"]["type"] == "Polygon"
    assert names == sorted(names) and len(names) == 10
    layers.write_prepared(out, str(tmp_path / "l"), "id")
    assert files.read_layer(spark, str(tmp_path / "l"), {"name": "string"}, lines=True).count() == 10
    with pytest.raises(ValueError):
        layers.write_prepared(out, str(tmp_path / "x"), "id", sort="nope")


def test_projected_layer(spark):
    box = [[[[1600000.0, 10000000.0], [1601000.0, 10000000.0], [1601000.0, 9999000.0], [1600000.0, 10000000.0]]]]
    layer = spark.createDataFrame([(1, "Polygon", box)], "id int, geometry_type string, coordinates array<array<array<array<double>>>>")
    r = layers.prepare_layer(layer, "id", epsg=2193).collect()[0]
    assert r.coordinates[0][0][0] == pytest.approx([173.0, 0.0]) and 173 < r.longitude < 173.01 and -0.01 < r.latitude < 0


def write_inputs(folder):
    (folder / "inc.tsv").write_text(HEAD + "".join(
        f"Old. {a}\tX\t{b}\t{m}\t{c}\tg\t1\n"
        for a, b, m, c, n in [("One", 100, "May 2023", "08 T", 5), ("One", 200, "April 2023", "Homicide and related offences", 2),
                              ("Two", 300, "nonsense", "T" * 201, 1), ("Two", 300, "June 2023", "", 3), ("Nowhere", 1, "May 2023", "08 T", 4)]
        for _ in range(n)))
    head = "AU2017_name,SA22023_code,SA22023_name,SA22023_name_ascii,REGC2023_name,TA2023_name,MB2023_code,MB2013_code,UR2023_name,extra\n"
    (folder / "conc.csv").write_text(head + "Old One,1,x,x,R,T,100,100,U,-\nOld One,2,Ōne,One,R,T,0999,100,U,-\nOld Two,3,Two,Two,R,T,300,300,U,-\n")
    (folder / "census.csv").write_text("Area,Census year,Value\nTwo,2023,100\nŌne city,2018,50\n")
    (folder / "areas.geojson").write_text(collection([
        ({"SA22023__2": "One", "latitude": -41.0, "longitude": 174.0}, ("Polygon", [square(174, -41)])),
        ({"SA22023__2": "Two", "latitude": -41.0, "longitude": 174.1}, None)]))
    (folder / "blocks.geojson").write_text(collection([({"MB2023_V1_": "0000999", "latitude": -41.0, "longitude": 174.0}, ("Polygon", [square(174, -41)]))]))


def test_whole_job(spark, tmp_path):
    write_inputs(tmp_path)
    p = lambda n: str(tmp_path / n)
    inputs = build.Inputs(p("inc.tsv"), p("conc.csv"), p("census.csv"), p("areas.geojson"), p("blocks.geojson"))
    for _ in range(2):  # a second load of the same file replaces, never adds
        tables = build.run_build(spark, inputs, p("out"), parts=2)
        areas = {r.suburb_id: r for r in tables["suburbs"].read().collect()}
        assert set(areas) == {"2", "3"}
        one, two = areas["2"], areas["3"]
        assert (one.name, one.population, one.total_crimes_12m, one.crime_rate_per_1000) == ("One", 50, 7, 140.0)
        assert (two.population, two.total_crimes_12m, two.crime_breakdown, two.rank_in_region) == (100, 3, {}, 2)
        assert one.rank_in_region == 1 and one.crime_breakdown == {"08": 5, "1": 2} and one.geometry.startswith("POLYGON")
        assert [n.suburb_id for n in one.nearby_suburbs] == ["3"] and two.nearby_suburbs[0].distance_km == 8.39
        blocks = {r.id: r for r in tables["meshblocks"].read().collect()}
        assert {k: (b.crime_count, b.lat) for k, b in blocks.items()} == {"999": (5, -41.0), "200": (2, 0.0), "300": (3, 0.0)}
        crimes = tables["crimes"].read()
        assert crimes.count() == 10 and "AU2017_name" not in crimes.columns
    rejects = spark.read.json(p("out/rejected/crimes")).collect()
    assert len(rejects) == 1 and rejects[0].errors[0].field == "offence_category"

    page = serving.query_incidents(crimes, tables["suburbs"].read(), district="T", month="2023-05", page_size=3)
    assert page.count() == 3
    rest = serving.query_incidents(crimes, month="2023-05", page_size=3, after=max(r.event_id for r in page.collect()))
    assert rest.count() == 2
    assert serving.query_areas(tables["suburbs"].read(), min_total_crimes=5).columns == AREA_SUMMARY
    assert serving.query_area(tables["suburbs"].read(), "nope").isEmpty()
    assert serving.query_area(tables["suburbs"].read(), "2").columns == AREA_DETAIL
    assert serving.query_blocks(tables["meshblocks"].read(), "2").count() == 2
    assert serving.area_reports(tables["suburbs"].read(), "2").collect()[0].status == "not_purchased"
    assert set(SUMMARY_MODEL) < set(DETAIL_MODEL)
    sinks.write_csv(tables["suburbs"].read(), p("csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(p("csv")).where("suburb_id = 2").collect()[0]
    assert json.loads(back.crime_breakdown) == {"08": 5, "1": 2}


def test_equal_rows_of_two_files_all_stay(spark, tmp_path):
    """Two deliveries with 5 and 3 equal rows are 8 incidents, in two loads and in two micro-batches, with the same ids."""
    write_inputs(tmp_path)
    (tmp_path / "in").mkdir()
    line = "Old. One\tX\t100\tMay 2023\t08 T\tg\t1\n"
    ids = {}
    for name, n in (("a.tsv", 5), ("b.tsv", 3)):
        (tmp_path / "in" / name).write_text(HEAD + line * n)
    for name in ("a.tsv", "b.tsv", "a.tsv"):  # the last is a reload
        tables = build.run_build(spark, build.Inputs(str(tmp_path / "in" / name), str(tmp_path / "conc.csv"), encoding="utf-8"), str(tmp_path / "out"), parts=1)
    ids["batch"] = {r.event_id for r in tables["crimes"].read().collect()}
    concordance = files.read_concordance(spark, str(tmp_path / "conc.csv"))
    table = KeyedTable(spark, str(tmp_path / "crimes"), ["event_id"], part=sinks.incident_month())
    stream = incremental.read_incident_stream(spark, str(tmp_path / "in"), str(tmp_path / "in/a.tsv"), files_per_batch=1)
    incremental.incident_stream(stream, area_dimension(concordance), code_remap(concordance), table, str(tmp_path / "cp")).awaitTermination()
    ids["stream"] = {r.event_id for r in table.read().collect()}
    assert len(ids["batch"]) == 8 and ids["batch"] == ids["stream"]


def test_a_batch_without_known_areas(spark, tmp_path):
    write_inputs(tmp_path)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.tsv").write_text(HEAD + "Nowhere\tX\t1\tMay 2023\t08 T\tg\t1\n")
    concordance = files.read_concordance(spark, str(tmp_path / "conc.csv"))
    table = KeyedTable(spark, str(tmp_path / "crimes"), ["event_id"], part=sinks.incident_month())
    stream = incremental.read_incident_stream(spark, str(tmp_path / "in"), str(tmp_path / "inc.tsv"))
    incremental.incident_stream(stream, area_dimension(concordance), code_remap(concordance), table, str(tmp_path / "cp")).awaitTermination()
    assert not table.exists()
    tables = build.run_build(spark, build.Inputs(str(tmp_path / "in/1.tsv"), str(tmp_path / "conc.csv"), encoding="utf-8"), str(tmp_path / "out"), parts=1)
    assert not any(t.exists() for t in tables.values())


def test_every_rejected_record_is_told(spark, tmp_path):
    write_inputs(tmp_path)
    bad = f"Old. Two\tX\t300\tMay 2023\t{'T' * 201}\tg\t1\n"
    (tmp_path / "inc.tsv").write_text(HEAD + bad * 7)
    inputs = build.Inputs(str(tmp_path / "inc.tsv"), str(tmp_path / "conc.csv"), encoding="utf-8")
    build.run_build(spark, inputs, str(tmp_path / "out"), parts=1)
    got = spark.read.json(str(tmp_path / "out/rejected/crimes")).collect()
    assert len(got) == 7 and len({r.original_record.event_id for r in got}) == 7


def test_job_without_optional_files(spark, tmp_path):
    write_inputs(tmp_path)
    inputs = build.Inputs(str(tmp_path / "inc.tsv"), str(tmp_path / "conc.csv"), encoding="utf-8")
    areas = build.run_build(spark, inputs, str(tmp_path / "out"), parts=1)["suburbs"].read().collect()
    assert {r.population for r in areas} == {10000} and all(r.lat == 0 and r.nearby_suburbs == [] for r in areas)


def test_pages_join_to_the_whole(spark):
    df = spark.createDataFrame([(f"{i:03d}", float(i % 7)) for i in range(95)], "suburb_id string, crime_rate_per_1000 double")
    seen = []
    for page in range(1, 5):
        seen += [r.suburb_id for r in serving.query_areas(df, page, 30, columns=["suburb_id"], min_crime_rate=1.0).collect()]
    assert seen == sorted(r.suburb_id for r in df.where("crime_rate_per_1000 >= 1").collect())
    for bad in ({"page": 0}, {"page_size": 501}, {"colour": "red"}):
        with pytest.raises(ValueError):
            serving.query_areas(df, **bad)


def test_month_filter_is_a_pushed_range(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2023, 5, d), str(d)) for d in range(1, 31)] + [(dt.date(2023, 6, 1), "x")], "victimisation_date date, event_id string")
    df.write.parquet(str(tmp_path / "p"))
    kept = serving.apply_filters(spark.read.parquet(str(tmp_path / "p")), serving.INCIDENT_FILTERS, {"month": "2023-05", "offence_code": None})
    assert kept.count() == 30
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(victimisation_date,2023-05-01)" in plan and "LessThan(victimisation_date,2023-06-01)" in plan


def test_metric_table_and_report(spark, tmp_path):
    path = str(tmp_path / "m")
    samples = [("api_time", 40.0), ("api_time", 70.0), ("cache_hit_rate", 90.0), ("data_ingestion_rate", 60000.0)]
    sinks.record_metrics(spark, path, [(name, v, "ms", {"i": i}) for i, (name, v) in enumerate(samples)])
    df = spark.read.schema(METRIC).parquet(path).withColumn("tie", F.col("context")["i"])
    summary, grades, total = metrics.performance_report(df, "timestamp", "tie")
    assert {r.family: (r["count"], r.median, r.std_dev) for r in summary.collect()}["cache"] == (1, 90.0, None)
    assert {r.subject: r.grade for r in grades.collect()} == {"api_response": "GOOD", "cache_performance": "GOOD", "ingestion_performance": "GOOD"}
    assert total.collect()[0][0] == 4
    sinks.save_report(summary, df, str(tmp_path / "r"), total)
    head = spark.read.json(str(tmp_path / "r/report")).first()
    assert head.total_metrics_collected == 4 and head.report_generated_at
    assert spark.read.json(str(tmp_path / "r/summary")).count() == 3


def test_hit_rate_without_requests(spark):
    df = spark.createDataFrame([("hits", 5, 1, 1), ("hits", 5, 2, 2)], "counter string, reading int, ts int, event_id int")
    assert metrics.hit_rate(df).isEmpty()


def test_streams_equal_batch(spark, tmp_path):
    months = ["May 2023", "June 2023", "odd"]
    data = [(i, f"a{i % 5}", months[i % 3]) for i in range(300)]
    src = spark.createDataFrame(data, "id long, area string, year_month string")
    counts = KeyedTable(spark, str(tmp_path / "counts"), ["area", "month"], 2)
    latest = KeyedTable(spark, str(tmp_path / "latest"), ["area"], 2)
    for i in range(3):  # files arrive between runs; the last one is offered twice
        src.where(F.col("id") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):
            stream = incremental.read_stream(spark, str(tmp_path / "in"), src.schema, files_per_batch=1)
            dated = stream.withColumn("d", month_from_name(F.col("year_month")))
            incremental.monthly_count_stream(dated, "area", "d", counts, str(tmp_path / "c1")).awaitTermination()
            incremental.upsert_stream(stream, latest, str(tmp_path / "c2"), order=F.col("id")).awaitTermination()
    want = src.withColumn("d", month_from_name(F.col("year_month"))).where("d is not null").groupBy("area", F.trunc("d", "MM").alias("month")).count()
    assert rows(counts.read().select("area", "month", "n")) == rows(want)
    assert latest.read().count() == 5


def test_incident_stream(spark, tmp_path):
    write_inputs(tmp_path)
    concordance = files.read_concordance(spark, str(tmp_path / "conc.csv"))
    areas, blocks = area_dimension(concordance), code_remap(concordance)
    (tmp_path / "in").mkdir()
    table = KeyedTable(spark, str(tmp_path / "crimes"), ["event_id"], part=sinks.incident_month())
    for i, want in enumerate((10, 20), 1):  # the same rows in a second file are further incidents
        (tmp_path / f"in/{i}.tsv").write_text((tmp_path / "inc.tsv").read_text())
        for _ in range(2):
            stream = incremental.read_incident_stream(spark, str(tmp_path / "in"), str(tmp_path / "inc.tsv"))
            incremental.incident_stream(stream, areas, blocks, table, str(tmp_path / "cp")).awaitTermination()
        assert table.read().count() == want and table.read().select("event_id").distinct().count() == want


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert files.scan_limited(spark.range(50).withColumn("k", F.col("id") % 2), ["id"], 5, k=1).count() == 5


def test_a_job_leaves_no_intermediates(spark, tmp_path, monkeypatch):
    write_inputs(tmp_path)
    (tmp_path / "shared").mkdir()
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    p = lambda n: str(tmp_path / n)
    tables = build.run_build(spark, build.Inputs(p("inc.tsv"), p("conc.csv"), p("census.csv"), p("areas.geojson"), p("blocks.geojson")), p("out"), parts=2)
    assert os.listdir(tmp_path / "shared") == [] and tables["suburbs"].read().count() == 2


def test_upsert_of_many_keys_is_not_broadcast(spark, tmp_path, monkeypatch):
    """Keys beyond the bound are joined by a shuffle, with the same rows."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    asked = []
    monkeypatch.setattr(session, "shuffled", lambda df, f=session.shuffled: asked.append(df.columns) or f(df))
    t = KeyedTable(spark, str(tmp_path / "t"), ["id"], 4)
    t.upsert(pairs(spark, (1, "a"), (2, "b"), (3, "c")))
    t.upsert(pairs(spark, (2, "x"), (3, "y"), (4, "z")), batch=1)
    t.upsert(pairs(spark, (2, "old"), (3, "old"), (5, "new")))
    assert rows(t.read()) == [(1, "a"), (2, "x"), (3, "y"), (4, "z"), (5, "new")]
    assert asked and set(map(tuple, asked)) == {("id",)}
