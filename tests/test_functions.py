import datetime as dt
import math

from pyspark.sql import functions as F

from precinct.functions import dates, geo, scores, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, inputs, f, type_="string"):
    return [r[0] for r in values(spark, [(i, v) for i, v in enumerate(inputs)], f"i int, v {type_}", f(F.col("v")))]


def test_slug(spark):
    got = one(spark, ["Parnell East", "Opua (Far North District)", "a(b)c", "", None, "Foo's  Bar.", "-x-"], text.slugify)
    assert got == ["parnell-east", "opua-far-north-district", "a-bc", "", "", "foo-s-bar", "x"]


def test_clean_text(spark):
    assert one(spark, ["St. Johns", "  a   b ", None, "a .b "], text.clean_text) == ["St Johns", "a b", None, "a b"]


def test_offence_code(spark):
    got = one(spark, ["08 x", "8 x", "theft and related offences", "Unlisted", None, ""], text.offence_code)
    assert got == ["08", None, "8", None, None, None]


def test_integer_text(spark):
    assert one(spark, ["0016901", "abc", None], text.integer_text) == ["16901", None, None]
    assert one(spark, ["0016901", "abc", None], text.code_text) == ["16901", "abc", None]


def test_months(spark):
    got = one(spark, ["May 2023", "MAY 2023", "Sept 2023", None, "May", "May 23", "May 2023 x", "December  1999", "unknown"], dates.month_from_name)
    edges = one(spark, ["January 9999", "January 1500", "September 1677", "October 1677", "April 2262", "May 2262"], dates.month_from_name)
    assert edges == [None, None, None, dt.date(1677, 10, 1), dt.date(2262, 4, 1), None]
    may = dt.date(2023, 5, 1)
    assert got == [may, may, None, None, None, None, None, dt.date(1999, 12, 1), None]


def test_window_bounds(spark):
    got = values(spark, [(dt.date(2024, 2, 1),)], "d date", dates.month_end(F.col("d")), dates.window_start(dates.month_end(F.col("d"))))
    assert got == [(dt.date(2024, 2, 29), dt.date(2023, 3, 1))]


def test_dates_as_text(spark):
    df = dates.dates_as_text(spark.createDataFrame([(dt.date(2024, 2, 1), 3)], "d date, n int"))
    assert df.collect()[0]["d"] == "2024-02-01" and df.collect()[0]["n"] == 3


def test_grades(spark):
    got = one(spark, [49.0, 50.0, 100.0, 200.0, None], lambda c: scores.grade(c, "api_response"), "double")
    assert got == ["EXCELLENT", "GOOD", "FAIR", "POOR", None]
    got = one(spark, [95.0, 85.0, 70.0, 69.0], lambda c: scores.grade(c, "cache_performance"), "double")
    assert got == ["EXCELLENT", "GOOD", "FAIR", "POOR"]


def test_rate_and_cap(spark):
    got = values(spark, [(40000, 10000), (5, 0), (5, None)], "t bigint, p bigint", scores.rate_per_1000(F.col("t"), F.col("p")), scores.cap_smallint(F.col("t")))
    assert got == [(4000.0, 32767), (0.0, 5), (0.0, 5)]


def test_finite_or_null(spark):
    assert one(spark, [1.0, math.inf, -math.inf, math.nan, None], scores.finite_or_null, "double") == [1.0, None, None, None, None]


def test_counts_text(spark):
    assert one(spark, ['{"8":3}', "no", None], text.text_as_counts) == [{"8": 3}, {}, {}]
    assert one(spark, [{"8": 3}], text.map_as_text, "map<string,bigint>") == ['{"8":3}']


def test_contains_either(spark):
    got = values(spark, [("Abc", "xaBCx"), ("xabcx", "ABC"), ("a", "b")], "a string, b string", text.contains_either(F.col("a"), F.col("b")))
    assert got == [(True,), (True,), (False,)]


def test_haversine_antipodes(spark):
    got = values(spark, [(0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double", geo.haversine_km(*[F.col(c) for c in "abcd"]))
    assert abs(got[0][0] - math.pi * 6371) < 1e-6


def test_transverse_mercator(spark):
    # the false origin of the projection lies at the equator on its central meridian
    lng, lat = geo.NZTM2000.to_lnglat(F.col("e"), F.col("n"))
    got = values(spark, [(1600000.0, 10000000.0), (1576041.15, 6188574.24)], "e double, n double", lng, lat)
    assert abs(got[0][0] - 173) < 1e-9 and abs(got[0][1]) < 1e-9
    # published check point of the national projection (34°26'38.998" S, 172°44'20.99" E)
    assert abs(got[1][0] - (172 + 44 / 60 + 20.99 / 3600)) < 2e-3 and abs(got[1][1] + (34 + 26 / 60 + 39 / 3600)) < 2e-3


def test_mercator_round_trip(spark):
    x, y = geo.to_mercator(F.col("lng"), F.col("lat"))
    lng, lat = geo.from_mercator(x, y)
    got = values(spark, [(174.5, -36.8)], "lng double, lat double", lng, lat)
    assert abs(got[0][0] - 174.5) < 1e-9 and abs(got[0][1] + 36.8) < 1e-9


def test_nested_wkt(spark):
    ring = [[0.0, 0.0], [1.5, 0.0], [1.0, 2.0], [0.0, 0.0]]
    df = spark.createDataFrame([(False, [[ring]]), (True, [[ring], [ring]])], "m boolean, c array<array<array<array<double>>>>")
    got = [r[0] for r in df.select(geo.multipolygon_wkt(F.col("c"), F.col("m"))).collect()]
    body = "((0 0, 1.5 0, 1 2, 0 0))"
    assert got == [f"POLYGON {body}", f"MULTIPOLYGON ({body}, {body})"]
