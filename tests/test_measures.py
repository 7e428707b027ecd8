import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from precinct.operators import dims, measures, ordering
from precinct.operators.copies import count_copies, expand_copies
from precinct.operators.ordering import dense_rank_desc, exact_quantiles, number_rows
from precinct.operators.validation import AREA_RULES, INCIDENT_RULES, split_valid
from precinct.plans.build import area_statistics


def month(i):
    return dt.date(2020 + (i // 12), i % 12 + 1, 1)


def facts(spark, counts):
    """counts: area -> {month index: n}"""
    rows, k = [], 0
    for area, months in counts.items():
        for m, n in months.items():
            for _ in range(n):
                rows.append((k, area, month(m) if m is not None else None, "8", f"{area} unit"))
                k += 1
    return spark.createDataFrame(rows, "row_no long, suburb_id string, victimisation_date date, offence_code string, AU2017_name string")


def test_trend_rules(spark):
    counts = {
        "one": {0: 5}, "two": {0: 5, 1: 1}, "three": {0: 1, 1: 1, 2: 1}, "four": {0: 9, 1: 1, 2: 1, 3: 1},
        "six": {0: 2, 1: 2, 2: 2, 3: 2, 4: 2, 5: 2}, "seven": {0: 99, 1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4},
        "gap": {0: 4, 1: 4, 3: 4, 10: 1, 11: 1, 20: 1},
    }
    df = facts(spark, counts)
    want = {"one": ("flat", 0.0), "two": ("up", 0.0), "three": ("up", 0.0), "four": ("down", (1 - 9) / 9 * 100),
            "six": ("flat", 0.0), "seven": ("up", 300.0), "gap": ("down", -75.0)}
    months = measures.monthly_counts(df, "suburb_id", "victimisation_date")
    got = {r.area: (r.crime_trend, r.trend_3m_change) for r in measures.trend(months).collect()}
    assert got == want
    cube = measures.event_cube(df)
    got = {r.area: (r.crime_trend, r.trend_3m_change) for r in measures.area_measures(cube).collect()}
    assert got == want


def test_undated_rows_count_where_they_should(spark):
    df = facts(spark, {"a": {0: 2, None: 3}, "b": {None: 1}})
    got = {r.area: r for r in measures.area_measures(measures.event_cube(df)).collect()}
    assert got["a"].total_12m == 2 and got["a"].total_all == 5 and got["a"].crime_breakdown == {"8": 5}
    assert got["a"].peak_crime_months == ["2020-01-01"]
    assert got["b"].total_12m == 0 and got["b"].peak_crime_months == [] and got["b"].crime_trend == "flat"


def test_window_and_peaks(spark):
    df = facts(spark, {"a": {0: 5, 1: 7, 2: 5, 3: 7, 4: 5}, "b": {16: 1, 4: 1}})
    months = measures.monthly_counts(df, "suburb_id", "victimisation_date")
    peaks = {r.area: r.peak_crime_months for r in measures.peak_months(months).collect()}
    assert peaks["a"] == ["2020-01-01", "2020-02-01", "2020-04-01"]
    # latest month is May 2021: the window starts on 2020-05-31, so May 2020 is out
    total = {r.area: r.total_12m for r in measures.rolling_total(df, "suburb_id", "victimisation_date").collect()}
    assert total == {"a": 0, "b": 1}


def test_measures_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    df = facts(spark, {f"a{i}": {m: rng.randint(1, 4) for m in rng.sample(range(30), 9)} for i in range(12)})
    results = []
    for n in (1, 17):
        cube = measures.event_cube(df.orderBy(F.rand(n)).repartition(n))
        results.append(sorted(map(str, measures.area_measures(cube).collect())))
    assert results[0] == results[1]


def test_last_row_wins(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("", 3, "x"), (None, 4, "y")], "key string, row_no int, v string")
    assert [tuple(r) for r in dims.last_row_wins(df, "key", "row_no", ["v"]).collect()] == [("k", "late")]


def brute_population(name, census):
    exact = [r for r in census if r[1] == name and r[2] == 2023]
    if exact:
        return exact[0][3]
    for r in census:
        if r[1].lower() in name.lower() or name.lower() in r[1].lower():
            return r[3]
    return 10000


def test_population(spark):
    rng = random.Random(1)
    words = ["north", "North", "bay", "st", "hill", "a", "ford"]
    phrase = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    census = [(i, phrase(), rng.choice([2013, 2018, 2023]), rng.randint(1, 99)) for i in range(60)]
    names = sorted({phrase() for _ in range(80)} | {"zzz", "Quay"})
    got = dims.attach_population(
        spark.createDataFrame([(n,) for n in names], "name_orig string"),
        spark.createDataFrame(census, "row_no int, area string, census_year int, value bigint"),
    )
    assert {r.name_orig: r.population for r in got.collect()} == {n: brute_population(n, census) for n in names}


def test_population_without_census_and_negative(spark):
    names = spark.createDataFrame([("a",), (None,)], "name_orig string")
    assert [r.population for r in dims.attach_population(names, None).collect()] == [10000, 10000]
    census = spark.createDataFrame([(1, "a", 2023, -998)], "row_no int, area string, census_year int, value bigint")
    assert {r.name_orig: r.population for r in dims.attach_population(names, census).collect()} == {"a": None, None: 10000}


def test_fanout(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)] + [("c", i) for i in range(6)], "k string, v int")
    assert {r.targets: r.n_keys for r in dims.mapping_fanout(df, "k", "v").collect()} == {"1": 1, "2-5": 1, ">5": 1}


def test_dense_rank(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice([0.0, rng.uniform(0, 5), rng.uniform(-2, 2), 3.0])) for i in range(400)]
    rows += [(1000 + i, "hot", 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    ladder = {g: sorted({v for _, h, v in rows if h == g}, reverse=True) for g in ("x", "y", "hot")}
    for r in dense_rank_desc(df, "g", "v", "r").collect():
        assert r.r == (0 if r.g is None else ladder[r.g].index(r.v) + 1)


@pytest.mark.parametrize("most", [0, 100, ordering.SORTED])  # by histogram, by both, by order
@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 500])
def test_exact_quantiles(spark, monkeypatch, n, most):
    monkeypatch.setattr(ordering, "SORTED", most)
    rng = random.Random(n)
    data = [rng.choice([rng.uniform(-9, 9), 4.0, 0.0, rng.lognormvariate(0, 5)]) for _ in range(n)]
    df = spark.createDataFrame([("a", v) for v in data] + [(None, 7.0), ("a", None)], "g string, v double")
    picks = {"q1": ("inclusive", 1, 4), "med": ("inclusive", 1, 2), "p95": ("exclusive", 19, 20)}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", picks).collect()}
    assert got["a"].q1 == pytest.approx(np.percentile(data, 25)) and got["a"].med == pytest.approx(statistics.median(data))
    want = statistics.quantiles(data, n=20)[18] if n > 1 else data[0]
    assert got["a"].p95 == pytest.approx(want)
    assert got[None].med == 7.0


def test_crowded_values(spark, monkeypatch):
    """Values much closer together than a bucket is wide are cut until no bucket is large."""
    monkeypatch.setattr(ordering, "SORTED", 0)
    monkeypatch.setattr(ordering, "LARGE", 100)
    monkeypatch.setattr(ordering, "PIECES", 8)
    rng = random.Random(2)
    data = {"a": [1 + rng.random() ** 9 * 1e-4 for _ in range(3000)], "b": [5.0] * 500 + [rng.uniform(-1, 1) for _ in range(40)], "c": [float("inf"), 1.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"q1": ("inclusive", 1, 4), "p95": ("exclusive", 19, 20)}).collect()}
    for g in "ab":
        assert got[g].q1 == pytest.approx(np.percentile(data[g], 25), abs=1e-15) and got[g].p95 == pytest.approx(statistics.quantiles(data[g], n=20)[18], abs=1e-15)
    ranks = dense_rank_desc(df, "g", "v", "rank").collect()
    for g, vs in data.items():
        order = {v: i for i, v in enumerate(sorted(set(vs), reverse=True), 1)}
        assert all(r["rank"] == order[r.v] for r in ranks if r.g == g)


def test_p95_published_cases(spark):
    for n, want in ((19, 19.0), (20, 19.95)):
        df = spark.createDataFrame([(float(i),) for i in range(1, n + 1)], "v double")
        assert exact_quantiles(df, [], "v", {"p": ("exclusive", 19, 20)}).collect()[0].p == pytest.approx(want)


def test_area_statistics(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(1, 6)], "crime_rate_per_1000 double, total_crimes_12m int")
    r = area_statistics(df).collect()[0]
    assert (r.n_areas, r.total_crimes, r.mean_rate, r.rate_p25, r.rate_p50, r.total_p75) == (5, 15, 3.0, 2.0, 3.0, 4.0)


def test_number_rows(spark):
    rng = random.Random(4)
    data = [(i, rng.choice("abc")) for i in range(500)]
    df = spark.createDataFrame(data, "id int, k string").repartition(13)
    got = {r.id: r.n for r in number_rows(df, [F.col("k"), F.col("id")], "n").collect()}
    assert got == {i: n for n, (i, _) in enumerate(sorted(data, key=lambda r: (r[1], r[0])), 1)}


def test_copies_survive_and_ids_are_stable(spark, monkeypatch):
    monkeypatch.setattr("precinct.operators.copies.COPIES_PER_CHUNK", 7)
    monkeypatch.setattr("precinct.operators.copies.COPIES_PER_PIECE", 3)
    rows = [(i, "hot", None) for i in range(100)] + [(100 + i, f"k{i}", "x") for i in range(30)]
    df = spark.createDataFrame(rows, "row_no long, a string, b string").withColumn("source", F.lit("f"))
    with pytest.raises(ValueError):
        count_copies(df.drop("source"), "row_no")
    ids = []
    for n in (1, 9):
        counted = count_copies(df.orderBy(F.rand(n)).repartition(n), "row_no")
        out = expand_copies(counted, cluster=F.col("a") if n > 1 else None).collect()
        assert len(out) == 130 and len({r.event_id for r in out}) == 130
        assert sum(r.a == "hot" for r in out) == 100
        ids.append({r.event_id for r in out})
    assert ids[0] == ids[1]


def test_validation(spark):
    base = {"event_id": "e", "suburb_id": "1", "offence_category": "c"}
    rows = [{**base}, {**base, "event_id": ""}, {**base, "offence_category": "x" * 201}, {**base, "suburb_id": None}]
    df = spark.createDataFrame([(r["event_id"], r["suburb_id"], r["offence_category"]) for r in rows], "event_id string, suburb_id string, offence_category string")
    valid, rejected = split_valid(df, INCIDENT_RULES)
    assert valid.count() == 1
    got = sorted((e["field"], e["rule"]) for r in rejected.collect() for e in r.errors)
    assert got == [("event_id", "min_length"), ("offence_category", "max_length"), ("suburb_id", "required")]
    assert rejected.collect()[0].original_record.asDict().keys() == base.keys()


def test_area_ranges(spark):
    rows = [(91.0, "up"), (float("nan"), "up"), (None, "up"), (5.0, "sideways"), (-90.0, "flat")]
    df = spark.createDataFrame(rows, "lat double, crime_trend string")
    with pytest.raises(ValueError):
        split_valid(df, AREA_RULES)
    df = df.withColumns({c: F.lit("x") for c in ("suburb_id", "name", "slug")})
    valid, rejected = split_valid(df, AREA_RULES)
    assert valid.count() == 2 and rejected.count() == 3


def test_small_groups_are_shuffled_once(spark, tmp_path):
    spark.range(3000).select((F.col("id") % 700).alias("g"), (F.col("id") * 7 % 1000).cast("double").alias("v")).write.parquet(str(tmp_path / "s"))
    df = exact_quantiles(spark.read.parquet(str(tmp_path / "s")), ["g"], "v", {"p95": ("exclusive", 19, 20)})
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_containment_matches_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcAB ") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 30])))
    names, areas = [word() for _ in range(120)], [word() for _ in range(120)]
    names += [areas[0] + "xy", areas[1][:5], "", "q" * 300 + "abca"]
    areas += ["q" * 200, "Zürich", "", None]
    a = spark.createDataFrame([(n,) for n in names], "n string")
    b = spark.createDataFrame([(i, v, 10 + i) for i, v in enumerate(areas)], "row_no int, area string, value long")
    hold = lambda x, y: x.lower() in y.lower() or y.lower() in x.lower()
    pairs = {(n, v) for n in names for v in areas if n and v and hold(n, v)}
    got = [tuple(r) for r in dims.containment_pairs(a, "n", b, "area").collect()]
    assert set(got) == pairs and len(got) == len(pairs)
    first = {n: next((10 + i for i, v in enumerate(areas) if v is not None and hold(n, v)), None) for n in names}
    found = {r.n: r.value for r in dims.first_containing(a, "n", b, "area", "value", "row_no").collect()}
    assert found == {n: v for n, v in first.items() if v is not None}
