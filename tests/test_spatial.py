import math
import random

import pytest
from pyspark.sql import functions as F

from precinct import session
from precinct.catalog import views
from precinct.operators import polygons
from precinct.operators.spatial import nearest_pairs


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def scattered(n, seed):
    """A third on one spot, dense and loose clusters, the antimeridian, a pole, the equator."""
    rng = random.Random(seed)
    spots = [
        lambda: (-36.5, 174.5), lambda: (-36.5, 174.5),
        lambda: (-41 + rng.gauss(0, 0.002), 174 + rng.gauss(0, 0.002)),
        lambda: (-41 + rng.gauss(0, 0.2), 174 + rng.gauss(0, 0.2)),
        lambda: (rng.uniform(-60, 60), rng.choice([-1, 1]) * rng.uniform(179.7, 180)),
        lambda: (rng.uniform(88.5, 90), rng.uniform(-180, 180)),
    ]
    return [(i, *spots[i % 6]()) for i in range(n)]


@pytest.mark.parametrize("radius,k", [(25.0, 3), (10.0, 10)])
def test_nearest_matches_all_pairs(spark, radius, k):
    pts = scattered(900, int(radius))
    got = {}
    for r in nearest_pairs(spark.createDataFrame(pts, "id long, lat double, lng double"), radius, k).collect():
        got.setdefault(r.id, []).append((r["rank"], round(r.distance_km, 2), r.neighbour_id))
    for i, a, b in pts:
        near = sorted((math.floor(d * 100 + 0.5) / 100, j) for j, x, y in pts if j != i and (d := km(a, b, x, y)) <= radius)[:k]
        assert [(round(d, 2), j) for d, j in near] == [(d, j) for _, d, j in sorted(got.get(i, []))]


def test_unusable_points_and_candidates(spark):
    step = 25 / (math.radians(1) * 6371)
    rows = [(1, 10.0, 20.0, "a"), (2, 10.0 + step * 0.9996, 20.0, "b"), (3, 10.0 - step * 1.0004, 20.0, "c"), (4, 0.0, 20.0, "d"), (5, 10.0, 20.0, "")]
    df = spark.createDataFrame(rows, "id long, lat double, lng double, slug string")
    got = sorted((r.id, r.neighbour_id) for r in nearest_pairs(df, 25.0, 3, candidate=F.col("slug") != "").collect())
    assert got == [(1, 2), (2, 1), (5, 1), (5, 2)]


def ring(f, points, part=0, r=0):
    return [(f, part, r, i, float(x), float(y)) for i, (x, y) in enumerate(points)]


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
BOX = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
SHAPES = {
    1: (ring(1, SQUARE), True),
    2: (ring(2, [(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]), False),  # bow tie
    3: (ring(3, SQUARE[:-1]), False),  # open
    4: (ring(4, [(0, 0), (1, 0), (0, 0)]), False),  # too few
    5: (ring(5, [(0, 0), (4, 0), (4, 4), (4, 0), (0, 4), (0, 0)]), False),  # folds back
    6: (ring(6, SQUARE) + ring(6, [(1, 1), (2, 1), (2, 2), (1, 1)], r=1), True),
    7: (ring(7, SQUARE) + ring(7, [(3, 1), (6, 1), (6, 2), (3, 1)], r=1), False),  # hole leaves the shell
    8: (ring(8, SQUARE) + ring(8, [(4, 4), (8, 4), (8, 8), (4, 4)], part=1), True),  # parts touch in a point
    9: (ring(9, [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]), False),  # touches itself
    10: (ring(10, [(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)]), True),  # repeated vertex
    11: (ring(11, [(0, 0), (4, 0), (float("nan"), 4), (0, 4), (0, 0)]), False),
    12: (ring(12, [(0, 0), (2, 0), (4, 0), (4, 4), (0, 4), (0, 0)]), True),  # vertex on a straight side
}
SHAPES |= {
    13: (ring(13, SQUARE) + ring(13, SQUARE, part=1), False),  # the same part twice
    14: (ring(14, SQUARE) + ring(14, [(4, 1), (8, 1), (8, 3), (4, 3), (4, 1)], part=1), False),  # parts share a piece of an edge
    15: (ring(15, SQUARE) + ring(15, [(2, 0), (5, -3), (2, 4), (-1, -3), (2, 0)], part=1), False),  # leaves through a vertex on an edge
    16: (ring(16, SQUARE) + ring(16, [(4, 4), (6, 2), (2, 2), (2, 6), (4, 4)], part=1), False),  # edges cross
    17: (ring(17, [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]) + ring(17, [(2, 1), (4, 2), (2, 3), (2, 1)], r=1), True),  # hole touches from inside
    18: (ring(18, [(0, 0), (2, 2), (0, 4), (-4, 2), (0, 0)]) + ring(18, [(2, 2), (3, 1), (1, 3), (5, 5), (2, 2)], part=1), False),  # crosses
    19: (ring(19, [(0, 0), (2, 2), (0, 4), (-4, 2), (0, 0)]) + ring(19, [(2, 2), (4, 0), (4, 4), (2, 2)], part=1), True),  # corner to corner
    20: (ring(20, [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]) + ring(20, [(2, 2), (-1, 5), (-1, -1), (3, 1), (2, 2)], part=1), False),
    30: (ring(30, BOX) + ring(30, [(5, 5), (6, 5), (6, 6), (5, 5)], r=1), False),  # hole beside its shell
    31: (ring(31, BOX) + ring(31, [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)], r=1) + ring(31, [(1.5, 1.5), (2, 1.5), (2, 2), (1.5, 1.5)], r=2), False),  # hole in a hole
    32: (ring(32, BOX) + ring(32, [(1, 1), (2, 1), (2, 2), (1, 1)], part=1), False),  # part in a part
    33: (ring(33, BOX) + ring(33, [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)], r=1) + ring(33, [(1.5, 1.5), (2, 1.5), (2, 2), (1.5, 1.5)], part=1), True),  # in its hole
    34: (ring(34, BOX) + ring(34, [(0, 2), (1, 1), (1, 3), (0, 2)], r=1), True),  # starts on its shell, inside
    35: (ring(35, BOX) + ring(35, [(4, 2), (5, 1), (5, 3), (4, 2)], r=1), False),  # starts on its shell, outside
    36: (ring(36, BOX) + ring(36, [(4, 2), (5, 1), (5, 3), (4, 2)], part=1), True),  # parts that touch
    37: (ring(37, BOX) + ring(37, [(0, 2), (1, 1), (1, 3), (0, 2)], part=1), False),  # part in a part that it touches
    38: (ring(38, BOX) + ring(38, [(1, 1), (2, 1), (2, 2), (1, 1)], r=1) + ring(38, [(2, 2), (3, 2), (3, 3), (2, 2)], r=2), True),  # holes that touch
    39: (ring(39, [(0, 0), (4, 0), (4, 4), (0, 4), (0, 3), (3, 3), (3, 1), (0, 1), (0, 0)]) + ring(39, [(1, 1.5), (2, 1.5), (2, 2.5), (1, 1.5)], r=1), False),  # in its bay
}
VERTEX = "feature_id int, part int, ring int, seq int, x double, y double"


def test_validity(spark):
    df = spark.createDataFrame([v for rows, _ in SHAPES.values() for v in rows], VERTEX)
    got = {r.feature_id: r.is_valid for r in polygons.validity(df).collect()}
    assert got == {f: ok for f, (_, ok) in SHAPES.items()}


def crosses(p, q, r, s):
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return turn(p, q, r) * turn(p, q, s) < 0 and turn(r, s, p) * turn(r, s, q) < 0


def test_crossings_match_all_pairs(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for f in range(120):
        n = rng.randint(4, 25)
        wobble = rng.choice([0.0, 0.05, 0.6])
        pts = [((1 + wobble * rng.random()) * math.cos(a + wobble * rng.random()), (10 ** rng.uniform(-2, 1)) * math.sin(a)) for a in (2 * math.pi * i / n for i in range(n))]
        pts.append(pts[0])
        rows += ring(f, pts)
        if any(crosses(pts[i], pts[i + 1], pts[j], pts[j + 1]) for i in range(n) for j in range(i)):
            want.add(f)
    got = {r.feature_id for r in polygons.crossings(spark.createDataFrame(rows, VERTEX)).collect()}
    assert want and len(want) < 120 and got == want


def test_long_rings_are_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(polygons, "RUN", 8)
    n = 100
    pts = [(5 + math.cos(2 * math.pi * i / n), 3 + math.sin(2 * math.pi * i / n)) for i in range(n)]
    df = spark.createDataFrame(ring(1, pts + pts[:1]), VERTEX)
    assert polygons.segments(df).count() == n
    r = polygons.planar_centroid(df).collect()[0]
    assert (r.cx, r.cy) == pytest.approx((5, 3)) and r.area == pytest.approx(n / 2 * math.sin(2 * math.pi / n))
    assert [v.seq for v in polygons.renumber(df.where("seq % 3 = 0")).orderBy("seq").collect()] == list(range(34))


def test_centroid_ignores_winding_of_holes(spark):
    hole = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
    big = [(0, 0), (10, 0), (10, 4), (0, 4), (0, 0)]
    df = spark.createDataFrame(ring(1, big) + ring(1, hole, r=1) + ring(2, big) + ring(2, hole[::-1], r=1), VERTEX)
    rows = polygons.planar_centroid(df).collect()
    for r in rows:
        assert r.area == pytest.approx(36) and r.cx == pytest.approx((40 * 5 - 4 * 2) / 36) and r.cy == pytest.approx(2)


def peucker(pts, tol):
    """Recursive thinning of a closed ring with the same minimum-size rule."""
    def off(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = 0 if dx == dy == 0 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    edges = []

    def walk(i, j, depth):
        if i + 1 == j:
            edges.append((i, j))
            return
        far = max(range(i + 1, j), key=lambda k: (off(pts[k], pts[i], pts[j]), -k))
        size = len(edges) + 1 if edges else 0
        forced = size < 4 and depth + 1 < 4
        if not forced and off(pts[far], pts[i], pts[j]) <= tol:
            edges.append((i, j))
            return
        walk(i, far, depth + 1)
        walk(far, j, depth + 1)

    walk(0, len(pts) - 1, 1)
    return [0] + [j for _, j in edges]


def test_simplify_matches_recursion(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for f in range(60):
        n = rng.randint(3, 40)
        pts = [((1 + 0.2 * rng.random()) * math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
        pts.append(pts[0])
        rows += ring(f, pts)
        want[f] = [pts[i] for i in peucker(pts, 0.15)]
    got = {}
    for r in polygons.simplify(spark.createDataFrame(rows, VERTEX), 0.15).orderBy("feature_id", "seq").collect():
        got.setdefault(r.feature_id, []).append((r.x, r.y))
    assert got == want


def test_thinning_keeps_valid_shapes_valid(spark):
    notch = [(0, 0), (10, 0), (10, 5), (5.4, 5), (5.2, 0.6), (5.0, 5), (0, 5), (0, 4), (0, 0)]
    rng = random.Random(11)
    rows = ring(0, notch)
    for f in range(1, 40):
        n = rng.randint(8, 40)
        pts = [((1 + rng.choice([0, 0.9]) * rng.random()) * math.cos(2 * math.pi * i / n), (1 + 0.9 * rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        rows += ring(f, pts + pts[:1])
    df = spark.createDataFrame(rows, VERTEX)
    before = {r.feature_id: r.is_valid for r in polygons.validity(df).collect()}
    for tolerance in (0.3, 1.0):
        out = polygons.simplify(df, tolerance)
        after = {r.feature_id: r.is_valid for r in polygons.validity(out).collect()}
        assert set(after) == set(before) and all(after[f] for f in before if before[f])
    assert out.count() < len(rows)


def test_layer_round_trip(spark):
    df = spark.createDataFrame(SHAPES[6][0] + SHAPES[8][0], VERTEX)
    back = polygons.explode_layer(polygons.collect_layer(df), "feature_id")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_that_grow_are_not_broadcast(spark):
    df = spark.createDataFrame(SHAPES[6][0] + SHAPES[8][0], VERTEX)
    for out in (polygons.centroids(df), polygons.crossings(df), polygons.validity(df), polygons.thinned(df, 0.1)):
        assert "Broadcast" not in plan(out)
    ids = session.materialize(spark.range(20), "ids")
    assert "Broadcast" in plan(spark.range(5).join(session.few_or_shuffled(ids), "id"))


def test_written_sides_are_broadcast_while_few(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    ids = session.materialize(spark.range(20), "ids")
    out = spark.range(5).join(session.few_or_shuffled(ids), "id")
    assert "Broadcast" not in plan(out) and out.count() == 5


def test_polygons_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    customers = ["id % 90 as c_custkey", "'x' as c_name", "1 as c_nationkey", "0D as c_acctbal", "'y' as c_mktsegment"]
    spark.range(100).selectExpr(*customers).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    whole = sorted(map(tuple, views.vertices(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(views, "SPREAD", 20)
    dealt = views.vertices(spark, str(tmp_path))
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert sorted(map(tuple, dealt.collect())) == whole
