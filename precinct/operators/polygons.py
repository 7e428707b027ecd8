"""Polygon layers as vertex tables.

A vertex table has one row per vertex: ``feature_id, part, ring, seq, x, y``
with ``seq`` running 0, 1, 2, ... along each closed ring (ring 0 is the shell).
Work is spread over vertices, so one huge polygon does not sit in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from precinct.functions.geo import from_mercator, number_text, to_mercator, to_wgs84
from precinct.session import few_or_shuffled, materialize, shuffled

RING = ["feature_id", "part", "ring"]
RUN = 4096


def explode_layer(layer: DataFrame, feature_id: str, parts: str = "coordinates") -> DataFrame:
    """Nested coordinate arrays -> vertex table."""
    a = layer.select(F.col(feature_id).alias("feature_id"), F.posexplode(parts).alias("part", "_rings"))
    b = a.select("feature_id", "part", F.posexplode("_rings").alias("ring", "_points"))
    c = b.select("feature_id", "part", "ring", F.posexplode("_points").alias("seq", "_xy"))
    return c.select(*RING, "seq", F.col("_xy")[0].alias("x"), F.col("_xy")[1].alias("y"))


def collect_layer(vertices: DataFrame, parts: str = "coordinates") -> DataFrame:
    """Vertex table -> one nested array per feature (the output is one value by nature)."""
    points = F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.array(p["x"], p["y"]))
    rings = vertices.groupBy(*RING).agg(points.alias("points"))
    polygons = rings.groupBy("feature_id", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ring", "points"))), lambda r: r["points"]).alias("rings")
    )
    return polygons.groupBy("feature_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "rings"))), lambda p: p["rings"]).alias(parts)
    )


def reproject(vertices: DataFrame, epsg: int) -> DataFrame:
    """Vertex coordinates to WGS84 longitude / latitude."""
    x, y = to_wgs84(F.col("x"), F.col("y"), epsg)
    return vertices.select(*RING, "seq", x.alias("x"), y.alias("y"))


def segments(vertices: DataFrame) -> DataFrame:
    """Consecutive vertex pairs of each ring.

    A ring is cut into runs of bounded length (the first vertex of a run also
    closes the run before), so the window never holds a whole long ring.
    """
    run = F.floor(F.col("seq") / RUN)
    runs = F.when((F.col("seq") % RUN == 0) & (F.col("seq") > 0), F.array(run, run - 1)).otherwise(F.array(run))
    rows = vertices.withColumn("_run", F.explode(runs))
    along = Window.partitionBy(*RING, "_run").orderBy("seq")
    ends = F.lead(F.struct("x", "y")).over(along)
    return (
        rows.withColumn("_end", ends).where(F.col("_end").isNotNull())
        .select(*RING, "seq", "x", "y", F.col("_end.x").alias("x2"), F.col("_end.y").alias("y2"))
    )


def renumber(rows: DataFrame) -> DataFrame:
    """Make ``seq`` consecutive again: count per run of the old numbers, then add the run's start."""
    others = [c for c in rows.columns if c not in (*RING, "seq")]
    rows = rows.withColumn("_run", F.floor(F.col("seq") / RUN))
    before = Window.partitionBy(*RING).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*RING, "_run").agg(F.count(F.lit(1)).alias("_n")).select(
        *RING, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*RING, "_run").orderBy("seq")
    rows = rows.withColumn("_i", F.row_number().over(inside)).join(shuffled(starts), [*RING, "_run"])
    return rows.select(*RING, (F.col("_start") + F.col("_i") - 1).cast("int").alias("seq"), *others)


def planar_centroid(vertices: DataFrame) -> DataFrame:
    """Area-weighted centroid (cx, cy) and area per feature.

    Each ring is weighted by its own winding, so shells add and holes subtract
    whichever way they are drawn. Coordinates are taken relative to a vertex of
    the feature to keep the products small.
    """
    origin = vertices.groupBy("feature_id").agg(
        F.min_by(F.struct("x", "y"), F.struct("part", "ring", "seq")).alias("_o")
    ).select("feature_id", F.col("_o.x").alias("ox"), F.col("_o.y").alias("oy"))
    s = segments(vertices).join(shuffled(origin), "feature_id")
    ax, ay, bx, by = F.col("x") - F.col("ox"), F.col("y") - F.col("oy"), F.col("x2") - F.col("ox"), F.col("y2") - F.col("oy")
    cross = ax * by - bx * ay
    rings = s.groupBy(*RING).agg(
        F.sum(cross).alias("a"), F.sum((ax + bx) * cross).alias("mx"), F.sum((ay + by) * cross).alias("my"),
        F.first("ox").alias("ox"), F.first("oy").alias("oy"),
    )
    weight = F.signum("a") * F.when(F.col("ring") == 0, 1.0).otherwise(-1.0)
    total = rings.groupBy("feature_id").agg(
        F.sum(weight * F.col("a")).alias("a"), F.sum(weight * F.col("mx")).alias("mx"), F.sum(weight * F.col("my")).alias("my"),
        F.first("ox").alias("ox"), F.first("oy").alias("oy"),
    )
    third = F.try_divide(F.lit(1.0), F.col("a") * 3.0)
    return total.select(
        "feature_id", (F.col("ox") + F.col("mx") * third).alias("cx"), (F.col("oy") + F.col("my") * third).alias("cy"),
        (F.col("a") / 2).alias("area"),
    )


def centroids(vertices: DataFrame) -> DataFrame:
    """(feature_id, latitude, longitude): planar centroid in Web Mercator, back in degrees."""
    mx, my = to_mercator(F.col("x"), F.col("y"))
    flat = planar_centroid(vertices.select(*RING, "seq", mx.alias("x"), my.alias("y")))
    lng, lat = from_mercator(F.col("cx"), F.col("cy"))
    return flat.select("feature_id", lat.alias("latitude"), lng.alias("longitude"))


def layer_wkt(vertices: DataFrame) -> DataFrame:
    """(feature_id, wkt): POLYGON for one part, MULTIPOLYGON for several."""
    point = F.concat_ws(" ", number_text(F.col("x")), number_text(F.col("y")))
    in_order = lambda order, text: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))), lambda p: p["t"]), ", "
    )
    wrap = lambda body: F.concat(F.lit("("), body, F.lit(")"))
    rings = vertices.groupBy(*RING).agg(wrap(in_order("seq", point)).alias("t"))
    polygons = rings.groupBy("feature_id", "part").agg(wrap(in_order("ring", F.col("t"))).alias("t"))
    return polygons.groupBy("feature_id").agg(
        F.when(F.count(F.lit(1)) > 1, F.concat(F.lit("MULTIPOLYGON ("), in_order("part", F.col("t")), F.lit(")")))
        .otherwise(F.concat(F.lit("POLYGON "), F.first("t"))).alias("wkt")
    )


def _ring_checks(vertices: DataFrame) -> DataFrame:
    """Per ring: vertex count, first = last, finite coordinates, signed area."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    ends = vertices.groupBy(*RING).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("x", "y"), "seq").alias("_first"), F.max_by(F.struct("x", "y"), "seq").alias("_last"),
        F.bool_and(finite(F.col("x")) & finite(F.col("y"))).alias("finite"),
        F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"),
    )
    return ends.select(
        *RING, "n", (F.col("_first") == F.col("_last")).alias("closed"), "finite",
        ((F.col("_x1") > F.col("_x0")) & (F.col("_y1") > F.col("_y0"))).alias("wide"),
    )


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _within_box(ax, ay, bx, by, px, py) -> Column:
    return px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))


def _overlap(A, B) -> Column:
    """Collinear segments that share more than a point."""
    longer_x = F.abs(A[2] - A[0]) >= F.abs(A[3] - A[1])
    shared = lambda i: F.least(F.greatest(A[i], A[i + 2]), F.greatest(B[i], B[i + 2])) > F.greatest(F.least(A[i], A[i + 2]), F.least(B[i], B[i + 2]))
    return F.when(longer_x, shared(0)).otherwise(shared(1))


def _through(A, before, B, b_before) -> Column:
    """The ring that turns at A's start passes from one side of the ring of B to the other there.

    ``before`` is the vertex before A's start. Where A starts on B's start, the ring of B turns there too, coming from ``b_before``.
    """
    cross = lambda a, b: a[0] * b[1] - a[1] * b[0]
    to = lambda x, y: (x - A[0], y - A[1])
    at_vertex = (A[0] == B[0]) & (A[1] == B[1])
    back = (F.when(at_vertex, b_before[0]).otherwise(B[0]) - A[0], F.when(at_vertex, b_before[1]).otherwise(B[1]) - A[1])
    ahead, enter, leave = to(B[2], B[3]), to(*before), to(A[2], A[3])
    turn = cross(back, ahead)
    between = lambda low, d, high: (cross(low, d) > 0) & (cross(d, high) > 0)
    inside = lambda d: F.when(turn > 0, between(back, d, ahead)).when(turn < 0, ~between(ahead, d, back)).otherwise(cross(back, d) > 0)
    on_b = (_turn(*B, A[0], A[1]) == 0) & _within_box(*B, A[0], A[1]) & ~((A[0] == B[2]) & (A[1] == B[3]))
    return on_b & (inside(enter) != inside(leave))


def crossings(vertices: DataFrame) -> DataFrame:
    """Features with a segment pair that makes the polygon invalid: (feature_id).

    Within a ring two segments may only share the vertex between neighbours;
    between rings they may touch in points, but neither share a piece of an edge
    nor cross, be it inside an edge or at a vertex. Segments meet through grid
    cells as large as the segment itself, on a level per power of two of its
    length, so a pair is looked for at the level of the longer one. Each
    segment opens at most four cells per level in use, and only pairs that
    share a cell are compared.
    """
    # repeated vertices make edges without length; the others are numbered without them
    seg = segments(vertices).where((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2")))
    seg = materialize(renumber(seg), "edges")
    ring_size = seg.groupBy(*RING).agg(F.max("seq").alias("_last"))
    seg = seg.join(shuffled(ring_size), RING)
    # the vertex before a segment's start is the start of the segment that ends there
    ends = seg.select(*RING, F.when(F.col("seq") == F.col("_last"), 0).otherwise(F.col("seq") + 1).alias("seq"), F.col("x").alias("px"), F.col("y").alias("py"))
    seg = seg.join(shuffled(ends), [*RING, "seq"])
    size = F.greatest(F.abs(F.col("x2") - F.col("x")), F.abs(F.col("y2") - F.col("y")))
    seg = seg.withColumn("level", F.ceil(F.log2(size)).cast("int") + 1)
    in_use = seg.groupBy("feature_id").agg(F.sort_array(F.collect_set("level")).alias("_levels"))

    def cells(df):
        edge = F.pow(F.lit(2.0), F.col("_level"))
        low_x, high_x = F.floor(F.least("x", "x2") / edge), F.floor(F.greatest("x", "x2") / edge)
        low_y, high_y = F.floor(F.least("y", "y2") / edge), F.floor(F.greatest("y", "y2") / edge)
        wide = df.withColumn("_cx", F.explode(F.sequence(low_x, high_x)))
        return wide.withColumn("_cy", F.explode(F.sequence(low_y, high_y)))

    home = cells(seg.withColumn("_level", F.col("level")))
    visits = cells(seg.join(shuffled(in_use), "feature_id").withColumn("_level", F.explode("_levels")).where(F.col("_level") >= F.col("level")).drop("_levels"))
    key = ["feature_id", "_level", "_cx", "_cy"]
    names = ["part", "ring", "seq", "x", "y", "x2", "y2", "px", "py", "_last"]
    a = visits.select(*key, "level", *[F.col(c).alias(f"a_{c}") for c in names])
    b = home.select(*key, *[F.col(c).alias(f"b_{c}") for c in names])
    pairs = a.join(shuffled(b), key)
    place = lambda p: F.struct(f"{p}_part", f"{p}_ring", f"{p}_seq")
    # same level: take each pair once; otherwise a is the shorter one
    pairs = pairs.where((F.col("level") < F.col("_level")) | (place("a") < place("b")))
    c = lambda n: F.col(n)
    A, B = (c("a_x"), c("a_y"), c("a_x2"), c("a_y2")), (c("b_x"), c("b_y"), c("b_x2"), c("b_y2"))
    t1, t2 = _turn(*A, B[0], B[1]), _turn(*A, B[2], B[3])
    t3, t4 = _turn(*B, A[0], A[1]), _turn(*B, A[2], A[3])
    proper = (t1 * t2 < 0) & (t3 * t4 < 0)
    touch = (
        proper
        | ((t1 == 0) & _within_box(*A, B[0], B[1])) | ((t2 == 0) & _within_box(*A, B[2], B[3]))
        | ((t3 == 0) & _within_box(*B, A[0], A[1])) | ((t4 == 0) & _within_box(*B, A[2], A[3]))
    )
    same_ring = (c("a_part") == c("b_part")) & (c("a_ring") == c("b_ring"))
    # Neighbours share one vertex; they are wrong only if they fold back on each other.
    after = (A[2] == B[0]) & (A[3] == B[1])
    before = (B[2] == A[0]) & (B[3] == A[1])
    gap = F.abs(c("a_seq") - c("b_seq"))
    adjacent = after & (c("b_seq") > c("a_seq")) & (gap == 1) | before & (c("a_seq") > c("b_seq")) & (gap == 1)
    around = (gap == c("a__last")) & (after | before)
    neighbour = adjacent | around
    dot = (A[2] - A[0]) * (B[2] - B[0]) + (A[3] - A[1]) * (B[3] - B[1])
    folded = (t1 == 0) & (t2 == 0) & (dot < 0)
    collinear = (t1 == 0) & (t2 == 0) & (t3 == 0) & (t4 == 0)
    p, q = (c("a_px"), c("a_py")), (c("b_px"), c("b_py"))
    across = proper | (collinear & _overlap(A, B)) | _through(A, p, B, q) | _through(B, q, A, p)
    wrong = F.when(same_ring & neighbour, folded).when(same_ring, touch).otherwise(across)
    return pairs.where(wrong).select("feature_id").distinct()


def _containment(probes: DataFrame, edges: DataFrame) -> DataFrame:
    """feature_id, part, ring, k of each probe with the rings (b_part, b_ring) that have edges over it: odd (it lies inside) and on (on an edge).

    Parity of the edges above the probe. Probes and edges meet in columns of a feature, as many as it has probes, so a probe sees the
    edges over its own column only.
    """
    sized = edges.groupBy("feature_id").agg(F.min(F.least("x", "x2")).alias("_lo"), F.max(F.greatest("x", "x2")).alias("_hi"))
    grid = sized.join(shuffled(probes.groupBy("feature_id").agg(F.count(F.lit(1)).alias("_n"))), "feature_id")
    column = lambda x: F.floor((x - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / F.col("_n")))
    spans = edges.select("feature_id", F.col("part").alias("b_part"), F.col("ring").alias("b_ring"), "x", "y", "x2", "y2").join(shuffled(grid), "feature_id")
    spans = spans.withColumn("_c", F.explode(F.sequence(column(F.least("x", "x2")), column(F.greatest("x", "x2"))))).drop("_lo", "_hi", "_n")
    asked = probes.join(shuffled(grid), "feature_id").withColumn("_c", column(F.col("px"))).drop("_lo", "_hi", "_n")
    met = asked.join(shuffled(spans), ["feature_id", "_c"]).where((F.col("part") != F.col("b_part")) | (F.col("ring") != F.col("b_ring")))
    x, y, x2, y2, px, py = map(F.col, ("x", "y", "x2", "y2", "px", "py"))
    over = ((x > px) != (x2 > px)) & (y + (px - x) * F.try_divide(y2 - y, x2 - x) > py)
    on = (_turn(x, y, x2, y2, px, py) == 0) & _within_box(x, y, x2, y2, px, py)
    return met.groupBy(*RING, "k", "b_part", "b_ring").agg((F.count_if(over) % 2 == 1).alias("odd"), F.bool_or(on).alias("on"))


def misplaced(vertices: DataFrame) -> DataFrame:
    """Features of several rings with a hole outside its shell, a hole inside another one, or a part inside another part: (feature_id).

    For rings that don't cross, where one vertex lies tells where the ring does. A vertex that lies on the other ring tells nothing; for
    such pairs all vertices and edge midpoints are tried, and the first that is off the other ring counts.
    """
    several = vertices.where(F.col("seq") == 0).groupBy("feature_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("feature_id")
    edges = materialize(segments(vertices.join(shuffled(several), "feature_id", "left_semi")), "ring-edges")
    edges = edges.where((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2")))
    first = edges.groupBy(*RING).agg(F.min_by(F.struct("x", "y"), "seq").alias("_p")).select(*RING, F.lit(0).alias("k"), F.col("_p.x").alias("px"), F.col("_p.y").alias("py"))
    pair = [*RING, "b_part", "b_ring"]
    found = materialize(_containment(first, edges), "ring-places")
    doubt = found.where("on").select(*pair)
    if not doubt.isEmpty():
        ends = edges.select(*RING, (F.col("seq") * 2).alias("k"), F.col("x").alias("px"), F.col("y").alias("py"))
        middles = edges.select(*RING, (F.col("seq") * 2 + 1).alias("k"), ((F.col("x") + F.col("x2")) / 2).alias("px"), ((F.col("y") + F.col("y2")) / 2).alias("py"))
        probes = materialize(ends.unionByName(middles).join(shuffled(doubt.select(*RING).distinct()), RING, "left_semi"), "ring-probes")
        places = materialize(_containment(probes, edges), "ring-doubts")
        # probes that no edge of the other ring is over lie outside of it
        off = probes.select(*RING, "k").join(shuffled(doubt), RING).join(shuffled(places.where("on").select(*pair, "k")), [*pair, "k"], "left_anti")
        off = off.groupBy(*pair).agg(F.min("k").alias("k"))
        sure = off.join(shuffled(places.where("odd").select(*pair, "k")), [*pair, "k"], "left_semi").select(*pair)
        inside = found.where("odd").select(*pair).join(shuffled(doubt), pair, "left_anti").unionByName(sure)
    else:
        inside = found.where("odd").select(*pair)
    own = F.col("part") == F.col("b_part")
    in_shell, in_holes = F.count_if(own & (F.col("b_ring") == 0)), F.count_if(own & (F.col("b_ring") > 0))
    holes = first.where("ring > 0").select(*RING).join(shuffled(inside), RING, "left").groupBy(*RING).agg(in_shell.alias("shell"), in_holes.alias("holes"))
    holes = holes.where("shell = 0 or holes > 0").select("feature_id")
    # a part may lie in a hole of another: then it is inside two of that part's rings
    shells = inside.where((F.col("ring") == 0) & ~own).groupBy("feature_id", "part", "b_part").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("feature_id")
    return holes.unionByName(shells).distinct()


def validity(vertices: DataFrame) -> DataFrame:
    """(feature_id, is_valid): closed rings of 4+ finite points with extent, no crossing, holes in their shell, not in each other, and parts beside each other."""
    rings = _ring_checks(vertices)
    sound = (F.col("n") >= 4) & F.col("closed") & F.col("finite") & F.col("wide")
    features = rings.groupBy("feature_id").agg(F.bool_and(F.coalesce(sound, F.lit(False))).alias("_sound"))
    # only sound features are searched for crossings (their numbers are finite), and only those without any for misplaced rings
    checked = vertices.join(shuffled(features.where("_sound").select("feature_id")), "feature_id", "left_semi")
    crossed = materialize(crossings(checked), "crossed")
    wrong = crossed.unionByName(misplaced(checked.join(few_or_shuffled(crossed), "feature_id", "left_anti"))).withColumn("_wrong", F.lit(True))
    return features.join(shuffled(wrong), "feature_id", "left").select(
        "feature_id", (F.col("_sound") & F.col("_wrong").isNull()).alias("is_valid")
    )


def simplify(vertices: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Thin each ring, and keep valid features valid.

    Features that were valid and are not after thinning are thinned anew with a quarter of the tolerance, until they are valid: at the latest when only
    vertices on a straight line go. Whether a feature was valid is asked only of those few that are not any more.
    """
    whole = materialize(vertices.select(*RING, "seq", "x", "y"), "simplify-whole")
    done, todo, step = [], whole, 0
    while True:
        thin = materialize(thinned(todo, tolerance / 4**step), "simplify-thin")
        broken = materialize(validity(thin).where(~F.col("is_valid")).select("feature_id"), "simplify-broken")
        if step == 0 and not broken.isEmpty():
            before = validity(whole.join(few_or_shuffled(broken), "feature_id", "left_semi"))
            broken = materialize(before.where("is_valid").select("feature_id"), "simplify-broken")
        known = few_or_shuffled(broken)
        done.append(thin.join(known, "feature_id", "left_anti"))
        if broken.isEmpty():
            return reduce(DataFrame.unionByName, done)
        todo, step = whole.join(known, "feature_id", "left_semi"), step + 1


def thinned(vertices: DataFrame, tolerance: float) -> DataFrame:
    """Thin each ring: a stretch whose vertices all lie within the tolerance keeps its ends only.

    Works in rounds over all rings at once. Every open stretch finds its
    farthest vertex with one aggregation and is cut there; stretches without
    one beyond the tolerance are done. To keep an area, a ring is always cut
    once, its first half always once more, and its second half too when the
    first half ends with fewer than three edges. Stretches may come to cross;
    ``simplify`` sees to that.
    """
    ends = vertices.groupBy(*RING).agg(F.max("seq").alias("_last"), F.min_by(F.struct("x", "y"), "seq").alias("_start"))
    stretch = [*RING, "lo", "hi"]
    placed = vertices.join(shuffled(ends), RING)
    inner = (F.col("seq") > 0) & (F.col("seq") < F.col("_last"))
    kept = [placed.where(~inner).select(*RING, "seq", "x", "y")]
    todo = placed.where(inner).select(
        *RING, "seq", "x", "y", F.lit(0).alias("lo"), F.col("_last").alias("hi"),
        F.col("_start.x").alias("lx"), F.col("_start.y").alias("ly"), F.col("_start.x").alias("hx"), F.col("_start.y").alias("hy"),
    )
    dx, dy = F.col("hx") - F.col("lx"), F.col("hy") - F.col("ly")
    along = F.try_divide((F.col("x") - F.col("lx")) * dx + (F.col("y") - F.col("ly")) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    off_x, off_y = F.col("x") - F.col("lx") - t * dx, F.col("y") - F.col("ly") - t * dy
    off = F.sqrt(off_x * off_x + off_y * off_y)

    def cut(open_rows: DataFrame, forced: Column) -> tuple[DataFrame, DataFrame]:
        """One round: (cuts made, vertices of the stretches that were cut)."""
        rows = materialize(open_rows.withColumn("d", off), "simplify-open")
        far = rows.groupBy(*stretch).agg(
            F.max_by(F.struct("seq", "x", "y", "d"), F.struct(F.col("d"), -F.col("seq"))).alias("far")
        )
        cuts = far.where((F.col("far.d") > tolerance) | forced).select(
            *stretch, F.col("far.seq").alias("c"), F.col("far.x").alias("cx"), F.col("far.y").alias("cy")
        )
        cuts = materialize(cuts, "simplify-cuts")
        left = F.col("seq") < F.col("c")
        pick = lambda a, b, name: F.when(left, F.col(a)).otherwise(F.col(b)).alias(name)
        halves = rows.join(shuffled(cuts), stretch).where(F.col("seq") != F.col("c")).select(
            *RING, "seq", "x", "y",
            pick("lo", "c", "lo"), pick("c", "hi", "hi"), pick("lx", "cx", "lx"), pick("ly", "cy", "ly"),
            pick("cx", "hx", "hx"), pick("cy", "hy", "hy"),
        )
        kept.append(cuts.select(*RING, F.col("c").alias("seq"), F.col("cx").alias("x"), F.col("cy").alias("y")))
        return cuts, halves

    def cut_until_done(open_rows: DataFrame, forced: Column) -> None:
        cuts, open_rows = cut(open_rows, forced)
        while not cuts.isEmpty():
            cuts, open_rows = cut(open_rows, F.lit(False))

    first, halves = cut(todo, F.lit(True))
    halves = materialize(halves, "simplify-halves")
    cut_until_done(halves, F.col("lo") == 0)
    # second halves that stayed whole beside a first half of fewer than three edges
    so_far = kept[0]
    for part in kept[1:]:
        so_far = so_far.unionByName(part)
    split = so_far.join(shuffled(first.select(*RING, "c")), RING).groupBy(*RING, "c").agg(
        F.count(F.when(F.col("seq") < F.col("c"), 1)).alias("_edges"), F.count(F.when(F.col("seq") > F.col("c"), 1)).alias("_after")
    )
    thin = split.where((F.col("_edges") < 3) & (F.col("_after") == 1)).select(*RING, F.col("c").alias("lo"))
    cut_until_done(halves.join(shuffled(thin), [*RING, "lo"], "left_semi"), F.lit(True))
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return renumber(out)
