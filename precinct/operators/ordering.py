"""Ranks, quantiles and numbering that never sort one group in one task.

All of them use ``order_bucket``: a pure, monotone function of the value. Rows
are first reduced to counts per (group, bucket); running totals over those
bounded histograms give every bucket its offset, and exact order is only
needed inside a bucket. Buckets that still hold many distinct values, as where
all values lie close together, are cut anew between their own smallest and
largest value until they are small or hold a single value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from precinct.session import materialize

BUCKETS_PER_OCTAVE = 4096
_TOP = 1 << 40
#: Distinct values of a bucket that may be sorted in one task, and pieces a larger one is cut into.
LARGE, PIECES = 100_000, 4096
#: Values of a group that are sorted whole for its quantiles.
SORTED = 10_000


def order_bucket(value: str) -> Column:
    """Monotone integer bucket of a double column, about 0.02 % wide; NaN sorts last."""
    v = f"cast(`{value}` as double)"
    octave = f"cast(floor(log2(abs({v})) * {BUCKETS_PER_OCTAVE}) + {1100 * BUCKETS_PER_OCTAVE} as bigint)"
    size = f"case when abs({v}) = double('infinity') then {_TOP} else {octave} end"
    return F.expr(
        f"case when isnan({v}) then {_TOP + 1} when {v} = 0 then 0L when {v} > 0 then {size} else -({size}) end"
    )


def _piece(value: str) -> Column:
    """Piece of a value between the smallest and largest of its bucket (``_lo``, ``_hi``); monotone, 0 to PIECES - 1."""
    share = F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")) * PIECES
    return F.coalesce(F.least(F.floor(share), F.lit(PIECES - 1)), F.lit(0)).cast("bigint")


def _refined(pairs: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct (group, value) with ``_bucket`` numbers in the order of values, no bucket with more than LARGE of them."""
    pairs, whole = materialize(pairs, "rank-pairs"), [group, "_bucket"]
    while True:
        sizes = pairs.groupBy(*whole).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        large = materialize(sizes.where((F.col("_n") > LARGE) & (F.col("_lo") < F.col("_hi")) & (F.abs("_hi") < float("inf")) & (F.abs("_lo") < float("inf"))), "large-buckets")
        if large.isEmpty():
            return pairs
        # every bucket leaves room for the pieces of the large ones; dense numbers keep them from growing out of range
        cut = pairs.join(large.drop("_n"), whole, "left").withColumn("_p", F.when(F.col("_lo").isNull(), F.lit(0)).otherwise(_piece(value)))
        numbers = cut.select(group, "_bucket", "_p").distinct().withColumn("_new", F.row_number().over(Window.partitionBy(group).orderBy("_bucket", "_p")).cast("bigint"))
        pairs = materialize(cut.join(numbers, [group, "_bucket", "_p"]).select(group, value, F.col("_new").alias("_bucket")), "rank-pairs")


def dense_rank_desc(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Dense rank of ``value`` within ``group``, highest = 1; rows without a group get 0.

    Only distinct (group, value) pairs are ranked, so copies of one value cost
    nothing, and the sort runs per (group, bucket).
    """
    pairs = (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .select(F.col(group), F.col(value))
        .distinct()
        .withColumn("_bucket", order_bucket(value))
    )
    pairs = _refined(pairs, group, value)
    above = Window.partitionBy(group).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pairs.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_bucket", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(F.desc(value))
    ranks = (
        pairs.withColumn("_in", F.row_number().over(inside))
        .join(offsets, [group, "_bucket"])
        .select(group, value, (F.col("_above") + F.col("_in")).cast("int").alias("_rank"))
    )
    return df.join(ranks, [group, value], "left").withColumn(out, F.coalesce("_rank", F.lit(0))).drop("_rank")


def _positions(kind: str, p: int, q: int, n: Column) -> tuple[Column, Column, Column]:
    """1-based ranks of the two neighbours and the weight (in q-ths) of the upper one."""
    if kind == "inclusive":  # position p/q * (n - 1), counted from 0
        h = (n - 1) * p
        low = (h - h % q) / q + 1
        return low.cast("bigint"), F.least(low + 1, n).cast("bigint"), h % q
    # exclusive: position p/q * (n + 1), counted from 1, kept inside the data;
    # the weight may leave [0, q] there, which extrapolates from the outer pair
    h = (n + 1) * p
    low = F.greatest(F.lit(1), F.least((h - h % q) / q, n - 1)).cast("bigint")
    return low, F.least(low + 1, n).cast("bigint"), h - low * q


def exact_quantiles(df: DataFrame, groups: list[str], value: str, picks: dict[str, tuple[str, int, int]]) -> DataFrame:
    """Exact quantiles per group.

    ``picks`` maps an output column to (kind, p, q) for the p/q quantile, kind
    being ``inclusive`` (linear between order statistics, ends included) or
    ``exclusive`` (position p/q * (n + 1)). Groups of up to SORTED values are sorted, after one shuffle; larger ones are scanned twice: once for
    bounded histograms, once for the few buckets that hold a wanted rank.
    """
    data = df.select(*groups, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if not groups:
        return _by_histogram(data, groups, picks)
    sizes = materialize(data.groupBy(*groups).agg(F.count(F.lit(1)).alias("_total")), "group-sizes")
    large = sizes.where(F.col("_total") > SORTED)
    n = sizes.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("_total") > SORTED).alias("large")).first()
    if n["all"] == n["large"]:
        return _by_histogram(data, groups, picks)
    if not n["large"]:
        return _by_order(data, groups, picks)
    same = [data[c].eqNullSafe(large[c]) for c in groups]
    return _by_order(data.join(large, same, "left_anti"), groups, picks).unionByName(_by_histogram(data.join(large, same, "left_semi"), groups, picks))


def _between(low: Column, high: Column, weight: Column) -> Column:
    return F.when(low == high, low).otherwise(low * (F.lit(1.0) - weight) + high * weight)


def _by_order(data: DataFrame, groups: list[str], picks: dict[str, tuple[str, int, int]]) -> DataFrame:
    """Equal values of a group counted, and running totals in their order; all of it in one partitioning by group."""
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    counted = data.repartition(*groups).groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
    at = lambda rank: F.max(F.when((rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n")), F.col("_v")))

    def value_of(name, kind, p, q):
        low, high, weight = _positions(kind, p, q, F.col("_total"))
        return _between(at(low), at(high), F.max(weight.cast("double") / q)).alias(name)

    return counted.groupBy(*groups).agg(*[value_of(name, *pick) for name, pick in picks.items()])


def _by_histogram(data: DataFrame, groups: list[str], picks: dict[str, tuple[str, int, int]]) -> DataFrame:
    data = data.withColumn("_bucket", order_bucket("_v"))
    keys = [F.col(g) for g in groups] or [F.lit(0)]
    hist = data.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    below = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select(
        *groups, "_bucket", "_n",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"),
        F.sum("_n").over(whole).alias("_total"),
    )
    wanted = []
    for name, (kind, p, q) in picks.items():
        low, high, weight = _positions(kind, p, q, F.col("_total"))
        for side, rank in (("low", low), ("high", high)):
            wanted.append(
                F.struct(F.lit(name).alias("pick"), F.lit(side).alias("side"), rank.alias("rank"),
                         (weight.cast("double") / q).alias("weight"))
            )
    targets = (
        hist.select(*groups, "_bucket", "_below", "_n", F.explode(F.array(*wanted)).alias("_t"))
        .where((F.col("_t.rank") > F.col("_below")) & (F.col("_t.rank") <= F.col("_below") + F.col("_n")))
        .select(*groups, "_bucket", "_t.pick", "_t.side", "_t.weight", (F.col("_t.rank") - F.col("_below")).alias("_r"))
    )
    # At most two rows per pick and group: once written, its size is known and
    # the scan below is not shuffled for it.
    targets = materialize(targets, "quantile-targets")
    hit = [*groups, "_bucket"]
    null_safe = lambda a, b, names: [a[c].eqNullSafe(b[c]) for c in names]
    buckets = targets.select(*hit).distinct()
    found = data.join(buckets, null_safe(data, buckets, hit), "left_semi")
    found, targets = _narrowed(materialize(found.groupBy(*hit, "_v").agg(F.count(F.lit(1)).alias("_n")), "quantile-values"), targets, hit)
    upto = Window.partitionBy(*hit).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_upto", F.sum("_n").over(upto))
    t, f = targets.alias("t"), found.alias("f")
    match = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in hit]
    picked = t.join(f, match).where((F.col("_r") <= F.col("f._upto")) & (F.col("_r") > F.col("f._upto") - F.col("f._n")))
    picked = picked.select(*[F.col(f"t.{g}").alias(g) for g in groups], "pick", "side", "weight", "_v")

    def value_of(name):
        at = lambda side: F.max(F.when((F.col("pick") == name) & (F.col("side") == side), F.col("_v")))
        weight = F.max(F.when(F.col("pick") == name, F.col("weight")))
        return _between(at("low"), at("high"), weight).alias(name)

    return picked.groupBy(*groups).agg(*[value_of(name) for name in picks])


def _narrowed(found: DataFrame, targets: DataFrame, hit: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counted values of the wanted buckets and the targets in them, cut until no bucket has more than LARGE distinct values."""
    same = lambda a, b, names: [a[c].eqNullSafe(b[c]) for c in names]
    while True:
        sizes = found.groupBy(*hit).agg(F.count(F.lit(1)).alias("_many"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        large = (F.col("_many") > LARGE) & (F.col("_lo") < F.col("_hi")) & (F.abs("_hi") < float("inf")) & (F.abs("_lo") < float("inf"))
        sizes = materialize(sizes.where(large), "large-buckets")
        if sizes.isEmpty():
            return found, targets
        cut = found.join(sizes, same(found, sizes, hit), "left").select(*[found[c] for c in hit], found["_v"], found["_n"], "_lo", "_hi")
        cut = materialize(cut.withColumn("_p", F.when(F.col("_lo").isNull(), F.lit(0)).otherwise(_piece("_v"))), "cut-values")
        below = Window.partitionBy(*hit).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        pieces = cut.groupBy(*hit, "_p").agg(F.sum("_n").alias("_m")).withColumn("_below", F.coalesce(F.sum("_m").over(below), F.lit(0)))
        t = targets.join(pieces, same(targets, pieces, hit)).where((F.col("_r") > F.col("_below")) & (F.col("_r") <= F.col("_below") + F.col("_m")))
        t = t.select(*[targets[c] for c in targets.columns if c not in ("_bucket", "_r")], F.struct(targets["_bucket"].cast("string").alias("b"), "_p").alias("_k"), (F.col("_r") - F.col("_below")).alias("_r"))
        # a piece is named by its bucket's name and its place
        name = lambda b, p: F.xxhash64(b, p)
        targets = materialize(t.withColumn("_bucket", name(F.col("_k.b"), F.col("_k._p"))).drop("_k"), "quantile-targets")
        cut = cut.withColumn("_bucket", name(F.col("_bucket").cast("string"), F.col("_p"))).select(*hit, "_v", "_n")
        wanted = targets.select(*hit).distinct()
        found = materialize(cut.join(wanted, same(cut, wanted, hit), "left_semi"), "quantile-values")


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Consecutive numbers from 1 in a total order, without a single-task window.

    The sorted rows are written with their partition number and place, then
    each partition's start is a running total over one row per partition.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = materialize(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", place), "numbered"
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return staged.join(starts, "_part").withColumn(out, F.col("_start") + F.col("_place") + 1).drop("_part", "_place", "_start")
