"""Minimax contiguous sharding of ordered atomic groups.

Equal texts form a group that stays whole. Groups stand in the order of a hash of their text. The least capacity for which a
greedy walk fills no more than the given number of shards is found by binary search; the cuts are then made under that capacity.

The driver never sees the groups. It holds segments, ranges of the hash with their byte sums. For a capacity it walks the segments
twice: as if a segment could be cut anywhere (what is then impossible is impossible) and as if it could not be cut (what is then
possible is possible). The two capacities enclose the answer; segments with more than one group in which a cut could fall are split
64-fold by one aggregation, until both agree. So its state is bounded by shards x rounds, whatever the number of rows.

Rows: a null text has 0 bytes, CRC 0 and is one group with the other null texts; size is bytes + 1. Repeated rows each get a slot of their
own; null ids are allowed. Empty tables give no rows. Other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.llm.common import Scratch, fits

BITS, FIRST, STEP = 60, 12, 6
#: Rows of a slice within which slots are numbered by one sort.
SLICE = 100_000


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the 60-bit order key of the group."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.conv(F.substring(F.md5(F.concat(F.when(F.col("text").isNull(), F.lit("0")).otherwise(F.lit("1")).cast("binary"), raw)), 1, BITS // 4), 16, 10)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), key.cast("long").alias("k"))


def _children(groups: DataFrame, segments: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first key, bits, bytes, groups) of the non-empty parts of the given segments (first key, bits)."""
    if not segments:
        return []
    begin, bits = F.lit(None).cast("long"), F.lit(None).cast("int")
    for level in sorted({b for _, b in segments}):
        starts = [s for s, b in segments if b == level]
        size = BITS - level
        inside = F.shiftleft(F.shiftright("k", size), size) if size else F.col("k")
        deeper = BITS - min(BITS, level + STEP)
        hit = inside.isin(starts)
        begin = F.when(hit, F.shiftleft(F.shiftright("k", deeper), deeper) if deeper else F.col("k")).otherwise(begin)
        bits = F.when(hit, F.lit(BITS - deeper)).otherwise(bits)
    rows = groups.select(begin.alias("s"), bits.alias("b"), "bytes").where("s is not null")
    got = rows.groupBy("s", "b").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
    return sorted((r["s"], r["b"], r["bytes"], r["n"]) for r in got)


def walk(segments: list[tuple], capacity: int, shards: int, fluid: bool) -> list[int] | None:
    """Byte offsets of the greedy cuts, or None if the shards don't suffice. fluid: segments of several groups can be cut anywhere."""
    cuts, used, at = [], 0, 0
    for _, _, size, n in segments:
        if fluid and n > 1:
            while used + size > capacity:
                step = capacity - used
                at, size, used = at + step, size - step, 0
                cuts.append(at)
                if len(cuts) >= shards:
                    return None
        elif size > capacity:
            return None
        elif used + size > capacity:
            cuts.append(at)
            used = 0
            if len(cuts) >= shards:
                return None
        used += size
        at += size
    return cuts + [at] * (shards - len(cuts))


def least(segments: list[tuple], shards: int, fluid: bool) -> int:
    """The smallest capacity of a possible walk, by binary search."""
    low, high = 0, sum(s[2] for s in segments)
    while low < high:
        mid = (low + high) // 2
        if walk(segments, mid, shards, fluid) is None:
            low = mid + 1
        else:
            high = mid
    return low


def level_cuts(segments: list[tuple], capacity: int, shards: int) -> list[int]:
    """Cuts under the capacity that aim at the mean of what is left, so that no shard is left empty needlessly."""
    total, at, used, begun, cuts = sum(s[2] for s in segments), 0, 0, 0, []
    for _, _, size, _ in segments:
        left = shards - len(cuts)
        mean = -(-(total - begun) // left)
        if left > 1 and used and (used + size > capacity or used + size - mean > mean - used):
            cuts.append(at)
            begun, used = at, 0
        used += size
        at += size
    cuts += [at] * (shards - len(cuts))
    loads = [b - a for a, b in zip([0, *cuts], cuts)]
    return cuts if max(loads, default=0) <= capacity else walk(segments, capacity, shards, False)


def cut_keys(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity and the first key of every shard but the first (shards without groups begin beyond all keys)."""
    every = groups.groupBy(F.shiftleft(F.shiftright("k", BITS - FIRST), BITS - FIRST).alias("s")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    segments = sorted((r["s"], FIRST, r["bytes"], r["n"]) for r in every.collect())
    if not segments:
        return 0, [1 << BITS] * (shards - 1)
    while True:
        low, high = least(segments, shards, True), least(segments, shards, False)
        ends = [walk(segments, low, shards, True), walk(segments, high, shards, True), walk(segments, high, shards, False), level_cuts(segments, high, shards)]
        ends += [c for c in (walk(segments, low, shards, False),) if c]
        spans = [(min(e[i] for e in ends), max(e[i] for e in ends)) for i in range(shards - 1)]
        wanted, at = [], 0
        for s, b, size, n in segments:
            if n > 1 and b < BITS and any(lo <= at + size and hi >= at for lo, hi in spans):
                wanted.append((s, b))
            at += size
        if not wanted or low == high and all(lo == hi for lo, hi in spans):
            break
        chosen = set(wanted)
        segments = sorted([x for x in segments if x[:2] not in chosen] + _children(groups, wanted))
    offsets, at = {}, 0
    for s, _, size, _ in segments:
        offsets[at] = s
        at += size
    return high, [offsets.get(c, 1 << BITS) for c in level_cuts(segments, high, shards)[: shards - 1]]


def shard(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, one row per row of docs."""
    scratch = Scratch(spark)
    rows = scratch.write(keyed(docs), "rows")
    groups = scratch.write(rows.groupBy("k").agg(F.sum("size").alias("bytes")), "groups")
    _, starts = cut_keys(groups, shards)
    scratch.drop("groups")
    number = sum((F.col("k") >= s).cast("int") for s in starts) if starts else F.lit(0)
    count = rows.count()
    slices = max(1, count // (SLICE * shards))
    placed = rows.select("doc_id", "size", "text_crc32", "k", number.cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id", "k"), F.lit(slices)).alias("slice"))
    sizes = placed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "k")) - 1
    return placed.withColumn("within", within).join(fits(offsets, slices * shards, 24), ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
