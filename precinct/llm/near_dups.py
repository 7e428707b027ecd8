"""MinHash near-dedup with HyperMinHash registers.

A document's set holds its distinct shingles of `words` consecutive words (the whole sequence if it has fewer). Equal sets form one node,
so copies are never paired. Every shingle falls into one of 240 buckets; a bucket keeps the least hash as its count of leading zeros
and ten mantissa bits, 16 bits in all. Buckets left empty are filled by further rounds of hashing. Six registers make a band key, 40
bands: two sets with Jaccard 0.85 miss all of them with probability 6e-9. Sets so small that one different shingle already breaks the threshold
have equal sets only as partners and need no bands.

Nodes of one key are paired in full if they are up to sixteen, else only with hubs: in every large bucket the member of least hash is the hub, and a node
meets the first `HUBS` of its hubs. A pair must pass the size bound and the collision-corrected estimate of the registers, within six
standard errors, before its full sets are compared. Linked nodes are merged into components.

Large buckets that share members make a family. Families that still hold several components are described by a reference R, the shingles that most of a
bounded sample of members have, and by each member's edits, E(x) = x without R and R without x. With S = |x| + |z|, x and z are linked if and
only if |x xor z| <= b S, where b = (1 - t) / (1 + t) for threshold t, and |x xor z| = |E(x) xor E(z)|. So

* where |E(x)| + |E(z)| <= b S, the pair is linked without being compared; the member for which |E| - b |.| is least tells all components of such pairs,
* all other linked pairs share an edit, and even one among the first b S + 1 edits of each in any common order, here the rarest first, as
  |E(x)| and |E(z)| differ by b S at most, and S <= |x| (1 + 1 / t). From the first they share on, either has as many edits left as they must share.

Members of a family that share such an edit are the buckets of the next round. What a family edits in common is in its reference, so few buckets
are left. After `ROUNDS` rounds the members outside the largest component of a bucket are paired with those of other components in it. R decides how much work
is done, never what is linked: no pair that shares a band is lost, and no cap is set.

Null and empty texts and texts without words have no set: each is its own component. Rows without id are their own component (null)
and stay. An id in several rows is one node for all its sets. Repeated rows count once. Very long texts are hashed in pieces; their sets must fit in a
task. Other columns are dropped by `components` and kept by `deduplicated`. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.llm.common import Scratch, as_bytes, fits, mix, ngram_hashes, released, word_hashes

BUCKETS, ROWS, MANTISSA = 240, 6, 10
#: Per cent that the intersection must be of the union.
PERCENT = 85
#: Standard errors that an estimate may lie below the threshold; smaller sets are always compared.
ERRORS, LEAST = 6.0, 64
#: Nodes of a bucket that is paired in full; hubs that a node of larger ones meets; rounds before all that is left is paired; members sampled for a reference.
SMALL, HUBS, ROUNDS, SAMPLE = 16, 4, 2, 33
#: Shingles that are sketched at once.
SLICE = 1 << 19


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    h = word_hashes(text.lower())
    return np.unique(ngram_hashes(h, min(n, len(h)))) if len(h) else np.empty(0, np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit registers for each non-empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    out, empty = np.zeros(len(sets) * BUCKETS, np.uint16), np.ones(len(sets) * BUCKETS, bool)
    k = 0
    while len(flat):
        # round k has hashes of its own and fills only buckets that all rounds before left empty
        with np.errstate(over="ignore"):
            h = mix(flat + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15))
        at = of * BUCKETS + (mix(h ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(BUCKETS)).astype(np.int64)
        free = empty[at]
        place, inverse = np.unique(at[free], return_inverse=True)
        least = np.full(len(place), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, inverse, h[free])
        out[place] = _register(least)
        empty[place] = False
        left = empty.reshape(len(sets), BUCKETS).any(1)[of]
        flat, of, k = flat[left], of[left], k + 1
    return out.reshape(len(sets), BUCKETS)


def _register(least: np.ndarray) -> np.ndarray:
    """Leading zeros and the mantissa bits after the first one."""
    zeros = 53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 63 - MANTISSA).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row."""
    bands = regs.reshape(len(regs), -1, ROWS).astype(np.uint64)
    keys = np.arange(bands.shape[1], dtype=np.uint64) + np.zeros((len(regs), 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return keys.astype(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard from equal registers, less those that chance alone makes equal."""
    equal = (a == b).mean(1)
    i = np.arange(53)
    low = lambda n: (1 - 2.0 ** -(i + 1)) ** (n[:, None] / BUCKETS) - (1 - 2.0**-i) ** (n[:, None] / BUCKETS)
    chance = (low(na) * low(nb)).sum(1) / 2**MANTISSA
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def _sketches(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set) and, where other sets can be linked, the registers."""

    def run(batches):
        for b in batches:
            sets = [shingle_set(x, n) for x in as_bytes(b.column("text"))]
            regs, some, held = {}, [], 0
            for k, s in enumerate(sets):
                if 100 * len(s) >= percent * (len(s) + 1):
                    some.append(k)
                    held += len(s)
                if some and (held >= SLICE or k + 1 == len(sets)):
                    regs |= zip(some, registers([sets[i] for i in some]))
                    some, held = [], 0
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([regs[k].tobytes() if k in regs else None for k in range(len(sets))], pa.binary())],
                names=["doc_id", "n_shingles", "node", "registers"])

    return docs.mapInArrow(released(run), "doc_id long, n_shingles long, node binary, registers binary")


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            regs = np.frombuffer(b"".join(b.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)
            keys = band_keys(regs)
            times = np.full(len(keys), keys.shape[1])
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.ravel(), pa.int64()), pa.array(np.repeat(b.column("id").to_numpy(), times)), pa.array(np.repeat(b.column("n").to_numpy(), times))],
                names=["k", "id", "n"])

    return nodes.select("id", "n", "registers").mapInArrow(released(run), "k long, id long, n long")


def _promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the estimate does not rule out."""
    left, right = (nodes.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("registers").alias(f"r{c}")) for c in "hx")
    both = pairs.join(left, "h").join(right, "x")
    need = percent / 100 - ERRORS * (percent / 100 * (1 - percent / 100) / BUCKETS) ** 0.5

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("rh", "rx"))
            na, nb = (b.column(c).to_numpy().astype(float) for c in ("nh", "nx"))
            yield b.select(["h", "x"]).filter(pa.array((estimate(ra, rb, na, nb) >= need) | (np.minimum(na, nb) < LEAST)))

    return both.select("h", "x", "nh", "nx", "rh", "rx").mapInArrow(released(run), "h long, x long").distinct()


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """id and its full set, of every row of the wanted ids."""

    def run(batches):
        for b in batches:
            sets = [shingle_set(x, n) for x in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "set"])

    return docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id").mapInArrow(released(run), "id long, set array<long>").where(F.size("set") > 0).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs h, x linked on full sets."""
    both = pairs.join(sets.select(F.col("id").alias("h"), F.col("set").alias("sh")), "h").join(sets.select(F.col("id").alias("x"), F.col("set").alias("sx")), "x")
    common = F.size(F.array_intersect("sh", "sx"))
    return both.where(100 * common >= percent * (F.size("sh") + F.size("sx") - common)).select(F.col("h").alias("a"), F.col("x").alias("b"))


def _hash(*columns: str | Column) -> Column:
    return F.xxhash64(*columns)


def _buckets(scratch: Scratch, rows: DataFrame, turn: int) -> DataFrame:
    """The rows with m, the number of rows of the key, and h, its hub with its size and component; keys of several components only."""
    # most keys have one row: only their numbers and the others' rows go further
    several = rows.groupBy("k").agg(F.count("*").alias("m")).where("m > 1")
    rows = rows.join(several, "k")
    zero = F.lit(0).cast("long")
    rows = scratch.write(rows if "c" in rows.columns else rows.withColumns({"c": F.col("id"), "e": zero, "rest": zero}), f"several-{turn}")
    first = F.min(F.struct(_hash("id", F.lit(turn)).alias("place"), "id", "n", "c")).alias("h")
    keys = rows.groupBy("k").agg(first, F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    return rows.join(keys.select("k", "h"), "k")


def _sized(a: Column, b: Column, percent: int) -> Column:
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _reach(a, b, percent: int) -> Column:
    """Two members whose first common edit this is can have as many in common as a link needs: no more than are left of either from here on."""
    return (100 + percent) * (a("e") + b("e") - 2 * F.least(a("rest"), b("rest"))) <= (100 - percent) * (a("n") + b("n"))


def _in_full(small: DataFrame, percent: int) -> DataFrame:
    """h, x: all pairs of a bucket that are of different components, of fitting sizes and within reach. Equal buckets are paired once."""
    members = F.sort_array(F.collect_set(F.struct("id", "n", "c", "e", "rest"))).alias("members")
    lists = small.groupBy("k").agg(members).select("members").distinct()
    fit = lambda a, b: (a["id"] < b["id"]) & (a["c"] != b["c"]) & _sized(a["n"], b["n"], percent) & _reach(a.getField, b.getField, percent)
    pairs = F.transform("members", lambda a: F.transform(F.filter("members", lambda b: fit(a, b)), lambda b: F.struct(a["id"].alias("h"), b["id"].alias("x"))))
    return lists.select(F.explode(F.flatten(pairs)).alias("p")).select("p.h", "p.x").distinct()


def _with_hubs(large: DataFrame, percent: int) -> DataFrame:
    """h, x: every member with the first of its hubs that are of other components and fitting sizes."""
    other = (F.col("h.c") != F.col("c")) & _sized(F.col("h.n"), F.col("n"), percent)
    stars = large.where(other).select("h.place", F.col("h.id").alias("h"), F.col("id").alias("x")).distinct()
    return stars.withColumn("at", F.row_number().over(Window.partitionBy("x").orderBy("place", "h"))).where(F.col("at") <= HUBS).select("h", "x")


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """h, x: members outside the largest component of a bucket with those of its other components, of fitting sizes and within reach."""
    sizes = rows.groupBy("k", "c").agg(F.count("*").alias("of")).groupBy("k").agg(F.max(F.struct("of", "c")).alias("top"))
    told = rows.join(sizes.select("k", F.col("top.c").alias("top")), "k")
    one, two = (told.select("k", "top", *[F.col(c).alias(f"{c}{i}") for c in ("id", "n", "c", "e", "rest")]) for i in "ab")
    of = lambda i: lambda c: F.col(f"{c}{i}")
    fit = (F.col("ca") != F.col("cb")) & _sized(F.col("na"), F.col("nb"), percent) & _reach(of("a"), of("b"), percent)
    pairs = one.where("ca <> top").join(two.drop("top"), "k").where(fit).select(F.col("ida").alias("a"), F.col("idb").alias("b"))
    return pairs.select(F.least("a", "b").alias("h"), F.greatest("a", "b").alias("x")).distinct()


def _families(scratch: Scratch, large: DataFrame, label: str) -> DataFrame:
    """id, n, g: the members of large buckets with their family; buckets that share members are of one family."""
    of = scratch.write(large.select("id", "n", F.struct(F.col("h.place"), F.col("h.id").alias("h")).alias("h")).distinct(), f"{label}-hubs")
    main = scratch.write(of.groupBy("id", "n").agg(F.min("h").alias("main")).select("id", "n", F.col("main.h").alias("main")), f"{label}-main")
    edges = of.join(main.select("id", "main"), "id").select(F.col("main").alias("a"), F.col("h.h").alias("b")).where("a <> b").distinct()
    named = connected(scratch, edges, f"{label}-families")
    out = main.join(named.select(F.col("id").alias("main"), "component"), "main", "left").select("id", "n", F.coalesce("component", "main").alias("g"))
    out = scratch.write(out, label)
    scratch.drop(f"{label}-hubs", f"{label}-main")
    return out


def _mixed(members: DataFrame, names: DataFrame) -> DataFrame:
    """The members of families of several components, with their component c."""
    told = members.drop("c").join(names, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    mixed = told.groupBy("g").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("g")
    return told.join(mixed, "g")


def _references(members: DataFrame, sets: DataFrame) -> DataFrame:
    """g, reference: the shingles that most of a sample of the family's members have."""
    place = F.row_number().over(Window.partitionBy("g").orderBy(_hash("id"), "id"))
    some = members.select("g", "id").withColumn("at", place).where(F.col("at") <= SAMPLE).join(sets, "id")
    counts = some.groupBy("g").agg(F.count("*").alias("of"))
    common = some.select("g", F.explode("set").alias("s")).groupBy("g", "s").agg(F.count("*").alias("df")).join(counts, "g").where("2 * df > of")
    return counts.select("g").join(common.groupBy("g").agg(F.collect_list("s").alias("reference")), "g", "left").withColumn("reference", F.coalesce("reference", F.array().cast("array<long>")))


def _edits(members: DataFrame, sets: DataFrame, references: DataFrame, percent: int) -> DataFrame:
    """g, id, n, v = (100 + percent) |E| - (100 - percent) n, and the edits E."""

    def run(batches):
        for b in batches:
            own = [np.setxor1d(s.values.to_numpy(), r.values.to_numpy(), assume_unique=True) for s, r in zip(b.column("set"), b.column("reference"))]
            n = b.column("n").to_numpy()
            v = (100 + percent) * np.fromiter(map(len, own), np.int64, len(own)) - (100 - percent) * n
            yield pa.RecordBatch.from_arrays([b.column("g"), b.column("id"), b.column("n"), pa.array(v, pa.int64()), pa.array(own, pa.list_(pa.int64()))], names=["g", "id", "n", "v", "own"])

    both = members.select("g", "id").join(sets, "id").join(references, "g").select("g", "id", F.size("set").cast("long").alias("n"), "set", "reference")
    return both.mapInArrow(released(run), "g long, id long, n long, v long, own array<long>")


def _near_reference(edits: DataFrame) -> DataFrame:
    """a, b: links that follow from the distances to the reference alone, by way of the member that is nearest for its size."""
    nearest = edits.groupBy("g").agg(F.min(F.struct("v", "id")).alias("z")).select("g", F.col("z.v").alias("vz"), F.col("z.id").alias("b"))
    return edits.select("g", F.col("id").alias("a"), "v").join(nearest, "g").where((F.col("v") + F.col("vz") <= 0) & (F.col("a") != F.col("b"))).select("a", "b").distinct()


def _rare_edits(edits: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """k, id, n, c: members that share one of the rarest edits of each, of families with several components; e: how many edits, rest: from this one on."""
    told = edits.drop("n").join(members, ["g", "id"]).withColumn("take", F.floor(F.col("n") * (100 - percent) / percent) + 1)
    # dealt by member, as one family may have a third of them
    listed = told.repartition("id").select("g", F.explode("own").alias("s"), "id", "n", "c", F.size("own").alias("of"), "take")
    shared = listed.groupBy("g", "s").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("df")).where("df > 1")
    by = Window.partitionBy("g", "id")
    # edits that no other member has come first
    place = F.col("of") - F.count("*").over(by) + F.row_number().over(by.orderBy("df", "s"))
    rare = listed.join(shared, ["g", "s"]).withColumn("place", place).where((F.col("place") <= F.col("take")) & (F.col("low") < F.col("high")))
    return rare.select(_hash("g", "s").alias("k"), "id", "n", "c", F.col("of").cast("long").alias("e"), (F.col("of") - F.col("place") + 1).cast("long").alias("rest")).distinct()


def connected(scratch: Scratch, links: DataFrame, label: str) -> DataFrame:
    """id, component (its smallest id) of every linked id. Each round hooks ids to their smallest neighbour and contracts the links."""
    edges = scratch.write(links.where("a <> b"), f"{label}-edges-0")
    names, k = None, 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        parent = scratch.write(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), f"{label}-parent-{k}")
        above = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = scratch.write(parent.join(above, "p", "left").select("a", F.coalesce("pp", "p").alias("p")), f"{label}-jump-{k}")
        up = jump.select(F.col("a").alias("b"), F.col("p").alias("q"))
        fewer = edges.join(jump, "a").join(up, "b").select(F.col("p").alias("a"), F.col("q").alias("b")).where("a <> b").distinct()
        fewer = scratch.write(fewer, f"{label}-edges-{k + 1}")
        if names is None:
            new = jump.select(F.col("a").alias("id"), F.col("p").alias("component"))
        else:
            new = names.join(jump, names["component"] == jump["a"], "left").select("id", F.coalesce("p", "component").alias("component"))
        names = scratch.write(new, f"{label}-names-{k}")
        edges, k = fewer, k + 1
    return names if names is not None else scratch.spark.createDataFrame([], "id long, component long")


def components(spark: SparkSession, docs: DataFrame, words: int = 3, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of docs."""
    scratch = Scratch(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    sketched = scratch.write(_sketches(docs, words, percent), "sketches")
    named = sketched.where("doc_id is not null and node is not null")
    # equal sets have equal registers
    same = named.groupBy("node").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    reps = scratch.write(same, "reps")
    nodes = reps.where("registers is not null").select("id", "n", "registers")
    rows = _bands(nodes)
    links, names, sets, turn = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "id long, component long"), None, 0
    while True:
        buckets = scratch.write(_buckets(scratch, rows, turn), f"buckets-{turn}")
        small, large = buckets.where(F.col("m") <= SMALL), buckets.where(F.col("m") > SMALL)
        pairs = _in_full(small, percent).union(_with_hubs(large, percent) if turn < ROUNDS else _across(large, percent)).distinct()
        near = scratch.write(_promising(scratch.write(pairs, f"pairs-{turn}"), nodes, percent), f"near-{turn}")
        if sets is None:
            ids = scratch.write(near.select("h").union(near.select("x")).union(large.select("id")).toDF("id").distinct(), "ids")
            sets = scratch.write(_sets(docs, fits(ids, ids.count(), 16), words), "sets")
        links = scratch.write(links.union(_linked(near, sets, percent)).distinct(), f"links-{turn}")
        names = connected(scratch, links, f"names-{turn}")
        if turn == ROUNDS or large.isEmpty():
            break
        members = scratch.write(_mixed(_families(scratch, large, f"members-{turn}"), names), f"mixed-{turn}")
        scratch.drop(f"several-{turn}", f"buckets-{turn}", f"pairs-{turn}", f"near-{turn}", f"members-{turn}")
        if members.isEmpty():
            break
        edits = scratch.write(_edits(members, sets, _references(members, sets), percent), f"edits-{turn}")
        reached = scratch.write(_near_reference(edits), f"reached-{turn}")
        links = links.union(reached)
        told = _mixed(members.drop("c"), connected(scratch, links, f"told-{turn}")) if not reached.isEmpty() else members
        rows = scratch.write(_rare_edits(edits, told, percent), f"rare-{turn}")
        scratch.drop(f"edits-{turn}")
        if rows.isEmpty():
            names = connected(scratch, links, "names")
            break
        turn += 1
    scratch.drop("sets")
    home = scratch.write(reps.select("node", "id").join(names, "id", "left").select("node", F.coalesce("component", "id").alias("component")), "home")
    keyed = sketched.join(home, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return keyed.select("doc_id", "n_shingles", component.cast("long").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def deduplicated(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of every component, with all columns: that of its smallest id, and of several rows of that id the first by text and digest."""
    scratch = Scratch(spark)
    found = components(spark, docs, words, percent)
    gone = scratch.write(found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    key = docs["doc_id"].cast("long")
    several = docs.where(key.isNotNull()).groupBy(key.alias("_several")).agg(F.count("*").alias("n")).where("n > 1").select("_several")
    several = scratch.write(several, "several")
    keep = docs.join(fits(gone, gone.count(), 16), key == gone["_gone"], "left_anti")
    if several.isEmpty():
        return keep
    again = several["_several"] == keep["doc_id"].cast("long")
    # inside one struct no name of docs can clash
    r = F.col("r")
    order = Window.partitionBy(r["doc_id"]).orderBy(r["text"], F.md5(F.to_json(r)))
    one = keep.join(several, again, "left_semi").select(F.struct(*[keep[c] for c in docs.columns]).alias("r"))
    one = one.select("r", F.row_number().over(order).alias("n")).where("n = 1").select("r.*")
    return keep.join(several, again, "left_anti").unionByName(one)


#: DuckDB: all pairs that share a shingle, then the smallest id reachable.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i + 1 : i + 3], ' ') AS g FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 3, 0) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
