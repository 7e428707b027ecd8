"""Nearest neighbours by cosine: multi-index hashing of learned binary codes.

A rotation is learned on a bounded sample of the vectors (`SAMPLE`, by hash): principal directions, turned until the signs of the rotated sample
lie as close as possible to it (iterative quantisation); spaces of fewer than 64 dimensions are filled up with further random rotations.
The signs of every vector are its code of 64 bits, cut into four substrings of 16 bits, each with an index of its own.

All vectors are indexed, in blocks of bounded size; every block of queries passes by every block. A query probes the four indexes with all substrings
at distance 0, then 1, and so on. After the tables up to number j were probed at distance d, every code within the Hamming radius 4 d + j
has been met (pigeonhole), and all of these are reranked by the exact cosine. The radius grows until a vector as near as the k-th best
found so far would lie inside it: its distance is expected at 64 * angle / pi, and the margin over that, in standard deviations, is
the least that holds `CONFIDENCE` of the true neighbours inside the sample. No bucket, radius or number of candidates is capped.

Equal vectors are one entry with their smallest ids, as no more than k + 1 of them can be answers, and equal queries are asked once.
What a block returns are k + 1 rows of each query, its own perhaps among them; that one is dropped at the end.

Rows without id and vectors that are null, zero, or hold null or non-finite components take no part. Missing components of shorter vectors
count as 0. Repeated ids are rows like others: only the query's own row is no candidate for it, and each row of a query id is answered. Ties go to
the smaller id. Very long vectors need a block of them in memory. Other columns are dropped. Without a query or a candidate there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.llm.blocks import blocks, matrix, meet, packed, usable
from precinct.llm.common import Scratch

BITS, PARTS, WIDTH = 64, 4, 16
BLOCK, QUERIES, SAMPLE, ASKED = 32_768, 4096, 8192, 512
CONFIDENCE = 0.98


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish; angles stay the same."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, initial=0))[1][:, None])


def squares(v: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", v, v)


def cosines(q: np.ndarray, square: float, v: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Of one scaled vector with scaled rows, all with their squares; a row's value does not depend on the others, and is 1 if both are equal."""
    return np.einsum("ij,j->i", v, q) / np.sqrt(each * square)


@dataclass
class Codes:
    rotation: np.ndarray
    margin: float

    def of(self, v: np.ndarray) -> np.ndarray:
        return np.packbits(v @ self.rotation > 0, axis=1, bitorder="little").view("<u8").ravel()

    def radius(self, cosine: float) -> int:
        """Hamming distance within which a vector of this cosine is expected."""
        p = float(np.arccos(np.clip(cosine, -1, 1))) / np.pi
        return int(np.ceil(BITS * p + self.margin * (BITS * p * (1 - p)) ** 0.5))


def fit(sample: np.ndarray, k: int, rounds: int = 40, confidence: float = CONFIDENCE) -> Codes:
    """Codes learned on scaled rows. Where the sample has too few rows to tell, everything lies within the radius."""
    r = np.random.default_rng(0)
    u = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    wide = u.shape[1]
    directions = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, :BITS]
    turn = np.linalg.qr(r.normal(size=(directions.shape[1],) * 2))[0]
    z = u @ directions
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
        turn = (left @ right).T
    columns = [directions @ turn]
    while sum(c.shape[1] for c in columns) < BITS:
        columns.append(np.linalg.qr(r.normal(size=(wide, wide)))[0])
    codes = Codes(np.concatenate(columns, axis=1)[:, :BITS], 0.0)
    if len(u) < 4 * (k + 1):
        return Codes(codes.rotation, float("inf"))
    bits, asked = codes.of(u), np.arange(0, len(u), max(1, len(u) // ASKED))
    near = u[asked] @ u.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argpartition(-near, k, axis=1)[:, : k + 1]
    cosine = np.take_along_axis(near, best, 1).min(1)
    p = np.arccos(np.clip(cosine, -1, 1))[:, None] / np.pi
    distance = np.bitwise_count(bits[asked][:, None] ^ bits[best])
    spread = np.maximum((BITS * p * (1 - p)) ** 0.5, 0.5)
    return Codes(codes.rotation, max(0.0, float(np.quantile((distance - BITS * p) / spread, confidence))))


#: All 16-bit differences by their number of bits.
_FLIPS = [np.flatnonzero(np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint32)) == d).astype(np.int64) for d in range(WIDTH + 1)]


class Index:
    """A block of entries: their codes, each substring's buckets, and what is needed to rerank and to answer."""

    def __init__(self, data: dict[str, bytes], wide: int, codes: Codes):
        self.keys = np.frombuffer(data["keys"], np.int64).reshape(-1, 2)
        self.v = np.frombuffer(data["v"], np.float64).reshape(len(self.keys), wide)
        self.ids, self.starts = np.frombuffer(data["ids"], np.int64), np.frombuffer(data["starts"], np.int64)
        self.codes, self.scheme, self.squares = codes.of(self.v), codes, squares(self.v)
        self.tables = []
        for j in range(PARTS):
            part = ((self.codes >> np.uint64(WIDTH * j)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
            self.tables.append((np.argsort(part, kind="stable"), np.r_[0, np.cumsum(np.bincount(part, minlength=1 << WIDTH))]))

    def probes(self, code: int) -> Iterator[tuple[int, np.ndarray]]:
        """radius, entries: rounds of probing; after each all codes within the radius have been met, and the entries are those at that distance."""
        far = np.full(len(self.codes), BITS + 1, np.uint8)
        left = len(far)
        for radius in range(BITS + 1):
            d, j = divmod(radius, PARTS)
            if left:
                order, starts = self.tables[j]
                values = (code >> WIDTH * j & (1 << WIDTH) - 1) ^ _FLIPS[d]
                first, n = starts[values], starts[values + 1] - starts[values]
                some = np.flatnonzero(n)
                first, n = first[some], n[some]
                entries = order[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                entries = entries[far[entries] > BITS]
                far[entries] = np.bitwise_count(self.codes[entries] ^ np.uint64(code))
                left -= len(entries)
            # nearer ones were within an earlier radius
            yield radius, np.flatnonzero(far == radius)

    def search(self, q: np.ndarray, code: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """entry, vec_id and score of the k + 1 best rows found."""
        rows, scores, square = np.empty(0, np.int64), np.empty(0), squares(q[None])[0]
        for radius, entries in self.probes(code):
            if len(entries):
                rows, scores = np.r_[rows, entries], np.r_[scores, cosines(q, square, self.v[entries], self.squares[entries])]
                if len(scores) > k + 1:
                    edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    rows, scores = rows[scores >= edge], scores[scores >= edge]
            if len(rows) > k and radius >= self.scheme.radius(scores.min()):
                break
        n = self.starts[rows + 1] - self.starts[rows]
        ids = self.ids[np.repeat(self.starts[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        rows, scores = np.repeat(rows, n), np.repeat(scores, n)
        best = np.lexsort((ids, -scores))[: k + 1]
        return rows[best], ids[best], scores[best]


def _pack(wide: int, with_ids: bool):
    def pack(part: pa.Table) -> dict[str, bytes]:
        keys = np.stack([part.column(c).to_numpy() for c in ("kx", "ky")], 1).astype(np.int64)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        out = {"keys": keys[order].tobytes(), "v": scaled(matrix(part.column("v"), wide))[order].tobytes()}
        if with_ids:
            ids = part.column("ids").combine_chunks().take(pa.array(order))
            out |= {"ids": ids.flatten().to_numpy().astype(np.int64).tobytes(), "starts": np.r_[0, np.cumsum(ids.value_lengths().to_numpy())].astype(np.int64).tobytes()}
        return out

    return pack


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, queries: int = QUERIES, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query row's k nearest found; is_query is an expression over vec_id."""
    scratch = Scratch(spark)
    rows = usable(vectors).where(F.exists("v", lambda x: x != 0))
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("kx"), F.xxhash64(F.lit(1), "v").alias("ky"))
    rows = scratch.write(rows.groupBy("vec_id", "kx", "ky").agg(F.count("*").alias("copies"), F.first("v").alias("v")), "rows")
    # equal vectors: the k + 1 smallest ids, copies counted
    listed = rows.select("kx", "ky", "v", "vec_id", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k + 1)))).alias("copy"))
    place = F.row_number().over(Window.partitionBy("kx", "ky").orderBy("vec_id", "copy"))
    entries = listed.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("kx", "ky").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = scratch.write(entries, "entries")
    asked = scratch.write(rows.where(is_query).groupBy("kx", "ky").agg(F.first("v").alias("v")), "asked")
    n, wide = entries.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    # about SAMPLE of the entries, by hash
    share = min(1.0, SAMPLE / max(1, n))
    sample = entries.where(F.pmod(F.xxhash64("ky", "kx"), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").limit(2 * SAMPLE).toArrow()
    codes = fit(scaled(matrix(sample.column("v"), wide)), k, confidence=confidence) if sample.num_rows else Codes(np.zeros((wide, BITS)), float("inf"))

    def ask(index: Index, data: dict[str, bytes]) -> Iterator[pa.RecordBatch]:
        keys = np.frombuffer(data["keys"], np.int64).reshape(-1, 2)
        v = np.frombuffer(data["v"], np.float64).reshape(len(keys), wide)
        got = [index.search(q, code, k) for q, code in zip(v, codes.of(v).tolist())]
        sizes = np.array([len(g[0]) for g in got], np.int64)
        of, (entry, ids, scores) = np.repeat(np.arange(len(keys)), sizes), (np.concatenate(x) for x in zip(*got))
        yield pa.RecordBatch.from_arrays([*(pa.array(keys[of, c]) for c in (0, 1)), pa.array(ids), pa.array(scores), pa.array((index.keys[entry] == keys[of]).all(1))],
                                         names=["kx", "ky", "vec_id", "score", "same"])

    held = packed(entries, ["kx", "ky"], block, n, _pack(wide, True))
    passing = packed(asked, ["ky", "kx"], queries, asked.count(), _pack(wide, False))
    found = meet(held, blocks(block, n), passing, lambda data: Index(data, wide, codes), ask, "kx long, ky long, vec_id long, score double, same boolean")
    place = F.row_number().over(Window.partitionBy("kx", "ky").orderBy(F.desc("score"), "vec_id", "same"))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("kx", "ky").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "same"))).alias("best"))
    # each query row without itself; of several rows like it, one goes
    each = rows.where(is_query).select("vec_id", "kx", "ky", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    mine = F.filter("best", lambda x: x["same"] & (x["vec_id"] == F.col("query_id")))
    others = F.filter("best", lambda x: F.coalesce(x["place"] != F.col("mine"), F.lit(True)))
    out = each.withColumnRenamed("vec_id", "query_id").join(best, ["kx", "ky"]).withColumn("mine", F.get(mine, F.lit(0))["place"])
    out = out.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
