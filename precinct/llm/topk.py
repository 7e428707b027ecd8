"""Exact top-k by inner product: term-at-a-time accumulation over blocks of candidates.

Vectors become integers, floor(64 * x) of every component. Candidates are dealt into blocks, queries into blocks of bounded
size; a task holds one block of candidates, and the blocks of queries pass by it one after the other. The candidates of a block are
postings by dimension; every non-zero component of a query scatters its weighted postings into the dense scores of the block. Postings of most of a
block are columns, and sums are made in the narrowest numbers that hold them exactly. The best k of
each block are selected by partition, and the blocks' winners merged per query, where Spark cuts to k rows per query before it shuffles.
Work grows with queries x rows, as every score counts.

Vectors that are null, or hold null or non-finite components, and rows without an id take no part. Repeated ids are rows like
others: each is a candidate and, if its id is asked for, a query, which leaves out its own row only. Equal rows are one entry with their
number. Missing components of shorter vectors count as 0. Ties go to the smaller id. Scores are 64-bit integers; components beyond
2^24 times 64 may overflow them. Other columns are dropped. No query or no candidate gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.llm.blocks import blocks, matrix, meet, packed, usable
from precinct.llm.common import Scratch

BLOCK, QUERIES = 16_384, 4096
#: Share of a block from which on a dimension is held as a whole column.
COMMON = 0.2


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id long, v array<long>, key (a hash of v) and copies, one row for all equal rows."""
    rows = usable(vectors).select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("v"))
    return rows.groupBy("vec_id", "v").agg(F.count("*").alias("copies")).withColumn("key", F.xxhash64("v"))


def _pack(part: pa.Table) -> dict[str, bytes]:
    """Ids, keys, copies and vectors as integers, by id."""
    ids, keys, copies = (part.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "key", "copies"))
    lists = part.column("v").combine_chunks()
    m = matrix(part.column("v"), int(lists.value_lengths().to_numpy().max(initial=0)))
    small = m.astype(np.int16) if m.size and np.abs(m).max() < 1 << 15 else m
    order = np.lexsort((keys, ids))
    arrays = {"ids": ids, "keys": keys, "copies": copies, "v": small}
    return {c: x[order].tobytes() for c, x in arrays.items()} | {"shape": np.array([small.shape[1], small.itemsize]).tobytes()}


class Entries:
    def __init__(self, data: dict[str, bytes]):
        self.ids, self.keys, self.copies = (np.frombuffer(data[c], np.int64) for c in ("ids", "keys", "copies"))
        wide, size = np.frombuffer(data["shape"], np.int64)
        self.v = np.frombuffer(data["v"], f"i{size}").reshape(len(self.ids), wide)


class Postings:
    """A block of candidates by dimension: which of them are not zero there, and their values; of dimensions that most of them have, all values."""

    def __init__(self, data: dict[str, bytes]):
        self.entries = Entries(data)
        v = self.entries.v
        self.most = np.abs(v.astype(np.float64)).max(0, initial=0)
        self.of, self.kind = [self._listed(v[:, d]) for d in range(v.shape[1])], v.dtype

    def _listed(self, values: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
        """Places and values, or no places and the whole column: to pick places costs several times what adding zeros does."""
        at = np.flatnonzero(values)
        return (None, values.copy()) if len(at) > COMMON * len(values) else (at, values[at])

    def fit(self, weights: np.ndarray) -> np.ndarray:
        """The weights, and from now on the postings, as the narrowest numbers in which all sums are exact."""
        wide = min(weights.shape[1], len(self.of))
        bound = np.abs(weights[:, :wide].astype(np.float64)).max(0, initial=0) @ self.most[:wide]
        kind = next((k for k, digits in ((np.float32, 24), (np.float64, 53)) if bound < 1 << digits), np.int64)
        if kind != self.kind:
            self.of, self.kind = [(at, v.astype(kind)) for at, v in self.of], np.dtype(kind)
        self.product = np.empty(len(self.entries.ids), kind)
        return weights[:, :wide].astype(kind)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        scores = np.zeros(len(self.entries.ids), self.kind)
        for d in np.flatnonzero(weights):
            at, v = self.of[d]
            product = np.multiply(v, weights[d], out=self.product[: len(v)])
            if at is None:
                scores += product
            else:
                scores[at] += product
        return scores

    def best(self, q: int, key: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but the query's own, ties to smaller ids."""
        e, scores = self.entries, self.scores(weights)
        copies = e.copies
        own = slice(*np.searchsorted(e.ids, [q, q + 1]))
        if own.start < own.stop:
            copies = copies.copy()
            copies[own] -= e.keys[own] == key
        rows = np.flatnonzero(copies)
        if len(rows) > k:
            s = scores[rows]
            edge = np.partition(s, len(s) - k)[len(s) - k]
            above, ties = rows[s > edge], rows[s == edge]
            rows = np.r_[above, ties[: k - len(above)]]
        rows = rows[np.lexsort((e.ids[rows], -scores[rows]))]
        rows = np.repeat(rows, np.minimum(copies[rows], k))[:k]
        return e.ids[rows], scores[rows].astype(np.int64)


def search(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query row's k best; is_query is an expression over vec_id."""
    rows = Scratch(spark).write(quantised(vectors), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    held = packed(rows, ["vec_id", "key"], block, counts["n"], _pack)
    asked = packed(rows.where(is_query), ["key", "vec_id"], queries, counts["q"], _pack)

    def ask(postings: Postings, data: dict[str, bytes]) -> Iterator[pa.RecordBatch]:
        e = Entries(data)
        got = [postings.best(q, key, w, k) for q, key, w in zip(e.ids.tolist(), e.keys.tolist(), postings.fit(e.v))]
        of = np.repeat(np.arange(len(got)), [len(ids) for ids, _ in got])
        found = (np.concatenate(x) for x in zip(*got))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (e.ids[of], e.keys[of], e.copies[of], *found)], names=["query_id", "key", "copies", "vec_id", "score"])

    best = meet(held, blocks(block, counts["n"]), asked, Postings, ask, "query_id long, key long, copies long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    each = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", each.alias("copy")).drop("copy")


#: DuckDB: all products, summed by component. For unique ids.
SQL = """
WITH e AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest([CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
