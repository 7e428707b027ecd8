"""Vectors as packed blocks of rows, and queries that pass by every block.

A block is one row with binaries, so a task holds one block of candidates and one block of queries at a time. Candidate blocks are shuffled once;
query blocks, the smaller side, are copied to every candidate block and stream past it in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id long and v array<double> of the rows that have an id and finite components only; -0 becomes 0."""
    v = F.transform(vectors["embedding"].cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), v.alias("v"))
    whole = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & whole)


def packed(rows: DataFrame, key: list[str], size: int, count: int, pack: Callable[[pa.Table], dict[str, bytes]]) -> DataFrame:
    """block, data: rows dealt by the hash of their key into blocks of about `size`; pack makes a group's arrays."""

    def run(number: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        data = pack(part)
        return pa.table({"block": pa.array([number[0].as_py()], pa.int64()), "data": pa.array([list(data.items())], pa.map_(pa.string(), pa.binary()))})

    block = F.pmod(F.xxhash64(*key), F.lit(blocks(size, count)))
    return rows.withColumn("_block", block).groupBy("_block").applyInArrow(run, "block long, data map<string,binary>")


def blocks(size: int, count: int) -> int:
    return max(1, -(-count // size))


def meet(candidates: DataFrame, n: int, queries: DataFrame, hold: Callable[[dict[str, bytes]], object],
         ask: Callable[[object, dict[str, bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Every block of queries by every one of the n blocks of candidates: ask(hold(candidates), queries)."""
    own = candidates.select("block", F.lit(-1).cast("long").alias("turn"), "data")
    each: Column = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    passing = queries.select(each.alias("block"), F.col("block").alias("turn"), "data")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for b in batches:
            for block, turn, data in zip(b.column("block").to_pylist(), b.column("turn").to_pylist(), b.column("data")):
                if turn < 0:
                    held, of = hold(dict(data.as_py())), block
                elif of == block:  # else no candidate fell into the block
                    yield from ask(held, dict(data.as_py()))

    return own.unionByName(passing).repartition(n, "block").sortWithinPartitions("block", "turn").mapInArrow(run, schema)


def matrix(lists: pa.ChunkedArray, wide: int) -> np.ndarray:
    """Lists of numbers as rows; what is missing at the end is 0."""
    whole = lists.combine_chunks()
    flat, sizes = whole.flatten().to_numpy(zero_copy_only=False), whole.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(sizes), wide), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
