"""What the operators share: tables, intermediates in the shared folder, word kernels."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precinct.session import scratch_path

#: Most bytes of rows that may be broadcast; larger sides are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators of the two kinds of words, as Java and Python patterns alike.
SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Arrow batches are kept small, as single texts can be very long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _shuffle_files_dropped(spark: SparkSession):
    """Shuffle files of a write go when it has ended, as nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables of one run in the shared folder; a table that is done with is emptied."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
        path = scratch_path(self.spark, label)
        with _shuffle_files_dropped(self.spark):
            df.write.options(**(options or {})).parquet(path)
        self.paths[label] = (path, df.schema)
        return self.spark.read.schema(df.schema).parquet(path)

    def bytes(self, label: str, row: int) -> int:
        """Rows of a written table times the given size of a row."""
        path, schema = self.paths[label]
        return self.spark.read.schema(schema).parquet(path).count() * row

    def drop(self, *labels: str) -> None:
        for label in labels:
            path, schema = self.paths.pop(label)
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def fits(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marked for broadcast if its counted rows, all of a known size, stay below the bound, else for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df.hint("merge")


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value in a row of Spark, at most."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, F.lit(32).cast("long"), lambda n, x: n + _bytes(x, kind.elementType) + 1), F.lit(32).cast("long"))
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(24).cast("long"))
    return F.lit(16).cast("long")


def measured(df: DataFrame) -> int:
    """Bytes of all rows of a written table, strings and arrays by their real sizes."""
    row = sum((_bytes(df[f.name], f.dataType) for f in df.schema.fields), F.lit(24).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("n")).first()["n"]


def fits_measured(df: DataFrame) -> DataFrame:
    """As `fits`, for rows that hold strings or arrays: by their summed sizes."""
    return F.broadcast(df) if measured(df) <= BROADCAST_BYTES else df.hint("merge")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column, separators: str) -> Column:
    """The words between separators; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def released(run: Callable) -> Callable:
    """A function over Arrow batches whose tasks give memory back to the system when they end.

    Workers outlive their tasks: what their allocators keep would stand beside the executor's heap in all later stages.
    """

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return whole


#: For bytes.translate: lower-cases A-Z and makes every separator of NOT_WORD a space.
WORD_BYTES = bytes(
    0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


class WordHash(dict):
    """64-bit hashes of words; what is kept is bounded by `most`, checked by `of`."""

    def __init__(self, most: int = 1 << 19):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: An odd number and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, from the words' hashes: a polynomial, as differences of running sums."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(hashes) - 1, b, np.uint64)]) for b in (_BASE, _INVERSE))
        sums = np.r_[np.uint64(0), np.cumsum(hashes * down, dtype=np.uint64)]
        return mix((sums[n:] - sums[:-n]) * up[: len(hashes) - n + 1])


#: White space of bytes.split.
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes hashed at once; a longer word is hashed whole.
PIECE = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE, n)
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            _POWERS[size] = tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (_INVERSE, _BASE))
    return _POWERS[size]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, as bytes.split cuts it: polynomials of their bytes, as differences of running sums."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            # a piece ends at white space, or where the word that fills it ends
            spaces = np.flatnonzero(_SPACES[np.frombuffer(text, np.uint8, end - at, at)])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                while end < len(text) and not _SPACES[text[end]]:
                    end += 1
        b = np.frombuffer(text, np.uint8, end - at, at)
        edges = np.flatnonzero(np.diff(np.r_[True, _SPACES[b], True]))
        starts, ends = edges[::2], edges[1::2]
        down, up = _powers(len(b))
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * down[: len(b)], dtype=np.uint64)]
            out.append(mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)
