"""Language-model scores from Elias-Fano tries of n-grams.

Training counts words and pairs (previous word, word) of all training texts. The model is a bigram with a Dirichlet prior on unigrams:

    P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU),    P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))

A trie has words on the first level and, below each, the words it followed. Levels are Elias-Fano sequences: the words' sorted hashes, the monotone
pointers to where a word's contexts begin, and the contexts' hashes, made monotone by their word's rank. log10(c(v, w) + MU * P(w)), log10 P(w) and
log10(c(w) + MU) are kept as 8-bit codes. A query finds the word by successor search in the first level, its range by two
pointers, and the context by successor search inside that range.

Tokens, of training and scored texts alike, are dealt by word to shards of bounded size, packed by chunks of documents: sorted words with run lengths, 32-bit
hashes of contexts, and document numbers. Words so frequent that they would fill much of a shard are dealt by word and context; their counts
come from the word counts made before, which also give N and V. A pair that a chunk holds HEAVY times or more goes to its shard as one entry with
its count, and the chunk keeps how often each document holds it: no pair brings a shard more than HEAVY tokens or one entry a chunk. A task builds the trie of one shard and scores the shard's tokens with it. As a word's
occurrence is also the next token's context, -log10(c(w) + MU) is added where w is, and every denominator is at hand without a second
shuffle. Chunks then sum up their documents' parts. Pairs of a shard whose contexts agree in 32 bits share an entry.

Null and empty texts have the end token only. A null id counts as the text ''. Rows are independent apart from the counts, where every training row
counts, repeated or not. A very long text is a chunk of its own. Other columns are dropped. Without training rows counts are 0 and the base has V = N = 0. Empty tables give no rows.
"""

from __future__ import annotations

import mmap

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import Scratch, WordHash, as_bytes, mix

MU = 100.0
#: Tokens of a shard and of a chunk.
SHARD, CHUNK = 1_000_000, 500_000
#: A pair that stands so often in a chunk is sent as one entry.
HEAVY = 32
# no word holds a space
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end", b" start"))
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Place of the r-th one in a byte.
SELECT = np.array([[*(k for k in range(8) if i >> k & 1), *[0] * (8 - bin(i).count("1"))] for i in range(256)], np.uint8)


def _map(raw: bytes) -> memoryview:
    """A read-only memory map that holds the bytes."""
    m = mmap.mmap(-1, max(1, len(raw)))
    m.write(raw)
    return memoryview(m).toreadonly()


class EliasFano:
    """A sorted sequence of integers below 2^63: low bits packed, high bits as unary gaps, in memory maps."""

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.n = len(values)
        universe = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (universe // max(1, self.n)).bit_length() - 1)
        low = values & np.uint64((1 << self.low_bits) - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(self.n)
        bits = np.zeros((int(high[-1]) if self.n else 0) // 64 * 64 + 64, np.uint8)
        bits[high] = 1
        self.high = np.frombuffer(_map(np.packbits(bits, bitorder="little").tobytes()), np.uint8)
        ones = POPCOUNT[self.high].reshape(-1, 8).sum(1)
        self.before = np.r_[0, np.cumsum(ones)].astype(np.int64)
        packed = b""
        if self.low_bits:
            step = max(1, (1 << 22) // self.low_bits) // 8 * 8 or 8
            shifts = np.arange(self.low_bits, dtype=np.uint64)
            packed = b"".join(np.packbits(((low[k : k + step, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes() for k in range(0, self.n, step))
        self.low = np.frombuffer(_map(packed + bytes(16)), np.uint8)
        self.bytes = len(self.high) + len(packed)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, i, side="right") - 1
        rank, at, left = i - self.before[word], word * 8, np.ones(len(i), bool)
        for _ in range(7):  # the byte of the word that holds the wanted one
            ones = POPCOUNT[self.high[at]]
            left &= rank >= ones
            if not left.any():
                break
            rank = np.where(left, rank - ones, rank)
            at = at + left
        place = at * 8 + SELECT[self.high[at], rank]
        out = (place - i).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            offset = i * self.low_bits
            wide = np.ndarray(len(self.low) - 8, "<u8", self.low, 0, (1,))[offset >> 3]
            out |= (wide >> (offset & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first place in [low, high) whose value is not smaller."""
        low, high = low.copy(), high.copy()
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            less = self.get(mid) < value[todo]
            low[todo] = np.where(less, mid + 1, low[todo])
            high[todo] = np.where(less, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        return low

    def find(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The place of the value in [low, high), or -1."""
        at = self.successor(low, high, value)
        inside = np.flatnonzero(at < high)
        out = np.full(len(at), -1, np.int64)
        same = inside[self.get(at[inside]) == value[inside]] if len(inside) else inside
        out[same] = at[same]
        return out


class Codes:
    """Numbers as 8-bit codes: 256 equal steps of their range, each with the mean of its members."""

    def __init__(self, values: np.ndarray):
        low, span = (values.min(), np.ptp(values)) if len(values) else (0.0, 0.0)
        self.codes = np.minimum((values - low) * (256 / span) if span else np.zeros(len(values)), 255).astype(np.uint8)
        members = np.maximum(1, np.bincount(self.codes, minlength=256))
        self.book = np.bincount(self.codes, values, 256) / members

    def __getitem__(self, i):
        return self.book[self.codes[i]]


class Trie:
    """words: sorted hashes (63 bits) with counts; pairs: sorted (rank of word << 32 | context) with counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, norm: float):
        self.words = EliasFano(words)
        of = (pairs >> np.uint64(32)).astype(np.int64)
        self.pointers = EliasFano(np.searchsorted(of, np.arange(len(words) + 1)))
        self.contexts = EliasFano(pairs)
        p = (counts + 0.5) / norm
        self.unigram, self.backoff = Codes(np.log10(p)), Codes(np.log10(counts + MU))
        self.bigram = Codes(np.log10(pair_counts + MU * p[of]))

    def query(self, words: np.ndarray, context_of: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word its place, or -1; of each (index into words, context) the log10 of its numerator."""
        zero = np.zeros(len(words), np.int64)
        at = self.words.find(zero, zero + self.words.n, words)
        rank = at[context_of]
        known = np.flatnonzero(rank >= 0)
        r = rank[known]
        found = self.contexts.find(self.pointers.get(r).astype(np.int64), self.pointers.get(r + 1).astype(np.int64), (r.astype(np.uint64) << np.uint64(32)) | contexts[known])
        out = np.full(len(rank), np.nan)
        hit = found >= 0
        out[known[hit]] = self.bigram[found[hit]]
        out[known[~hit]] = self.unigram[r[~hit]] + np.log10(MU)
        return at, out


def _tokens(text: bytes, hashes: WordHash) -> np.ndarray:
    return np.r_[hashes.of(text.lower().split()), END] >> np.uint64(1)


def _counts(docs: DataFrame) -> DataFrame:
    """word, n over the training texts: summed per batch, then by Spark."""

    def run(batches):
        hashes = WordHash()
        for b in batches:
            train = [_tokens(x, hashes) for x, held in zip(as_bytes(b.column("text")), b.column("held_out").to_pylist()) if not held]
            if train:
                words, n = np.unique(np.concatenate(train), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select("text", "held_out").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: A heavy pair as its shard gets it, with its count in training, and the head of how documents hold them.
ENTRY = np.dtype([("word", "<u8"), ("context", "<u4"), ("n", "<i8")])
PACKED = "shard long, chunk long, words binary, runs binary, contexts binary, rows binary, held binary, ids binary, sizes binary, heavy binary"
PARTS = "chunk long, shard long, ids binary, held binary, sizes binary, known binary, base binary, score binary, heavy binary, rows binary"


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


def _pack_kept(runs: np.ndarray, rows: np.ndarray, n: np.ndarray) -> bytes:
    """Documents per entry, and of each its number and count."""
    rows, n = _narrow(rows), _narrow(n)
    return np.array([len(runs), len(rows), rows.itemsize, n.itemsize], np.int64).tobytes() + runs.astype(np.uint32).tobytes() + rows.tobytes() + n.tobytes()


def _unpack_kept(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    entries, places, a, b = np.frombuffer(raw, np.int64, 4).tolist()
    at = 32 + 4 * entries
    rows, n = np.frombuffer(raw, f"<u{a}", places, at), np.frombuffer(raw, f"<u{b}", places, at + a * places)
    return np.repeat(np.arange(entries), np.frombuffer(raw, np.uint32, entries, 32)), rows, n


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _packed(docs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """A row per chunk and shard, and one per chunk (shard -1 and below) with the documents' ids."""

    def flush(number, ids, held, tokens):
        chunk = (TaskContext.get().partitionId() << 32) + number
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        words = np.concatenate(tokens)
        before = np.r_[np.uint64(0), words[:-1]]
        before[np.r_[0, np.cumsum(sizes)[:-1]]] = START >> np.uint64(1)
        scrambled = mix(before + np.uint64(0x2545F4914F6CDD1D))
        context = (scrambled >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(hot, words), max(0, len(hot) - 1))
        split = hot[at] == words if len(hot) else np.zeros(len(words), bool)
        shard = (mix(np.where(split, words ^ scrambled, words)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((context, words, shard))
        shard, words, context = shard[order], words[order], context[order]
        row = np.repeat(np.arange(len(tokens), dtype=np.uint32), sizes)[order]
        bits = np.packbits(np.array(held, bool)).tobytes()
        same = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (context[1:] != context[:-1]), True])
        often = np.diff(same) >= HEAVY
        is_heavy = np.repeat(often, np.diff(same))
        entry = np.repeat(np.cumsum(often) - 1, np.diff(same))[is_heavy]
        begin = same[:-1][often]
        train = np.bincount(entry[~np.array(held, bool)[row[is_heavy]]], minlength=len(begin))
        entries = np.zeros(len(begin), ENTRY)
        entries["word"], entries["context"], entries["n"] = words[begin], context[begin], train
        of_entry = shard[begin]
        # (entry, document) with counts, for the merge
        places, n = np.unique(entry.astype(np.uint64) << np.uint64(32) | row[is_heavy], return_counts=True)
        of = np.bincount((places >> np.uint64(32)).astype(np.int64), minlength=len(begin))
        kept = _pack_kept(of, places & np.uint64(0xFFFFFFFF), n)
        out = [(-1 - chunk % shards, chunk, None, None, None, None, bits, np.array([-1 if i is None else i for i in ids], np.int64).tobytes() + np.packbits([i is None for i in ids]).tobytes(), sizes.tobytes(), kept)]
        touched = np.unique(shard)
        shard, words, context, row = (x[~is_heavy] for x in (shard, words, context, row))
        row = row.astype(np.uint16 if len(tokens) <= 1 << 16 else np.uint32)
        for k in touched:
            a, b = np.searchsorted(shard, [k, k + 1])
            first = np.flatnonzero(np.r_[True, words[a + 1 : b] != words[a : b - 1]]) if b > a else np.empty(0, np.int64)
            runs = np.diff(np.r_[first, b - a]).astype(np.uint32)
            low, high = np.searchsorted(of_entry, [k, k + 1])
            out.append((int(k), chunk, words[a:b][first].tobytes(), runs.tobytes(), context[a:b].tobytes(), row[a:b].tobytes(), bits, None, None, entries[low:high].tobytes()))
        kinds = [pa.int64()] * 2 + [pa.binary()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_names(PACKED))

    def run(batches):
        hashes, number, size, ids, held, tokens = WordHash(), 0, 0, [], [], []
        for b in batches:
            for i, h, text in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), as_bytes(b.column("text"))):
                ids.append(i)
                held.append(h)
                tokens.append(_tokens(text, hashes))
                size += len(tokens[-1])
                if size >= CHUNK:
                    yield flush(number, ids, held, tokens)
                    number, size, ids, held, tokens = number + 1, 0, [], [], []
        if ids:
            yield flush(number, ids, held, tokens)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, PACKED)


def _scored(packed: DataFrame, norm: float, train_rows: int, hot: np.ndarray, hot_counts: np.ndarray) -> DataFrame:
    """Of each chunk and shard: known tokens, base and score by document."""

    def score(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        rows = sorted(part.to_pylist(), key=lambda r: r["chunk"])
        kinds = [pa.int64()] * 2 + [pa.binary()] * 8
        if key[0].as_py() < 0:
            out = [(r["chunk"], r["shard"], r["ids"], r["held"], r["sizes"], None, None, None, r["heavy"], None) for r in rows]
            return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_names(PARTS))
        each = [np.frombuffer(r["words"], np.uint64) for r in rows]
        entries = [np.frombuffer(r["heavy"], ENTRY) for r in rows]
        heavy = np.concatenate(entries)
        words, inverse = np.unique(np.concatenate([*each, heavy["word"]]), return_inverse=True)
        inverse = inverse.astype(np.uint64)
        runs = [np.frombuffer(r["runs"], np.uint32) for r in rows]
        rank = np.repeat(inverse[: len(inverse) - len(heavy)], np.concatenate(runs))
        keys = (rank << np.uint64(32)) | np.concatenate([np.frombuffer(r["contexts"], np.uint32) for r in rows])
        del rank
        heavy_keys = (inverse[len(inverse) - len(heavy) :] << np.uint64(32)) | heavy["context"]
        sizes = [int(x.sum()) for x in runs]
        ends = np.cumsum(sizes)
        docs, train = [], []
        for r, n in zip(rows, sizes):
            d = np.frombuffer(r["rows"], np.uint16 if len(r["rows"]) == 2 * n else np.uint32)
            docs.append(d)
            train.append(~np.unpackbits(np.frombuffer(r["held"], np.uint8)).astype(bool)[d])
        asked, back = np.unique(np.concatenate([keys, heavy_keys]), return_inverse=True)
        n = np.bincount(back, np.concatenate([*train, heavy["n"]]), len(asked)).astype(np.int64)
        pairs, pair_counts = asked[n > 0], n[n > 0]
        counts = np.bincount((pairs >> np.uint64(32)).astype(np.int64), pair_counts, len(words))
        if len(hot):
            at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
            counts = np.where(hot[at] == words, hot_counts[at], counts)
        some = counts > 0
        # ranks in the trie are those of the words that training has
        rank = (np.cumsum(some) - 1).astype(np.uint64)
        of = (pairs >> np.uint64(32)).astype(np.int64)
        inner = (rank[of] << np.uint64(32)) | (pairs & np.uint64(0xFFFFFFFF))
        trie = Trie(words[some], counts[some], inner, pair_counts, norm)
        asked_word = (asked >> np.uint64(32)).astype(np.int64)
        at, numerator = trie.query(words, asked_word, asked & np.uint64(0xFFFFFFFF))
        unseen = np.isnan(numerator)
        numerator[unseen] = np.log10(MU * 0.5 / norm)
        denominator = np.where(at >= 0, trie.backoff[np.maximum(at, 0)] if trie.words.n else 0.0, np.log10(MU))
        denominator = np.where(words == END >> np.uint64(1), np.log10(train_rows + MU), denominator)
        value, base, known = numerator - denominator[asked_word], np.log10(counts + 0.5)[asked_word], some[asked_word]
        out = []
        heavy_ends = len(keys) + np.cumsum([len(x) for x in entries])
        for r, d, low, high, first, last in zip(rows, docs, np.r_[0, ends[:-1]], ends, np.r_[len(keys), heavy_ends[:-1]], heavy_ends):
            b, h = back[low:high], back[first:last]
            # only documents that have tokens here: with many shards most have none
            some_rows, place = np.unique(d, return_inverse=True)
            sums = [np.bincount(place, x[b], len(some_rows)) for x in (known, base, value)]
            sums[0] = sums[0].astype(np.uint32)
            told = np.concatenate([x[h].astype(np.float64) for x in (known, base, value)])
            out.append((r["chunk"], r["shard"], None, None, None, *(x.tobytes() for x in sums), told.tobytes(), _narrow(some_rows).tobytes()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_names(PARTS))

    return packed.groupBy("shard").applyInArrow(score, PARTS)


def scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), a row per row of docs."""
    scratch = Scratch(spark)
    doc_id = docs["doc_id"].cast("long")
    held = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1
    docs = docs.select(doc_id.alias("doc_id"), held.alias("held_out"), docs["text"].cast("string").alias("text"))
    counts = scratch.write(_counts(docs), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    train_tokens, norm = total["n"], float(total["n"] + 0.5 * (total["v"] + 1))
    train_rows = sum(r["n"] for r in counts.where(F.col("word") == int(END >> np.uint64(1))).collect())
    shards = max(1, -(-train_tokens // SHARD))
    # no more than 4 * shards words can be that frequent
    frequent = sorted((r["word"], r["n"]) for r in counts.where(F.col("n") * 4 * shards > train_tokens).collect()) if shards > 1 else []
    hot, hot_counts = (np.array([x[k] for x in frequent], t) for k, t in ((0, np.uint64), (1, np.float64)))
    scratch.drop("counts")
    parts = scratch.write(_scored(_packed(docs, shards, hot), norm, train_rows, hot, hot_counts), "parts")

    def merge(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        rows = sorted(part.to_pylist(), key=lambda r: r["shard"])
        head = next(r for r in rows if r["ids"] is not None)
        sizes = np.frombuffer(head["sizes"], np.int64)
        n = len(sizes)
        ids = np.frombuffer(head["ids"][: 8 * n], np.int64)
        null = np.unpackbits(np.frombuffer(head["ids"][8 * n :], np.uint8))[:n].astype(bool)
        sums = np.zeros((3, n))
        # shards in order give the values of the entries in order
        entry, row, times = _unpack_kept(head["heavy"])
        told = np.concatenate([np.frombuffer(r["heavy"], np.float64).reshape(3, -1) for r in rows if r["ids"] is None], axis=1)
        for k in range(3):
            sums[k] += np.bincount(row, times * told[k][entry], n)
        for r in rows:
            if r["ids"] is None:
                some = len(r["base"]) // 8
                at = np.frombuffer(r["rows"], np.uint16 if len(r["rows"]) == 2 * some else np.uint32)
                for k, (name, kind) in enumerate((("known", np.uint32), ("base", np.float64), ("score", np.float64))):
                    sums[k, at] += np.frombuffer(r[name], kind)
        return pa.table({
            "doc_id": pa.array(ids, mask=null), "held_out": np.unpackbits(np.frombuffer(head["held"], np.uint8))[:n].astype(bool), "n_tokens": sizes,
            "n_known": sums[0].round().astype(np.int64), "base_score": sums[1] - sizes * np.log10(norm), "score": sums[2]})

    merged = parts.groupBy("chunk").applyInArrow(merge, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return merged.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
