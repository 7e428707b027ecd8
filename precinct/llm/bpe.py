"""Byte-pair encoding of whole texts by batched numpy merge rounds, and decoding.

The vocabulary is a `tokenizers` JSON file of a word-level BPE with byte symbols and an end-of-word suffix. A text is cut at
special tokens, normalised (NFC, white space, lower case per character), cut into words, and every word not met before
joins one flat symbol array per batch. In each round every word finds its lowest-rank pair, by binary search of
left * V + right in the sorted pair keys, and merges all places of it; finished words leave the array.

Null and empty texts have no tokens. Very long words cost rounds, not memory. Rows are independent: copies and repeated ids
give the same result each. Other columns are dropped, so their names can't clash.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import released

NONE = np.int64(1) << 40
#: Characters of texts that are encoded together.
PORTION = 1 << 19
#: White space that Python's str.split takes and the vocabulary's rules don't.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@dataclass
class Vocabulary:
    """The file's tables, as arrays; its size is that of the vocabulary."""

    pieces: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    first: np.ndarray
    last: np.ndarray
    special: dict[str, int]
    pattern: str
    base: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        ids = model["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pieces = [""] * (max([*ids.values(), *special.values()]) + 1)
        for text, i in [*ids.items(), *special.items()]:
            pieces[i] = text
        base = len(pieces)
        left, right = (np.array([ids[m[k]] for m in model["merges"]], np.int64) for k in (0, 1))
        merged = np.array([ids[a + b] for a, b in model["merges"]], np.int64)
        order = np.argsort(left * base + right, kind="stable")
        symbol = byte_symbols()
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        return cls(
            pieces, (left * base + right)[order], order.astype(np.int64), merged[order],
            np.array([ids[s] for s in symbol], np.int64), np.array([ids[s + suffix] for s in symbol], np.int64),
            special, pattern, base,
        )


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one flat array, and where each word's ids begin (one more for the end)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(words), np.uint8)
    sym = v.first[raw]
    sym[ends - 1] = v.last[raw[ends - 1]]
    word = np.repeat(np.arange(len(words)), sizes)
    done_sym, done_word = [], []
    while len(sym):
        rank = np.full(len(sym), NONE)
        key = sym[:-1] * v.base + sym[1:]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        found = (v.keys[at] == key) & (word[:-1] == word[1:])
        rank[:-1][found] = v.ranks[at[found]]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.minimum.reduceat(rank, starts)
        counts = np.diff(np.r_[starts, len(sym)])
        lowest = np.repeat(least, counts)
        hit = (rank == lowest) & (lowest < NONE)
        # of overlapping places of one pair every second one counts, from the left
        run = np.flatnonzero(hit)
        if len(run):
            fresh = np.r_[True, np.diff(run) > 1]
            offset = np.arange(len(run)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            run = run[offset % 2 == 0]
            sym[run] = v.merged[at[run]]
        keep = np.ones(len(sym), bool)
        keep[run + 1] = False
        still = lowest < NONE
        out = ~still
        done_sym.append(sym[out])
        done_word.append(word[out])
        keep &= still
        sym, word = sym[keep], word[keep]
    sym, word = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_sym, done_word))
    order = np.argsort(word, kind="stable")
    return sym[order].astype("<u4"), np.r_[0, np.cumsum(np.bincount(word.astype(np.int64), minlength=len(words)))]


class Encoder:
    """Encodes batches of texts; keeps the ids of at most twice `most` words between batches, of which those met again stay longer."""

    def __init__(self, v: Vocabulary, most: int = 1 << 16):
        self.v, self.most, self.known, self.older = v, most, {}, {}
        self.pattern = regex.compile(v.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Lists of normalised words between white space, and the ids of special tokens."""
        parts = self.special.split(text) if self.special and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.v.special[part]
            elif part:
                part = unicodedata.normalize("NFC", part) if not part.isascii() else part
                part = part.replace("Σ", "σ").lower()  # per character: no final form
                yield WHITE.split(part) if ODD_SPACE.search(part) else part.split()

    def learn(self, chunks: set[str]) -> None:
        names, words, counts = [], [], []
        for c in chunks:
            found = self.pattern.findall(c)
            names.append(c)
            counts.append(len(found))
            words += [w.encode() for w in found]
        unique = dict.fromkeys(words)
        for i, w in enumerate(unique):
            unique[w] = i
        flat, at = merge_words(list(unique), self.v) if unique else (np.empty(0, "<u4"), np.zeros(1, np.int64))
        raw, k = flat.tobytes(), 0
        ids = [raw[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        for c, n in zip(names, counts):
            self.known[c] = b"".join(ids[unique[w]] for w in words[k : k + n])
            k += n

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [list(self.pieces(t)) for t in texts]
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        new = set().union(*(p for parts in cut for p in parts if not isinstance(p, int))).difference(self.known)
        again = new.intersection(self.older)
        self.known |= {w: self.older[w] for w in again}
        self.learn(new - again)
        got = self.known.__getitem__
        return [b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(got, p)) for p in parts) for parts in cut]


IDS, DECODED = "doc_id long, n_tokens long, ids binary", "doc_id long, n_tokens long, ids binary, decoded string"
Batches = Iterator[pa.RecordBatch]


def portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a batch, of about PORTION characters at once."""
    ids, texts, at = batch.column("doc_id"), batch.column("text"), 0
    while at < len(texts):
        some, held = [], 0
        while at + len(some) < len(texts) and held < PORTION:
            some.append(texts[at + len(some)].as_py() or "")
            held += len(some[-1])
        yield ids.slice(at, len(some)), some
        at += len(some)


def _encoding(v: Vocabulary) -> Callable[[Batches], Batches]:
    def run(batches):
        encoder = Encoder(v)
        for b in batches:
            for doc_id, texts in portions(b):
                ids = encoder.batch(texts)
                yield pa.RecordBatch.from_arrays(
                    [doc_id, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return run


def _decoding(v: Vocabulary) -> Callable[[Batches], Batches]:
    def run(batches):
        got = [p.encode() for p in v.pieces].__getitem__
        for b in batches:
            texts = [b" ".join(map(got, np.frombuffer(x, "<u4").tolist())) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit), one row per row of docs."""
    return _rows(docs, doc_id, text).mapInArrow(released(_encoding(Vocabulary.load(vocabulary))), IDS)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds decoded string to doc_id, n_tokens, ids: the tokens' strings, with spaces between, as the file names no decoder."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(released(_decoding(Vocabulary.load(vocabulary))), DECODED)


def encode_decode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """decode(encode(docs)), both in the same Python worker: Spark would hold two of them for each task, with a vocabulary each."""
    v = Vocabulary.load(vocabulary)
    encoding, decoding = _encoding(v), _decoding(v)
    return _rows(docs, doc_id, text).mapInArrow(released(lambda batches: decoding(encoding(batches))), DECODED)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return encode_decode(docs, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
