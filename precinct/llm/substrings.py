"""Substring dedup by seed and extend over winnowed anchors.

A window is `WINDOW` consecutive words. Of its shingles of `SEED` words the one with the least hash (leftmost of equals) is its anchor, so equal
windows have equal anchors at the same place in them, and a text has about one anchor in five words. Seeds are anchors that occur in more
than one document. At every seed occurrence the match is extended both ways as far as windows of that anchor reach: this neighbourhood, a block, is what
other occurrences are joined by, and not pairs of documents. A block that stands in a document with a smaller id is repeated as a whole. Of the
blocks that are the first of their kind but share the anchor with others, the windows are joined one by one. Repeated windows that overlap
form the maximal repeats, whose words are removed from every document but the first that holds them.

Matches are of 64-bit hashes of the words under the anchor's 64-bit hash. Hot seeds are reduced by partial aggregation before any join, and joins
put one row per occurrence on a key, which Spark may split.

Null and empty texts have no words. Rows without id neither lose words nor cause removal. Rows of one id never remove each other's words; rows are told
apart by id and a hash of the text, so repeated rows give equal results. Very long texts are hashed in pieces, in one row. Other columns are dropped. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import Scratch, as_bytes, mix, ngram_hashes, word_hashes

WINDOW, SEED = 13, 4


def winnow(hashes: np.ndarray, window: int = WINDOW, seed: int = SEED):
    """Place and hash of each anchor, and the first and last start of the windows that have it."""
    if len(hashes) < window:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    g = ngram_hashes(hashes, seed)
    at = np.lib.stride_tricks.sliding_window_view(g, window - seed + 1).argmin(1)
    at = at + np.arange(len(at))
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], g[at[first]], first, np.r_[first[1:], len(at)] - 1


def _anchors(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            found = [winnow(word_hashes(x)) for x in as_bytes(b.column("text"))]
            if not found:
                continue
            counts = [len(f[0]) for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([f[1] for f in found]).view(np.int64)),
                pa.array(np.repeat(b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), counts)),
                pa.array(np.concatenate([f[0] for f in found]).astype(np.int32))], names=["anchor", "doc_id", "at"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "anchor long, doc_id long, at int")


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks at the given places: their hash, first window start and window hashes."""

    def run(batches):
        for b in batches:
            out = []
            for doc_id, row, text, places in zip(b.column("doc_id").to_pylist(), b.column("row").to_pylist(), as_bytes(b.column("text")), b.column("places")):
                h = word_hashes(text)
                at, anchor, low, high = winnow(h)
                wanted, n = np.isin(at, places.values.to_numpy()), high - low + 1
                if not wanted.any():
                    continue
                windows = ngram_hashes(h, WINDOW)
                offset = np.arange(len(windows)) - np.repeat(low, n)
                with np.errstate(over="ignore"):
                    placed = mix(windows + offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    block = mix(np.add.reduceat(placed, low) + ((at - low) * 64 + n).astype(np.uint64))
                count = int(wanted.sum())
                out.append((np.full(count, doc_id), np.full(count, row), anchor[wanted], block[wanted], low[wanted], n[wanted], windows[np.repeat(wanted, n)]))
            if out:
                doc_ids, row_ids, anchors, blocks, lows, sizes, windows = (np.concatenate(c) for c in zip(*out))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(windows.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.view(np.int64)) for c in (doc_ids, row_ids, anchors, blocks)), pa.array(lows.astype(np.int32)), lists],
                    names=["doc_id", "row", "anchor", "block", "low", "windows"])

    return docs.mapInArrow(run, "doc_id long, row long, anchor long, block long, low int, windows array<long>")


def repeats(spark: SparkSession, scratch: Scratch, docs: DataFrame) -> DataFrame:
    """doc_id, row and the starts of the repeated windows as runs (start, end), a row per document that has some."""
    anchors = scratch.write(_anchors(docs), "anchors")
    seeds = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    seeds = scratch.write(seeds, "seeds")
    places = anchors.join(seeds, "anchor").groupBy("doc_id").agg(F.collect_list("at").alias("places"))
    places = scratch.write(places, "places")
    scratch.drop("anchors", "seeds")
    blocks = scratch.write(_blocks(docs.join(places, "doc_id").select("doc_id", "row", "text", "places")), "blocks")
    scratch.drop("places")
    kinds = scratch.write(blocks.groupBy("anchor", "block").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "kinds")
    variants = kinds.groupBy("anchor").agg(F.count("*").alias("n"), F.min("first").alias("low"), F.max("last").alias("high")).where("n > 1 and low < high").select("anchor")
    firsts = kinds.join(variants, "anchor").select("anchor", "block", F.col("first").alias("doc_id"))
    windows = blocks.join(firsts, ["anchor", "block", "doc_id"], "left_semi").dropDuplicates(["anchor", "block"]).select(
        "anchor", "block", "doc_id", F.posexplode("windows").alias("offset", "window"))
    windows = scratch.write(windows, "windows")
    known = scratch.write(windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("anchor", "window", "first"), "known")
    parts = windows.join(known, ["anchor", "window"]).where("first < doc_id").groupBy("anchor", "block").agg(F.collect_list("offset").alias("offsets"))
    # one table to join, so that Spark can split the occurrences of a hot block
    told = scratch.write(kinds.join(parts, ["anchor", "block"], "left").where("first < last or offsets is not null").select("anchor", "block", "first", "offsets"), "told")
    scratch.drop("windows", "known", "kinds")
    again = blocks.select("doc_id", "row", "anchor", "block", "low", F.size("windows").alias("n")).join(told, ["anchor", "block"])
    whole = F.array(F.struct(F.col("low").alias("start"), (F.col("low") + F.col("n") + (WINDOW - 1)).alias("end")))
    single = F.transform("offsets", lambda o: F.struct((F.col("low") + o).alias("start"), (F.col("low") + o + WINDOW).alias("end")))
    spans = again.select("doc_id", "row", F.explode(F.when(F.col("doc_id") > F.col("first"), whole).otherwise(single)).alias("s"))
    found = scratch.write(spans.groupBy("doc_id", "row").agg(F.collect_set("s").alias("spans")), "spans")
    scratch.drop("blocks", "told")
    return found


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) and removed (maximal spans, by word), a row per row of docs."""
    scratch = Scratch(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    docs = docs.withColumn("row", F.xxhash64("text"))
    marked = docs.join(repeats(spark, scratch, docs), ["doc_id", "row"], "left").select("doc_id", "text", "spans.start", "spans.end")

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, starts, ends in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")), b.column("start").to_pylist(), b.column("end").to_pylist()):
                words, removed = text.split(), []
                for s, e in sorted(zip(starts or (), ends or ())):
                    if removed and s <= removed[-1][1]:
                        removed[-1][1] = max(removed[-1][1], e)
                    else:
                        removed.append([s, e])
                kept, at = [], 0
                for s, e in removed:
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode(), [{"start": s, "end": e} for s, e in removed]))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>")


ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                   ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


#: DuckDB: every window with the smallest id in which it starts.
SQL = r"""
WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
g AS (SELECT doc_id, s, array_to_string(words[s + 1 : s + 13], ' ') AS g FROM (SELECT doc_id, words, unnest(range(0, len(words) - 12)) AS s FROM w WHERE len(words) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
k AS (SELECT doc_id, string_agg(words[p + 1], ' ' ORDER BY p) AS kept, count(*) AS n FROM (SELECT doc_id, words, unnest(range(0, len(words))) AS p FROM w) ANTI JOIN r USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::bigint AS n_words, (len(words) - coalesce(n, 0))::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""
