"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is `window` consecutive words of an item (the whole item if it has fewer). Its elements are shingles of up to `shingle`
words. For containment of a whole window one element must be looked up: its rarest, by counts over all documents; windows with an
element that occurs nowhere are dropped. Every document position looks its shingle up among these. The element's offset gives the window's place; the
position and length bounds ask that it lies inside the document, and what is left is compared word by word.

Null and empty texts have no words. Items without an id take no part; an id in several rows is one item with all their windows. Each
document row gives one result row; rows are told apart by id and a hash of the text, so repeated rows and null ids work. Other
columns are dropped. Without items or documents nothing is hit. A very long text is one row's array of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.llm.common import BROADCAST_BYTES, LOWER, UPPER, Scratch, fits, measured

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What separates the same words before lower-casing, to count them.
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 3


def _words(text: Column) -> Column:
    plain = F.octet_length(text) == F.char_length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _shingle(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def _shingles(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Adds pos and key: a row for every position and shingle size that fits."""
    # outer: else the optimiser asks for a non-empty array first, and splits every text twice
    rows = rows.select("*", F.posexplode_outer("words").alias("pos", "word"))
    keys = [F.when(F.col("pos") + s <= F.size("words"), _shingle("words", F.col("pos"), s)) for s in sizes]
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return rows.select("*", key.alias("key")).where("key is not null")


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """item_id, the words, size and digest of every window."""
    rows = items.select(items["item_id"].cast("string").alias("item_id"), _words(F.coalesce(items["text"].cast("string"), F.lit(""))).alias("words"))
    rows = rows.where(F.col("item_id").isNotNull() & (F.size("words") > 0)).distinct()
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))))
    rows = rows.select("item_id", "words", start.alias("start"))
    rows = rows.select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("window"))
    return rows.select("item_id", "window", F.size("window").alias("size"), F.md5(F.concat_ws(" ", "window")).alias("window_id"))


def lookups(scratch: Scratch, docs: DataFrame, items: DataFrame, window: int, shingle: int):
    """Distinct windows by their rarest shingle, the items of each, and the shingle sizes in use (None without windows)."""
    cut = scratch.write(windows_of(items, window), "windows")
    sizes = sorted({min(shingle, r["size"]) for r in cut.select("size").distinct().collect()})
    if not sizes:
        return None
    owners = cut.select("window_id", "item_id").distinct()
    distinct = cut.drop("item_id").dropDuplicates(["window_id"])
    size = F.least(F.col("size"), F.lit(shingle))
    key = F.coalesce(*[F.when(size == s, _shingle("window", F.col("offset"), s)) for s in sizes])
    elements = distinct.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("size") - size))).withColumn("key", key)
    keys = scratch.write(elements.select("key").distinct(), "keys")
    seen = _shingles(docs, sizes).select("key").join(fits(keys, keys.count(), 32), "key", "left_semi")
    counts = scratch.write(seen.groupBy("key").agg(F.count("*").alias("n")), "counts")
    rarest = elements.join(counts, "key", "left").groupBy("window_id", "window", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("rare"))
    looked = rarest.where("rare.n > 0").select("window_id", "window", "size", "rare.key", F.col("rare.offset").alias("anchor"))
    return scratch.write(looked, "lookups"), owners, sizes


def occurrences(docs: DataFrame, looked: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, row, window_id, first and end of every place where a window stands."""
    begin, size = F.col("pos") - F.col("anchor"), F.col("size")
    inside = (begin >= 0) & (begin + size <= F.size("words"))
    equal = F.slice("words", F.greatest(begin, F.lit(0)) + 1, size) == F.col("window")
    if measured(looked) <= BROADCAST_BYTES:
        # the words stay in the task: only places that are equal leave the join
        found = _shingles(docs, sizes).join(F.broadcast(looked), "key").where(inside & equal)
    else:
        # only keys and places are shuffled; candidates meet the words of their document again
        narrow = _shingles(docs, sizes).select("doc_id", "row", "pos", "key").join(looked.hint("merge"), "key").where(begin >= 0)
        each = narrow.groupBy("doc_id", "row").agg(F.collect_list(F.struct("pos", "anchor", "size", "window", "window_id")).alias("c"))
        again = docs.dropDuplicates(["doc_id", "row"]).join(each.toDF("_id", "_row", "c"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
        found = again.select("doc_id", "row", "words", F.explode("c").alias("c")).select("doc_id", "row", "words", "c.*").where(inside & equal)
    return found.select("doc_id", "row", "window_id", begin.alias("first"), (begin + size).alias("end"))


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and row (a hash of the text), one row per row of docs."""
    scratch = Scratch(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    docs = docs.withColumn("row", F.xxhash64("text"))
    every = docs.select("doc_id", "row", F.size(F.array_remove(F.split(text, RAW_SEPARATORS), "")).cast("long").alias("n_words"))
    split = docs.select("doc_id", "row", _words(text).alias("words"))
    found = lookups(scratch, split, items, window, shingle)
    none = F.sha2(F.lit("").cast("binary"), 256)
    if found is None:
        return every.select("doc_id", "n_words", *(F.lit(0).cast("long").alias(c) for c in ("n_hit", "n_items")), none.alias("items_sha256"), F.lit(False).alias("contaminated"), "row")
    looked, owners, sizes = found
    hits = scratch.write(occurrences(split, looked, sizes), "hits")
    scratch.drop("keys", "counts", "lookups")
    order = Window.partitionBy("doc_id", "row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.col("end") - F.greatest(F.col("first"), F.coalesce(F.max("end").over(order), F.lit(0))), F.lit(0))
    spans = hits.select("doc_id", "row", "first", "end").distinct().withColumn("n", covered)
    spans = spans.groupBy("doc_id", "row").agg(F.sum("n").cast("long").alias("n_hit"))
    named = hits.select("doc_id", "row", "window_id").distinct().join(owners, "window_id").groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["row"].eqNullSafe(b["row"])
    marks = spans.join(named, same(spans, named)).select(spans["doc_id"], spans["row"], "n_hit", "items")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(marks, same(every, marks), "left").select(
        every["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), every["row"])


def remove_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of an item occurs."""
    marks = contamination(spark, docs, items).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
    bad = Scratch(spark).write(marks, "contaminated")
    row = F.xxhash64(docs["text"].cast("string"))
    return docs.join(fits(bad, bad.count(), 32), docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & row.eqNullSafe(bad["_row"]), "left_anti")


#: DuckDB: windows and document windows compared as lists.
SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words FROM documents),
b AS (SELECT item_id::varchar AS item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(words[s + 1 : s + size], ' ') AS w FROM (
  SELECT item_id, words, least(len(words), 10) AS size, unnest(range(0, greatest(len(words) - 10, 0) + 1)) AS s FROM b WHERE len(words) > 0)),
dw AS (SELECT doc_id, s, size, array_to_string(words[s + 1 : s + size], ' ') AS w FROM (
  SELECT doc_id, words, size, unnest(range(0, len(words) - size + 1)) AS s FROM d, (SELECT DISTINCT size FROM bw) WHERE len(words) >= size)),
hit AS (SELECT doc_id, s, size, item_id FROM dw JOIN bw USING (size, w)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(words)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
