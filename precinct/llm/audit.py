"""How filters interact: what each removes in every order, from the potential of the removal game.

Five filters A to E judge whole texts; a document's failures make one of 32 masks, and a part of the corpus (a language) is told by how many of
its documents, good documents and toxic documents have each mask. The removal game of a part gives a coalition S of filters the number v(S) of
documents that fail any of them. Its potential is Hart and Mas-Colell's,

    P(empty) = 0,    |S| P(S) = v(S) + sum over i in S of P(S without i),

computed by recursion over the 32 coalitions, times 120, so that all of it stays whole numbers. The Shapley value of filter i, 120 times,
is P(all) - P(all without i): what i removes summed over all 120 orders. What a step of an order removes is the difference of v between two
coalitions, those of the filters before it with and without its own; the same holds for good and for toxic documents.

Documents are read once, and only ids, digests and masks are shuffled. E (equal to the text of a smaller id) needs the least id of each text:
rows are first counted by digest, part, labels and id, then by all but the id, with the least id of each group and its rows. Copies, even of a third of
all rows, are spread over tasks in the first count and reach the last one as a few rows.

Null texts are empty; null languages are the part ''. Rows without an id are equal to no smaller id and are never the smaller one; they have no label.
Repeated rows each count, and as their ids are equal, neither fails E for the other. An id labelled several times is good, or toxic, if any of its
labels says so. Other columns are dropped before anything is named. A part of few documents has its 600 rows like any other; an
empty table has no parts. Very long texts are split into words once, in one row.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import SPACE, UPPER, words_of

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = words_of(text, SPACE)
    n, distinct, length = F.size(words), F.size(F.array_distinct(words)), F.length(text)
    capitals = length - F.length(F.translate(text, UPPER, ""))
    bits = (n < 200, 100 * distinct.cast("long") < 50 * n.cast("long"), 100 * capitals.cast("long") > 3 * length.cast("long"), F.rlike(text, F.lit(r"[#$%&*|]")))
    return sum((F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters they fail."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), failures(text).alias("mask"))
    told = labels.select(labels["doc_id"].cast("long").alias("labelled"), *[(F.coalesce(labels[c].cast("int"), F.lit(0)) == 1).cast("int").alias(c) for c in ("quality", "toxic")])
    told = told.where("labelled is not null").groupBy("labelled").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    rows = rows.join(told, rows["id"] == told["labelled"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    keys = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*keys, "id").agg(F.count("*").alias("n"))
    by_text = by_id.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    low = F.min("first.id").over(Window.partitionBy("digest"))
    passed = F.col("without") + F.when(F.col("first.id") == F.col("low"), F.col("first.n")).otherwise(0)
    told = by_text.withColumn("low", low).select("part", "mask", "good", "toxic", "n", passed.alias("passed"))
    both = F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("passed").alias("k")),
                             F.struct(F.col("mask").bitwiseOR(F.lit(1 << 4)).alias("m"), (F.col("n") - F.col("passed")).alias("k"))))
    told = told.select("part", "good", "toxic", both.alias("b")).where("b.k > 0")
    n = F.col("b.k")
    return told.groupBy("part", F.col("b.m").alias("mask")).agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def games(counted: DataFrame) -> DataFrame:
    """part, total, c (n, good and toxic documents that fail any filter of each coalition, by its number) and p (120 times the potential of each)."""
    hit = (F.col("mask").bitwiseAND(F.col("s")) != 0).cast("int")
    each = counted.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
    each = each.groupBy("part", "s").agg(*[F.sum(F.col(c) * hit).alias(c) for c in ("n", "good", "toxic")], F.sum("n").alias("total"))
    whole = each.groupBy("part").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("s", "n", "good", "toxic"))).alias("c"))
    without = " + ".join(f"if(s & {1 << i} = 0, 0L, p[s - {1 << i}])" for i in range(len(FILTERS)))
    return whole.withColumn("p", F.expr(f"aggregate(sequence(1, {ALL}), array(0L), (p, s) -> concat(p, array((120 * c[s].n + {without}) div bit_count(s))))"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    orders = F.explode(F.array(*[F.lit("".join(x)) for x in permutations(FILTERS)]))
    rows = games(masks(docs, labels)).withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda j: F.expr(f"shiftleft(1, ascii(substring(filter_order, {j}, 1)) - ascii('A'))")
    rows = rows.withColumn("own", bit("step"))
    rows = rows.withColumn("before", sum((F.when(F.col("step") > j, bit(j)).otherwise(0) for j in range(1, len(FILTERS))), F.lit(0)))
    at = lambda s, c: F.get("c", s)[c]
    after, rest = F.col("before") + F.col("own"), F.lit(ALL) - F.col("own")
    gained = lambda c: at(after, c) - at(F.col("before"), c)
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - at(after, "n")).alias("kept"), gained("n").alias("removed"),
        (at(F.col("own"), "n") - gained("n")).alias("redundant"), (at(F.lit(ALL), "n") - at(rest, "n")).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"), (F.get("p", F.lit(ALL)) - F.get("p", rest)).alias("shapley"))


#: DuckDB: every order is played step by step on documents counted by the filters they fail.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
l AS (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d LEFT JOIN l ON id = doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
g AS (SELECT part, filter_order, fails, n, good, toxic, coalesce(list_min([strpos(filter_order, i) FOR i IN string_split(fails, '') IF i <> '']), 6) AS gone FROM m, o),
s AS (SELECT g.*, step, substring(filter_order, step::bigint, 1) AS own FROM g, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step::int AS step, own,
  coalesce(sum(n) FILTER (gone > step), 0)::bigint AS kept, coalesce(sum(n) FILTER (gone = step), 0)::bigint AS removed,
  coalesce(sum(n) FILTER (gone < step AND contains(fails, own)), 0)::bigint AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::bigint AS unique_fails,
  coalesce(sum(good) FILTER (gone = step), 0)::bigint AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0)::bigint AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::bigint AS shapley FROM r
"""
