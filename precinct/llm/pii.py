"""Personal data, and terms that reveal it, in DataFrame operations only.

Base spans come from patterns: emails, addresses, card and phone numbers. Every distinct value is a protected entity c. Terms t (words of
three letters or more, lower-cased, outside base spans) of all texts that hold an entity are judged. The corpus says how much t tells of c:

    PMI(c; t) = log(n_ct * N / (n_c * (n_t + doubt))),    IC(c) = log(N / n_c)

with N documents, n_c that hold c, n_t that hold t, n_ct that hold both, wherever they stand. Doubt smooths the share of t's documents that
hold c, as few documents prove little: a text more in which t stands without c is counted in part. A term is disclosing if PMI >= alpha * IC:
knowing the term then tells almost as much as the entity itself. Entities of a single document are judged like all others. As n_ct <= n_c, a
disclosing term has n_t + doubt <= n_c^alpha * N^(1 - alpha); pairs of more frequent terms are never made. Terms that determine the entity (n_ct / n_t >= certain) are removed wherever they stand, in all
documents; the others are generalised wherever they stand in documents that hold the entity.

Patterns are the base ones, written so that Java's matcher neither backtracks nor restarts inside a run it has failed on: a match can
begin at the head of a run or where the last match ended. Positions are code points, as sums of the lengths of the texts between matches.

Null and empty texts have no spans. Rows are told apart by id and a hash of the text, so repeated rows (each counts) and null ids work.
Documents are counted by row. Other columns are kept by `sanitised` and dropped by `find`. Empty tables give no rows. A text with k
matches, or k places of disclosing terms, costs k^2 / 2 copied references; one with entities costs their number times that of its rare terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import Scratch, fits_measured

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}+"
DOUBT, ALPHA, CERTAIN = 0.5, 0.9, 0.9
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
PLACE = "array<struct<start:int,end:int,value:string,action:string>>"


def matches(text: Column, pattern: str) -> Column:
    """start, end and value of each match, by code point."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pieces = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda v, g: F.struct(v.alias("v"), g.alias("g")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["g"])
        end = begin + F.length(x["v"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["v"].alias("value")))).alias("out"))

    return F.aggregate(pieces, first, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _octets(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), F.substring(p, 1, 3)).cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """Kinds as listed, each by start."""
    kinds = (
        ("email", EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        ("ip", IP, F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), _octets),
        ("card", CARD, F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")), lambda v: F.length(_digits(v)).between(16, 19) & _luhn(v)),
        ("phone", PHONE, F.rlike(text, F.lit(r"\+[0-9]")), lambda v: F.length(_digits(v)).between(8, 15)),
    )
    return F.concat(*[_spans_of(text, *k) for k in kinds])


def _spans_of(text: Column, kind: str, pattern: str, possible: Column, valid) -> Column:
    good = F.filter(matches(text, pattern), lambda x: valid(x["value"]))
    spans = F.transform(good, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"], x["end"], x["value"]))
    return F.when(possible, spans).otherwise(F.array().cast(SPAN)).cast(SPAN)


def _bare(text: Column, spans: Column) -> Column:
    """The text with blanks in place of its base spans: what is left keeps its places."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, blank).alias("out"))

    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"])))
    blanked = F.aggregate(ordered, first, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, blanked).otherwise(text)


def _terms(bare: Column) -> Column:
    """The distinct terms of a text."""
    words = F.transform(F.array_distinct(F.split(bare, r"[^\p{L}]+")), F.lower)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))


def _places(bare: Column, marks: Column) -> Column:
    """Every place of the marked terms, by start."""
    found, gaps = F.regexp_extract_all(bare, F.lit(TERM), F.lit(0)), F.split(bare, TERM, -1)
    pieces = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda v, g: F.struct(v.alias("v"), g.alias("g")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(PLACE).alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["g"])
        end, term = begin + F.length(x["v"]), F.lower(x["v"])
        hit = F.array_position(marks["term"], term)
        place = F.struct(begin.alias("start"), end.alias("end"), term.alias("value"), F.get(marks["action"], (hit - 1).cast("int")).alias("action"))
        return F.struct(end.alias("at"), F.when(hit > 0, F.concat(acc["out"], F.array(place))).otherwise(acc["out"]).cast(PLACE).alias("out"))

    return F.aggregate(pieces, first, step, lambda acc: acc["out"])


def find(spark: SparkSession, docs: DataFrame, doubt: float = DOUBT, alpha: float = ALPHA, certain: float = CERTAIN) -> DataFrame:
    """doc_id, row (hash of the text), spans (base) and terms (start, end, value and action of disclosing terms), a row per row of docs."""
    scratch = Scratch(spark)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    bare = docs.select("*", base_spans(F.col("text")).alias("spans")).select("doc_id", "row", "spans", _bare(F.col("text"), F.col("spans")).alias("bare"))
    based = scratch.write(bare.select("doc_id", "row", "spans", _terms(F.col("bare")).alias("terms")), "spans")
    n = float(based.count())
    entities = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    holders = based.where(F.size("spans") > 0).select("doc_id", "row", entities.alias("entities"), "terms")
    n_c = scratch.write(holders.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_c")), "entities")
    most = float(n_c.agg(F.coalesce(F.max("n_c"), F.lit(0)).alias("n")).first()["n"])
    # no term that stands in more texts can be disclosing
    reach = lambda c: F.pow(c, F.lit(alpha)) * (n ** (1 - alpha) * (1 + 1e-9))
    n_t = based.select(F.explode("terms").alias("term"), (F.size("spans") > 0).alias("held")).groupBy("term").agg(F.count("*").alias("n_t"), F.max("held").alias("held"))
    rare = scratch.write(n_t.where(F.col("held") & (F.col("n_t") + doubt <= reach(F.lit(most)))).select("term", "n_t"), "rare")
    near = holders.select("doc_id", "row", "entities", F.explode("terms").alias("term")).join(fits_measured(rare), "term")
    near = near.select("doc_id", "row", "term", "n_t", F.explode("entities").alias("entity")).join(fits_measured(n_c), "entity")
    near = scratch.write(near.where(F.col("n_t") + doubt <= reach(F.col("n_c"))), "near")
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("n_ct"), F.max("n_c").alias("n_c"), F.max("n_t").alias("n_t"))
    pmi, ic = F.log(F.col("n_ct") * n / (F.col("n_c") * (F.col("n_t") + doubt))), F.log(n / F.col("n_c"))
    told = pairs.where((pmi >= alpha * ic) & (ic > 0))
    told = scratch.write(told.select("entity", "term", F.when(F.col("n_ct") >= certain * F.col("n_t"), "remove").otherwise("generalise").alias("action")), "told")
    gone = scratch.write(told.where("action = 'remove'").select("term", "action").distinct(), "gone")
    marks = near.join(fits_measured(told), ["entity", "term"]).select("doc_id", "row", "term", "action").union(
        based.select("doc_id", "row", F.explode("terms").alias("term")).join(fits_measured(gone), "term").select("doc_id", "row", "term", "action"))
    marks = marks.groupBy("doc_id", "row", "term").agg(F.max("action").alias("action"))
    marks = scratch.write(marks.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("term", "action"))).alias("marks")), "marks")
    scratch.drop("entities", "rare", "near", "told", "gone")
    joint = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["row"].eqNullSafe(b["row"])
    marked = docs.join(fits_measured(marks), joint(docs, marks)).select(docs["doc_id"], docs["row"], "text", "marks", base_spans(F.col("text")).alias("spans"))
    marked = marked.select("doc_id", "row", "marks", _bare(F.col("text"), F.col("spans")).alias("bare"))
    places = marked.select("doc_id", "row", _places(F.col("bare"), F.col("marks")).alias("places")).dropDuplicates(["doc_id", "row"])
    places = scratch.write(places, "places")
    return based.join(fits_measured(places), joint(based, places), "left").select(
        based["doc_id"], based["row"], "spans", F.coalesce("places", F.array().cast(PLACE)).alias("terms"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of base spans, and all spans as kind:start:end."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    more = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
                        F.concat_ws(",", F.concat(base, more)).alias("spans"))


def sanitised(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with all columns; in text, base spans are <EMAIL> and so on, generalised terms <TERM>, and removed terms are gone."""
    found = find(spark, docs)
    spans = F.transform("spans", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("by")))
    terms = F.transform("terms", lambda s: F.struct(s["start"], s["end"], F.when(s["action"] == "remove", "").otherwise("<TERM>").alias("by")))
    edits = found.where((F.size("spans") > 0) | (F.size("terms") > 0)).select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.sort_array(F.concat(spans, terms)).alias("_edits")).dropDuplicates(["_id", "_row"])
    edits = Scratch(spark).write(edits, "edits")
    text = docs["text"].cast("string")
    joined = docs.join(fits_measured(edits), docs["doc_id"].cast("long").eqNullSafe(edits["_id"]) & F.xxhash64(F.coalesce(text, F.lit(""))).eqNullSafe(edits["_row"]), "left")
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, e):
        between = F.substring(text, acc["at"] + 1, e["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], e["end"]).alias("at"), F.when(e["start"] >= acc["at"], F.concat(acc["out"], between, e["by"])).otherwise(acc["out"]).alias("out"))

    new = F.aggregate(edits["_edits"], first, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(edits["_edits"].isNull(), text).otherwise(new)
    return joined.select(*[(new if c.lower() == "text" else F.length(new).cast("long") if c.lower() == "n_chars" else docs[c]).alias(c) for c in docs.columns])
