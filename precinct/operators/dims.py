"""Dimension preparation and lookups.

No join here carries a broadcast hint: Catalyst broadcasts a side only below
its size threshold and shuffles (with skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from precinct.functions.scores import DEFAULT_POPULATION
from precinct.functions.text import clean_text

#: Letters of the pieces by which texts that hold others are found.
GRAM = 4


def last_row_wins(df: DataFrame, key: str, row_no: str, attributes: list[str]) -> DataFrame:
    """One row per non-empty key holding the attributes of its last row."""
    last = F.max_by(F.struct(*attributes), F.col(row_no)).alias("_last")
    return (
        df.where(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key).agg(last)
        .select(key, *[F.col(f"_last.{a}").alias(a) for a in attributes])
    )


def first_row_wins(df: DataFrame, key: str, row_no: str, attributes: list[str]) -> DataFrame:
    first = F.min_by(F.struct(*attributes), F.col(row_no)).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{a}").alias(a) for a in attributes])


def area_dimension(concordance: DataFrame, clean_keys: bool = True) -> DataFrame:
    """Old area name -> code, names, region, council, location type (last row wins)."""
    key = clean_text(F.col("AU2017_name")) if clean_keys else F.col("AU2017_name")
    columns = {
        "suburb_id": F.col("SA22023_code").cast("string"),
        "name": F.col("SA22023_name_ascii"),
        "name_orig": F.col("SA22023_name"),
        "region": F.col("REGC2023_name"),
        "council": F.col("TA2023_name"),
        "location_type": F.col("UR2023_name"),
    }
    rows = concordance.select(key.alias("area_key"), "row_no", *[c.alias(n) for n, c in columns.items()])
    return last_row_wins(rows, "area_key", "row_no", list(columns))


def code_remap(concordance: DataFrame) -> DataFrame:
    """Old small-area code -> new one (last row wins, rows without both are skipped)."""
    pairs = concordance.select(
        F.col("MB2013_code").cast("string").alias("old_code"), F.col("MB2023_code").cast("string").alias("new_code"), "row_no"
    ).where(F.col("new_code").isNotNull())
    return last_row_wins(pairs, "old_code", "row_no", ["new_code"])


def remap(df: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
    """Left lookup of ``column``; codes without an entry stay as they are."""
    joined = df.join(mapping, df[column] == mapping["old_code"], "left")
    return joined.withColumn(out, F.coalesce("new_code", F.col(column))).drop("old_code", "new_code")


def unmatched(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no dimension row, counted per key."""
    return df.join(dim, key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def area_blocks(concordance: DataFrame) -> DataFrame:
    """Small areas of each area as rows in list order (``position`` orders them)."""
    return concordance.where(
        F.col("AU2017_name").isNotNull() & (F.col("AU2017_name") != "") & F.col("MB2023_code").isNotNull()
    ).select("AU2017_name", F.col("row_no").alias("position"), F.col("MB2023_code").alias("meshblock"))


def _lengths(df: DataFrame, column: str) -> Column:
    """The distinct text lengths of a column as one scalar array (bounded by the longest text)."""
    return df.agg(F.collect_set(F.length(column)).alias("lengths")).scalar()


def _substrings(df: DataFrame, text: str, lengths: Column) -> DataFrame:
    """Every distinct substring of ``text`` whose length occurs in ``lengths``."""
    sized = df.withColumn("_len", F.explode(lengths)).where(F.col("_len") <= F.length(text))
    starts = F.sequence(F.lit(1), F.length(text) - F.col("_len") + 1)
    cut = F.array_distinct(F.transform(starts, lambda i: F.col(text).substr(i, F.col("_len"))))
    return sized.withColumn("_part", F.explode(cut))


def _short(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.length(text) <= GRAM)


def _holders(outer: DataFrame, o: str, inner: DataFrame, i: str) -> DataFrame:
    """Distinct (o, i) where the text o holds the text i, for texts i longer than GRAM.

    Every text i is looked up by its piece of GRAM letters that fewest texts o have; those that have it are tried.
    """
    pieces = _substrings(outer.select(o).distinct(), o, F.array(F.lit(GRAM))).select(o, "_part")
    asked = _substrings(inner.select(i).where(F.length(i) > GRAM).distinct(), i, F.array(F.lit(GRAM))).select(i, "_part")
    rarest = asked.join(pieces.groupBy("_part").agg(F.count(F.lit(1)).alias("_df")), "_part", "left")
    # a piece that no text o has rules its text out
    rarest = rarest.groupBy(i).agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("df"), "_part")).alias("_k")).where("_k.df > 0")
    return rarest.select(i, F.col("_k._part").alias("_part")).join(pieces, "_part").where(F.contains(F.col(o), F.col(i))).select(o, i)


def first_containing(names: DataFrame, name: str, census: DataFrame, area: str, value: str, row_no: str) -> DataFrame:
    """For each name the first census row whose area holds the name or is held by it.

    Ignores case. Containment is turned into equality: of whole short texts with pieces of their length, of longer ones by their rarest piece. A
    text has as many pieces as letters, so candidates stay proportional to the input instead of names x census rows.
    """
    wanted = names.select(F.col(name), F.lower(name).alias("_low")).distinct()
    texts = wanted.select("_low").distinct()
    entries = census.where(F.col(area).isNotNull()).select(F.lower(area).alias("_area"), F.struct(F.col(row_no).alias("row_no"), F.col(value).alias("value")).alias("_hit"))
    entries = entries.groupBy("_area").agg(F.min_by("_hit", F.col("_hit.row_no")).alias("_hit"))
    # the census area lies inside the name
    short = _short(entries, "_area")
    inner = _substrings(texts, "_low", _lengths(short, "_area"))
    inside = inner.join(short, inner["_part"] == short["_area"]).select("_low", "_hit")
    inside = inside.unionByName(_holders(texts, "_low", entries, "_area").join(entries, "_area").select("_low", "_hit"))
    # the name lies inside the census area: of a short piece only the first row counts
    few = _short(texts, "_low")
    outer = _substrings(entries, "_area", _lengths(few, "_low"))
    outer = outer.groupBy("_part").agg(F.min_by("_hit", F.col("_hit.row_no")).alias("_hit"))
    around = few.join(outer, few["_low"] == outer["_part"]).select("_low", "_hit")
    around = around.unionByName(_holders(entries, "_area", texts, "_low").join(entries, "_area").select("_low", "_hit"))
    best = inside.unionByName(around).groupBy("_low").agg(F.min_by("_hit", F.col("_hit.row_no")).alias("_hit"))
    return wanted.join(best, "_low").select(name, F.col("_hit.value").alias("value"))


def containment_pairs(names: DataFrame, name: str, others: DataFrame, other: str) -> DataFrame:
    """Distinct (name, other) where one text holds the other, case ignored."""
    a = names.select(F.col(name), F.lower(name).alias("_a")).where(F.length("_a") > 0).distinct()
    b = others.select(F.col(other), F.lower(other).alias("_b")).where(F.length("_b") > 0).distinct()

    def held(outer: DataFrame, o: str, inner: DataFrame, i: str) -> DataFrame:
        few = _short(inner, i).select(i).distinct()
        pieces = _substrings(outer.select(o).distinct(), o, _lengths(few, i))
        return pieces.join(few, pieces["_part"] == few[i]).select(o, i).unionByName(_holders(outer, o, inner, i))

    pairs = held(a, "_a", b, "_b").unionByName(held(b, "_b", a, "_a")).distinct()
    return pairs.join(a, "_a").join(b, "_b").select(name, other).distinct()


def attach_population(
    areas: DataFrame, census: DataFrame | None, name: str = "name_orig", out: str = "population", year: int = 2023
) -> DataFrame:
    """Exact name in the census year, else the containment rule, else the default.

    Negative counts mark "not applicable" and become null.
    """
    if census is None:
        return areas.withColumn(out, F.lit(DEFAULT_POPULATION).cast("bigint"))
    exact = first_row_wins(
        census.where((F.col("census_year") == year) & F.col("area").isNotNull()).select("area", "row_no", F.col("value").alias("_exact")),
        "area", "row_no", ["_exact"],
    ).withColumn("_is_exact", F.lit(True))
    names = areas.select(name).where(F.col(name).isNotNull()).distinct()
    looked = names.join(exact, names[name] == exact["area"], "left").drop("area")
    open_names = looked.where(F.col("_is_exact").isNull()).select(name)
    loose = first_containing(open_names, name, census, "area", "value", "row_no").withColumnRenamed("value", "_loose").withColumn("_is_loose", F.lit(True))
    looked = looked.join(loose, name, "left")
    count: Column = (
        F.when(F.col("_is_exact"), F.col("_exact"))
        .when(F.col("_is_loose"), F.col("_loose"))
        .otherwise(F.lit(DEFAULT_POPULATION))
    )
    looked = looked.select(name, F.when(count >= 0, count).cast("bigint").alias(out), F.lit(True).alias("_known"))
    joined = areas.join(looked, name, "left")
    return joined.withColumn(out, F.when(F.col("_known"), F.col(out)).otherwise(F.lit(DEFAULT_POPULATION))).drop("_known")


def mapping_fanout(df: DataFrame, source: str, target: str) -> DataFrame:
    """How many keys have 1, 2-5 or more targets."""
    per_key = (
        df.where(F.col(source).isNotNull()).select(source, target).distinct()
        .groupBy(source).agg(F.count(target).alias("_targets"))
    )
    size = F.when(F.col("_targets") <= 1, "1").when(F.col("_targets") <= 5, "2-5").otherwise(">5")
    return per_key.groupBy(size.alias("targets")).agg(F.count(F.lit(1)).alias("n_keys"))
