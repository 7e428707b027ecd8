"""Scans of the incident, census, concordance and polygon files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from precinct.functions.text import code_text, integer_text, strip_space
from precinct.schemas import CENSUS, CENSUS_COLUMNS, CONCORDANCE_COLUMNS, INCIDENT_COLUMNS

# Encodings in the order they are tried. ISO-8859-1 (Latin-1) decodes
# any byte, so nothing after it could be reached.
ENCODINGS = ("utf-8", "utf-16", "iso-8859-1")
# Fields that stand for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
REPLACEMENT = "�"


def file_order() -> Column:
    """Sortable text that orders rows as they stand in their files.

    Built from file, block and place in the scan, so no pass over the data is
    needed; equal files and bytes give the same order under any split size.
    """
    return F.format_string(
        "%s|%020d|%020d", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )


def row_position() -> Column:
    """Number that orders the rows of a file; equal places in several files tie-break by file.

    A block's first byte plus the row's place in its task never passes the next
    block's first byte, since a row takes at least one byte. A number keeps the
    aggregations over facts on hash aggregation.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    offset = F.col("_metadata.file_block_start") + place
    return F.shiftleft(offset, 20) + F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 20))


def present(c: Column) -> Column:
    """The text of a field, or null where it stands for a missing value."""
    return F.when(~c.isin(*MISSING), c)


def header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names of a headed file; reads its first line only."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    return reader.option("multiLine", encoding.startswith("utf-16")).csv(path).columns


def _text_columns(
    spark: SparkSession, path: str, wanted, sep: str = ",", encoding: str = "utf-8", order=file_order, source: Column | None = None
) -> DataFrame:
    """All columns of a headed file as text, names trimmed; fails on a missing column."""
    names = header(spark, path, sep, encoding)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("sep", sep)
    reader = reader.option("encoding", encoding).option("quote", '"').option("escape", '"')
    # Only UTF-16 cannot be split; convert such files once and go on from a table.
    df = reader.option("multiLine", encoding.startswith("utf-16")).csv(path)
    position = {n.strip().lstrip("﻿"): i for i, n in enumerate(names)}
    missing = [w for w in wanted if w not in position]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    more = [] if source is None else [source.alias("source")]
    return df.select(*[present(F.col(f"_c{position[w]}")).alias(w) for w in wanted], order().alias("row_no"), *more)


def detect_encoding(spark: SparkSession, path: str, wanted=tuple(INCIDENT_COLUMNS), sep: str = "\t") -> str:
    """First encoding that shows the header and decodes every byte."""
    for encoding in ENCODINGS:
        names = {n.strip().lstrip("﻿") for n in header(spark, path, sep, encoding)}
        if not set(wanted) <= names:
            continue
        lines = spark.read.option("header", False).option("sep", "\u0001").option("quote", "").option("encoding", encoding)
        rows = lines.option("multiLine", encoding.startswith("utf-16")).schema("line string").csv(path)
        if rows.where(F.col("line").contains(REPLACEMENT)).isEmpty():
            return encoding
    raise ValueError(f"no encoding fits {path}")


def read_incidents(spark: SparkSession, path: str, encoding: str | None = None, source: str | None = None) -> DataFrame:
    """Tab-separated incidents: the six used columns as trimmed text, plus ``row_no`` and ``source``.

    ``source`` names the load; by default it is the path of a row's file. Pass ``encoding`` when it is known; finding it costs a
    pass over the file.
    """
    encoding = encoding or detect_encoding(spark, path)
    df = _text_columns(spark, path, INCIDENT_COLUMNS, "\t", encoding, row_position, F.col("_metadata.file_path") if source is None else F.lit(source))
    out = [strip_space(F.col(f"`{src}`")).alias(name) for src, name in INCIDENT_COLUMNS.items()]
    return df.select("row_no", *out, "source").withColumn("meshblock", code_text(F.col("meshblock")))


def read_census(spark: SparkSession, path: str | None) -> DataFrame:
    """Census counts; no file gives an empty table, so every area takes the default."""
    if path is None:
        return spark.createDataFrame([], CENSUS)
    df = _text_columns(spark, path, CENSUS_COLUMNS)
    return df.select(
        F.col("Area").alias("area"), F.expr("try_cast(`Census year` as int)").alias("census_year"),
        F.expr("try_cast(`Value` as double)").try_cast("bigint").alias("value"), "row_no",
    )


def read_concordance(spark: SparkSession, path: str) -> DataFrame:
    """The nine used concordance columns; codes without leading zeros."""
    df = _text_columns(spark, path, CONCORDANCE_COLUMNS)
    codes = {"SA22023_code", "MB2023_code", "MB2013_code"}
    return df.select("row_no", *[(code_text(F.col(c)) if c in codes else F.col(c)).alias(c) for c in CONCORDANCE_COLUMNS])


def _parts(geometry_type: Column, coordinates: Column) -> Column:
    """Polygon or MultiPolygon coordinates as part -> ring -> point -> [x, y]; null for other types."""
    polygon = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    multi = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(geometry_type == "Polygon", polygon).when(geometry_type == "MultiPolygon", multi)


#: What every feature of a collection holds once, as common writers put it: after its opening brace and the name of the member.
FEATURE = '"Feature"'
_OPENING = r'\{\s*"type"\s*:\s*$'


def _feature_records(spark: SparkSession, path: str) -> DataFrame:
    """A FeatureCollection cut at each feature's type, so that a file is split freely: text, row_no and regular.

    The record before a file's first cut is its head; every other one starts inside a feature, right after its type, and ends inside the next. It
    is regular if it does so. The files of a folder may also be the parts of one collection.
    """
    records = spark.read.option("lineSep", FEATURE).text(path).select(F.col("value").alias("text"), file_order().alias("row_no"), F.col("_metadata.file_path").alias("_file"))
    head = F.rlike("text", F.lit(r"^[\x{FEFF}\s,]*\{"))
    opens = F.rlike("text", F.lit(_OPENING))
    inner = F.rlike("text", F.lit(r"^\s*[,}]"))
    return records.withColumns({"head": head, "opens": opens, "regular": head | inner})


def _is_regular(records: DataFrame) -> bool:
    """Every file has one head, and all its records but one, the last, end where a feature starts."""
    files = records.groupBy("_file").agg(
        F.bool_and("regular").alias("regular"), F.count(F.when(F.col("head"), 1)).alias("heads"), F.count(F.when(~F.col("opens"), 1)).alias("ends"),
        F.max(F.struct("row_no", "opens")).getField("opens").alias("open"), F.min(F.struct("row_no", "head")).getField("head").alias("first"))
    return files.where(~F.col("regular") | (F.col("heads") != 1) | (F.col("ends") != 1) | F.col("open") | ~F.col("first")).isEmpty()


def read_layer(spark: SparkSession, path: str, properties: dict[str, str], lines: bool = False) -> DataFrame:
    """GeoJSON layer -> row_no, the named properties, geometry_type, coordinates.

    A FeatureCollection is read in parallel, cut at its features; one whose features don't start with their type, or that has other members with
    the value "Feature", is read whole by one task. With ``lines`` every line is a Feature.
    """
    props = T.StructType([T.StructField(k, T.StringType() if t == "string" else T.DoubleType()) for k, t in properties.items()])
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", props), T.StructField("geometry", geometry)])
    records = None if lines else _feature_records(spark, path)
    if lines:
        df = spark.read.schema(feature).json(path).select("*", file_order().alias("row_no"))
    elif _is_regular(records):
        # the parser stops where the feature ends: what the record holds of the next one is not read
        one = F.from_json(F.concat(F.lit('{"type":"Feature"'), F.col("text")), feature)
        df = records.where(~F.col("head")).select(one.alias("_f"), "row_no").select("_f.*", "row_no")
    else:
        document = T.StructType([T.StructField("features", T.ArrayType(feature))])
        df = spark.read.schema(document).option("multiLine", True).json(path)
        df = df.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("features").alias("_pos", "_f"))
        df = df.select("_f.*", F.format_string("%s|%020d", "_file", "_pos").alias("row_no"))
    kind = F.col("geometry.type")
    return df.select(
        "row_no", *[F.col(f"properties.`{p}`").alias(p) for p in properties],
        kind.alias("geometry_type"), _parts(kind, F.col("geometry.coordinates")).alias("coordinates"),
    )


def read_area_layer(spark: SparkSession, path: str, name: str = "SA22023__2", lines: bool = False) -> DataFrame:
    """(row_no, name, lat, lng, geometry_type, coordinates); features without a name are skipped."""
    df = read_layer(spark, path, {name: "string", "latitude": "double", "longitude": "double"}, lines)
    return df.where(F.col(name).isNotNull() & (F.col(name) != "")).select(
        "row_no", F.col(name).alias("name"), F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), "geometry_type", "coordinates"
    )


def read_block_layer(spark: SparkSession, path: str, code: str = "MB2023_V1_", lines: bool = False) -> DataFrame:
    """As the area layer, keyed by the integer code without leading zeros; other codes are skipped."""
    df = read_layer(spark, path, {code: "string", "latitude": "double", "longitude": "double"}, lines)
    return df.withColumn("id", integer_text(F.col(code))).where(F.col("id").isNotNull()).select(
        "row_no", "id", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), "geometry_type", "coordinates"
    )


def scan_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Stored table with a column list; the parquet scan reads only those."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_limited(df: DataFrame, columns: list[str], n: int, **equals) -> DataFrame:
    """The small benchmark lookups: columns, equality filters and a limit."""
    for name, value in equals.items():
        df = df.where(F.col(name) == value)
    return df.select(*columns).limit(n)
