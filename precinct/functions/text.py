"""Text cleaning, slugs and code extraction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The sixteen offence divisions and their codes.
OFFENCE_DIVISIONS = {
    "1": "HOMICIDE AND RELATED OFFENCES",
    "2": "ACTS INTENDED TO CAUSE INJURY",
    "3": "SEXUAL ASSAULT AND RELATED OFFENCES",
    "4": "DANGEROUS OR NEGLIGENT ACTS ENDANGERING PERSONS",
    "5": "ABDUCTION, HARASSMENT AND OTHER RELATED OFFENCES AGAINST A PERSON",
    "6": "ROBBERY, EXTORTION AND RELATED OFFENCES",
    "7": "UNLAWFUL ENTRY WITH INTENT/BURGLARY, BREAK AND ENTER",
    "8": "THEFT AND RELATED OFFENCES",
    "9": "FRAUD, DECEPTION AND RELATED OFFENCES",
    "10": "ILLICIT DRUG OFFENCES",
    "11": "PROHIBITED AND REGULATED WEAPONS AND EXPLOSIVES OFFENCES",
    "12": "PROPERTY DAMAGE AND ENVIRONMENTAL POLLUTION",
    "13": "PUBLIC ORDER OFFENCES",
    "14": "TRAFFIC AND VEHICLE REGULATORY OFFENCES",
    "15": "OFFENCES AGAINST JUSTICE PROCEDURES, GOVERNMENT SECURITY AND GOVERNMENT OPERATIONS",
    "16": "MISCELLANEOUS OFFENCES",
}


def strip_space(c: Column) -> Column:
    """Trim any Unicode white space (Spark's ``trim`` knows only U+0020)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    """Dots become spaces, runs of white space collapse, ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, ".", " "), r"(?U)\s+", " "))


def slugify(c: Column) -> Column:
    """URL slug of a name; an opening bracket separates, null gives ''."""
    spaced = F.regexp_replace(F.lower(c), r"\(([^)]+)\)", " $1")
    hyphenated = F.regexp_replace(spaced, "[^a-z0-9]+", "-")
    return F.coalesce(F.regexp_replace(hyphenated, "^-+|-+$", ""), F.lit(""))


def offence_code(c: Column) -> Column:
    """Leading two digits as they stand, else the code of the division name, else null."""
    pairs = [F.lit(x) for code, name in OFFENCE_DIVISIONS.items() for x in (name.lower(), code)]
    by_name = F.try_element_at(F.create_map(*pairs), F.lower(c))
    return F.when(c.rlike("^[0-9]{2}"), F.substring(c, 1, 2)).otherwise(by_name)


def integer_text(c: Column) -> Column:
    """``0016901`` -> ``16901``; null where the text is no integer."""
    return F.trim(c).try_cast("bigint").cast("string")


def code_text(c: Column) -> Column:
    """Codes compare without leading zeros; non-numeric codes stay as they are."""
    return F.coalesce(integer_text(c), c)


def contains_either(a: Column, b: Column) -> Column:
    """Case-insensitive: one text holds the other."""
    a, b = F.lower(a), F.lower(b)
    return a.contains(b) | b.contains(a)


def family(c: Column) -> Column:
    """Metric family: the part before the first underscore."""
    return F.substring_index(c, "_", 1)


def map_as_text(c: Column) -> Column:
    return F.to_json(c)


def text_as_counts(c: Column) -> Column:
    """JSON text -> map of counts; anything unreadable gives an empty map."""
    return F.coalesce(F.from_json(c, "map<string,bigint>"), F.from_json(F.lit("{}"), "map<string,bigint>"))
