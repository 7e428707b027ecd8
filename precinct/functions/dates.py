"""Month-grained date helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


# Month names.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)


# First and last month whose first day a timestamp of nanoseconds in 64 bits can hold.
FIRST, LAST = "1677-10-01", "2262-04-01"


def month_from_name(c: Column) -> Column:
    """``May 2023`` -> 2023-05-01, any case; null when it does not parse or lies outside of ``FIRST`` to ``LAST``.

    A name lookup, since a timestamp pattern costs several times as much per row.
    """
    numbers = F.create_map(*[F.lit(x) for i, name in enumerate(MONTHS, 1) for x in (name, i)])
    words = F.split(c, r"\s+")
    name, digits = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    year = F.when((F.size(words) == 2) & digits.rlike("^[0-9]{4}$") & (digits != "0000"), digits.try_cast("int"))
    month = F.try_element_at(numbers, F.lower(name))
    day = F.when(year.isNotNull() & month.isNotNull(), F.make_date(year, month, F.lit(1)))
    return F.when(day.between(F.to_date(F.lit(FIRST)), F.to_date(F.lit(LAST))), day)


def month_floor(c: Column) -> Column:
    return F.trunc(c, "MM")


def iso_day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def window_start(reference: Column, days: int = 365) -> Column:
    """First day (inclusive) of the rolling window that ends at ``reference``."""
    return F.date_sub(reference, days)


def month_bounds(month: str) -> tuple[Column, Column]:
    """``YYYY-MM`` -> [first day, first day of the next month)."""
    first = F.to_date(F.lit(f"{month}-01"))
    return first, F.to_date(F.add_months(first, 1))


def dates_as_text(df: DataFrame) -> DataFrame:
    """Every date or timestamp column as ``YYYY-MM-DD`` text."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            (iso_day(F.col(f"`{f.name}`")) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields
        ]
    )
