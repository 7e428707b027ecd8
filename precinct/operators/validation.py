"""Row constraints, the valid / rejected split and the reject report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """One constraint on one field. Null passes unless the rule is ``required``."""

    field: str
    name: str
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()

    def test(self) -> str:
        """SQL condition that holds for a good value."""
        c = f"`{self.field}`"
        if self.name == "required":
            return f"{c} is not null"
        if self.name == "min_length":
            ok = f"length({c}) >= {int(self.low)}"
        elif self.name == "max_length":
            ok = f"length({c}) <= {int(self.high)}"
        elif self.name == "one_of":
            ok = f"{c} in ({', '.join(repr(a) for a in self.allowed)})"
        elif self.name == "range":
            # NaN sorts above every number in Spark, so it needs its own test.
            value = f"cast({c} as double)"
            ok = f"not isnan({value})"
            if self.low is not None:
                ok += f" and {value} >= {float(self.low)}D"
            if self.high is not None:
                ok += f" and {value} <= {float(self.high)}D"
        else:
            raise ValueError(f"unknown rule {self.name}")
        return f"{c} is null or ({ok})"

    def error(self) -> str:
        """SQL struct (field, rule, value) for a bad value, null for a good one."""
        found = f"named_struct('field', '{self.field}', 'rule', '{self.name}', 'value', cast(`{self.field}` as string))"
        return f"case when not ({self.test()}) then {found} end"


def text(field: str, longest: int | None = None, required: bool = False) -> list[Rule]:
    rules = [Rule(field, "required"), Rule(field, "min_length", low=1)] if required else []
    return rules + ([Rule(field, "max_length", high=longest)] if longest else [])


def span(field: str, low: float | None = None, high: float | None = None) -> list[Rule]:
    return [Rule(field, "range", low=low, high=high)]


# Field lengths and ranges of the three tables.
INCIDENT_RULES = [
    *text("event_id", required=True),
    *text("suburb_id", required=True),
    *text("offence_code", 10),
    *text("offence_category", 200),
    *text("offence_description", 500),
    *text("AU2017_name", 200),
]
AREA_RULES = [
    *text("suburb_id", required=True),
    *text("AU2017_name", 200),
    *text("name", 200, required=True),
    *text("slug", 250, required=True),
    *text("region", 100),
    *text("council", 100),
    *text("location_type", 50),
    *span("lat", -90, 90),
    *span("lng", -180, 180),
    *span("safety_score", 0, 100),
    *span("crime_rate_per_1000", 0),
    *span("total_crimes_12m", 0, 32767),
    Rule("crime_trend", "required"),
    Rule("crime_trend", "one_of", allowed=("up", "down", "flat")),
    *span("rank_in_region", 0),
    *span("population", 0),
]
BLOCK_RULES = [
    *text("id", required=True),
    *text("suburb_id", required=True),
    *span("crime_count", 0),
    *span("lat", -90, 90),
    *span("lng", -180, 180),
]


def with_errors(df: DataFrame, rules: list[Rule], out: str = "errors") -> DataFrame:
    """Add the broken rules of each row as an array of (field, rule, value).

    Rules of absent columns are left out, but a required column must be there.
    """
    absent = sorted({r.field for r in rules if r.name == "required" and r.field not in df.columns})
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    broken = [r.error() for r in rules if r.field in df.columns]
    return df.withColumn(out, F.expr(f"array_compact(array({', '.join(broken)}))"))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows). A rejected row is its original record plus the errors."""
    checked = with_errors(df, rules)
    valid = checked.where(F.size("errors") == 0).drop("errors")
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rejected = checked.where(F.size("errors") > 0).select(record.alias("original_record"), "errors")
    return valid, rejected


def summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(what, n_rows): valid rows, rejected rows and rows per broken field:rule, counted in one pass."""
    reasons = F.transform("errors", lambda e: F.concat_ws(":", e["field"], e["rule"]))
    kind = F.array(F.when(F.size("errors") == 0, "valid").otherwise("rejected"))
    told = with_errors(df, rules).select(F.explode(F.concat(kind, reasons)).alias("what"))
    return told.groupBy("what").agg(F.count(F.lit(1)).alias("n_rows"))


def reject_reasons(rejected: DataFrame) -> DataFrame:
    """Rows per broken (field, rule)."""
    return (
        rejected.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n_rows"))
    )
