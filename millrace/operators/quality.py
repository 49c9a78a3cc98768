"""Constraints and expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import EVENT_TYPES


@dataclass(frozen=True)
class Check:
    """A condition on one row; null passes, as in SQL."""

    name: str
    condition: Column


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int


@dataclass(frozen=True)
class Unique:
    """No two rows share the values; rows with a null in them are exempt."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: DataFrame
    parent_key: str


Rule = Check | NotNull | MaxLength | Unique | ForeignKey


def _row_rule(rule: Rule) -> tuple[str, Column] | None:
    if isinstance(rule, Check):
        return f"check {rule.name}", ~rule.condition
    if isinstance(rule, NotNull):
        return f"not null {rule.column}", F.col(rule.column).isNull()
    if isinstance(rule, MaxLength):
        return f"length {rule.column}", F.length(rule.column) > rule.length
    return None


def _entry(place: int, keys: Sequence[Column], rows: int, parent: int) -> Column:
    """One mark of a key under a rule; keys are compared by 128 bits."""
    hashes = [F.xxhash64(F.lit(seed), *keys) if keys else F.lit(0).cast("long") for seed in (1, 2)]
    values = (F.lit(place), *hashes, F.lit(rows).cast("long"), F.lit(parent))
    return F.struct(*[v.alias(n) for v, n in zip(values, ("place", "h0", "h1", "rows", "parent"), strict=True)])


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of rows that break it.

    One scan of the table and of each parent: every row gives a mark for each
    row rule it breaks and for its key under each key rule, parents mark their
    keys, and one aggregate, partial on the map side, counts them all.
    """
    titles: list[str] = []
    marks: list[Column] = []
    parents: list[DataFrame] = []
    kinds = {f.name: f.dataType for f in df.schema}
    for place, rule in enumerate(rules):
        if row := _row_rule(rule):
            title, broken = row
            marks.append(F.when(broken, _entry(place, [], 1, 0)))
        elif isinstance(rule, Unique):
            title = "unique " + ", ".join(rule.columns)
            given = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in rule.columns))
            marks.append(F.when(given, _entry(place, [F.col(c) for c in rule.columns], 1, 0)))
        else:
            title = f"foreign key {rule.column}"
            key = rule.parent.schema[rule.parent_key].dataType
            # Both sides in the parent's type, so equal values have equal hashes.
            child = F.col(rule.column) if kinds[rule.column] == key else F.col(rule.column).try_cast(key)
            marks.append(F.when(F.col(rule.column).isNotNull(), _entry(place, [child], 1, 0)))
            own = _entry(place, [F.col(rule.parent_key)], 0, 1)
            parents.append(rule.parent.filter(F.col(rule.parent_key).isNotNull()).select(own.alias("m")))
        titles.append(title)
    given = df.select(F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("m"))
    every = reduce(DataFrame.unionByName, parents, given).select("m.*")
    by_key = every.groupBy("place", "h0", "h1").agg(F.sum("rows").alias("rows"), F.max("parent").alias("parent"))
    places = lambda kind: [i for i, r in enumerate(rules) if isinstance(r, kind)]
    fine = F.col("place").isin(places(Unique)) & (F.col("rows") < 2) | F.col("place").isin(places(ForeignKey)) & (F.col("parent") == 1)
    counted = by_key.filter(~fine).groupBy("place").agg(F.sum("rows").alias("violations"))
    named = F.posexplode(F.array(*map(F.lit, titles))).alias("place", "rule")
    listed = df.sparkSession.range(1).select(named)
    joined = listed.join(counted, "place", "left")
    return joined.select("rule", F.coalesce("violations", F.lit(0)).alias("violations"))


def clickstream_rules() -> dict[str, Column]:
    """Expectations on a clickstream row (columns need a session to be built)."""
    return {
        "valid_event_type": F.col("event_type").isin(*EVENT_TYPES),
        "valid_product_id": F.col("product_id").isNotNull(),
        "valid_event_ts": F.col("event_ts").isNotNull(),
    }


def holds(rule: Column) -> Column:
    """A rule whose outcome is null counts as broken."""
    return F.coalesce(rule, F.lit(False))


def keep_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that meet every rule; a filter drops null outcomes by itself.

    The bare rules can be pushed into the scan.
    """
    return df.filter(reduce(lambda a, b: a & b, rules.values()))


def violation_counts(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.when(~holds(rule), 1)).alias(name) for name, rule in rules.items()]


def expect_or_drop(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The valid rows, and counts per rule that fill in when they are used."""
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *violation_counts(rules))
    return keep_valid(watched, rules), seen


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rows seen and rows that break it."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *violation_counts(rules))
    return counted.unpivot(["_rows"], list(rules), "rule", "violations").select(
        "rule", F.col("_rows").alias("rows"), "violations"
    )


def check_contract(df: DataFrame, contract: T.StructType) -> list[str]:
    """How a table's schema departs from the one the producer promises."""
    actual = {f.name: f.dataType for f in df.schema}
    problems = [
        f"{f.name}: missing" if f.name not in actual
        else f"{f.name}: {actual[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in contract
        if actual.get(f.name) != f.dataType
    ]
    expected = set(contract.fieldNames())
    return problems + [f"{name}: not in the contract" for name in actual if name not in expected]
