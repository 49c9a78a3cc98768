"""Table evolution: updates, new columns, migrations, schema and state comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the matching rows; every expression sees the old row.

    A condition that is null does not match.  Column types stay as they are.
    """
    changed = {
        name: F.when(condition, value).otherwise(F.col(name)).cast(df.schema[name].dataType).alias(name)
        for name, value in values.items()
    }
    return df.select(*[changed.get(c, F.col(c)) for c in df.columns])


def add_column(df: DataFrame, name: str, kind: str, default: Any = None) -> DataFrame:
    """Add a column with a default unless the table already has it."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(kind))


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Fail the job that reads a row with a null in one of the columns.

    Checked while the rows pass by, so it costs no scan of its own.  It is a
    filter, so the check stays when nobody reads the columns; and it counts as
    not deterministic, so the optimizer neither moves nor tries it.
    """
    for c in columns:
        missing = F.col(c).isNull() & (F.rand() >= 0)
        df = df.filter(F.when(missing, F.raise_error(F.lit(f"null in column {c}")).cast("boolean")).otherwise(True))
    return df


def apply_migrations(tables: Tables, steps: Sequence[Callable[[Tables], Tables]]) -> Tables:
    """Run migration steps in order; steps are written to be repeatable."""
    return reduce(lambda state, step: {**state, **step(state)}, steps, dict(tables))


_WIDER = {
    ("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"),
    ("short", "long"), ("integer", "long"), ("float", "double"), ("integer", "double"),
    ("date", "timestamp_ntz"),
}


def _may_widen(held: T.DataType, arriving: T.DataType) -> T.DataType:
    """The type that holds both, or an error."""
    if held == arriving:
        return held
    if isinstance(held, T.DecimalType) and isinstance(arriving, T.DecimalType):
        whole = max(held.precision - held.scale, arriving.precision - arriving.scale)
        scale = max(held.scale, arriving.scale)
        if whole + scale > 38:
            raise TypeError(f"no decimal holds both {held.simpleString()} and {arriving.simpleString()}")
        return T.DecimalType(whole + scale, scale)
    pair = (held.typeName(), arriving.typeName())
    if pair in _WIDER:
        return arriving
    if pair[::-1] in _WIDER:
        return held
    raise TypeError(f"cannot change type {held.simpleString()} to {arriving.simpleString()}")


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append a batch whose columns have changed.

    A new column is null in the old rows; a column the batch no longer has
    keeps its history and is null in the batch.  A renamed column is a dropped
    and a new one.  Types may only widen.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    for field in batch.schema:
        held = kinds.get(field.name, field.dataType)
        kinds[field.name] = _may_widen(held, field.dataType)

    def widened(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])

    return widened(target).unionByName(widened(batch), allowMissingColumns=True)


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: table, column, type, nullable."""
    rows = [
        (table, f.name, f.dataType.simpleString(), f.nullable)
        for table, df in tables.items()
        for f in df.schema
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, nullable boolean"
    )


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns that only one side has, or whose type or nullability differs."""
    on = ["table_name", "column_name"]
    a = left.select(*on, F.struct("data_type", "nullable").alias("_left"))
    b = right.select(*on, F.struct("data_type", "nullable").alias("_right"))
    drift = (
        F.when(F.col("_right").isNull(), "only left")
        .when(F.col("_left").isNull(), "only right")
        .when(F.col("_left.data_type") != F.col("_right.data_type"), "type")
        .when(F.col("_left.nullable") != F.col("_right.nullable"), "nullable")
    )
    return (
        a.join(b, on, "full_outer")
        .withColumn("drift", drift)
        .filter(F.col("drift").isNotNull())
        .select(
            *on,
            "drift",
            F.col("_left.data_type").alias("left_type"),
            F.col("_right.data_type").alias("right_type"),
        )
    )


def column_fill(df: DataFrame) -> DataFrame:
    """One row per column with the number of rows that have a value in it."""
    counted = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "filled_rows")


def table_figures(tables: Mapping[str, DataFrame], measures: Mapping[str, Column]) -> DataFrame:
    """One row per table: rows, and the total of its measure if it has one.

    Every measure is summed at its own scale; the totals are shown at the
    largest of them.
    """
    scales = {name: _scale(df.select(measures[name]).schema[0].dataType) for name, df in tables.items() if name in measures}
    shown = f"decimal(38,{max(scales.values(), default=0)})"
    parts = []
    for name, df in tables.items():
        amount = measures.get(name, F.lit(0)).cast(f"decimal(38,{scales.get(name, 0)})")
        total = F.coalesce(F.sum(amount), F.lit(0)).cast(shown)
        counted = df.agg(F.count(F.lit(1)).alias("rows"), total.alias("total"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "rows", "total"))
    return reduce(DataFrame.unionByName, parts)


def _scale(kind: T.DataType) -> int:
    """Decimals of a measure; a float has none of its own and gets 18, so that
    its sum does not depend on the order of the rows."""
    if isinstance(kind, T.DecimalType):
        return kind.scale
    return 18 if isinstance(kind, (T.FloatType, T.DoubleType)) else 0


def reconcile(before: Tables, after: Tables, measures: Mapping[str, Column]) -> DataFrame:
    """Row counts and totals of two states, table by table.

    ``measures`` gives the amount to total for the tables that have one.
    """

    def side(tables: Tables, label: str) -> DataFrame:
        return table_figures(tables, measures).withColumnsRenamed(
            {"rows": f"{label}_rows", "total": f"{label}_total"}
        )

    joined = side(before, "before").join(side(after, "after"), "table_name", "full_outer")
    same = F.col("before_rows").eqNullSafe(F.col("after_rows")) & F.col("before_total").eqNullSafe(
        F.col("after_total")
    )
    return joined.withColumn("matches", same)
