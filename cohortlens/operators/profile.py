"""Table profiling.

Each profile is one aggregation over the table: all per-column
statistics are computed in a single `agg`, and the one wide result row is
turned into a long `(column, ...)` table with `inline`, so the cost is
one scan regardless of the column count.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NumericType,
    ShortType, StringType, TimestampNTZType, TimestampType,
)

# fixed value: the role-inference threshold on distinct counts
CATEGORICAL_MAX_DISTINCT = 15


def q(name: str) -> Column:
    """Column reference that tolerates any character in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def _long(row_df: DataFrame, entries: list[Column]) -> DataFrame:
    return row_df.select(F.inline(F.array(*entries)))


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """First n rows in a stated order (TakeOrderedAndProject, no full sort)."""
    if order_by is None:
        return df.limit(n)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[q(c) for c in order]).limit(n)


def dtypes(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) from the schema; no job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns (schema only)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def info(df: DataFrame) -> DataFrame:
    """Position, column, non-null count, type, and the row count."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count(q(f.name)).alias(f"__c{i}") for i, f in enumerate(fields)]
    row = df.agg(*aggs)
    entries = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                        F.col(f"__c{i}").alias("non_null"),
                        F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col("__rows").alias("rows"))
               for i, f in enumerate(fields)]
    return _long(row, entries)


def _cell(df: DataFrame, column: str) -> tuple[Column, Column] | None:
    """A value as (whole number, text), one of them NULL, equal exactly where
    Spark's grouping holds the values equal; None for types without such a form."""
    kind, value = df.schema[column].dataType, q(column)
    no_number, no_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    if isinstance(kind, (BooleanType, ByteType, ShortType, IntegerType, LongType)):
        return value.cast("long"), no_text
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("long"), no_text
    if isinstance(kind, TimestampType):
        return F.unix_micros(value), no_text
    if isinstance(kind, (DoubleType, FloatType)):
        return no_number, (value + F.lit(0).cast(kind)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(kind, (DecimalType, TimestampNTZType)):
        return no_number, value.cast("string")
    if isinstance(kind, BinaryType):
        return no_number, F.hex(value)
    if type(kind) is StringType and kind == StringType():
        return no_number, value
    return None


def nunique(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
            rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.

    Exact: every row gives narrow (column, value) cells, which each map task
    deduplicates before one shuffle on (column, value); then they are counted.
    Columns of types without a plain form (arrays, structs, collated text) are
    counted by distinct aggregates. `approx=True` uses HyperLogLog++ sketches
    instead: bounded memory, no row expansion. NaN is one value; an empty
    table gives zeros.
    """
    columns = list(columns) if columns is not None else df.columns
    cells = {} if approx else {i: cell for i, c in enumerate(columns) if (cell := _cell(df, c)) is not None}
    rest = [i for i in range(len(columns)) if i not in cells]
    row = None
    if cells:
        long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("__at"), number.alias("__number"), text.alias("__text"))
                                            for i, (number, text) in cells.items()])))
        long = long.where(F.col("__number").isNotNull() | F.col("__text").isNotNull()).distinct()
        row = long.agg(*[F.count_if(F.col("__at") == i).alias(f"__d{i}") for i in cells])
    if rest:
        one = (lambda c: F.approx_count_distinct(q(c), rsd)) if approx else (lambda c: F.count_distinct(q(c)))
        others = df.agg(*[one(columns[i]).alias(f"__d{i}") for i in rest])
        row = others if row is None else row.join(others)  # one row each
    if row is None:
        return df.sparkSession.createDataFrame([], "position int, column string, nunique long")
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                        F.col(f"__d{i}").alias("nunique")) for i, c in enumerate(columns)]
    return _long(row, entries)


def column_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """Name, type and distinct count per column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    nu = nunique(df, approx=approx)
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return nu.select("position", "column", mapping[F.col("column")].alias("dtype"), "nunique")


def infer_roles(df: DataFrame, label: str, exclude: Sequence[str] = (),
                threshold: int = CATEGORICAL_MAX_DISTINCT, approx: bool = False) -> DataFrame:
    """`nunique <= threshold` -> categorical, else numeric; label skipped."""
    cols = [c for c in df.columns if c != label and c not in set(exclude)]
    nu = nunique(df, cols, approx=approx)
    return nu.withColumn(
        "role", F.when(F.col("nunique") <= threshold, "categorical").otherwise("numeric"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL (and NaN) count per column, plus a `__total__` row."""
    columns = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def missing(c: str) -> Column:
        cond = q(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(q(c))
        return cond

    aggs = [F.count_if(missing(c)).alias(f"__n{i}") for i, c in enumerate(columns)]
    row = df.agg(*aggs)
    total = sum((F.col(f"__n{i}") for i in range(len(columns))), F.lit(0).cast("bigint"))
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                        F.col(f"__n{i}").alias("nulls")) for i, c in enumerate(columns)]
    entries.append(F.struct(F.lit(len(columns)).alias("position"),
                            F.lit("__total__").alias("column"), total.alias("nulls")))
    return _long(row, entries)


def missing_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Presence pattern per row ('1' = present) and how many rows share it.

    The row x column presence matrix is never materialised: the pattern is
    a string built per row and grouped (partial aggregation map-side).
    """
    columns = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def absent(c: str) -> Column:
        m = q(c).isNull()
        return m | F.isnan(q(c)) if types[c] in ("double", "float") else m

    flags = [F.when(absent(c), F.lit("0")).otherwise(F.lit("1")) for c in columns]
    pattern = F.concat(*flags)
    missing = sum((F.when(absent(c), 1).otherwise(0) for c in columns), F.lit(0))
    return (df.select(pattern.alias("pattern"), missing.alias("n_missing"))
            .groupBy("pattern", "n_missing").agg(F.count(F.lit(1)).alias("rows")))


def missing_matrix(df: DataFrame, id_col: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The row x column presence matrix itself (1 = present), one
    narrow projection per row, no shuffle."""
    columns = [c for c in (list(columns) if columns is not None else df.columns) if c != id_col]
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def present(c: str) -> Column:
        m = q(c).isNotNull()
        return m & ~F.isnan(q(c)) if types[c] in ("double", "float") else m

    return df.select(q(id_col).alias(id_col), *[present(c).cast("int").alias(c) for c in columns])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """P10: count and percent of rows per value, most frequent first.

    The total is a scalar subquery over the (small) grouped result.
    """
    counts = df.groupBy(q(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.select(F.sum("count")).scalar()
    return counts.select("value", "count", (F.col("count") * 100.0 / total).alias("percent")) \
        .orderBy(F.desc("count"), F.asc("value"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column (nulls kept, as pandas `unique`)."""
    return df.select(q(col).alias("value")).distinct()


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))
