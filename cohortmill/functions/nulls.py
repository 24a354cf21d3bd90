"""Missing-value rules.  A missing number is null or NaN; operators see null only."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)
FLOATING = (T.DoubleType, T.FloatType)


def col(c) -> Column:
    """A column given by name or already as a Column."""
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name for use in SQL text."""
    return name if "`" in name else "`" + name.replace(".", "`.`") + "`"


def number(c) -> Column:
    """The value as double, with NaN turned into null."""
    if isinstance(c, str):      # one call to the JVM instead of five, which counts for wide tables
        return F.expr(f"nanvl(CAST({quoted(c)} AS DOUBLE), CAST(NULL AS DOUBLE))")
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def is_missing(c) -> Column:
    return number(c).isNull()


def ne(c, value) -> Column:
    """``c != value`` that keeps rows where ``c`` is missing."""
    return ~col(c).eqNullSafe(F.lit(value))


def not_in(c, values) -> Column:
    """``c not in values`` that keeps rows where ``c`` is missing."""
    return ~holds(col(c).isin(list(values)))


def holds(condition: Column) -> Column:
    """Three-valued logic to two: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Null out NaN in the floating-point columns, in one projection."""
    wanted = set(columns if columns is not None else df.columns)
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if f.name in wanted and isinstance(f.dataType, FLOATING) else F.col(f.name)
        for f in df.schema.fields
    ])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def complete(columns) -> Column:
    """All columns known.

    One condition per column rather than ``dropna``: its single condition over many columns makes
    the optimizer derive a variant for every subset of renamed columns.
    """
    return all_of(number(c).isNotNull() for c in columns)
