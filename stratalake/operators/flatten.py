"""Nested columns to flat rows. All of it is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def promote_struct(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by its fields, which come first.

    A field named like another column would make both unusable, so that is
    refused; give a ``prefix`` to keep them apart.
    """
    struct = df.schema[column].dataType
    if not isinstance(struct, T.StructType):
        raise TypeError(f"{column} is a {struct.simpleString()}, not a struct")
    others = [name for name in df.columns if name != column]
    promoted = {name: f"{prefix}{name}" for name in struct.fieldNames()}
    taken = {name.lower() for name in others}
    clashes = [name for name in promoted.values() if name.lower() in taken]
    if clashes:
        raise ValueError(f"{column} has fields that already are columns: {clashes}")
    return df.select(
        *[_quoted(column).getField(name).alias(alias) for name, alias in promoted.items()],
        *[_quoted(name) for name in others],
    )


def explode_only(df: DataFrame, column: str, alias: str = "col") -> DataFrame:
    """One row per array element and nothing else; null and empty arrays vanish."""
    return _exploded(df.select(_quoted(column)), column, alias)


def explode_keep(df: DataFrame, column: str, alias: str = "col") -> DataFrame:
    """One row per array element beside the other columns, without the array."""
    return _exploded(df, column, alias)


def items_as_rows(df: DataFrame, column: str) -> DataFrame:
    """One row per nested item, for documents that hold one item or many.

    A struct column is already one item per row and is passed on; an array is
    exploded. Either way a row without items stays, with a null item.
    """
    if not isinstance(df.schema[column].dataType, T.ArrayType):
        return df
    others = [_quoted(name) for name in df.columns if name != column]
    return df.select(*others, F.explode_outer(_quoted(column)).alias(column))


def _exploded(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``explode`` that evaluates the array once.

    For a plain ``explode`` the optimizer adds a filter on the array's size. If
    the array comes out of a parser, that parses every document again, twice. An
    outer explode has no such filter; rows without elements have no position.
    """
    kept = [name for name in df.columns if name != column]
    if alias.lower() in {name.lower() for name in kept}:
        raise ValueError(f"{alias} already is a column")
    others = [_quoted(name) for name in kept]
    positioned = F.posexplode_outer(_quoted(column)).alias("__position", alias)
    return df.select(*others, positioned).where(F.col("__position").isNotNull()).drop("__position")


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
