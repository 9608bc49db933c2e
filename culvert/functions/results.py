"""Helpers for user logic that may fail per row.

An extension point (topic resolver, key function, codec) returns either one
Column, or a pair of Columns ``(value, error)`` in which a non-null error text
marks the row as failed. Errors stay data; no row fails a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Fallible = Column | tuple[Column, Column]


def value_and_error(result: Fallible) -> tuple[Column, Column]:
    if isinstance(result, tuple):
        value, error = result
        return value, error.cast("string")
    return result, F.lit(None).cast("string")


def quoted(text: Column) -> Column:
    """``text`` between double quotes, with nothing escaped inside."""
    return F.concat(F.lit('"'), F.coalesce(text, F.lit("")), F.lit('"'))


def case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """One CASE over ``branches`` in order; ``otherwise`` alone when there are none."""
    if not branches:
        return otherwise
    condition, value = branches[0]
    chain = F.when(condition, value)
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def computed_once(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with ``columns`` computed at this point of the plan.

    Spark pushes a filter below the projection that computes its columns and so
    computes them twice: once to test, once for the rows that stay. For columns
    that parse a payload or try patterns that doubles the work. Filters on the
    output of a generator stay above it; this one unfolds a list of one row.
    """
    others = [column_named(name) for name in df.columns if name not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def column_named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
