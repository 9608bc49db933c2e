"""Record headers to fields, and fields back to headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from culvert import schemas

# W3 trace-context header keys, matched exactly and case-sensitively.
TRACE_HEADERS = ("traceparent", "tracestate", "baggage")


def headers_to_fields(df: DataFrame) -> DataFrame:
    """Add ``fields``: the headers without the trace ones as a map, null when none is left.

    Of several headers with one key the last counts; a null value becomes ``""``.
    """
    # A column of its own, so that the list is made once per row.
    df = df.withColumn("_entries", _entries(F.col("headers")))
    entries = F.col("_entries")
    # map_from_entries raises on a repeated key, so repeated keys are resolved here.
    repeated = (F.size(entries) > 1) & (F.size(F.array_distinct(entries["key"])) < F.size(entries))
    last_of_each = F.filter(entries, lambda e, i: F.array_position(_after(entries["key"], i), e["key"]) == 0)
    fields = F.map_from_entries(F.when(repeated, last_of_each).otherwise(entries))
    return df.withColumn("fields", F.when(F.size(entries) > 0, fields)).drop("_entries")


def _entries(headers: Column) -> Column:
    """The headers to keep, as text."""
    kept = F.filter(headers, lambda h: ~h["key"].isin(*TRACE_HEADERS))
    return F.transform(
        kept,
        lambda h: F.struct(
            h["key"].alias("key"),
            F.coalesce(h["value"].cast("string"), F.lit("")).alias("value"),
        ),
    )


def _after(items: Column, index: Column) -> Column:
    """The items behind zero-based ``index``."""
    return F.slice(items, index + 2, F.greatest(F.size(items) - index - 1, F.lit(0)))


def headers_from(fields: Column) -> Column:
    """One header per field, ordered by key; an empty list for a null map."""
    entries = F.sort_array(F.map_entries(fields)).cast(schemas.HEADERS)
    return F.coalesce(entries, F.array().cast(schemas.HEADERS))


def fields_to_headers(df: DataFrame) -> DataFrame:
    """Add ``headers`` from ``fields``."""
    return df.withColumn("headers", headers_from(F.col("fields")))
