"""Schemas shared by the sources, the steps and the tests."""

from __future__ import annotations

from pyspark.sql import types as T

HEADER = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
])

HEADERS = T.ArrayType(HEADER)

MESSAGE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("json", T.VariantType()),
    T.StructField("text", T.StringType()),
    T.StructField("raw", T.BinaryType()),
])

FIELDS = T.MapType(T.StringType(), T.StringType())

# The columns of Spark's Kafka source with includeHeaders=true.
RECORDS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", HEADERS),
])

OUTBOUND = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", HEADERS),
])

HIGH_WATERMARKS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("high_watermark", T.LongType()),
])

COMMITTED = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("next_offset", T.LongType()),
])

RULES = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("key", T.StringType()),
])
