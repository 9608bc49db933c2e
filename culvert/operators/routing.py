"""Routing of bus events to Kafka topics: destination, partition key, outbound record."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from culvert import schemas
from culvert.functions.headers import headers_from
from culvert.functions.patterns import Pattern
from culvert.functions.payload import Codec, encode_payload
from culvert.functions.results import Fallible, case, column_named, computed_once, quoted, value_and_error

FALLBACKS = ("error", "slash_to_dot", "ignore")

KeyFunction = Callable[[Column, Column, Column], Fallible]

ROUTE_COLUMNS = ("mapping_ord", "kafka_topic", "key", "status", "error")


@dataclass(frozen=True)
class TopicMapping:
    """Events whose topic matches ``pattern`` go to ``kafka_topic``.

    ``key`` is None for records without a key, ``"fields.x"`` for the value of
    one field, a Column, or a function of the topic, the message and the merged
    fields that gives the key or a pair ``(key, error)``.
    """

    pattern: str
    kafka_topic: str
    key: str | Column | KeyFunction | None = None


def merge_fields(fields: Column, captured: Column | None) -> Column:
    """``fields`` with the captured values on top."""
    if captured is None:
        return fields
    given = F.coalesce(fields, F.create_map().cast(schemas.FIELDS))
    kept = F.map_filter(given, lambda name, _: ~F.map_contains_key(captured, name))
    return F.map_concat(kept, captured)


def merged_fields(df: DataFrame, pattern: str) -> DataFrame:
    """Add ``merged_fields``: what a key function of a mapping with ``pattern`` gets to see."""
    compiled = Pattern(pattern)
    topic, fields = F.col("topic"), F.col("fields")
    merged = merge_fields(fields, compiled.captured_map(topic))
    return df.withColumn("merged_fields", F.when(compiled.matches(topic), merged))


def _key_of(mapping: TopicMapping, pattern: Pattern) -> tuple[Column, Column]:
    topic, msg, fields = F.col("topic"), F.col("msg"), F.col("fields")
    if mapping.key is None:
        return F.lit(None).cast("binary"), F.lit(None).cast("string")
    if isinstance(mapping.key, str):
        root, _, name = mapping.key.partition(".")
        if root != "fields" or not name:
            raise ValueError(f'a key given as text must read "fields.<name>": {mapping.key!r}')
        if name in pattern.captures:
            return pattern.capture(topic, name).cast("binary"), F.lit(None).cast("string")
        # A field that is not there reads as empty text, so the key is empty, not null.
        return F.coalesce(fields[name], F.lit("")).cast("binary"), F.lit(None).cast("string")
    if isinstance(mapping.key, Column):
        result: Fallible = mapping.key
    else:
        result = mapping.key(topic, msg, merge_fields(fields, pattern.captured_map(topic)))
    key, error = value_and_error(result)
    return key.cast("binary"), error


def route(df: DataFrame, mappings: Sequence[TopicMapping], default: str = "error") -> DataFrame:
    """Add ``mapping_ord, kafka_topic, key, status, error`` to bus events.

    The first mapping whose pattern matches ``topic`` counts. Where none does,
    ``default`` decides: ``error``, ``slash_to_dot`` or ``ignore``. The pattern
    tests run once, into ``mapping_ord``; everything else switches on that number.
    """
    check_default(default)
    topic = F.col("topic")
    patterns = [Pattern(mapping.pattern) for mapping in mappings]
    matched = case(
        [(pattern.matches(topic), F.lit(i)) for i, pattern in enumerate(patterns)],
        F.lit(None).cast("int"),
    )
    df = computed_once(df.withColumn("mapping_ord", matched), "mapping_ord")
    ord_ = F.col("mapping_ord")

    keys = [_key_of(mapping, pattern) for mapping, pattern in zip(mappings, patterns)]
    keyed = [i for i, mapping in enumerate(mappings) if mapping.key is not None]
    df = df.withColumns({
        "_target": case(
            [(ord_ == i, F.lit(mapping.kafka_topic)) for i, mapping in enumerate(mappings)],
            F.lit(None).cast("string"),
        ),
        "_key": case([(ord_ == i, keys[i][0]) for i in keyed], F.lit(None).cast("binary")),
        "_key_error": case([(ord_ == i, keys[i][1]) for i in keyed], F.lit(None).cast("string")),
    })
    return finish_route(df, default)


def check_default(default: str) -> None:
    if default not in FALLBACKS:
        raise ValueError(f"default must be one of {FALLBACKS}: {default!r}")


def finish_route(df: DataFrame, default: str) -> DataFrame:
    """Turn ``mapping_ord, _target, _key, _key_error`` into the route columns."""
    topic, unmatched = F.col("topic"), F.col("mapping_ord").isNull()
    if default == "slash_to_dot":
        fallback = F.translate(topic, "/", ".")
    elif default == "ignore":
        fallback = F.when(topic.isNotNull(), F.lit(""))
    else:
        fallback = F.lit(None).cast("string")
    df = df.withColumn("kafka_topic", F.when(unmatched, fallback).otherwise(F.col("_target")))

    target, key_failed = F.col("kafka_topic"), F.col("_key_error").isNotNull()
    # The error texts of a failed key function and of an unmatched topic.
    key_text = F.concat(F.lit("kafka producer: resolve key for "), quoted(topic), F.lit(": "), F.col("_key_error"))
    unmatched_text = F.concat(
        F.lit("kafka producer: no topic mapping matched for topic "),
        quoted(topic),
        F.lit(" and default_topic_transform is error"),
    )
    return df.withColumns({
        "kafka_topic": F.when(~key_failed, target),
        "key": F.when(~key_failed, F.col("_key")),
        "status": F.when(key_failed, "key_error")
        .when(target.isNull(), "unmatched")
        .when(target == "", "ignored")
        .otherwise("ok"),
        "error": F.when(key_failed, key_text).when(target.isNull(), unmatched_text),
    }).drop("_target", "_key", "_key_error")


def produce(routed: DataFrame, fmt: str | Codec = "auto") -> DataFrame:
    """All routed events with their encoded ``value`` and their ``headers``.

    ``status`` tells what becomes of each: ``ok`` events are sent, ``ignored`` ones are
    not wanted, and those that do not match, have no key or do not encode carry an
    ``error``. So sent, ignored and failed events add up to the events that came in.
    The headers hold the event's own fields; captured values do not become headers.
    """
    encoded = encode_payload(routed, fmt)
    headers = F.when(F.col("status") == "ok", headers_from(F.col("fields")))
    return computed_once(encoded.withColumn("headers", headers), "value", "headers", "status", "error")


def sent(produced: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Outbound records of the produced events that are ``ok``; ``keep`` carries columns along."""
    return produced.filter(F.col("status") == "ok").select(
        *keep, F.col("kafka_topic").alias("topic"), "key", "value", "headers"
    )


def in_key_order(produced: DataFrame, order: str) -> DataFrame:
    """The same rows, those of one topic and key sorted by ``order``, each topic and key in
    one partition or, where it holds more than that, in partitions that follow each other:
    the rows are dealt by ranges, so a hot key is split by its order and not sent to one task.
    """
    by = ["kafka_topic", "key", order]
    return produced.repartitionByRange(*by).sortWithinPartitions(*by)


def failed(produced: DataFrame) -> DataFrame:
    """The produced events that could not be sent, with ``status`` and ``error``."""
    return produced.filter(F.col("error").isNotNull())


def to_outbound(routed: DataFrame, fmt: str | Codec = "auto", keep: Sequence[str] = ()) -> DataFrame:
    """Outbound records of the routed events that are ``ok`` and encode; see ``produce`` for the others."""
    return sent(produce(routed.filter(F.col("status") == "ok"), fmt), keep)


def route_many(df: DataFrame, producers: dict[str, Sequence[TopicMapping]]) -> DataFrame:
    """Route every event through several producers that each ignore what is not theirs.

    Gives one row per event and producer that takes it, with the producer's
    name in ``producer``. The events are read once: all routes are computed
    beside each other and unfolded, instead of a union of one scan per producer.
    """
    if not producers:
        raise ValueError("at least one producer is needed")
    own = [column_named(name) for name in df.columns]
    routes = []
    for i, (name, mappings) in enumerate(producers.items()):
        df = route(df, mappings, "ignore")
        packed = F.struct(F.lit(name).alias("producer"), *(F.col(c) for c in ROUTE_COLUMNS))
        df = df.withColumn(f"_route_{i}", packed).drop(*ROUTE_COLUMNS)
        routes.append(F.col(f"_route_{i}"))
    taken = F.filter(F.array(*routes), lambda r: r["status"] != "ignored")
    return df.select(*own, F.inline(taken))
