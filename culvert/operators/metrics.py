"""Counters, gauges and histograms as grouped aggregates.

All of them pre-aggregate on the map side, so a topic that holds much of the
rows costs no task more than its share of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from culvert.functions.results import computed_once
from culvert.operators.offsets import PARTITION, lag_of
from culvert.session import written_once


@dataclass(frozen=True)
class Instrument:
    name: str
    unit: str


# Instrument names and units.
CONSUMED = Instrument("messaging.client.consumed.messages", "{message}")
CONSUMER_ERRORS = Instrument("kafka.consumer.errors", "{error}")
LAG = Instrument("kafka.consumer.lag", "{message}")
PROCESS_DURATION = Instrument("messaging.process.duration", "s")
COMMITS = Instrument("kafka.consumer.commits", "{operation}")
SENT = Instrument("messaging.client.sent.messages", "{message}")
PRODUCER_ERRORS = Instrument("kafka.producer.errors", "{error}")
PRODUCE_DURATION = Instrument("messaging.client.operation.duration", "s")

# Attribute names, and the two attribute values that never change.
SYSTEM, SYSTEM_VALUE = "messaging.system", "kafka"
DESTINATION = "messaging.destination.name"
PARTITION_ID = "messaging.destination.partition.id"
OPERATION, OPERATION_VALUE = "messaging.operation.name", "send"

DELIVERED = ("ok", "handler_error")

# Bounds of the buckets of a histogram in a report, in seconds.
BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1)


def consumed_messages(ingested: DataFrame) -> DataFrame:
    """Delivered records per topic, as ``n``; failures do not count."""
    return ingested.filter(F.col("status") == "ok").groupBy("topic").agg(F.count("*").alias("n"))


def consumer_errors(ingested: DataFrame) -> DataFrame:
    """Records per topic without subscription, without bus topic, or failed in the handler."""
    return ingested.filter(F.col("error").isNotNull()).groupBy("topic").agg(F.count("*").alias("n"))


def duration_histogram(df: DataFrame, col: str, by: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """``n, total, shortest, longest`` of ``col`` per ``by``, and the count of each bucket.

    ``bucket_0`` counts what lies at or below the first bound, ``bucket_i`` what
    lies above bound i-1 and at or below bound i, the last bucket the rest.
    """
    return df.groupBy(*by).agg(*_distribution(F.col(col), bounds))


def _distribution(value: Column, bounds: Sequence[float]) -> list[Column]:
    edges = list(bounds)
    if edges != sorted(set(edges)):
        raise ValueError("bounds must rise")
    inside = []
    for i in range(len(edges) + 1):
        above = value > edges[i - 1] if i > 0 else F.lit(True)
        below = value <= edges[i] if i < len(edges) else F.lit(True)
        inside.append(value.isNotNull() & above & below)
    return [
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("shortest"),
        F.max(value).alias("longest"),
        *(F.count_if(condition).alias(f"bucket_{i}") for i, condition in enumerate(inside)),
    ]


def process_duration(ingested: DataFrame, col: str, bounds: Sequence[float]) -> DataFrame:
    """Histogram per topic of the time in the handler; rows that never reached it do not count."""
    return duration_histogram(ingested.filter(F.col("status").isin(*DELIVERED)), col, ["topic"], bounds)


def commit_count(ingested: DataFrame, batch_col: str, eligible: Column | None = None) -> DataFrame:
    """Number of poll batches with at least one row to commit, as ``n``; without ``eligible``, the good rows."""
    eligible = F.col("status") == "ok" if eligible is None else eligible
    return ingested.filter(eligible).agg(F.countDistinct(batch_col).alias("n"))


def sent_messages(results: DataFrame) -> DataFrame:
    """Acknowledged records per topic; rows with a ``write_error`` do not count."""
    if "write_error" in results.columns:
        results = results.filter(F.col("write_error").isNull())
    return results.groupBy("topic").agg(F.count("*").alias("n"))


def producer_errors(results: DataFrame) -> DataFrame:
    """Records per topic that the broker refused; routing, key and encoding errors never get that far."""
    return results.filter(F.col("write_error").isNotNull()).groupBy("topic").agg(F.count("*").alias("n"))


def produce_duration(results: DataFrame, col: str, bounds: Sequence[float]) -> DataFrame:
    """Histogram per topic of the time to send, of acknowledged records only."""
    return duration_histogram(results.filter(F.col("write_error").isNull()), col, ["topic"], bounds)


def with_metric_attrs(
    df: DataFrame,
    client: str,
    topic: Column | None = None,
    partition: Column | None = None,
    sends: bool | Column = False,
    client_attr: str = "client.name",
) -> DataFrame:
    """Add the map ``attributes``: system and client on every row, the others where they are not null.

    ``sends`` marks the instruments of the send operation.
    """
    sending = sends if isinstance(sends, Column) else F.lit(sends)
    nothing = F.lit(None).cast("string")
    named = {
        SYSTEM: F.lit(SYSTEM_VALUE),
        DESTINATION: nothing if topic is None else topic,
        PARTITION_ID: nothing if partition is None else partition.cast("string"),
        OPERATION: F.when(sending, OPERATION_VALUE),
        client_attr: F.lit(client),
    }
    pairs = [part for name, value in named.items() for part in (F.lit(name), value)]
    return df.withColumn("attributes", F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull()))


def metrics_report(
    ingested: DataFrame,
    high_watermarks: DataFrame,
    results: DataFrame,
    batch_col: str,
    eligible: Column,
    client: str,
    client_attr: str = "client.name",
    duration_col: str = "duration_s",
    bounds: Sequence[float] = BOUNDS,
) -> DataFrame:
    """All instruments in one table: ``name, unit, attributes, measure, value``.

    Equal to the single functions above, but ``ingested`` and ``results`` are
    each read once: one aggregation per topic, partition and batch feeds every
    instrument, and the high watermarks join the same grouping as rows. That
    aggregation is written once. ``measure`` is ``value`` for counters and
    gauges, and ``count``, ``sum``, ``min``, ``max`` or ``bucket_i`` for histograms;
    a table without ``duration_col`` has none.
    """
    outcome = [name for name in ("bus_topic", "status", "error") if name in ingested.columns]

    def duration(df: DataFrame, counts: Column) -> Column:
        return F.when(counts, F.col(duration_col) if duration_col in df.columns else F.lit(None).cast("double"))

    reached = duration(ingested, F.col("status").isin(*DELIVERED))
    per_batch = written_once(
        computed_once(ingested, *outcome).groupBy(*PARTITION, batch_col).agg(
            F.count_if(F.col("status") == "ok").alias("consumed"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            F.max(eligible).alias("commits"),
            F.max("offset").alias("last"),
            *_distribution(reached, bounds),
        ),
        "report",
    )
    consumer = per_batch.select(
        F.inline(F.array(
            _point(CONSUMED, n=F.col("consumed"), topic=F.col("topic")),
            _point(CONSUMER_ERRORS, n=F.col("errors"), topic=F.col("topic")),
            _point(LAG, topic=F.col("topic"), partition=F.col("partition"), last=F.col("last")),
            _point(COMMITS, n=F.col("commits").cast("long"), batch=F.col(batch_col)),
        ))
    )
    watermarks = high_watermarks.select(
        F.inline(F.array(
            _point(LAG, topic=F.col("topic"), partition=F.col("partition"), high=F.col("high_watermark"))
        ))
    )
    acknowledged = duration(results, F.col("write_error").isNull())
    per_topic = written_once(
        results.groupBy("topic").agg(
            F.count_if(F.col("write_error").isNull()).alias("sent"),
            F.count_if(F.col("write_error").isNotNull()).alias("refused"),
            *_distribution(acknowledged, bounds),
        ),
        "report",
    )
    histograms = _long_form(per_batch, PROCESS_DURATION, bounds).unionByName(
        _long_form(per_topic, PRODUCE_DURATION, bounds)
    )
    producer = per_topic.select(
        F.inline(F.array(
            _point(SENT, n=F.col("sent"), topic=F.col("topic")),
            _point(PRODUCER_ERRORS, n=F.col("refused"), topic=F.col("topic")),
        ))
    )
    # A batch is spread over topics and partitions, but is committed once.
    by_batch = (
        consumer.unionByName(watermarks)
        .unionByName(producer)
        .groupBy("name", "unit", "topic", "partition", "batch")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.max("high").alias("high"))
        .withColumn("n", F.when(F.col("name") == COMMITS.name, F.least("n", F.lit(1))).otherwise(F.col("n")))
    )
    totals = by_batch.groupBy("name", "unit", "topic", "partition").agg(
        F.sum("n").alias("n"), F.max("last").alias("last"), F.max("high").alias("high")
    )
    is_lag = F.col("name") == LAG.name
    value = F.when(is_lag, lag_of(F.col("high"), F.col("last"))).otherwise(F.col("n").cast("double"))
    # A counter that was never raised has no point; a partition without high watermark was not fetched.
    points = (
        totals.withColumn("value", value)
        .filter(F.when(is_lag, F.col("high").isNotNull()).otherwise(F.col("n") > 0))
        .select("name", "unit", "topic", "partition", F.lit("value").alias("measure"), "value")
        .unionByName(histograms)
    )
    return with_metric_attrs(
        points,
        client,
        topic=F.col("topic"),
        partition=F.col("partition"),
        sends=F.col("name").isin(SENT.name, PRODUCE_DURATION.name),
        client_attr=client_attr,
    ).select("name", "unit", "attributes", "measure", "value")


def _long_form(partial: DataFrame, instrument: Instrument, bounds: Sequence[float]) -> DataFrame:
    """Partial distributions merged per topic, one row per measure; topics without any are left out."""
    buckets = [f"bucket_{i}" for i in range(len(bounds) + 1)]
    merged = partial.groupBy("topic").agg(
        *(F.sum(name).alias(name) for name in ("n", "total", *buckets)),
        F.min("shortest").alias("shortest"),
        F.max("longest").alias("longest"),
    )
    named = {"count": "n", "sum": "total", "min": "shortest", "max": "longest", **{name: name for name in buckets}}
    measures = F.array(*(
        F.struct(F.lit(measure).alias("measure"), F.col(column).cast("double").alias("value"))
        for measure, column in named.items()
    ))
    return merged.filter(F.col("n") > 0).select(
        F.lit(instrument.name).alias("name"),
        F.lit(instrument.unit).alias("unit"),
        "topic",
        F.lit(None).cast("int").alias("partition"),
        F.inline(measures),
    )


def _point(instrument: Instrument, **given: Column) -> Column:
    """One measurement as a struct; what is not given is null."""
    types = {"topic": "string", "partition": "int", "batch": "string", "n": "long", "last": "long", "high": "long"}
    return F.struct(
        F.lit(instrument.name).alias("name"),
        F.lit(instrument.unit).alias("unit"),
        *(given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in types.items()),
    )
