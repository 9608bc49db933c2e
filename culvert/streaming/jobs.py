"""Continuous jobs: ingest with dead letters, produce, bridge, running counts.

A micro-batch is written by ``foreachBatch`` under its batch id, and the
checkpoint moves on only after all its writes: every record is handled at least
once, and on a table target a replayed batch replaces what it wrote before.

Positions, lag, counters and histograms are kept as changes by batch (``ChangeLog``),
so that they are the same after a replay or a restart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from culvert.functions.payload import Codec
from culvert.operators.bridge import bridge
from culvert.operators.ingest import Handler, Subscription, build_dlq, commit_eligible, ingest, split_outcomes
from culvert.operators.metrics import process_duration
from culvert.operators.offsets import PARTITION, committed_positions, consumer_lag
from culvert.operators.routing import TopicMapping, failed, in_key_order, produce, route, sent
from culvert.operators.rules import CompiledRules, compile_rules, forget, route_by_table
from culvert.session import scratch
from culvert.sources.delivery import Send, send_rows
from culvert.sources.records import Log, write_dlq, write_records
from culvert.streaming.changes import ChangeLog, counter_log, histogram_log

AVAILABLE_NOW: dict[str, object] = {"availableNow": True}

Subscriber = Callable[[DataFrame, int], None]

#: The ends of the partitions when a batch was taken: ``topic, partition, high_watermark``.
Watermarks = Callable[[int], DataFrame]

#: Batches between two snapshots of what a job keeps.
COMPACT_EVERY = 100


def keep(log: ChangeLog, changed: DataFrame, batch_id: int) -> None:
    """Write what a batch has changed, and now and then fold the changes."""
    log.append(changed, batch_id)
    if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
        log.compact(changed.sparkSession)


def run_ingest(
    records: DataFrame,
    subs: Sequence[Subscription],
    subscriber: Subscriber,
    checkpoint: str,
    handler: Handler | None = None,
    fmt: str | Codec = "auto",
    dlq: Log | Callable[[], Send] | None = None,
    dlq_topic: str = "dead-letters",
    header_prefix: str = "dlq-",
    report: Subscriber | None = None,
    trigger: dict[str, object] = AVAILABLE_NOW,
    bus_name: str = "bus",
    positions: ChangeLog | None = None,
    commit: str = "after_process",
    watermarks: Watermarks | None = None,
    lag: Subscriber | None = None,
) -> StreamingQuery:
    """Ingest a stream of records.

    ``subscriber`` gets the delivered rows of each micro-batch, ``dlq`` the dead
    letters, ``report`` all rows with their ``status``. The counts of the batch
    appear in the query's progress under ``ingest``. Should one of the writes
    fail, the whole batch is tried again after a restart. Without ``dlq`` the
    failed rows reach ``report`` only, and the checkpoint passes them by.

    A ``dlq`` that is no log but makes senders answers for each dead letter; one that it
    does not take fails alone. ``positions`` is told the committed position of every
    partition after each batch, last of all writes: of the rows that are good or whose
    dead letter was taken, or with ``commit="periodic"`` of all. ``lag`` gets, after each
    batch, how far every partition of ``watermarks`` is behind; a partition without
    records in the batch is not.
    """
    if (lag is None) != (watermarks is None):
        raise ValueError("lag is told from watermarks: give both or none")
    ok = F.col("status") == "ok"
    ingested = ingest(records, subs, handler, fmt, bus_name).observe(
        "ingest",
        F.count("*").alias("polled"),
        F.count_if(ok).alias("delivered"),
        F.count_if(~ok).alias("failed"),
        F.count_if("decode_failed").alias("undecoded"),
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # Written up to three times, decoded once. A lost block is computed again from the source.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outcomes = split_outcomes(batch, dlq is not None)
            subscriber(outcomes.ok, batch_id)
            refused = None
            if callable(dlq):
                origin = F.col("topic").alias("_from")
                letters = build_dlq(outcomes.dead, dlq_topic, header_prefix, keep=[origin, "partition", "offset"])
                place = [F.col("_from").alias("topic"), "partition", "offset"]
                refused = send_rows(letters, dlq, place).filter("write_error IS NOT NULL")
            elif dlq is not None:
                write_dlq(build_dlq(outcomes.dead, dlq_topic, header_prefix), dlq, batch_id)
            if report is not None:
                report(batch, batch_id)
            if lag is not None:
                lag(consumer_lag(batch, watermarks(batch_id)), batch_id)
            if positions is not None:
                eligible = batch.select(*PARTITION, "offset", "status", "error")
                if refused is not None and commit == "after_process":
                    eligible = eligible.join(refused, [*PARTITION, "offset"], "left_anti")
                done = committed_positions(eligible, commit_eligible(dlq is not None), commit)
                keep(positions, done, batch_id)
        finally:
            batch.unpersist()

    return _start(ingested, on_batch, checkpoint, trigger)


def run_produce(
    events: DataFrame,
    mappings: Sequence[TopicMapping] | DataFrame,
    target: Log | Callable[[], Send],
    checkpoint: str,
    default: str = "error",
    fmt: str | Codec = "auto",
    trigger: dict[str, object] = AVAILABLE_NOW,
    failures: Subscriber | None = None,
    report: Subscriber | None = None,
    results: Subscriber | None = None,
    order: str | None = None,
) -> StreamingQuery:
    """Route, encode and write a stream of bus events.

    ``mappings`` may be a table of rules; a micro-batch is then routed by the rules
    as they are when it runs. They are compiled again only when they have changed. With
    ``order``, a column of the events, the records of one topic and key are written in that
    order, in one file or in files that follow each other. ``failures`` gets the events of each micro-batch that
    do not match, have no key or do not encode, with their ``error``; ``report`` gets
    all events with their ``status``. Sent, ignored and failed events of a batch add
    up to its ``events`` in the query's progress under ``produce``.

    A ``target`` that is no log but makes senders answers for each record; ``results``
    gets what it said, as ``topic, write_error, duration_s``, which is what
    ``sent_messages``, ``producer_errors`` and ``produce_duration`` count.
    """
    if results is not None and not callable(target):
        raise ValueError("only a target that makes senders has results")

    compiled: CompiledRules | None = None

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal compiled
        if isinstance(mappings, DataFrame):
            before, compiled = compiled, compile_rules(mappings, before=compiled)
            if before is not None and before is not compiled:
                forget(before)
            batch = _watched(produce(route_by_table(batch, compiled, default), fmt))
        if order is not None:
            batch = in_key_order(batch, order)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if callable(target):
                said = send_rows(sent(batch), target, ["topic"])
                if results is not None:
                    results(said, batch_id)
            else:
                write_records(sent(batch), target, batch_id)
            if failures is not None:
                failures(failed(batch), batch_id)
            if report is not None:
                report(batch, batch_id)
        finally:
            batch.unpersist()

    if isinstance(mappings, DataFrame):
        return _start(events, on_batch, checkpoint, trigger)
    return _start(_watched(produce(route(events, mappings, default), fmt)), on_batch, checkpoint, trigger)


def _watched(produced: DataFrame) -> DataFrame:
    """Counts of what became of the events, under ``produce``."""
    by_status = ("ok", "ignored", "unmatched", "key_error", "serialize_error")
    counts = [F.count_if(F.col("status") == name).alias(name) for name in by_status]
    return produced.observe("produce", F.count("*").alias("events"), *counts)


def run_each(
    rows: DataFrame, subscriber: Subscriber, checkpoint: str, trigger: dict[str, object] = AVAILABLE_NOW
) -> StreamingQuery:
    """Hand each micro-batch of a stream on as it is."""
    return _start(rows, subscriber, checkpoint, trigger)


def run_bridge(
    records: DataFrame,
    subs: Sequence[Subscription],
    mappings: Sequence[TopicMapping],
    target: Log,
    checkpoint: str,
    handler: Handler | None = None,
    default: str = "error",
    fmt: str | Codec = "auto",
    dlq: Log | None = None,
    dlq_topic: str = "dead-letters",
    header_prefix: str = "dlq-",
    report: Subscriber | None = None,
    trigger: dict[str, object] = AVAILABLE_NOW,
    bus_name: str = "bus",
    positions: ChangeLog | None = None,
    commit: str = "after_process",
) -> StreamingQuery:
    """Ingest a stream of records, route the events and write them on.

    ``dlq`` gets the record, as it came, of every row that failed in either
    direction; ``report`` gets all rows. The counts of a micro-batch appear in the
    query's progress under ``bridge``. Each record is decoded and encoded once.
    ``positions`` is told the committed positions as in ``run_ingest``; a record whose
    event is routed nowhere on purpose is done.
    """
    rows = produce(bridge(records, subs, mappings, handler, default, fmt, bus_name), fmt).observe(
        "bridge",
        F.count("*").alias("polled"),
        F.count_if(F.col("status") == "ok").alias("sent"),
        F.count_if(F.col("status") == "ignored").alias("ignored"),
        F.count("error").alias("failed"),
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_records(sent(batch), target, batch_id)
            if dlq is not None:
                write_dlq(build_dlq(batch, dlq_topic, header_prefix), dlq, batch_id)
            if report is not None:
                report(batch, batch_id)
            if positions is not None:
                eligible = commit_eligible(dlq is not None) | (F.col("status") == "ignored")
                keep(positions, committed_positions(batch, eligible, commit), batch_id)
        finally:
            batch.unpersist()

    return _start(rows, on_batch, checkpoint, trigger)


def running_counts(df: DataFrame, by: Sequence[str] = ("topic", "status")) -> DataFrame:
    """Counters that only grow; on a stream, write them in ``complete`` or ``update`` mode."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def run_counts(
    ingested: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = ("topic", "status"),
    trigger: dict[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep the running counts of a stream: each batch writes the counters that it has
    raised, under its id, and ``latest_counts`` reads the newest of each."""
    log = counter_log(path, by)
    counts = running_counts(ingested, by).select(*(F.col(name).cast("string").alias(name) for name in by), "n")
    return _start(counts, lambda batch, batch_id: keep(log, batch, batch_id), checkpoint, trigger, "update")


def latest_counts(spark: SparkSession, path: str, by: Sequence[str] = ("topic", "status")) -> DataFrame:
    """The counters as they stand after the newest batch."""
    return counter_log(path, by).newest(spark)


def run_durations(
    ingested: DataFrame,
    path: str,
    checkpoint: str,
    col: str,
    bounds: Sequence[float],
    trigger: dict[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep the histogram per topic of the time in the handler, over batches and restarts:
    its counts, sum and buckets are the state of the stream, and each batch writes those of
    the topics it has seen. ``latest_durations`` reads them."""
    log = histogram_log(path, bounds)
    return _start(
        process_duration(ingested, col, bounds),
        lambda batch, batch_id: keep(log, batch, batch_id),
        checkpoint,
        trigger,
        "update",
    )


def latest_durations(spark: SparkSession, path: str, bounds: Sequence[float]) -> DataFrame:
    return histogram_log(path, bounds).newest(spark)


def _start(
    df: DataFrame, on_batch: Subscriber, checkpoint: str, trigger: dict[str, object], mode: str = "append"
) -> StreamingQuery:
    def tidied(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            on_batch(batch, batch_id)

    writer = df.writeStream.outputMode(mode).foreachBatch(tidied)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
