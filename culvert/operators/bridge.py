"""Both directions under one client: records in, events routed, records out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from culvert.functions.payload import Codec
from culvert.operators.ingest import SOURCE, Handler, Subscription, ingest, settled
from culvert.operators.routing import TopicMapping, route


def bridge(
    records: DataFrame,
    subs: Sequence[Subscription],
    mappings: Sequence[TopicMapping],
    handler: Handler | None = None,
    default: str = "error",
    fmt: str | Codec = "auto",
    bus_name: str = "bus",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Ingest records and route the delivered events, one row per record.

    ``source_topic`` is the record's topic, ``topic`` the event's. ``status``
    and ``error`` tell the first stage that failed, of both directions;
    ``produce`` and ``to_outbound`` make the records to send of the rows that
    are ``ok``. ``source`` holds the record as it came, for ``build_dlq`` and
    ``committed_positions``.
    """
    ingested = settled(ingest(records, subs, handler, fmt, bus_name))
    source = [name for name in SOURCE if name in records.columns]
    events = ingested.select(
        *keep,
        F.struct(*source).alias("source"),
        F.col("topic").alias("source_topic"),
        F.when(F.col("status") == "ok", F.col("bus_topic")).alias("topic"),
        "msg",
        "fields",
        F.col("status").alias("_status"),
        F.col("error").alias("_error"),
    )
    arrived = F.col("_status") == "ok"
    return (
        route(events, mappings, default)
        .withColumns({
            "status": F.when(arrived, F.col("status")).otherwise(F.col("_status")),
            "error": F.when(arrived, F.col("error")).otherwise(F.col("_error")),
        })
        .drop("_status", "_error")
    )
