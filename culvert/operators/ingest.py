"""Ingest of records as bus events: subscription, topic resolution, delivery, dead letters.

Each step sets ``status`` and ``error`` only where no earlier step has failed,
so the first failing stage explains the row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from culvert import schemas
from culvert.functions.headers import headers_to_fields
from culvert.functions.payload import Codec, decode_payload
from culvert.functions.results import Fallible, case, computed_once, quoted, value_and_error
from culvert.functions.templates import render

# A record's own columns, and what ingest finds out about it.
SOURCE = ("topic", "partition", "offset", "key", "value", "headers")
OUTCOME = ("bus_topic", "status", "error")

TopicResolver = Callable[[Column, Column, Column, Column], Fallible]
Handler = Callable[[Column, Column, Column], Column]


@dataclass(frozen=True)
class Subscription:
    """One Kafka topic, by exact name, and how its records get their bus topic.

    Give exactly one of ``static`` (a fixed topic), ``template`` (text with
    references) and ``column`` (a Column, or a function of the Kafka topic, the
    key text, the fields and the message). A null topic is a failure.
    """

    topic: str
    static: str | None = None
    template: str | None = None
    column: Column | TopicResolver | None = None

    def __post_init__(self) -> None:
        if sum(given is not None for given in (self.static, self.template, self.column)) != 1:
            raise ValueError(f"give one of static, template and column for {self.topic!r}")

    def resolve(self) -> tuple[Column, Column]:
        topic, key, fields, msg = (F.col(c) for c in ("topic", "key_text", "fields", "msg"))
        if self.static is not None:
            result: Fallible = F.lit(self.static)
        elif self.template is not None:
            result = render(self.template, topic, key, fields, msg)
        elif isinstance(self.column, Column):
            result = self.column
        else:
            result = self.column(topic, key, fields, msg)
        value, error = value_and_error(result)
        return value.cast("string"), error


def python_handler(fn: Callable[[str, object, dict[str, str]], str | None]) -> Handler:
    """A handler in plain Python: ``fn(bus topic, message, fields)`` gives an error text or
    None. It is called for the rows that have come so far without failing, and for no
    others; what it raises is the error of that row. Rows come in Arrow batches.

    The message is what the payload decoded to: a parsed JSON value, text, bytes or None.
    """

    @F.pandas_udf("string")
    def outcome(
        topic: pd.Series, kind: pd.Series, parsed: pd.Series, text: pd.Series, raw: pd.Series, fields: pd.Series
    ) -> pd.Series:
        errors: list[str | None] = [None] * len(topic)
        for i in topic.notna().to_numpy().nonzero()[0].tolist():
            try:
                given = {"json": parsed, "string": text, "bytes": raw}.get(kind[i])
                message = None if given is None else given[i]
                if kind[i] == "json":
                    message = json.loads(message)
                error = fn(topic[i], message, dict(fields[i] if fields[i] is not None else {}))
                errors[i] = None if error is None else str(error)
            except Exception as e:
                errors[i] = str(e) or type(e).__name__
        return pd.Series(errors, dtype=object)

    return lambda bus_topic, msg, fields: outcome(
        bus_topic, msg["kind"], F.to_json(msg["json"]), msg["text"], msg["raw"], fields
    )


def decode_key(df: DataFrame) -> DataFrame:
    """Add ``key_text``: no key stays null, an empty key stays empty."""
    return df.withColumn("key_text", F.col("key").cast("string"))


def with_subscription(df: DataFrame, subs: Sequence[Subscription]) -> DataFrame:
    """Add ``sub_ord``, the first subscription of the row's topic, with ``status`` and ``error``."""
    return _with_status(_subscribe(df, subs))


def resolve_topics(df: DataFrame, subs: Sequence[Subscription], bus_name: str = "bus") -> DataFrame:
    """Add ``bus_topic``; a row whose topic cannot be resolved gets status ``topic_error``.

    ``topic_reason`` is the resolver's own account of a failure. ``bus_name`` is
    how the error text calls the bus.
    """
    return _with_status(_resolve(df, subs), bus_name)


def _subscribe(df: DataFrame, subs: Sequence[Subscription]) -> DataFrame:
    first: dict[str, int] = {}
    for i, sub in enumerate(subs):
        first.setdefault(sub.topic, i)
    topic = F.col("topic")
    found = case([(topic == name, F.lit(i)) for name, i in first.items()], F.lit(None).cast("int"))
    return df.withColumn("sub_ord", found)


def _resolve(df: DataFrame, subs: Sequence[Subscription]) -> DataFrame:
    ord_ = F.col("sub_ord")
    # A shadowed subscription is never looked up, so it needs no branch.
    used = {sub.topic: i for i, sub in reversed(list(enumerate(subs)))}
    resolved = {i: subs[i].resolve() for i in sorted(used.values())}
    nothing = F.lit(None).cast("string")
    df = df.withColumns({
        "bus_topic": case([(ord_ == i, topic) for i, (topic, _) in resolved.items()], nothing),
        "topic_reason": case([(ord_ == i, reason) for i, (_, reason) in resolved.items()], nothing),
    })
    return df.withColumn("bus_topic", F.when(F.col("topic_reason").isNull(), F.col("bus_topic")))


def _handle(df: DataFrame, handler: Handler) -> DataFrame:
    outcome = handler(F.col("bus_topic"), F.col("msg"), F.col("fields"))
    return df.withColumn("handler_error", F.when(F.col("bus_topic").isNotNull(), outcome))


def _with_status(df: DataFrame, bus_name: str = "bus") -> DataFrame:
    """Set ``status`` and ``error`` from the columns of the steps done so far, in their order."""
    topic = F.col("topic")
    # The error texts of a topic nobody subscribed to and of one that cannot be resolved.
    unknown = F.concat(F.lit("kafka consumer: no subscription found for topic "), quoted(topic))
    stages = [(F.col("sub_ord").isNull(), "no_subscription", unknown)]
    if "bus_topic" in df.columns:
        reason = F.coalesce("topic_reason", F.lit("unresolved reference"))
        unresolved = F.concat(
            F.lit(f"kafka consumer: resolve {bus_name} topic for "), quoted(topic), F.lit(": "), reason
        )
        stages.append((F.col("bus_topic").isNull(), "topic_error", unresolved))
    if "handler_error" in df.columns:
        stages.append((F.col("handler_error").isNotNull(), "handler_error", F.col("handler_error")))
    return df.withColumns({
        "status": case([(failed, F.lit(status)) for failed, status, _ in stages], F.lit("ok")),
        "error": case([(failed, text) for failed, _, text in stages], F.lit(None).cast("string")),
    })


def ingest(
    records: DataFrame,
    subs: Sequence[Subscription],
    handler: Handler | None = None,
    fmt: str | Codec = "auto",
    bus_name: str = "bus",
) -> DataFrame:
    """Records to ``ingested``: key, fields and payload decoded, topic resolved, delivered."""
    if not subs:
        raise ValueError("at least one subscription is needed")
    df = decode_payload(headers_to_fields(decode_key(records)), fmt)
    df = _resolve(_subscribe(df, subs), subs)
    if handler is not None:
        df = _handle(df, handler)
    return _with_status(df, bus_name).drop("sub_ord", "topic_reason", "handler_error")


def settled(ingested: DataFrame) -> DataFrame:
    """The same rows with the outcome computed at this point: a filter on it, made next,
    does not decode a payload a second time."""
    return computed_once(ingested, *(name for name in OUTCOME if name in ingested.columns))


def bus_events(ingested: DataFrame) -> DataFrame:
    """The delivered events: ``topic, msg, fields`` of the rows that are ``ok``."""
    delivered = settled(ingested).filter(F.col("status") == "ok")
    return delivered.select(F.col("bus_topic").alias("topic"), "msg", "fields")


class Outcomes(NamedTuple):
    ok: DataFrame
    dead: DataFrame
    dropped: DataFrame


def with_outcome(ingested: DataFrame, dlq: bool = True) -> DataFrame:
    """Add ``outcome``: ``success``, ``dead_letter`` or, without a dead-letter topic, ``dropped``."""
    failed = F.lit("dead_letter" if dlq else "dropped")
    return ingested.withColumn("outcome", F.when(F.col("status") == "ok", "success").otherwise(failed))


def split_outcomes(ingested: DataFrame, dlq: bool = True) -> Outcomes:
    """Rows that succeeded, that go to the dead-letter topic, and that are dropped.

    Each part reads ``ingested`` again: write several of them from a persisted
    batch, as ``run_ingest`` does.
    """
    with_all = with_outcome(settled(ingested), dlq)
    parts = (with_all.filter(F.col("outcome") == name).drop("outcome") for name in ("success", "dead_letter", "dropped"))
    return Outcomes(*parts)


def build_dlq(
    df: DataFrame,
    topic: str,
    header_prefix: str = "dlq-",
    as_of: datetime | Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Dead-letter records of the failed rows.

    Key, value and all headers stay as they came, in order; the error, the
    original topic and the time (``as_of``, or now) are appended as headers.
    Of bridged rows the record is taken from ``source``.
    """
    bridged = "source" in df.columns
    own = {name: F.col(f"source.{name}" if bridged else name) for name in ("topic", "key", "value", "headers")}
    if as_of is None:
        as_of = F.current_timestamp()
    moment = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    added = {
        "error": F.col("error"),
        "original-topic": own["topic"],
        "timestamp": F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    extra = F.array(*(
        F.struct(F.lit(header_prefix + name).alias("key"), value.cast("binary").alias("value"))
        for name, value in added.items()
    ))
    original = F.coalesce(own["headers"], F.array().cast(schemas.HEADERS))
    outcome = [name for name in ("status", "error") if name in df.columns]
    return computed_once(df, *outcome).filter(F.col("error").isNotNull()).select(
        *keep,
        F.lit(topic).alias("topic"),
        own["key"].alias("key"),
        own["value"].alias("value"),
        F.concat(original, extra).alias("headers"),
    )


def commit_eligible(dlq: bool = True, dlq_error: Column | None = None) -> Column:
    """Whether a row's position may be committed.

    True for a success, and for a failure whose dead letter was written. Without
    a dead-letter topic, or where ``dlq_error`` is set, a failure is not eligible.
    """
    ok = F.col("status") == "ok"
    if not dlq:
        return ok
    return ok | (F.lit(True) if dlq_error is None else dlq_error.isNull())
