"""One query per step of the toolkit, over the tables derived from ``events``.

Every query reads the whole of its tables. The output columns are primitive:
maps as JSON text, bytes as hex, header lists as text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from culvert import schemas
from culvert.functions.headers import fields_to_headers, headers_to_fields
from culvert.functions.patterns import extract_fields
from culvert.functions.payload import Codec, decode_payload, encode_payload, message
from culvert.operators import ingest as i
from culvert.operators import metrics as m
from culvert.operators import offsets as o
from culvert.operators import routing as r
from culvert.operators.bridge import bridge
from culvert.operators.rules import route_by_table
from culvert.plans import tables as t
from culvert.session import work_dir, written_once
from culvert.sources import files
from culvert.sources.delivery import FileSend
from culvert.sources.records import ParquetLog, read_records, stream_records, subscribed, write_records
from culvert.streaming import jobs
from culvert.streaming.changes import histogram_log, position_log

Query = Callable[[SparkSession, str], DataFrame]

BOUNDS = m.BOUNDS
CLIENT = "main"
DLQ_TOPIC = "app.dlq"
AS_OF = "2026-01-02T03:04:05Z"


def hex_of(column: str | Column) -> Column:
    return F.hex(column)


def map_text(column: str) -> Column:
    return F.expr(f"to_json(map_from_entries(array_sort(map_entries({column}))))")


def headers_text(column: str) -> Column:
    shown = f"transform({column}, h -> concat(h.key, '=', coalesce(hex(h.value), 'null')))"
    return F.expr(f"concat_ws('|', {shown})")


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.records_without_offset(t.events(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.records(t.events(spark, sf_dir))


def _bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.bus_events(t.events(spark, sf_dir))


def _ingested(records: DataFrame) -> DataFrame:
    return i.ingest(records, t.SUBSCRIPTIONS, t.handler)


# Sources and positions.


def scan_subscribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = subscribed(_plain(spark, sf_dir), ["app.click", "app.view", "app.click"])
    return picked.select("event_id", "topic", F.col("partition").alias("part"), hex_of("value").alias("value_hex"))


def log_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written to a log laid out by topic, of which some topics are read back."""
    log = ParquetLog(work_dir(spark, "log"), schemas.OUTBOUND, by_topic=True)
    write_records(r.to_outbound(r.route(_bus(spark, sf_dir), t.MAPPINGS, "ignore")), log)
    return read_records(spark, log, ["shop.purchases", "meters", "nobody"]).select(
        "topic", hex_of("key").alias("key_hex"), hex_of("value").alias("value_hex"), headers_text("headers").alias("headers_text")
    )


def _resumed(start: str, watermarks: Callable[[DataFrame], DataFrame] = t.high_watermarks) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = t.events(spark, sf_dir)
        sizes = written_once(t.partition_sizes(events), "sizes")
        resumed = o.resume_from(t.records(events), t.committed(sizes), watermarks(sizes), start)
        return resumed.select("event_id", "topic", F.col("partition").alias("part"), F.col("offset").alias("off"))

    return query


def _positions(commit: str, dlq: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ingested = _ingested(_records(spark, sf_dir))
        positions = o.committed_positions(ingested, i.commit_eligible(dlq), commit)
        return positions.select("topic", F.col("partition").alias("part"), "next_offset")

    return query


# Ingest.


def subscription_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = i.with_subscription(_plain(spark, sf_dir), t.SUBSCRIPTIONS)
    return found.select("event_id", "topic", "sub_ord", "status", "error")


def key_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.decode_key(_plain(spark, sf_dir)).select(
        "event_id", "key_text", F.col("key_text").isNull().alias("no_key"), F.length("key_text").alias("key_length")
    )


def headers_to_fields_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers_to_fields(_plain(spark, sf_dir)).select(
        "event_id", map_text("fields").alias("fields_text"), headers_text("headers").alias("headers_text")
    )


def trace_header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = headers_to_fields(_plain(spark, sf_dir))
    return fields.select(
        "event_id",
        F.size("headers").alias("n_headers"),
        F.size("fields").alias("n_fields"),
        F.map_contains_key("fields", "traceparent").alias("has_trace"),
    )


def _decoded(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        msg = F.col("msg")
        return decode_payload(_plain(spark, sf_dir), fmt).select(
            "event_id",
            "decode_failed",
            msg["kind"].alias("kind"),
            F.to_json(msg["json"]).alias("json_text"),
            F.try_variant_get(msg["json"], "$.k", "double").alias("k"),
            msg["text"].alias("text"),
            hex_of(msg["raw"]).alias("raw_hex"),
        )

    return query


def decode_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_payload(_plain(spark, sf_dir), "json")
    return decoded.groupBy("topic").agg(
        F.count("*").alias("n"),
        F.count_if("decode_failed").alias("n_failed"),
        F.count_if(F.col("msg.kind") == "bytes").alias("n_raw"),
    )


def _encoded(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        encoded = encode_payload(_bus(spark, sf_dir), fmt)
        return encoded.select("event_id", hex_of("value").alias("value_hex"), "status", "error")

    return query


# A user's own format: upper-case text between angle brackets; anything else does not decode.
ANGLED = Codec(
    "angled",
    decode=lambda value: F.when(value.cast("string").startswith("{"), message("string", text=F.upper(value.cast("string")))),
    encode=lambda msg: (
        F.concat(F.lit("<"), F.coalesce(msg["text"], F.to_json(msg["json"])), F.lit(">")).cast("binary"),
        F.when(msg["kind"] == "bytes", "angled format takes no bytes"),
    ),
)


def custom_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_payload(_plain(spark, sf_dir), ANGLED)
    encoded = encode_payload(decoded.select("event_id", "decode_failed", "msg"), ANGLED)
    return encoded.select(
        "event_id", "decode_failed", F.col("msg.kind").alias("kind"), hex_of("value").alias("value_hex"), "status", "error"
    )


def _resolve(records: DataFrame, subs: list[i.Subscription]) -> DataFrame:
    df = decode_payload(headers_to_fields(i.decode_key(records)))
    return i.resolve_topics(i.with_subscription(df, subs), subs)


def resolve_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolve(_plain(spark, sf_dir), t.SUBSCRIPTIONS).select("event_id", "topic", "bus_topic", "status")


def resolve_topic_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    def by_visitor(topic: Column, key: Column, fields: Column, msg: Column) -> tuple[Column, Column]:
        return F.concat_ws("/", F.lit("visitor"), key, topic), F.when(F.length(key) == 0, "empty key")

    subs = [
        i.Subscription("app.view", column=by_visitor),
        i.Subscription("app.click", column=F.concat(F.lit("click/"), F.col("partition").cast("string"))),
        i.Subscription("app.error", column=lambda topic, key, fields, msg: F.concat(F.lit("error/"), fields["region"])),
    ]
    return _resolve(_plain(spark, sf_dir), subs).select("event_id", "bus_topic", "status", "error")


def resolve_topic_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = _resolve(_plain(spark, sf_dir), t.SUBSCRIPTIONS)
    return resolved.filter(F.col("status") == "topic_error").groupBy("topic", "error").agg(F.count("*").alias("n"))


def deliver_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(_plain(spark, sf_dir)).select("event_id", "topic", "bus_topic", "status", "error")


def outcome_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingested = _ingested(_plain(spark, sf_dir))
    return (
        i.with_outcome(ingested)
        .withColumnRenamed("outcome", "outcome_dlq")
        .transform(lambda df: i.with_outcome(df, dlq=False))
        .groupBy("topic", "outcome_dlq", "outcome")
        .agg(F.count("*").alias("n"))
    )


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(AS_OF).cast("timestamp")
    dead = i.build_dlq(_ingested(_plain(spark, sf_dir)), DLQ_TOPIC, as_of=as_of, keep=["event_id"])
    return dead.select(
        "event_id",
        "topic",
        hex_of("key").alias("key_hex"),
        hex_of("value").alias("value_hex"),
        headers_text("headers").alias("headers_text"),
    )


# Routing.


def _routed(mappings: list[r.TopicMapping], default: str = "error") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return r.route(_bus(spark, sf_dir), mappings, default).select(
            "event_id", "topic", "mapping_ord", "kafka_topic", hex_of("key").alias("key_hex"), "status", "error"
        )

    return query


def route_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.col("topic")
    return (
        _bus(spark, sf_dir)
        .withColumn("device", extract_fields("meter/+meterId/level", topic))
        .withColumn("purchase", extract_fields("shop/+region/#rest", topic))
        .select("event_id", map_text("device").alias("device_text"), map_text("purchase").alias("purchase_text"))
    )


def route_field_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = r.merged_fields(_bus(spark, sf_dir), "meter/+meterId/level")
    return merged.select("event_id", map_text("merged_fields").alias("merged_text"), map_text("fields").alias("fields_text"))


def fields_to_headers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields_to_headers(_bus(spark, sf_dir)).select("event_id", headers_text("headers").alias("headers_text"))


def _outbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = r.route(_bus(spark, sf_dir), t.MAPPINGS, "slash_to_dot")
    return r.to_outbound(routed, keep=["event_id", "duration_s"])


def produced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outbound(spark, sf_dir).select(
        "event_id",
        "topic",
        hex_of("key").alias("key_hex"),
        hex_of("value").alias("value_hex"),
        headers_text("headers").alias("headers_text"),
    )


def route_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_table(_bus(spark, sf_dir), t.rules_of(spark, t.MAPPINGS), "slash_to_dot")
    return routed.select("event_id", "topic", "mapping_ord", "kafka_topic", "status")


def route_rule_table_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.events(spark, sf_dir)
    # The rules are read several times, so they are derived once.
    path = work_dir(spark, "rules")
    t.user_rules(events).write.parquet(path)
    routed = route_by_table(t.bus_events(events), spark.read.parquet(path))
    return routed.select("event_id", "topic", "mapping_ord", "kafka_topic", "status", "error")


PRODUCERS = {"meters": t.MAPPINGS[:2], "shop": [t.MAPPINGS[2]], "audit": [r.TopicMapping("#", "audit")]}


def route_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.route_many(_bus(spark, sf_dir), PRODUCERS).select(
        "event_id", "producer", "kafka_topic", hex_of("key").alias("key_hex"), "status"
    )


# Metrics.


def m_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.consumed_messages(_ingested(_plain(spark, sf_dir)))


def m_consumer_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.consumer_errors(_ingested(_plain(spark, sf_dir)))


def _rounded(histogram: DataFrame) -> DataFrame:
    return histogram.withColumn("total", F.round("total", 6))


def m_process_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(m.process_duration(_ingested(_plain(spark, sf_dir)), "duration_s", BOUNDS))


def _lag(watermarks: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = t.events(spark, sf_dir)
        lag = o.consumer_lag(t.records(events), watermarks(t.partition_sizes(events)))
        return lag.select("topic", F.col("partition").alias("part"), "lag")

    return query


def m_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingested = _ingested(_plain(spark, sf_dir))
    return m.commit_count(ingested, "batch_id", i.commit_eligible(dlq=False))


def m_commits_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    ingested = _ingested(_plain(spark, sf_dir))
    return m.commit_count(ingested, "batch_id", i.commit_eligible(dlq=True))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.write_results(_outbound(spark, sf_dir))


def m_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.sent_messages(_results(spark, sf_dir))


def m_producer_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.producer_errors(_results(spark, sf_dir))


def m_produce_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(m.produce_duration(_results(spark, sf_dir), "duration_s", BOUNDS))


def m_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = m.with_metric_attrs(m_sent(spark, sf_dir), CLIENT, topic=F.col("topic"), sends=True)
    return sent.select("n", map_text("attributes").alias("attributes_text"))


def m_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.events(spark, sf_dir)
    report = m.metrics_report(
        _ingested(t.records(events)),
        t.high_watermarks(t.partition_sizes(events)),
        _results(spark, sf_dir),
        "batch_id",
        i.commit_eligible(dlq=False),
        CLIENT,
    )
    value = F.when(F.col("measure") == "sum", F.round("value", 6)).otherwise(F.col("value"))
    return report.select(
        "name", "unit", map_text("attributes").alias("attributes_text"), "measure", value.alias("value")
    )


# Texts as payloads: quotes, line ends, brackets and several languages.


def decode_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.texts(spark, sf_dir).withColumn("value", F.col("text").cast("binary"))
    msg = F.col("msg")
    return decode_payload(records).select(
        "src", "id", msg["kind"].alias("kind"), F.md5(msg["text"].cast("binary")).alias("text_md5"), "decode_failed"
    )


def encode_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text encoded as JSON, and decoded again."""
    events = t.texts(spark, sf_dir).withColumn("msg", message("string", text=F.col("text")))
    encoded = encode_payload(events, "json").drop("msg")
    again = decode_payload(encoded, "json")
    return again.select(
        "src",
        "id",
        F.md5("value").alias("value_md5"),
        F.col("msg.kind").alias("kind"),
        F.md5(F.col("msg.text").cast("binary")).alias("text_md5"),
    )


# What becomes of produced events.


def _produced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.produce(r.route(_bus(spark, sf_dir), t.MAPPINGS_ALL), "bytes")


def produce_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _produced(spark, sf_dir).select(
        "event_id",
        "kafka_topic",
        hex_of("key").alias("key_hex"),
        hex_of("value").alias("value_hex"),
        headers_text("headers").alias("headers_text"),
        "status",
        "error",
    )


def route_rule_table_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_table(_bus(spark, sf_dir), t.rules_of(spark, t.MAPPINGS), "slash_to_dot")
    return routed.select(
        "event_id", "topic", "mapping_ord", "kafka_topic", hex_of("key").alias("key_hex"), "status", "error"
    )


def route_rule_table_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules in more shapes than are looked up one by one: matched by joins."""
    events = t.events(spark, sf_dir)
    routed = route_by_table(t.bus_events(events), t.shaped_user_rules(events), "ignore")
    return routed.select("event_id", "topic", "mapping_ord", "kafka_topic", hex_of("key").alias("key_hex"), "status")


def route_rule_table_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules, matched by walking down the trie of their levels."""
    events = t.events(spark, sf_dir)
    routed = route_by_table(t.bus_events(events), t.shaped_user_rules(events), "ignore", max_lookups=0, max_masks=0)
    return routed.select("event_id", "topic", "mapping_ord", "kafka_topic", hex_of("key").alias("key_hex"), "status")


# Streams: each runs over the files there are, and its result is read back.


def stream_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "ingest")
    delivered, dead, report = (ParquetLog(f"{base}/{name}") for name in ("delivered", "dead", "report"))
    jobs.run_ingest(
        t.records_without_offset(t.event_stream(spark, sf_dir)),
        t.SUBSCRIPTIONS,
        lambda batch, batch_id: delivered.write(batch.select("event_id", "bus_topic", "msg", "fields"), batch_id),
        f"{base}/checkpoint",
        t.handler,
        dlq=dead,
        dlq_topic=DLQ_TOPIC,
        report=lambda batch, batch_id: report.write(jobs.running_counts(batch), batch_id),
    ).awaitTermination()
    counts = report.read(spark).select("topic", "status", F.lit("record").alias("what"), "n")
    events = _count(delivered.read(spark), F.substring_index("bus_topic", "/", 1), "event")
    letters = _count(dead.read(spark), F.col("topic"), "dead letter")
    return counts.unionByName(events).unionByName(letters).groupBy("what", "topic", "status").agg(F.sum("n").alias("n"))


def _count(df: DataFrame, topic: Column, what: str) -> DataFrame:
    return df.groupBy(topic.alias("topic")).agg(F.count("*").alias("n")).select(
        "topic", F.lit(None).cast("string").alias("status"), F.lit(what).alias("what"), "n"
    )


def stream_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "produce")
    target = ParquetLog(f"{base}/outbound")
    jobs.run_produce(
        t.bus_events(t.event_stream(spark, sf_dir)), t.MAPPINGS, target, f"{base}/checkpoint", "slash_to_dot"
    ).awaitTermination()
    return target.read(spark).groupBy("topic").agg(
        F.count("*").alias("n"), F.count("key").alias("n_keys"), F.sum(F.size("headers")).alias("n_headers")
    )


def stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "counts")
    ingested = _ingested(t.records_without_offset(t.event_stream(spark, sf_dir)))
    jobs.run_counts(ingested, f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return jobs.latest_counts(spark, f"{base}/counts").select("topic", "status", "n")


def stream_produce_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent and events failed by a running job, row by row."""
    base = work_dir(spark, "failures")
    target, lost = ParquetLog(f"{base}/outbound"), ParquetLog(f"{base}/failed")
    jobs.run_produce(
        t.bus_events(t.event_stream(spark, sf_dir)),
        t.MAPPINGS_ALL,
        target,
        f"{base}/checkpoint",
        fmt="bytes",
        failures=lambda batch, batch_id: lost.write(batch.select("event_id", "topic", "status", "error"), batch_id),
    ).awaitTermination()
    nothing = F.lit(None).cast("string")
    out = target.read(spark).select(
        nothing.cast("long").alias("event_id"), "topic", F.lit("ok").alias("status"), nothing.alias("error"),
        hex_of("key").alias("key_hex"), hex_of("value").alias("value_hex"),
    )
    failed = lost.read(spark).select(
        "event_id", "topic", "status", "error", nothing.alias("key_hex"), nothing.alias("value_hex")
    )
    return out.unionByName(failed)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job reports of its batches, summed over them."""
    base = work_dir(spark, "progress")
    sink = ParquetLog(f"{base}/delivered")
    query = jobs.run_ingest(
        t.records_without_offset(t.event_stream(spark, sf_dir)),
        t.SUBSCRIPTIONS,
        lambda batch, batch_id: sink.write(batch.select("event_id"), batch_id),
        f"{base}/checkpoint",
        t.handler,
    )
    query.awaitTermination()
    seen = [p.observedMetrics["ingest"].asDict() for p in query.recentProgress if "ingest" in p.observedMetrics]
    names = ("polled", "delivered", "failed", "undecoded")
    totals = [(name, sum(row[name] for row in seen)) for name in names]
    return spark.createDataFrame(totals, "what string, n long")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that is started again on its checkpoint handles no record twice."""
    base = work_dir(spark, "restart")
    target = ParquetLog(f"{base}/outbound")
    for _ in range(2):
        jobs.run_produce(
            t.bus_events(t.event_stream(spark, sf_dir)), t.MAPPINGS, target, f"{base}/checkpoint", "slash_to_dot"
        ).awaitTermination()
    return target.read(spark).select(
        "topic", hex_of("key").alias("key_hex"), hex_of("value").alias("value_hex"), headers_text("headers").alias("headers_text")
    )


def replay_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Forget that the newest batch was done, as a crash before the commit would."""
    done = max(int(name) for name in files.children(spark, f"{checkpoint}/commits") if name.isdigit())
    for name in (f"{done}", f".{done}.crc"):
        files.remove(spark, f"{checkpoint}/commits/{name}")


def _polled(spark: SparkSession, log: ParquetLog) -> DataFrame:
    return stream_records(spark, log, t.TOPICS, "earliest")


def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed positions and the number of commits of a running job; its last batch is
    handled twice, and the changes are folded in between."""
    base = work_dir(spark, "positions")
    log, positions = t.poll_log(spark, sf_dir, f"{base}/log"), position_log(f"{base}/positions")

    def run() -> None:
        jobs.run_ingest(
            _polled(spark, log), t.SUBSCRIPTIONS, lambda batch, batch_id: None, f"{base}/checkpoint", t.handler, positions=positions
        ).awaitTermination()

    run()
    replay_last_batch(spark, f"{base}/checkpoint")
    run()
    positions.compact(spark)
    replay_last_batch(spark, f"{base}/checkpoint")
    run()
    newest = positions.newest(spark).select("topic", F.col("partition").alias("part"), F.col("next_offset").alias("n"))
    commits = positions.batches(spark).select(F.lit("commits").alias("topic"), F.lit(None).cast("int").alias("part"), "n")
    return newest.unionByName(commits)


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag after each poll of a running job."""
    base = work_dir(spark, "lag")
    log, told = t.poll_log(spark, sf_dir, f"{base}/log"), ParquetLog(f"{base}/lag")
    ends = written_once(t.high_watermarks(t.partition_sizes(t.events(spark, sf_dir))), "ends")
    jobs.run_ingest(
        _polled(spark, log),
        t.SUBSCRIPTIONS,
        lambda batch, batch_id: None,
        f"{base}/checkpoint",
        t.handler,
        watermarks=lambda batch_id: ends,
        lag=lambda lag, batch_id: told.write(lag, batch_id),
    ).awaitTermination()
    return told.read(spark).select(F.col("batch_id").cast("long").alias("poll"), "topic", F.col("partition").alias("part"), "lag")


def stream_dlq_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of a job whose dead-letter sink takes none of partition 1, and the dead
    letters it took."""
    base = work_dir(spark, "refused")
    log, positions = t.poll_log(spark, sf_dir, f"{base}/log"), position_log(f"{base}/positions")
    sink = FileSend(f"{base}/dead", ("topic", "key", "value"), t.in_partition_1, "sink down")
    jobs.run_ingest(
        _polled(spark, log),
        t.SUBSCRIPTIONS,
        lambda batch, batch_id: None,
        f"{base}/checkpoint",
        t.handler,
        dlq=sink,
        dlq_topic=DLQ_TOPIC,
        positions=positions,
    ).awaitTermination()
    taken = spark.read.schema("topic string, key binary, value binary").parquet(f"{base}/dead")
    letters = taken.groupBy("topic").agg(F.count("*").alias("n")).select("topic", F.lit(None).cast("int").alias("part"), "n")
    newest = positions.newest(spark).select("topic", F.col("partition").alias("part"), F.col("next_offset").alias("n"))
    return newest.unionByName(letters)


def stream_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent records, errors and timed sends per topic as the sender answered, and the records
    that arrived."""
    base = work_dir(spark, "sent")
    told = ParquetLog(f"{base}/results")
    jobs.run_produce(
        t.bus_events(t.event_stream(spark, sf_dir)),
        t.MAPPINGS,
        FileSend(f"{base}/arrived", ("topic", "key"), t.key_ends_in_7, "broker down"),
        f"{base}/checkpoint",
        "slash_to_dot",
        results=lambda said, batch_id: told.write(said, batch_id),
    ).awaitTermination()
    results = told.read(spark)
    durations = m.produce_duration(results, "duration_s", BOUNDS)
    arrived = spark.read.schema("topic string, key binary").parquet(f"{base}/arrived")
    counts = {
        "sent": m.sent_messages(results),
        "errors": m.producer_errors(results),
        "timed": durations.filter("shortest >= 0").select("topic", "n"),
        "arrived": arrived.groupBy("topic").agg(F.count("*").alias("n")),
    }
    named = [df.select(F.lit(what).alias("what"), "topic", "n") for what, df in counts.items()]
    return functools.reduce(DataFrame.unionByName, named)


def stream_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram that a job keeps over polls and a restart."""
    base = work_dir(spark, "durations")
    for polls in (slice(0, 2), slice(2, None)):
        log = t.poll_log(spark, sf_dir, f"{base}/log", polls)
        ingested = _ingested(_polled(spark, log))
        jobs.run_durations(ingested, f"{base}/histogram", f"{base}/checkpoint", "duration_s", BOUNDS).awaitTermination()
        histogram_log(f"{base}/histogram", BOUNDS).compact(spark)
    return _rounded(jobs.latest_durations(spark, f"{base}/histogram", BOUNDS))


def stream_python_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses and errors where the handler is plain Python that raises."""
    base = work_dir(spark, "python")
    report = ParquetLog(f"{base}/report")
    jobs.run_ingest(
        t.records_without_offset(t.event_stream(spark, sf_dir)),
        t.SUBSCRIPTIONS,
        lambda batch, batch_id: None,
        f"{base}/checkpoint",
        i.python_handler(t.k_in_range),
        report=lambda batch, batch_id: report.write(batch.select("event_id", "status", "error"), batch_id),
    ).awaitTermination()
    return report.read(spark).select("event_id", "status", "error")


def resume_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to read of each partition, from the stored position to the end."""
    sizes = written_once(t.partition_sizes(t.events(spark, sf_dir)), "sizes")
    ranges = o.offset_range(t.committed(sizes), t.high_watermarks(sizes))
    return ranges.select("topic", F.col("partition").alias("part"), "first", "end")


def resume_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records behind the positions, out of a log of files whose row groups in front of
    them are skipped."""
    events = t.events(spark, sf_dir)
    log = ParquetLog(work_dir(spark, "resume"), t.records(events).schema, in_order=("topic", "partition", "offset"))
    write_records(t.records(events), log)
    sizes = written_once(t.partition_sizes(events), "sizes")
    records = read_records(spark, log, t.TOPICS)
    resumed = o.resume_from(records, t.committed(sizes), t.high_watermarks(sizes), "earliest")
    return resumed.select("event_id", "topic", F.col("partition").alias("part"), F.col("offset").alias("off"))


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job behind a log has read of it, when the last batch of the job in front was
    replayed after that."""
    base = work_dir(spark, "replayed")
    log = ParquetLog(f"{base}/log", schemas.OUTBOUND, once=True)
    seen = ParquetLog(f"{base}/seen")

    def downstream() -> None:
        stream = stream_records(spark, log, ["shop.purchases", "meters", "nobody"])
        jobs.run_each(stream, lambda batch, batch_id: seen.write(batch, batch_id), f"{base}/behind").awaitTermination()

    for attempt in range(2):
        if attempt:
            replay_last_batch(spark, f"{base}/checkpoint")
        jobs.run_produce(
            t.bus_events(t.event_stream(spark, sf_dir)), t.MAPPINGS, log, f"{base}/checkpoint", "slash_to_dot", order="event_id"
        ).awaitTermination()
        downstream()
    return seen.read(spark).select(
        "topic", hex_of("key").alias("key_hex"), hex_of("value").alias("value_hex"), headers_text("headers").alias("headers_text")
    )


def stream_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent on and dead letters of both directions, row by row; a dead letter's time is left out."""
    base = work_dir(spark, "bridge")
    target, dead = ParquetLog(f"{base}/outbound"), ParquetLog(f"{base}/dead")
    jobs.run_bridge(
        t.records_without_offset(t.event_stream(spark, sf_dir)),
        t.SUBSCRIPTIONS,
        t.BRIDGE_MAPPINGS,
        target,
        f"{base}/checkpoint",
        t.handler,
        dlq=dead,
        dlq_topic=DLQ_TOPIC,
    ).awaitTermination()
    untimed = F.filter("headers", lambda h: h["key"] != "dlq-timestamp").alias("headers")
    letters = dead.read(spark).select("topic", "key", "value", untimed)
    return target.read(spark).select("topic", "key", "value", "headers").union(letters).select(
        "topic", hex_of("key").alias("key_hex"), hex_of("value").alias("value_hex"), headers_text("headers").alias("headers_text")
    )


def bridge_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.produce(bridge(_plain(spark, sf_dir), t.SUBSCRIPTIONS, t.BRIDGE_MAPPINGS, t.handler, keep=["event_id"]))
    dead = i.build_dlq(rows, DLQ_TOPIC, as_of=F.lit(AS_OF).cast("timestamp"), keep=["event_id"])
    return dead.select(
        "event_id",
        "topic",
        hex_of("key").alias("key_hex"),
        hex_of("value").alias("value_hex"),
        headers_text("headers").alias("headers_text"),
    )


def bridge_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bridge(_records(spark, sf_dir), t.SUBSCRIPTIONS, t.BRIDGE_MAPPINGS, t.handler)
    positions = o.committed_positions(rows, i.commit_eligible(dlq=False))
    return positions.select("topic", F.col("partition").alias("part"), "next_offset")


def _bridged(records: DataFrame) -> DataFrame:
    return bridge(
        records, t.SUBSCRIPTIONS, t.BRIDGE_MAPPINGS, t.handler, "slash_to_dot", keep=["event_id"]
    )


def bridge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridged = _bridged(_plain(spark, sf_dir))
    return bridged.groupBy("source_topic", "kafka_topic", "status").agg(F.count("*").alias("n"), F.count("key").alias("n_keys"))


def bridge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.to_outbound(_bridged(_plain(spark, sf_dir)), keep=["event_id"]).select(
        "event_id",
        "topic",
        hex_of("key").alias("key_hex"),
        hex_of("value").alias("value_hex"),
        headers_text("headers").alias("headers_text"),
    )


QUERIES: dict[str, Query] = {
    "scan_subscribed": scan_subscribed,
    "log_round_trip": log_round_trip,
    "resume_stored": _resumed("stored"),
    "resume_earliest": _resumed("earliest"),
    "resume_latest": _resumed("latest"),
    "resume_new_partition": _resumed("latest", t.early_watermarks),
    "resume_range": resume_range,
    "resume_log": resume_log,
    "committed_positions": _positions("after_process", dlq=False),
    "committed_positions_dlq": _positions("after_process", dlq=True),
    "committed_positions_periodic": _positions("periodic", dlq=False),
    "subscription_lookup": subscription_lookup,
    "key_decode": key_decode,
    "headers_to_fields": headers_to_fields_query,
    "trace_header_filter": trace_header_filter,
    "decode_auto": _decoded("auto"),
    "decode_json": _decoded("json"),
    "decode_string": _decoded("string"),
    "decode_bytes": _decoded("bytes"),
    "decode_failures": decode_failures,
    "encode_auto": _encoded("auto"),
    "encode_json": _encoded("json"),
    "encode_string": _encoded("string"),
    "encode_bytes": _encoded("bytes"),
    "custom_codec": custom_codec,
    "resolve_topic": resolve_topic,
    "resolve_topic_custom": resolve_topic_custom,
    "resolve_topic_errors": resolve_topic_errors,
    "deliver_status": deliver_status,
    "outcome_split": outcome_split,
    "dlq_records": dlq_records,
    "route_exact": _routed(t.MAPPINGS_ALERTS),
    "route_plus": _routed([t.MAPPINGS[2], t.MAPPINGS[3]], "ignore"),
    "route_hash": _routed([t.MAPPINGS[1]], "ignore"),
    "route_reserved": _routed(t.MAPPINGS_SYS),
    "route_capture": route_capture,
    "route_first_match": _routed(t.MAPPINGS, "slash_to_dot"),
    "route_field_merge": route_field_merge,
    "route_key": _routed([t.MAPPINGS[0], t.MAPPINGS[2], r.TopicMapping("gate/#", "gates", "fields.region")], "ignore"),
    "route_key_error": _routed(t.MAPPINGS_KEYERR),
    "fallback_error": _routed(t.MAPPINGS),
    "fallback_slash_to_dot": _routed(t.MAPPINGS[4:], "slash_to_dot"),
    "fallback_ignore": _routed(t.MAPPINGS, "ignore"),
    "route_empty_target": _routed(t.MAPPINGS_OPS),
    "fields_to_headers": fields_to_headers_query,
    "produced_records": produced_records,
    "route_rule_table": route_rule_table,
    "route_rule_table_by_user": route_rule_table_by_user,
    "route_rule_table_keyed": route_rule_table_keyed,
    "route_rule_table_shapes": route_rule_table_shapes,
    "route_rule_table_trie": route_rule_table_trie,
    "route_many": route_many,
    "produce_outcomes": produce_outcomes,
    "decode_texts": decode_texts,
    "encode_texts": encode_texts,
    "m_consumed": m_consumed,
    "m_consumer_errors": m_consumer_errors,
    "m_process_duration": m_process_duration,
    "m_lag": _lag(t.high_watermarks),
    "m_lag_stale": _lag(t.early_watermarks),
    "m_commits": m_commits,
    "m_commits_dlq": m_commits_dlq,
    "m_sent": m_sent,
    "m_producer_errors": m_producer_errors,
    "m_produce_duration": m_produce_duration,
    "m_attrs": m_attrs,
    "m_report": m_report,
    "stream_ingest_counts": stream_ingest_counts,
    "stream_route_counts": stream_route_counts,
    "stream_running_counts": stream_running_counts,
    "stream_produce_failures": stream_produce_failures,
    "stream_progress": stream_progress,
    "stream_restart": stream_restart,
    "stream_bridge": stream_bridge,
    "stream_positions": stream_positions,
    "stream_lag": stream_lag,
    "stream_dlq_refused": stream_dlq_refused,
    "stream_sent": stream_sent,
    "stream_durations": stream_durations,
    "stream_python_handler": stream_python_handler,
    "stream_replayed": stream_replayed,
    "bridge_dlq": bridge_dlq,
    "bridge_positions": bridge_positions,
    "bridge_counts": bridge_counts,
    "bridge_records": bridge_records,
}
