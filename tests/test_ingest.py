"""Ingest step by step, dead letters, positions and metrics."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert import schemas
from culvert.operators import metrics
from culvert.operators.bridge import bridge
from culvert.operators.ingest import (
    Subscription,
    build_dlq,
    bus_events,
    commit_eligible,
    ingest,
    split_outcomes,
    with_outcome,
    with_subscription,
)
from culvert.operators.offsets import committed_positions, consumer_lag, resume_from
from culvert.operators.routing import TopicMapping


def record(topic="foo", key=None, value=b"{}", headers=None, partition=0, offset=0):
    def raw(data):
        return None if data is None else bytearray(data)

    listed = None if headers is None else [(name, raw(data)) for name, data in headers]
    return (topic, partition, offset, None, 0, raw(key), raw(value), listed)


def records(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RECORDS)


SENSOR = record("meter.levels", b"unit-7", b'{"temp":22.5}', [("region", b"north")])


def ingested(spark, subs, *rows, handler=None):
    return ingest(records(spark, *rows), subs, handler).collect()


def test_subscription_is_found_by_exact_topic(spark):
    subs = [Subscription("foo", static="a/b"), Subscription("bar", static="c/d"), Subscription("bar", static="e/f")]
    rows = with_subscription(records(spark, record("bar"), record("unknown"), record("bar2")), subs).collect()
    assert [(r.sub_ord, r.status) for r in rows] == [(1, "ok"), (None, "no_subscription"), (None, "no_subscription")]
    assert rows[1].error == 'kafka consumer: no subscription found for topic "unknown"'


def test_record_arrives_with_topic_message_and_fields(spark):
    def topic_of(topic, key, fields, msg):
        return F.concat(F.lit("meter/"), key, F.lit("/level"))

    for sub in (
        Subscription("meter.levels", column=topic_of),
        Subscription("meter.levels", template="meter/${key}/level"),
    ):
        df = ingest(records(spark, SENSOR), [sub])
        row = df.select("*", F.variant_get("msg.json", "$.temp", "double").alias("temp")).first()
        assert (row.bus_topic, row.temp, row.fields) == ("meter/unit-7/level", 22.5, {"region": "north"})
        assert (row.status, row.error) == ("ok", None)


def test_topic_that_cannot_be_resolved_skips_the_handler(spark):
    def broken(topic, key, fields, msg):
        return F.lit("a/b"), F.lit("bad expression")

    def handler(topic, msg, fields):
        return F.lit("handler was called")

    row = ingested(spark, [Subscription("foo", column=broken)], record(), handler=handler)[0]
    assert (row.bus_topic, row.status) == (None, "topic_error")
    assert row.error == 'kafka consumer: resolve bus topic for "foo": bad expression'


def test_name_of_the_bus_in_the_error_is_an_argument(spark):
    subs = [Subscription("foo", template="${key}")]
    row = ingest(records(spark, record()), subs, bus_name="event").first()
    assert row.error == 'kafka consumer: resolve event topic for "foo": unresolved reference'


def test_failing_handler_fails_the_record(spark):
    subs = [Subscription("foo", static="a/b")]
    row = ingested(spark, subs, record(), handler=lambda *_: F.lit("no room"))[0]
    assert (row.status, row.error, row.bus_topic) == ("handler_error", "no room", "a/b")


def test_record_without_key_and_headers(spark):
    row = ingested(spark, [Subscription("foo", static="a/b")], record(value=b'"hello"'))[0]
    assert (row.bus_topic, row.msg.kind, row.msg.text, row.fields) == ("a/b", "string", "hello", None)


def test_no_key_is_null_and_an_empty_key_is_empty(spark):
    rows = ingested(spark, [Subscription("foo", static="a/b")], record(), record(key=b""))
    assert [row.key_text for row in rows] == [None, ""]


def test_undecodable_payload_is_no_error(spark):
    df = ingest(records(spark, record(value=b"{broken"), record(value=None)), [Subscription("foo", static="a")], fmt="json")
    assert [(r.decode_failed, r.msg.kind, r.status) for r in df.collect()] == [(True, "bytes", "ok"), (False, "null", "ok")]


TEMPLATES = [
    ("plain", "plain"),
    ("", ""),
    ("${topic}/x", "t2/x"),
    ("a/${fields.region}", "a/north"),
    ("a/${fields.none}", None),
    ("${ msg.temp }", "22.5"),
    ("${msg.none}", None),
    ("${msg}", None),
    ("${key}-${key}", "unit-7-unit-7"),
]


def test_templates(spark):
    subs = [Subscription(f"t{i}", template=template) for i, (template, _) in enumerate(TEMPLATES)]
    rows = ingested(spark, subs, *((sub.topic, *SENSOR[1:]) for sub in subs))
    assert [row.bus_topic for row in rows] == [want for _, want in TEMPLATES]
    assert [row.status for row in rows] == ["topic_error" if want is None else "ok" for _, want in TEMPLATES]


def test_subscription_arguments_are_checked(spark):
    for given in ({}, {"static": "a", "template": "b"}):
        with pytest.raises(ValueError):
            Subscription("foo", **given)
    with pytest.raises(ValueError):
        ingest(records(spark, record()), [Subscription("foo", template="${nothing.x}")])
    with pytest.raises(ValueError):
        ingest(records(spark, record()), [])


FAILED = [Subscription("other", static="x")]


def test_dead_letter_keeps_the_record_and_appends_headers(spark):
    row = record("in.topic", b"key-5", b'{"n":4}', [("region", b"south"), ("traceparent", b"00"), ("region", b"2")])
    df = ingest(records(spark, row), [Subscription("in.topic", static="a")], lambda *_: F.lit("no room left"))
    as_of = datetime(2026, 1, 2, 3, 4, 5, 999999, tzinfo=timezone.utc)
    letter = build_dlq(df, "lost.found", as_of=as_of).first()
    assert (letter.topic, bytes(letter.key), bytes(letter.value)) == ("lost.found", b"key-5", b'{"n":4}')
    assert [(h.key, bytes(h.value)) for h in letter.headers] == [
        ("region", b"south"),
        ("traceparent", b"00"),
        ("region", b"2"),
        ("dlq-error", b"no room left"),
        ("dlq-original-topic", b"in.topic"),
        ("dlq-timestamp", b"2026-01-02T03:04:05Z"),
    ]


def test_dead_letter_of_a_record_without_headers(spark):
    letter = build_dlq(ingest(records(spark, record("t")), FAILED), "dlq", header_prefix="x-").first()
    assert [h.key for h in letter.headers] == ["x-error", "x-original-topic", "x-timestamp"]
    assert all(h.value for h in letter.headers)
    assert letter.key is None


def test_dead_letter_time_is_utc_in_any_session_time_zone(spark):
    as_of = datetime(2026, 7, 1, 12, 0, 0, tzinfo=timezone.utc)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        letter = build_dlq(ingest(records(spark, record("t")), FAILED), "dlq", as_of=as_of).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert bytes(letter.headers[2].value) == b"2026-07-01T12:00:00Z"


def test_dead_letter_of_a_dead_letter_shows_the_newest_error(spark):
    first = build_dlq(ingest(records(spark, record("t")), FAILED), "dlq")
    again = first.selectExpr("*", "0 as partition", "0L as offset")
    second = build_dlq(ingest(again, FAILED), "dlq2")
    assert second.select(F.size("headers")).first()[0] == 6
    fields = ingest(second, [Subscription("dlq2", static="a")]).first().fields
    assert fields["dlq-original-topic"] == "dlq"


LOG = [
    record("foo", partition=0, offset=0),
    record("foo", partition=0, offset=1, value=b'{"bad":1}'),
    record("foo", partition=0, offset=2),
    record("foo", partition=1, offset=5, value=b'{"bad":1}'),
    record("bar", partition=0, offset=7),
]


def refuse_bad(topic, msg, fields):
    return F.when(F.try_variant_get(msg["json"], "$.bad", "int") == 1, "bad")


def processed(spark):
    return ingest(records(spark, *LOG), [Subscription("foo", static="a")], refuse_bad)


def positions(df):
    return {(r.topic, r.partition): r[2] for r in df.collect()}


def test_split_outcomes(spark):
    df = processed(spark)
    for dlq, want in (True, (2, 3, 0)), (False, (2, 0, 3)):
        assert tuple(part.count() for part in split_outcomes(df, dlq)) == want
    assert {r.outcome for r in with_outcome(df).collect()} == {"success", "dead_letter"}
    assert bus_events(df).columns == ["topic", "msg", "fields"] and bus_events(df).count() == 2


def test_commit_passes_over_a_failure_in_front_of_a_success(spark):
    df = processed(spark)
    assert positions(committed_positions(df, commit_eligible(dlq=False))) == {("foo", 0): 3}
    assert positions(committed_positions(df)) == {("foo", 0): 3}


def test_commit_with_dead_letters_and_with_failing_ones(spark):
    df = processed(spark)
    everything = {("foo", 0): 3, ("foo", 1): 6, ("bar", 0): 8}
    assert positions(committed_positions(df, commit_eligible(dlq=True))) == everything
    assert positions(committed_positions(df, commit_eligible(dlq=False), "periodic")) == everything
    lost = df.withColumn("dlq_error", F.when(F.col("topic") == "bar", "broker down"))
    eligible = commit_eligible(True, F.col("dlq_error"))
    assert positions(committed_positions(lost, eligible)) == {("foo", 0): 3, ("foo", 1): 6}


def position_tables(spark):
    committed = spark.createDataFrame([("foo", 0, 1)], schemas.COMMITTED)
    ends = spark.createDataFrame([("foo", 0, 3), ("foo", 1, 6), ("bar", 0, 7), ("foo", 9, 50)], schemas.HIGH_WATERMARKS)
    return committed, ends


def test_resume(spark):
    committed, ends = position_tables(spark)
    log = records(spark, *LOG)

    def resumed(start):
        rows = [(r.topic, r.partition, r.offset) for r in resume_from(log, committed, ends, start).collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    late = {("foo", 0, 1), ("foo", 0, 2), ("bar", 0, 7)}
    assert resumed("earliest") == late | {("foo", 1, 5)}
    assert resumed("latest") == resumed("stored") == late
    with pytest.raises(ValueError):
        resume_from(log, committed, ends, "middle")


def test_resume_reads_all_of_a_partition_that_nobody_knows(spark):
    committed, ends = position_tables(spark)
    log, unknown = records(spark, *LOG), ends.filter("topic <> 'bar'")
    for start in ("earliest", "latest", "stored"):
        rows = resume_from(log, committed, unknown, start).filter("topic = 'bar'").collect()
        assert len(rows) == log.filter("topic = 'bar'").count() > 0


def test_lag(spark):
    _, ends = position_tables(spark)
    lag = positions(consumer_lag(records(spark, *LOG), ends))
    assert lag == {("foo", 0): 0.0, ("foo", 1): 0.0, ("bar", 0): 0.0, ("foo", 9): 0.0}
    ahead = spark.createDataFrame([("foo", 0, 10), ("foo", 1, 2)], schemas.HIGH_WATERMARKS)
    assert positions(consumer_lag(records(spark, *LOG), ahead)) == {("foo", 0): 7.0, ("foo", 1): 0.0}


def counts(df):
    return {r.topic: r.n for r in df.collect()}


def test_counters_count_less_than_their_names_say(spark):
    df = processed(spark)
    assert counts(metrics.consumed_messages(df)) == {"foo": 2}
    assert counts(metrics.consumer_errors(df)) == {"foo": 2, "bar": 1}


def test_commits_count_batches(spark):
    df = processed(spark).withColumn("batch", F.when(F.col("offset") < 3, 1).otherwise(F.col("offset")))
    assert metrics.commit_count(df, "batch", commit_eligible(dlq=False)).first().n == 1
    assert metrics.commit_count(df, "batch", commit_eligible(dlq=True)).first().n == 3


def test_histogram_buckets(spark):
    df = spark.createDataFrame([("t", d) for d in (0.5, 1.0, 1.5, 2.0, 9.0)] + [("t", None), ("u", None)], "topic string, d double")
    rows = {r.topic: r for r in metrics.duration_histogram(df, "d", ["topic"], [1, 2]).collect()}
    assert tuple(rows["t"])[1:] == (5, 14.0, 0.5, 9.0, 2, 2, 1)
    assert tuple(rows["u"])[1:] == (0, None, None, None, 0, 0, 0)
    with pytest.raises(ValueError):
        metrics.duration_histogram(df, "d", ["topic"], [2, 1])


def test_process_duration_leaves_out_what_never_reached_the_handler(spark):
    df = processed(spark).withColumn("d", F.lit(1.0))
    assert {r.topic: r.n for r in metrics.process_duration(df, "d", [1]).collect()} == {"foo": 4}


def test_attributes(spark):
    df = spark.createDataFrame([("t", 3)], "topic string, partition int")
    full = metrics.with_metric_attrs(df, "main", F.col("topic"), F.col("partition"), sends=True, client_attr="c").first()
    assert full.attributes == {
        "messaging.system": "kafka",
        "messaging.destination.name": "t",
        "messaging.destination.partition.id": "3",
        "messaging.operation.name": "send",
        "c": "main",
    }
    assert metrics.with_metric_attrs(df, "main").first().attributes == {"messaging.system": "kafka", "client.name": "main"}


def test_report_equals_the_single_metrics(spark):
    df = processed(spark).withColumn("batch", F.col("offset") % 2)
    _, ends = position_tables(spark)
    schema = T.StructType([*schemas.OUTBOUND.fields[:1], T.StructField("write_error", T.StringType())])
    results = spark.createDataFrame([("x", None), ("x", "down"), ("y", None)], schema)
    report = metrics.metrics_report(df, ends, results, "batch", commit_eligible(False), "main").collect()
    got = {}
    for row in report:
        place = (row.attributes.get("messaging.destination.name"), row.attributes.get("messaging.destination.partition.id"))
        got.setdefault(row.name, {})[place] = row.value
    assert got == {
        "messaging.client.consumed.messages": {("foo", None): 2.0},
        "kafka.consumer.errors": {("foo", None): 2.0, ("bar", None): 1.0},
        "kafka.consumer.lag": {("foo", "0"): 0.0, ("foo", "1"): 0.0, ("bar", "0"): 0.0, ("foo", "9"): 0.0},
        "kafka.consumer.commits": {(None, None): 1.0},
        "messaging.client.sent.messages": {("x", None): 1.0, ("y", None): 1.0},
        "kafka.producer.errors": {("x", None): 1.0},
    }
    sends = {row.name for row in report if "messaging.operation.name" in row.attributes}
    assert sends == {"messaging.client.sent.messages"}


def test_bridge_tells_the_first_failing_stage_of_both_directions(spark):
    subs = [Subscription("foo", template="in/${key}"), Subscription("bar", static="lost")]
    mappings = [TopicMapping("in/+id", "out", "fields.id")]
    rows = [record("foo", b"7"), record("foo"), record("bar"), record("baz"), record("foo", b"8", b'{"bad":1}')]
    df = bridge(records(spark, *rows), subs, mappings, refuse_bad, keep=["offset"])
    got = [(r.source_topic, r.kafka_topic, r.status) for r in df.collect()]
    assert got == [
        ("foo", "out", "ok"),
        ("foo", None, "topic_error"),
        ("bar", None, "unmatched"),
        ("baz", None, "no_subscription"),
        ("foo", None, "handler_error"),
    ]


def test_user_logic_may_be_a_pandas_udf(spark):
    import pandas as pd

    @F.pandas_udf("topic string, error string")
    def resolver(key: pd.Series, value: pd.Series) -> pd.DataFrame:
        bad = key.isna()
        return pd.DataFrame({"topic": "u/" + key.fillna(""), "error": bad.map({True: "no key", False: None})})

    def resolve(topic, key, fields, msg):
        result = resolver(key, msg["text"])
        return result["topic"], result["error"]

    rows = ingested(spark, [Subscription("foo", column=resolve)], record(key=b"1"), record())
    assert [(r.bus_topic, r.status) for r in rows] == [("u/1", "ok"), (None, "topic_error")]
    assert rows[1].error.endswith(": no key")


def test_columns_of_any_name_pass_through(spark):
    df = records(spark, record("foo", b"7")).withColumn("odd.`name", F.lit(1))
    passed = ingest(df, [Subscription("foo", template="in/${key}")])
    assert passed.first()["odd.`name"] == 1
