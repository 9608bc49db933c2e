"""Random records and events against a plain record-by-record account of what should happen."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from culvert import schemas
from culvert.operators.ingest import Subscription, build_dlq, commit_eligible, ingest
from culvert.operators.metrics import consumed_messages, consumer_errors
from culvert.operators.offsets import committed_positions

TRACE = {"traceparent", "tracestate", "baggage"}
TEXT = st.sampled_from(["", "a", "é", "x/y", '"', "old"])
BYTES = TEXT.map(str.encode) | st.just(b"\xff")
HEADER = st.tuples(st.sampled_from(["region", "id", "traceparent", "baggage", "Baggage"]), st.none() | BYTES)
VALUE = st.none() | st.sampled_from([b"", b"1 2", b"{bad", b'"text"', b"null", b"[1]", b'{"k":5}', b'{"k":95}', b'{"k":"t"}', b'{"k":null}'])
RECORD = st.tuples(
    st.sampled_from(["static", "by_key", "by_region", "by_k", "nobody"]),
    st.integers(0, 2),
    st.none() | BYTES,
    VALUE,
    st.none() | st.lists(HEADER, max_size=5),
)

SUBS = [
    Subscription("static", static="s/t"),
    Subscription("by_key", template="key/${key}"),
    Subscription("by_region", template="r/${fields.region}/${topic}"),
    Subscription("by_k", template="${msg.k}/k"),
    Subscription("static", static="shadowed"),
]


def handler(topic, msg, fields):
    return F.when(F.try_variant_get(msg["json"], "$.k", "int") >= 90, "too big")


def expected(topic, partition, key, value, headers):
    """Decode, subscription, resolver, handler; the first failing stage explains the record."""
    fields = {name: (data or b"").decode("utf-8", "replace") for name, data in headers or [] if name not in TRACE} or None
    key_text = None if key is None else key.decode("utf-8", "replace")
    kind, k = "null", None
    if value is not None:
        kind = "string"
        try:
            parsed = json.loads(value)
            if not isinstance(parsed, str):
                kind = "json"
                k = parsed.get("k") if isinstance(parsed, dict) else None
        except ValueError:
            pass
    if topic == "nobody":
        return kind, fields, None, "no_subscription", 'kafka consumer: no subscription found for topic "nobody"'
    region = (fields or {}).get("region")
    bus_topic = {
        "static": "s/t",
        "by_key": None if key_text is None else f"key/{key_text}",
        "by_region": None if region is None else f"r/{region}/by_region",
        "by_k": None if k is None else f"{k}/k",
    }[topic]
    if bus_topic is None:
        return kind, fields, None, "topic_error", f'kafka consumer: resolve bus topic for "{topic}": unresolved reference'
    if isinstance(k, int) and k >= 90:
        return kind, fields, bus_topic, "handler_error", "too big"
    return kind, fields, bus_topic, "ok", None


def raw(data):
    return None if data is None else bytearray(data)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(RECORD, min_size=300, max_size=300))
def test_ingest_agrees_with_the_account(spark, given_records):
    rows = [
        (t, p, i, None, 0, raw(key), raw(value), None if hs is None else [(n, raw(d)) for n, d in hs])
        for i, (t, p, key, value, hs) in enumerate(given_records)
    ]
    df = ingest(spark.createDataFrame(rows, schemas.RECORDS), SUBS, handler).persist()
    try:
        want = [expected(*record) for record in given_records]
        got = sorted(df.select("offset", F.col("msg.kind").alias("kind"), "fields", "bus_topic", "status", "error").collect())
        assert [tuple(row)[1:] for row in got] == want

        failed = [i for i, outcome in enumerate(want) if outcome[3] != "ok"]
        letters = build_dlq(df, "dlq", keep=["offset"]).collect()
        assert sorted(letter.offset for letter in letters) == failed
        for letter in letters:
            _, _, key, value, headers = given_records[letter.offset]
            assert (raw(letter.key), raw(letter.value)) == (raw(key), raw(value))
            assert [(h.key, raw(h.value)) for h in letter.headers[:-3]] == [(n, raw(d)) for n, d in headers or []]

        for dlq in (True, False):
            positions = {}
            for i, (topic, partition, *_) in enumerate(given_records):
                if dlq or want[i][3] == "ok":
                    positions[topic, partition] = i + 1
            committed = committed_positions(df, commit_eligible(dlq)).collect()
            assert {(r.topic, r.partition): r.next_offset for r in committed} == positions

        for counter, good in (consumed_messages(df), True), (consumer_errors(df), False):
            counts = {}
            for i, (topic, *_) in enumerate(given_records):
                if (want[i][3] == "ok") == good:
                    counts[topic] = counts.get(topic, 0) + 1
            assert {r.topic: r.n for r in counter.collect()} == counts
    finally:
        df.unpersist()
