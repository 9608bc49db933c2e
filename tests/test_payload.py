"""Decoding and encoding of payloads."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.functions.payload import CODECS, Codec, codec_for, decode_payload, encode_payload, message


def decode(spark, values, fmt="auto"):
    df = spark.createDataFrame(
        [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, value binary"
    )
    msg = F.col("msg")
    rows = decode_payload(df, fmt).select(
        "i",
        "decode_failed",
        msg["kind"].alias("kind"),
        F.to_json(msg["json"]).alias("json"),
        msg["text"].alias("text"),
        msg["raw"].alias("raw"),
    )
    return [row for row in sorted(rows.collect(), key=lambda row: row.i)]


def test_auto_decodes_the_basic_payloads(spark):
    rows = decode(spark, [b"", b'{"a":1}', b"[1,2,3]", b'"hello"', b"not-json", None])
    assert [(r.kind, r.json, r.text) for r in rows] == [
        ("string", None, ""),
        ("json", '{"a":1}', None),
        ("json", "[1,2,3]", None),
        ("string", None, "hello"),
        ("string", None, "not-json"),
        ("null", None, None),
    ]
    assert not any(r.decode_failed for r in rows)


def test_numbers_read_as_double(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1,"t":22.5}'),)], "value binary")
    msg = F.col("msg.json")
    row = decode_payload(df).select(
        F.variant_get(msg, "$.a", "double").alias("a"), F.variant_get(msg, "$.t", "double").alias("t")
    ).first()
    assert (row.a, row.t) == (1.0, 22.5)


TRAILING = [b"1 2", b"1,2", b"1] [2", b"1} x", b'{"a":1} x', b'{"a":1}}', b"[1]]", b"1}", b"1]", b'1,"v":2', b"1,", b"}", b"],["]
BROKEN = [b"", b" ", b"NaN", b"01", b"{a:1}", b"'a'", b"[1,]", b'"x', b"// x", b"1 //x", b"\x00", b"tru"]
WHOLE = [b' {"a":1} ', b"\n[1]\t", b"null", b"true", b"-0", b'"\\u00e9"', b"{}", b"[]", b'{"a":{"b":[1,{"c":null}]}}']


@pytest.mark.parametrize("fmt, kind", [("auto", "string"), ("json", "bytes")])
def test_what_is_not_one_whole_json_value_stays_as_it_is(spark, fmt, kind):
    values = TRAILING + BROKEN
    rows = decode(spark, values, fmt)
    assert [r.kind for r in rows] == [kind] * len(values)
    kept = [bytes(r.raw) if fmt == "json" else r.text.encode() for r in rows]
    assert kept == values
    assert [r.decode_failed for r in rows] == [fmt == "json"] * len(values)


def test_whole_json_values_parse(spark):
    for row, value in zip(decode(spark, WHOLE, "json"), WHOLE):
        assert not row.decode_failed
        parsed = json.loads(value)
        assert row.text == parsed if isinstance(parsed, str) else json.loads(row.json) == parsed


def test_repeated_object_key_is_json_and_the_last_counts(spark):
    assert decode(spark, [b'{"a":1,"a":2}'])[0].json == '{"a":2}'


def _is_json(text):
    def refuse(name):
        raise ValueError(name)

    try:
        json.loads(text, parse_constant=refuse)
        return True
    except ValueError:
        return False


JSON_SCRAPS = st.lists(st.sampled_from(list('{}[],:"1-.e ') + ["true", "null", '"a"', '"a":', "\\"]), max_size=8).map("".join)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(JSON_SCRAPS, min_size=500, max_size=500))
def test_json_test_agrees_with_a_strict_parser(spark, texts):
    rows = decode(spark, [text.encode() for text in texts], "json")
    assert [text for text, row in zip(texts, rows) if row.decode_failed == _is_json(text)] == []


def test_string_and_bytes_never_parse(spark):
    value = b'{"a":1}'
    text, same = decode(spark, [value], "string")[0], decode(spark, [value], "bytes")[0]
    assert (text.kind, text.text) == ("string", '{"a":1}')
    assert (same.kind, bytes(same.raw)) == ("bytes", value)


def test_text_that_is_no_utf8_keeps_its_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "value binary")
    row = encode_payload(decode_payload(df, "auto").select("msg"), "auto").first()
    assert bytes(row.value) == b"\xff\xfe"


def encode(spark, column, fmt):
    row = encode_payload(spark.range(1).select(column().alias("msg")), fmt).first()
    return None if row.value is None else bytes(row.value), row.status, row.error


def an_object():
    return message("json", json=F.parse_json(F.lit('{"hello":"world"}')))


def raw():
    return message("bytes", raw=F.lit('{"already":"encoded"}').cast("binary"))


def a_text(text='say "hi"\n[x]'):
    return message("string", text=F.lit(text))


@pytest.mark.parametrize("fmt", CODECS)
def test_null_and_bytes_encode_to_themselves(spark, fmt):
    assert encode(spark, lambda: message("null"), fmt) == (None, "ok", None)
    assert encode(spark, raw, fmt) == (b'{"already":"encoded"}', "ok", None)


@pytest.mark.parametrize("fmt", ["auto", "json", "string"])
def test_json_encodes_to_its_text(spark, fmt):
    assert encode(spark, an_object, fmt) == (b'{"hello":"world"}', "ok", None)


def test_text_is_verbatim_but_quoted_by_json(spark):
    for fmt in ("auto", "string", "bytes"):
        assert encode(spark, a_text, fmt)[0] == b'say "hi"\n[x]'
    assert json.loads(encode(spark, a_text, "json")[0]) == 'say "hi"\n[x]'
    assert encode(spark, lambda: a_text("[]"), "json")[0] == b'"[]"'


def test_bytes_format_refuses_json(spark):
    value, status, error = encode(spark, an_object, "bytes")
    assert (value, status) == (None, "serialize_error")
    assert error == "kafka producer: serialize payload: bytes format needs bytes or string"


def test_rows_that_failed_before_are_not_encoded(spark):
    df = spark.range(1).select(an_object().alias("msg"), F.lit("key_error").alias("status"), F.lit("e").alias("error"))
    row = encode_payload(df, "bytes").first()
    assert (row.value, row.status, row.error) == (None, "key_error", "e")


def test_unknown_format_is_refused_by_both_directions(spark):
    df = spark.createDataFrame([], T.StructType([T.StructField("value", T.BinaryType())]))
    for step in (decode_payload, encode_payload, codec_for):
        with pytest.raises(ValueError, match="unknown wire format"):
            step(*(("yaml",) if step is codec_for else (df, "yaml")))


def test_custom_codec_decodes_and_encodes(spark):
    reverse = Codec(
        "reverse",
        decode=lambda value: F.when(F.length(value) > 1, message("string", text=F.reverse(value.cast("string")))),
        encode=lambda msg: F.reverse(msg["text"]).cast("binary"),
    )
    rows = decode(spark, [b"abc", b"x", None], reverse)
    assert [(r.kind, r.text, r.decode_failed) for r in rows] == [
        ("string", "cba", False),
        ("bytes", None, True),
        ("null", None, False),
    ]
    assert encode(spark, lambda: a_text("abc"), reverse) == (b"cba", "ok", None)
