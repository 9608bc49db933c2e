"""Headers to fields and back."""

from pyspark.sql import functions as F

from culvert import schemas
from culvert.functions.headers import fields_to_headers, headers_to_fields


def fields(spark, *lists):
    rows = [
        (i, None if headers is None else [(k, None if v is None else bytearray(v)) for k, v in headers])
        for i, headers in enumerate(lists)
    ]
    df = spark.createDataFrame(rows, "i int, headers array<struct<key:string,value:binary>>")
    return [row.fields for row in sorted(headers_to_fields(df).collect(), key=lambda row: row.i)]


def test_no_headers_give_no_fields(spark):
    assert fields(spark, None, []) == [None, None]


def test_headers_become_fields(spark):
    assert fields(spark, [("colour", b"teal"), ("size", b"9")]) == [{"colour": "teal", "size": "9"}]


def test_trace_headers_are_left_out(spark):
    trace = [("traceparent", b"00-7f"), ("tracestate", b"v=1"), ("baggage", b"u=2")]
    assert fields(spark, [("hall", b"north"), *trace], trace[:2]) == [{"hall": "north"}, None]


def test_trace_names_match_exactly(spark):
    assert fields(spark, [("Traceparent", b"1"), ("baggage2", b"2")]) == [{"Traceparent": "1", "baggage2": "2"}]


def test_last_of_repeated_headers_counts(spark):
    given = [("a", b"1"), ("b", b"2"), ("a", b"3"), ("a", None), ("b", b"4")]
    assert fields(spark, given, given[:3]) == [{"a": "", "b": "4"}, {"a": "3", "b": "2"}]


def test_null_value_is_empty_text(spark):
    assert fields(spark, [("a", None), ("b", b"")]) == [{"a": "", "b": ""}]


def test_fields_become_sorted_headers(spark):
    df = spark.createDataFrame([({"b": "2", "a": ""},), ({},), (None,)], "fields map<string,string>")
    rows = fields_to_headers(df).collect()
    assert [[(h.key, bytes(h.value)) for h in row.headers] for row in rows] == [[("a", b""), ("b", b"2")], [], []]
    assert fields_to_headers(df).schema["headers"].dataType.elementType.fieldNames() == schemas.HEADER.fieldNames()


def test_fields_survive_the_way_there_and_back(spark):
    df = spark.createDataFrame([({"b": "2", "a": "é"},)], "fields map<string,string>")
    back = headers_to_fields(fields_to_headers(df).select("headers"))
    assert back.select(F.col("fields")).first().fields == {"b": "2", "a": "é"}
