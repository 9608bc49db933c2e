"""Patterns, routing, keys and outbound records."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from culvert import schemas
from culvert.functions.patterns import Pattern, extract_fields
from culvert.functions.payload import message
from culvert.operators.routing import TopicMapping, merged_fields, route, route_many, to_outbound
from culvert.operators.rules import route_by_table
from culvert.plans import tables


def events(spark, *topics, fields=None):
    rows = [(i, topic, fields) for i, topic in enumerate(topics)]
    df = spark.createDataFrame(rows, "event_id long, topic string, fields map<string,string>")
    return df.withColumn("msg", message("string", text=F.lit("hi")))


def routed(spark, mappings, topic, default="error", fields=None):
    row = route(events(spark, topic, fields=fields), mappings, default).first()
    return row.kafka_topic, None if row.key is None else bytes(row.key), row.status, row.error


def constant(text):
    return lambda topic, msg, fields: F.lit(text)


def test_exact_match(spark):
    got = routed(spark, [TopicMapping("meter/oil", "meters", constant("fixed"))], "meter/oil")
    assert got == ("meters", b"fixed", "ok", None)


def test_first_match_wins(spark):
    mappings = [TopicMapping("meter/#", "first"), TopicMapping("meter/oil", "second")]
    assert routed(spark, mappings, "meter/oil")[0] == "first"


def test_wildcard_captures_a_field(spark):
    mapping = TopicMapping("meter/+meterId/level", "meters", "fields.meterId")
    assert routed(spark, [mapping], "meter/m-9/level") == ("meters", b"m-9", "ok", None)


def test_captured_fields_override_the_given_ones_for_the_key(spark):
    def both(topic, msg, fields):
        return F.concat_ws("|", fields["meterId"], fields["region"])

    given_fields = {"region": "hall 4", "meterId": "given"}
    mapping = TopicMapping("meter/+meterId/level", "meters", both)
    assert routed(spark, [mapping], "meter/m-9/level", fields=given_fields)[1] == b"m-9|hall 4"
    merged = merged_fields(events(spark, "meter/m-9/level", fields=given_fields), mapping.pattern).first()
    assert merged.merged_fields == {"region": "hall 4", "meterId": "m-9"}


def test_no_key_function_gives_no_key(spark):
    assert routed(spark, [TopicMapping("gate/#", "gates")], "gate/open") == ("gates", None, "ok", None)


def test_missing_field_gives_an_empty_key(spark):
    assert routed(spark, [TopicMapping("a/#", "t", "fields.x")], "a/b") == ("t", b"", "ok", None)
    assert routed(spark, [TopicMapping("a/#", "t", "fields.x")], "a/b", fields={"y": "1"})[1] == b""


def test_key_as_column(spark):
    assert routed(spark, [TopicMapping("a/#", "t", F.upper("topic"))], "a/b")[1] == b"A/B"


def test_key_failure_does_not_fall_through(spark):
    failing = TopicMapping("meter/#", "meters", lambda *_: (F.lit("k"), F.lit("no such meter")))
    got = routed(spark, [failing, TopicMapping("meter/oil", "second")], "meter/oil", "slash_to_dot")
    assert got == (None, None, "key_error", 'kafka producer: resolve key for "meter/oil": no such meter')


def test_key_failure_comes_before_an_empty_target(spark):
    failing = TopicMapping("meter/#", "", lambda *_: (F.lit("k"), F.lit("no")))
    assert routed(spark, [failing], "meter/oil")[2] == "key_error"


def test_unmatched_is_an_error_by_default(spark):
    got = routed(spark, [TopicMapping("meter/#", "meters")], "gate/open")
    assert got == (
        None,
        None,
        "unmatched",
        'kafka producer: no topic mapping matched for topic "gate/open" and default_topic_transform is error',
    )


def test_slash_to_dot(spark):
    assert routed(spark, [], "a/b/c", "slash_to_dot") == ("a.b.c", None, "ok", None)


@pytest.mark.parametrize("mappings", [[], [TopicMapping("meter/#", "meters")]])
def test_ignore(spark, mappings):
    assert routed(spark, mappings, "gate/open", "ignore") == ("", None, "ignored", None)


def test_empty_target_is_ignored(spark):
    assert routed(spark, [TopicMapping("a", "")], "a") == ("", None, "ignored", None)


@pytest.mark.parametrize("default", ["error", "slash_to_dot", "ignore"])
def test_null_topic_is_unmatched(spark, default):
    assert routed(spark, [TopicMapping("#", "all")], None, default)[2] == "unmatched"


def test_arguments_are_checked(spark):
    for mappings, default in ([], "drop"), ([TopicMapping("a/#/b", "t")], "error"), ([TopicMapping("a", "t", "msg.x")], "error"):
        with pytest.raises(ValueError):
            route(events(spark, "a"), mappings, default)


MATCHES = [
    ("meter", "meter", True),
    ("meter", "meter\n", False),
    ("meter/+", "meter/x", True),
    ("meter/+", "meter/x\n", True),
    ("meter/+", "meter/", True),
    ("meter/+", "meter", False),
    ("meter/+", "meter/x/y", False),
    ("meter/+/z", "meter//z", True),
    ("meter/#", "meter", True),
    ("meter/#", "meter/x/y", True),
    ("meter/#", "meters", False),
    ("+", "x", True),
    ("+", "$SYS", False),
    ("+/x", "$SYS/x", False),
    ("#", "$SYS/x", False),
    ("#", "a/b", True),
    ("#", "", True),
    ("$SYS/#", "$SYS/x", True),
    ("$SYS/+", "$SYS/x", True),
    ("a/$b/+", "a/$b/c", True),
    ("a.c", "abc", False),
    ("a/+/#", "a", False),
    ("a/+/#", "a/b", True),
    ("a/x+", "a/x+", True),
    ("a/x+", "a/xx", False),
    ("+/#", "a", True),
]


def test_patterns(spark):
    topics = list(dict.fromkeys(topic for _, topic, _ in MATCHES))
    patterns = list(dict.fromkeys(pattern for pattern, _, _ in MATCHES))
    tests = [Pattern(pattern).matches(F.col("topic")).alias(str(i)) for i, pattern in enumerate(patterns)]
    rows = {row.topic: row for row in events(spark, *topics).select("topic", *tests).collect()}
    wrong = [case for case in MATCHES if rows[case[1]][str(patterns.index(case[0]))] != case[2]]
    assert wrong == []


@pytest.mark.parametrize("pattern", ["+/x", "#", "$SYS/#", "meter/+/z", "a/+/#"])
def test_rule_table_matches_like_a_pattern(spark, pattern):
    df = events(spark, *dict.fromkeys(topic for _, topic, _ in MATCHES))
    rules = tables.rules_of(spark, [TopicMapping(pattern, "hit")])
    want = {row.topic for row in df.filter(Pattern(pattern).matches(F.col("topic"))).collect()}
    for result in (route_by_table(df, rules), route_by_table(df, rules, max_lookups=0)):
        assert {row.topic for row in result.filter(F.col("status") == "ok").collect()} == want


def test_captures(spark):
    df = events(spark, "a/b/c/d", "a", "x")
    rows = df.select(
        "topic",
        extract_fields("a/+one/#rest", F.col("topic")).alias("both"),
        extract_fields("a/#rest", F.col("topic")).alias("rest"),
        extract_fields("+x/+x/#", F.col("topic")).alias("twice"),
        extract_fields("a/#", F.col("topic")).alias("none"),
    ).collect()
    got = {row.topic: (row.both, row.rest, row.twice, row.none) for row in rows}
    assert got["a/b/c/d"] == ({"one": "b", "rest": "c/d"}, {"rest": "b/c/d"}, {"x": "b"}, None)
    assert got["a"] == (None, {"rest": ""}, None, None)
    assert got["x"] == (None, None, None, None)


def naive_match(pattern, topic):
    """Level by level, as MQTT states it."""
    if topic.startswith("$") and pattern[:1] in ("+", "#"):
        return False
    ps, ts = pattern.split("/"), topic.split("/")
    for i, p in enumerate(ps):
        if p.startswith("#"):
            return True
        if i >= len(ts) or not (p.startswith("+") or p == ts[i]):
            return False
    return len(ps) == len(ts)


LEVEL = st.sampled_from(["a", "b", "", "$a", "c.d", "=", "x+"])
TOPIC = st.lists(LEVEL, min_size=1, max_size=4).map("/".join)
PATTERN = st.tuples(
    st.lists(LEVEL | st.sampled_from(["+", "+n"]), max_size=4), st.sampled_from([None, None, "#", "#r"])
).map(lambda p: "/".join(p[0] + ([p[1]] if p[1] else [])) or "a")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PATTERN, min_size=25, max_size=25), st.lists(TOPIC, min_size=120, max_size=120))
def test_routing_agrees_with_matching_level_by_level(spark, patterns, topics):
    mappings = [TopicMapping(pattern, f"t{i}") for i, pattern in enumerate(patterns)]
    df, rules = events(spark, *topics), tables.rules_of(spark, mappings)
    want = [next((i for i, p in enumerate(patterns) if naive_match(p, topic)), None) for topic in topics]
    for result in (
        route(df, mappings),
        route_by_table(df, rules, max_lookups=1000),
        route_by_table(df, rules, max_broadcast_rules=0),
    ):
        rows = sorted(result.select("event_id", "mapping_ord", "kafka_topic").collect())
        assert [row.mapping_ord for row in rows] == want
        assert [row.kafka_topic for row in rows] == [None if i is None else f"t{i}" for i in want]


def test_rule_table_without_rules_or_with_a_broken_one(spark):
    empty = spark.createDataFrame([], schemas.RULES)
    assert route_by_table(events(spark, "a/b"), empty, "slash_to_dot").first().kafka_topic == "a.b"
    broken = spark.createDataFrame([(0, "a/#/b", "t", None), (1, "a/b", "u", None)], schemas.RULES)
    assert route_by_table(events(spark, "a/b"), broken).first().kafka_topic == "u"
    without_keys = broken.drop("key")
    assert route_by_table(events(spark, "a/b"), without_keys).first().key is None
    for rows in [(0, "a", "t", None), (0, "b", "u", None)], [(0, "a", "t", "msg.x")]:
        with pytest.raises(ValueError):
            route_by_table(events(spark, "a/b"), spark.createDataFrame(rows, schemas.RULES))


KEYED = [
    TopicMapping("a/+x/+y", "t0", "fields.y"),
    TopicMapping("b/+x/+x", "t1", "fields.x"),
    TopicMapping("c/#rest", "t2", "fields.rest"),
    TopicMapping("d/+x", "t3", "fields.z"),
    TopicMapping("e/#", "t4"),
    TopicMapping("+x/#x", "t5", "fields.x"),
]


@pytest.mark.parametrize("fields", [None, {"z": "given", "x": "hidden"}])
def test_keys_of_a_rule_table_equal_those_of_mappings(spark, fields):
    topics = ["a/1/2", "b/1/2", "c", "c/", "c/1/2", "d/1", "e/1", "f", "f/1/2", "$s/1", None, ""]
    df, rules = events(spark, *topics, fields=fields), tables.rules_of(spark, KEYED)
    shown = ["event_id", "mapping_ord", "kafka_topic", "status", "key"]
    want = sorted(map(str, route(df, KEYED).select(*shown).collect()))
    for result in (route_by_table(df, rules), route_by_table(df, rules, max_lookups=0)):
        assert sorted(map(str, result.select(*shown).collect())) == want


def test_events_pass_a_rule_table_once_each(spark):
    df = events(spark, *(["hot"] * 500 + [None, None, "cold"]))
    rules = tables.rules_of(spark, [TopicMapping("hot", "h"), TopicMapping("hot", "again")])
    for result in (route_by_table(df, rules), route_by_table(df, rules, max_lookups=0)):
        counts = {(row.kafka_topic, row.status): row["count"] for row in result.groupBy("kafka_topic", "status").count().collect()}
        assert counts == {("h", "ok"): 500, (None, "unmatched"): 3}


def test_outbound_headers_are_the_events_own_fields(spark):
    df = events(spark, "meter/m-9/level", "other", fields={"region": "eu"})
    routed_df = route(df, [TopicMapping("meter/+meterId/level", "meters", "fields.meterId")], "ignore")
    out = to_outbound(routed_df)
    assert out.columns == ["topic", "key", "value", "headers"]
    row = out.collect()
    assert len(row) == 1
    assert (row[0].topic, bytes(row[0].key), bytes(row[0].value)) == ("meters", b"m-9", b"hi")
    assert [(h.key, bytes(h.value)) for h in row[0].headers] == [("region", b"eu")]


def test_several_producers_may_take_one_event(spark):
    producers = {"a": [TopicMapping("x/#", "xs")], "b": [TopicMapping("x/1", "ones"), TopicMapping("y", "")]}
    rows = route_many(events(spark, "x/1", "x/2", "y"), producers).collect()
    assert sorted((r.event_id, r.producer, r.kafka_topic) for r in rows) == [(0, "a", "xs"), (0, "b", "ones"), (1, "a", "xs")]


def test_patterns_without_regex():
    assert Pattern("a/b").is_exact and not Pattern("a/+").is_exact
    assert Pattern("a/+x/#y").captures == {"x": 1, "y": 2}
