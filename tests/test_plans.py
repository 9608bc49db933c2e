"""Plans: what is shuffled, what is broadcast, where filters and Python stand."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from compare import spark_rows
from culvert.operators.ingest import build_dlq, bus_events, ingest, settled, split_outcomes
from culvert.operators.offsets import resume_from
from culvert.operators.routing import TopicMapping, route, to_outbound
from culvert.operators.rules import route_by_table, shaped_rules
from culvert.plans import tables
from culvert.plans.queries import QUERIES

SF = f"{TESTDATA}/sf0.001"
BATCH_QUERIES = [name for name in QUERIES if not name.startswith("stream_")]

# Steps that treat each row by itself must not shuffle.
ROW_BY_ROW = [
    name for name in BATCH_QUERIES
    if name.startswith(("decode_", "encode_", "route_", "fallback_", "deliver", "bridge_rec", "dlq", "produced", "custom"))
    and name not in ("decode_failures",)
    and not name.startswith("route_rule_table")
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|NestedLoopJoin|CartesianProduct", plan)


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_row_by_row_steps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF))


def test_scan_reads_only_the_columns_in_use(spark):
    plan = plan_of(QUERIES["route_first_match"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {column.split(":")[0] for column in schema.split(",")} == {"event_id", "user_id", "event_type"}


def test_ignored_events_are_dropped_before_encoding(spark):
    out = to_outbound(route(tables.bus_events(tables.events(spark, SF)), tables.MAPPINGS, "ignore"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("StructsToJsonEvaluator") < plan.rindex("Filter")


def test_filter_on_status_does_not_parse_again(spark):
    df = ingest(tables.records_without_offset(tables.events(spark, SF)), tables.SUBSCRIPTIONS, tables.handler)
    for part in (settled(df).filter(F.col("status") == "ok"), bus_events(df), *split_outcomes(df)[:2], build_dlq(df, "dlq")):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1


def test_patterns_are_tried_once(spark):
    routed = route(tables.bus_events(tables.events(spark, SF)), tables.MAPPINGS)
    plan = routed.filter(F.col("status") == "ok")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == sum(1 for m in tables.MAPPINGS if "/+" in m.pattern or m.pattern.startswith("+"))


def test_small_rule_tables_are_broadcast_and_large_ones_are_not(spark):
    bus, rules = tables.bus_events(tables.events(spark, SF)), tables.rules_of(spark, tables.MAPPINGS)
    small = plan_of(route_by_table(bus, rules))
    assert "BroadcastHashJoin" in small and "NestedLoop" not in small
    executed = route_by_table(bus, rules)
    executed.collect()
    final = plan_of(executed)
    assert final.count("ReusedExchange") >= 3 and final.count("BroadcastHashJoin") >= 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = route_by_table(bus, rules, "slash_to_dot", max_broadcast_rules=3)
        # The matches are a table of their own; the events meet them spread over the salts.
        assert re.search(r"hashpartitioning\(topic#\d+, _salt#\d+", plan_of(large))
        assert plan_of(large).count("SortMergeJoin") == 1
        want = route(bus, tables.MAPPINGS, "slash_to_dot").select("event_id", "mapping_ord", "kafka_topic", "key")
        assert spark_rows(large.select("event_id", "mapping_ord", "kafka_topic", "key")) == spark_rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_positions_without_an_outcome_read_only_places(spark):
    plan = QUERIES["committed_positions_periodic"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan and "transform" not in plan


def test_a_hot_topic_is_not_shuffled_to_one_task(spark):
    """Half of the events have one topic, a sixth another that no rule matches; some have none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        number = F.col("id")
        topic = (
            F.when(number % 2 == 0, "hot/topic")
            .when(number % 3 == 0, "nobody/wants/this")
            .when(number % 5 == 0, F.lit(None))
            .otherwise(F.concat(F.lit("dev/"), (number % 900).cast("string")))
        )
        bus = spark.range(0, 60000, 1, 16).select("id", topic.alias("topic"))
        rules = tables.rules_of(spark, [TopicMapping("hot/+", "h"), TopicMapping("dev/#", "d")])
        routed = route_by_table(bus, rules, max_broadcast_rules=0)
        placed = routed.select("id", "kafka_topic", "status", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {row.id: row.kafka_topic for row in placed}
    assert len(placed) == 60000
    for i in range(60000):
        want = "h" if i % 2 == 0 else None if i % 3 == 0 or i % 5 == 0 else "d"
        assert got[i] == want
    sizes = [sum(1 for row in placed if row.task == task) for task in range(8)]
    assert max(sizes) < 60000 / 3


def test_rules_that_take_joins_by_their_number_of_shapes(spark):
    larger = f"{TESTDATA}/sf0.01"
    rules = tables.shaped_user_rules(tables.events(spark, larger))
    shapes = shaped_rules(rules).select("any_rest", "mask").distinct()
    assert shapes.count() > 16
    assert "_salt" in plan_of(QUERIES["route_rule_table_shapes"](spark, larger))


def test_a_thousand_rules_in_one_table(spark):
    mappings = [TopicMapping(f"meter/{i}/+" if i % 2 else f"meter/{i}", f"t{i}") for i in range(1000)]
    bus = tables.bus_events(tables.events(spark, SF))
    got = route_by_table(bus, tables.rules_of(spark, mappings)).groupBy("kafka_topic").count()
    users = tables.events(spark, SF).groupBy("event_type", "user_id").count().collect()
    want = {}
    for row in users:
        hit = (row.event_type == "click" and row.user_id % 2) or (row.event_type == "view" and not row.user_id % 2)
        name = f"t{row.user_id}" if hit else None
        want[name] = want.get(name, 0) + row["count"]
    assert {row.kafka_topic: row["count"] for row in got.collect()} == want


def test_offsets_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK_IDS", 37)
    events = tables.events(spark, SF)
    got = {row.event_id: (row.topic, row.partition, row.offset) for row in tables.records(events).collect()}
    seen, want = {}, {}
    for row in events.select("event_id", "event_type", "user_id").orderBy("event_id").collect():
        place = (f"app.{row.event_type}", row.user_id % 4)
        want[row.event_id] = (*place, seen.get(place, 0))
        seen[place] = seen.get(place, 0) + 1
    assert got == want


@pytest.mark.parametrize("name", ["deliver_status", "bridge_counts", "produced_records", "m_report", "decode_auto"])
def test_generated_methods_stay_small_enough_for_the_jit(spark, name):
    """HotSpot leaves methods of more than 8000 bytes interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan()
        package = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", package.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000


def test_resuming_does_not_shuffle_the_records(spark, tmp_path):
    events = tables.events(spark, SF)
    tables.records(events).write.parquet(str(tmp_path / "log"))
    log, sizes = spark.read.parquet(str(tmp_path / "log")), tables.partition_sizes(events)
    for start in ("earliest", "stored"):
        plan = plan_of(resume_from(log, tables.committed(sizes), tables.high_watermarks(sizes), start))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "Exchange hashpartitioning" not in plan
