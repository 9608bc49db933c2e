"""Rules that take joins: what the driver holds, and what is repeated for hot topics."""

import re

import pytest
from pyspark.sql import functions as F

from culvert.operators import rules
from culvert.operators.routing import TopicMapping
from culvert.operators.rules import route_by_table
from culvert.plans import tables
from test_plans import plan_of


@pytest.mark.parametrize("masks", [64, 0])
def test_many_matches_are_not_broadcast_and_only_hot_topics_are_salted(spark, monkeypatch, masks):
    """Spark sees small files where the driver would hold every match under every salt."""
    monkeypatch.setattr(rules, "MAX_BROADCAST_RULES", 100)
    topic = F.when(F.col("id") < 3000, "dev/0/a").when(F.col("id") % 2000 < 1990, F.concat(F.lit("dev/"), "id", F.lit("/a")))
    bus = spark.range(0, 6000, 1, 4).select("id", topic.alias("topic"))
    mappings = [TopicMapping("+/0/a", "hot"), TopicMapping("dev/+/a", "all")]
    routed = route_by_table(bus, tables.rules_of(spark, mappings), "ignore", max_lookups=0, max_masks=masks)
    last = plan_of(routed).split("Initial Plan")[-1]
    assert "SortMergeJoin" in last
    assert not re.search(r"BroadcastHashJoin \[topic#\d+, _salt", last)
    got = {row.id: row.kafka_topic for row in routed.collect()}
    assert got == {i: "hot" if i < 3000 else "all" if i % 2000 < 1990 else None for i in range(6000)}


def test_a_match_is_repeated_for_hot_topics_alone(spark, monkeypatch):
    topic = F.when(F.col("id") < 3000, "dev/0").otherwise(F.concat(F.lit("dev/"), "id"))
    bus = spark.range(0, 6000, 1, 4).select("id", topic.alias("topic"))
    table = tables.rules_of(spark, [TopicMapping("dev/+", "all")])
    seen, join = [], type(bus).join
    monkeypatch.setattr(type(bus), "join", lambda df, other, *how: seen.append(other) or join(df, other, *how))
    assert route_by_table(bus, table, max_lookups=0).filter("kafka_topic = 'all'").count() == 6000
    salted = next(df for df in seen if "_of" in df.columns)
    assert salted.count() == 3000 + rules.SALTS
