"""Rule tables walked as a trie and kept over micro-batches; logs that are written once."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from conftest import TESTDATA
from culvert import schemas
from culvert.operators import rules as r
from culvert.operators.routing import TopicMapping, in_key_order, route, sent, produce
from culvert.operators.rules import compile_rules, route_by_table
from culvert.plans import tables
from culvert.plans.queries import replay_last_batch
from culvert.session import lasting, scratch, work_dir, written_once
from culvert.sources.files import children, exists
from culvert.sources.records import ParquetLog, stream_records, write_records
from culvert.streaming import jobs

SF = f"{TESTDATA}/sf0.001"


def matches(pattern, topic):
    """One pattern against one topic, level by level."""
    wanted, levels = pattern.split("/"), topic.split("/")
    if any(w.startswith("#") for w in wanted[:-1]):
        return False
    if topic.startswith("$") and wanted[0][:1] in ("+", "#"):
        return False
    if wanted[-1].startswith("#"):
        wanted = wanted[:-1]
        levels = levels[: len(wanted)] if len(levels) >= len(wanted) else None
    return levels is not None and len(levels) == len(wanted) and all(w.startswith("+") or w == x for w, x in zip(wanted, levels))


def patterns(n, seed, deepest=12, words="abc"):
    rng, out = random.Random(seed), set()
    while len(out) < n:
        levels = [rng.choice(["+", "+x", *words, *words, "", "$s"]) for _ in range(rng.randint(0, deepest))]
        tail = rng.choice([[], ["#"], ["#rest"]]) if levels else ["#"]
        out.add("/".join(levels + tail))
    return sorted(out)


def test_the_trie_finds_the_first_rule(spark):
    rng = random.Random(3)
    rules = patterns(700, 1, 5)
    topics = ["/".join(rng.choice(["a", "b", "c", "", "$s", "zz"]) for _ in range(rng.randint(1, 7))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in [*topics, "", "/", "$s", None]], "topic string")
    table = spark.createDataFrame([(i, p, f"k{i}", None) for i, p in enumerate(rules)], schemas.RULES)
    routed = route_by_table(df, table, "ignore", max_lookups=0, max_masks=0).select("topic", "mapping_ord").distinct().collect()
    for row in routed:
        hits = [i for i, p in enumerate(rules) if row.topic is not None and matches(p, row.topic)]
        assert row.mapping_ord == (hits[0] if hits else None), row.topic
    assert sum(row.mapping_ord is not None for row in routed) > 100
    other = route_by_table(df, table, "ignore", max_lookups=0, max_masks=10**6)
    assert spark_rows(other) == spark_rows(route_by_table(df, table, "ignore", max_lookups=0, max_masks=0))


def test_many_rules_of_many_shapes_without_a_set_of_masks(spark):
    """20,000 rules of 12 levels in 200 shapes and more; a topic may fit thousands of masks."""
    rng = random.Random(8)
    shapes = [[rng.random() < 0.4 for _ in range(12)] for _ in range(220)]
    rows = []
    for i in range(20_000):
        wild = shapes[i % len(shapes)]
        rows.append((i, "/".join("+" if w else f"v{(i * 7 + k) % 50}" for k, w in enumerate(wild)), f"t{i}", None))
    distinct = {p: o for o, p, *_ in reversed(rows)}
    table = spark.createDataFrame(rows, schemas.RULES)
    picked = rng.sample(rows, 60)
    topics = ["/".join(x if x != "+" else f"w{k}" for k, x in enumerate(p.split("/"))) for _, p, *_ in picked]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    compiled = compile_rules(table)
    assert compiled.shapes is None and not compiled.few
    got = {row.topic: row.mapping_ord for row in route_by_table(df, compiled).collect()}
    for topic, (_, pattern, *_) in zip(topics, picked):
        assert got[topic] is not None and got[topic] <= distinct[pattern]
        assert matches(rows[got[topic]][1], topic)
    r.forget(compiled)


def rule_table(spark, *mappings):
    return tables.rules_of(spark, [TopicMapping(*m) for m in mappings])


@pytest.mark.parametrize("most", [2_000, 0])
def test_rules_are_compiled_when_they_change(spark, monkeypatch, most):
    monkeypatch.setattr(r, "MAX_LOCAL_RULES", most)
    first = compile_rules(rule_table(spark, ("a/+", "x"), ("b", "y")))
    same = compile_rules(rule_table(spark, ("a/+", "x"), ("b", "y")), before=first)
    assert same is first and bool(first.paths) == (most == 0)
    other = compile_rules(rule_table(spark, ("a/+", "x"), ("b", "z")), before=first)
    assert other is not first
    df = spark.createDataFrame([("b",)], "topic string")
    assert route_by_table(df, first).first().kafka_topic == "y"
    assert route_by_table(df, other).first().kafka_topic == "z"
    r.forget(first)
    assert not any(exists(spark, p) for p in first.paths) and all(exists(spark, p) for p in other.paths)
    for broken in ([(1, "a", "x", None), (1, "b", "y", None)], [(1, "a", "x", "topic")]):
        with pytest.raises(ValueError):
            compile_rules(spark.createDataFrame(broken, schemas.RULES))


def folders(spark):
    return set(children(spark, spark.conf.get("spark.checkpoint.dir")))


@pytest.mark.parametrize("most", [2_000, 0])
def test_ten_batches_use_one_snapshot_and_leave_nothing(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(r, "MAX_LOCAL_RULES", most)
    path, before = str(tmp_path / "events"), folders(spark)
    tables.events(spark, SF).repartition(10).write.parquet(path)
    stream = spark.readStream.schema(tables.events(spark, SF).schema).option("maxFilesPerTrigger", 1).parquet(path)
    made = []
    real = r.shaped_rules
    monkeypatch.setattr(r, "shaped_rules", lambda rules: made.append(1) or real(rules))
    monkeypatch.setattr(r, "MAX_MASKS", 0)  # by joins, which write tables of their own
    rules, target = tables.rules_of(spark, tables.MAPPINGS), ParquetLog(str(tmp_path / "out"))
    jobs.run_produce(tables.bus_events(stream), rules, target, str(tmp_path / "ck"), "slash_to_dot").awaitTermination()
    assert len(glob.glob(f"{target.path}/batch_id=*")) == 10 and len(made) == 1
    left = folders(spark) - before
    assert len(left) == (2 if most == 0 else 0)  # the snapshot in use
    want = sent(produce(route(tables.bus_events(tables.events(spark, SF)), tables.MAPPINGS, "slash_to_dot")))
    shown = [F.hex("key").alias("k"), F.hex("value").alias("v"), "topic"]
    assert spark_rows(target.read(spark).select(*shown)) == spark_rows(want.select(*shown))


def test_scratch_folders_go_and_lasting_ones_stay(spark):
    with scratch(spark):
        gone = written_once(spark.range(3), "gone").inputFiles()[0]
        with lasting():
            stays = written_once(spark.range(3), "stays").inputFiles()[0]
        assert exists(spark, gone)
    assert not exists(spark, gone) and exists(spark, stays)
    assert not exists(spark, work_dir(spark, "never"))


def log_rows(spark, *topics):
    rows = [(t, None, bytearray(b"%d" % i), None) for i, t in enumerate(topics)]
    return spark.createDataFrame(rows, schemas.OUTBOUND)


def test_a_batch_that_is_there_stays(spark, tmp_path):
    log = ParquetLog(str(tmp_path / "log"), schemas.OUTBOUND, once=True)
    write_records(log_rows(spark, "foo", "bar"), log, 0)
    files = set(glob.glob(f"{log.path}/batch_id=0/*.parquet"))
    write_records(log_rows(spark, "other"), log, 0)
    assert set(glob.glob(f"{log.path}/batch_id=0/*.parquet")) == files
    write_records(log_rows(spark, "foo"), log, 1)
    assert sorted(x.topic for x in log.read(spark).collect()) == ["bar", "foo", "foo"]
    assert glob.glob(f"{log.path}/_staged/*") == []


def test_a_run_that_comes_second_leaves_the_first(spark, tmp_path, monkeypatch):
    log = ParquetLog(str(tmp_path / "log"), schemas.OUTBOUND, once=True)
    write_records(log_rows(spark, "foo"), log, 0)
    monkeypatch.setattr("culvert.sources.records.exists", lambda *_: False)  # looked before the first was done
    write_records(log_rows(spark, "late"), log, 0)
    assert [x.topic for x in log.read(spark).collect()] == ["foo"] and glob.glob(f"{log.path}/_staged/*") == []


def test_a_stream_behind_a_replayed_job_reads_no_row_twice(spark, tmp_path):
    events = tables.events(spark, SF)
    target = ParquetLog(str(tmp_path / "log"), schemas.OUTBOUND, once=True)
    seen = []

    def front():
        stream = tables.event_stream(spark, SF)
        jobs.run_produce(tables.bus_events(stream), tables.MAPPINGS, target, f"{tmp_path}/ck", "slash_to_dot").awaitTermination()

    def behind():
        stream = stream_records(spark, target, ["meters"])
        jobs.run_each(stream, lambda batch, _: seen.append(batch.count()), f"{tmp_path}/behind").awaitTermination()

    front()
    behind()
    replay_last_batch(spark, f"{tmp_path}/ck")
    front()
    behind()
    assert sum(seen) == events.filter("event_type = 'view'").count()


def test_records_of_a_key_are_written_in_order(spark):
    rows = spark.range(20_000).selectExpr(
        "(id * 7919) % 20000 AS seq", "if(id % 3 = 0, 'hot', concat('t', id % 5)) AS kafka_topic",
        "cast(if(id % 3 = 0, 'hot', cast(id % 11 AS string)) AS binary) AS key",
    ).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = in_key_order(rows, "seq").withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_key = {}
    for row in sorted(parts, key=lambda row: row.place):
        by_key.setdefault((row.kafka_topic, bytes(row.key)), []).append((row.part, row.seq))
    assert len(parts) == 20_000
    for places in by_key.values():
        assert [s for _, s in places] == sorted(s for _, s in places)
    assert len({p for p, _ in by_key["hot", b"hot"]}) > 1  # split by its order
