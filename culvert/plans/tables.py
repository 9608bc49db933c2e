"""Records, bus events, positions and rules derived from the ``events`` table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from culvert import schemas
from culvert.operators.ingest import Subscription
from culvert.operators.routing import TopicMapping
from culvert.session import work_dir
from culvert.sources.records import ParquetLog

# event_id is unique, so a block of this many ids never holds more rows than that.
BLOCK_IDS = 1 << 20

PARTITION_KEYS = ["topic", "partition"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream; the pattern in the name covers a single file and a folder alike."""
    reader = spark.readStream.schema(events(spark, sf_dir).schema).option("maxBytesPerTrigger", 64 << 30)
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def _bytes(text: str) -> str:
    return f"CAST({text} AS BINARY)"


def _header(key: str, text: str) -> str:
    return f"named_struct('key', '{key}', 'value', {_bytes(text)})"


REGION = "concat('r', user_id % 3)"
TRACE = [
    _header("traceparent", "'00-0af7651916cd43dd8448eb211c80319c-b7ad6b7169203331-01'"),
    _header("tracestate", "'vendor=x'"),
    _header("baggage", "'tenant=1'"),
]

KEY = f"""CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN X'' ELSE {_bytes("CAST(user_id AS STRING)")} END"""

VALUE = f"""CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN X'' WHEN 2 THEN {_bytes("'not-json'")}
  WHEN 3 THEN {_bytes("""'"hello"'""")} WHEN 4 THEN {_bytes("'[1,2,3]'")} WHEN 5 THEN {_bytes("'1 2'")}
  ELSE {_bytes("props")} END"""

HEADERS = f"""CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN array({TRACE[0]})
  WHEN 2 THEN array({_header("region", "'old'")}, {_header("region", REGION)})
  WHEN 3 THEN array({_header("region", REGION)}, {_header("empty", "NULL")})
  ELSE array({_header("region", REGION)}, {", ".join(TRACE)}) END"""

BUS_TOPIC = """CASE event_type WHEN 'click' THEN concat('meter/', user_id, '/level')
  WHEN 'view' THEN concat('meter/', user_id) WHEN 'purchase' THEN concat('shop/eu/purchase/', user_id)
  WHEN 'signup' THEN concat('$SYS/', user_id, '/signup') ELSE 'gate/open' END"""

BUS_MESSAGE = f"""named_struct(
  'kind', CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'string' WHEN 2 THEN 'bytes' ELSE 'json' END,
  'json', CASE WHEN event_id % 4 = 3 THEN parse_json(props) END,
  'text', CASE WHEN event_id % 4 = 1 THEN 'hello' END,
  'raw', CASE WHEN event_id % 4 = 2 THEN {_bytes("props")} END)"""


def in_partitions(events: DataFrame) -> DataFrame:
    """The events with the ``topic`` and ``partition`` their record lies in."""
    return events.selectExpr("*", "concat('app.', event_type) AS topic", "CAST(user_id % 4 AS INT) AS partition")


def with_offset(events: DataFrame) -> DataFrame:
    """Add ``offset``, the event's place within its topic and partition by ``event_id``.

    A topic and partition may hold much of the log, so no task numbers all of
    it. Rows are numbered within blocks of ids, which are bounded, and a block
    begins where the row counts of the blocks before it end.
    """
    placed = in_partitions(events).withColumn("_block", F.expr(f"event_id div {BLOCK_IDS}"))
    within = Window.partitionBy(*PARTITION_KEYS, "_block").orderBy("event_id")
    before = Window.partitionBy(*PARTITION_KEYS).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy(*PARTITION_KEYS, "_block")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(blocks, [*PARTITION_KEYS, "_block"])
        .withColumn("offset", F.col("_first") + F.col("_place"))
        .drop("_block", "_place", "_first")
    )


def records(events: DataFrame) -> DataFrame:
    """Records with their position; rows are numbered before the record columns are made."""
    numbered = with_offset(events)
    return _as_records(numbered, "offset")


def records_without_offset(events: DataFrame) -> DataFrame:
    """Records as they can be made on a stream too: no position within the partition."""
    return _as_records(in_partitions(events))


def _as_records(events: DataFrame, *position: str) -> DataFrame:
    return events.selectExpr(
        "topic",
        "partition",
        *position,
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "0 AS timestampType",
        f"{KEY} AS key",
        f"{VALUE} AS value",
        f"{HEADERS} AS headers",
        "event_id",
        "CASE WHEN event_type = 'error' THEN 100 + event_id % 3 ELSE event_id % 13 END AS batch_id",
        "value / 1000 AS duration_s",
    )


def partition_sizes(events: DataFrame) -> DataFrame:
    """Rows per topic and partition; offsets have no gaps, so this is the last offset plus one."""
    return in_partitions(events).groupBy(*PARTITION_KEYS).agg(F.count("*").alias("n"))


def high_watermarks(sizes: DataFrame) -> DataFrame:
    """End of each partition of ``partition_sizes``, and one partition that has no rows."""
    ends = sizes.select(
        *PARTITION_KEYS, (F.col("n") + F.col("partition") * 3).cast("long").alias("high_watermark")
    )
    spark = sizes.sparkSession
    empty = spark.range(1).select(
        F.lit("app.click").alias("topic"), F.lit(9).alias("partition"), F.lit(50).cast("long").alias("high_watermark")
    )
    return ends.unionByName(empty)


def early_watermarks(sizes: DataFrame) -> DataFrame:
    """Ends as they were taken earlier: three quarters of each partition, and none of the
    last partition of a topic, which has appeared since."""
    end = F.expr("n * 3 div 4").alias("high_watermark")
    return sizes.filter(F.col("partition") < 3).select(*PARTITION_KEYS, end)


def committed(sizes: DataFrame) -> DataFrame:
    """Half of each partition is committed, in the first two partitions of each topic."""
    half = F.expr("n div 2").alias("next_offset")
    return sizes.filter(F.col("partition") < 2).select(*PARTITION_KEYS, half)


SUBSCRIPTIONS = [
    Subscription("app.click", static="web/click"),
    Subscription("app.view", template="web/${key}/view"),
    Subscription("app.purchase", template="shop/${fields.region}/purchase"),
    Subscription("app.signup", template="user/${msg.k}/signup"),
    Subscription("app.click", static="web/shadowed"),
]


def handler(bus_topic: Column, msg: Column, fields: Column) -> Column:
    """Refuses messages whose ``k`` is 90 or more."""
    return F.when(F.try_variant_get(msg["json"], "$.k", "int") >= 90, "k out of range")


def bus_events(events: DataFrame) -> DataFrame:
    """Bus events of all message kinds, some with fields and some under a reserved topic."""
    return events.selectExpr(
        "event_id",
        "user_id",
        f"{BUS_TOPIC} AS topic",
        f"{BUS_MESSAGE} AS msg",
        f"CASE WHEN event_id % 5 <> 0 THEN map('region', {REGION}, 'meterId', 'given') END AS fields",
        "value / 1000 AS duration_s",
    )


MAPPINGS = [
    TopicMapping("meter/+meterId/level", "meter.levels", "fields.meterId"),
    TopicMapping("meter/#", "meters"),
    TopicMapping("shop/+/purchase/+userId", "shop.purchases", "fields.region"),
    TopicMapping("meter/+/level", "shadowed"),
    TopicMapping("+/+/signup", "signups"),
    TopicMapping("ops/#", ""),
]
MAPPINGS_SYS = [*MAPPINGS, TopicMapping("$SYS/#", "sys")]
MAPPINGS_ALERTS = [*MAPPINGS, TopicMapping("gate/open", "gates")]
MAPPINGS_OPS = [MAPPINGS[0], TopicMapping("meter/#", ""), *MAPPINGS[2:]]


def _failing_key(topic: Column, msg: Column, fields: Column) -> tuple[Column, Column]:
    return fields["meterId"], F.when(fields["meterId"].endswith("0"), "bad device")


MAPPINGS_KEYERR = [TopicMapping("meter/+meterId/level", "meter.levels", _failing_key), *MAPPINGS[1:]]

# Events in every status: sent, ignored, unmatched, without key; in format bytes some do not encode.
MAPPINGS_ALL = [MAPPINGS_KEYERR[0], TopicMapping("meter/#", ""), *MAPPINGS[2:]]

# What the records of SUBSCRIPTIONS become when they are routed on.
BRIDGE_MAPPINGS = [
    TopicMapping("web/click", "clicks"),
    TopicMapping("web/+visitor/view", "views", "fields.visitor"),
    TopicMapping("shop/+region/#", "purchases", "fields.region"),
]


def rules_of(spark: SparkSession, mappings: list[TopicMapping]) -> DataFrame:
    """The mappings as a rule table; keys must be given as text."""
    rows = [(i, mapping.pattern, mapping.kafka_topic, mapping.key) for i, mapping in enumerate(mappings)]
    return spark.createDataFrame(rows, schemas.RULES)


def user_rules(events: DataFrame) -> DataFrame:
    """A rule table that grows with the data: one rule for two of three users, numbered by user."""
    user, sells = F.col("user_id").cast("string"), F.col("user_id") % 3 == 1
    return events.select("user_id").filter(F.col("user_id") % 3 < 2).distinct().select(
        F.col("user_id").alias("ord"),
        F.when(sells, F.concat(F.lit("shop/+/purchase/"), user))
        .otherwise(F.concat(F.lit("meter/"), user, F.lit("/+")))
        .alias("pattern"),
        F.concat(F.when(sells, "buyer.").otherwise("device."), user).alias("kafka_topic"),
    )


def shaped_user_rules(events: DataFrame) -> DataFrame:
    """A rule per user in one of 24 shapes, more than are looked up one by one."""
    user, shape = F.col("user_id").cast("string"), (F.col("user_id") % 24).cast("int")
    levels = F.array(F.lit("meter"), user, F.lit("reading"))
    # The last three bits mask levels, what is left decides how the pattern ends.
    masked = [
        F.when(shape.bitwiseAND(F.lit(1 << i)) > 0, F.lit("+x")).otherwise(F.get(levels, F.lit(i))) for i in (0, 1, 2)
    ]
    kind = F.floor(shape / 8)
    pattern = (
        F.when(kind == 0, F.concat_ws("/", *masked))
        .when(kind == 1, F.concat_ws("/", *masked[:2], F.lit("#")))
        .otherwise(F.concat_ws("/", *masked, F.lit("#rest")))
    )
    return events.select("user_id").distinct().select(
        F.col("user_id").cast("int").alias("ord"),
        pattern.alias("pattern"),
        F.concat(F.lit("user."), user).alias("kafka_topic"),
        F.when(shape.bitwiseAND(F.lit(2)) > 0, "fields.x").otherwise("fields.region").alias("key"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts at hand as ``src, id, text``: prose, web pages and conversations."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    documents = read("documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text")
    pages = read("pages").select(F.lit("pages"), "page_id", "html")
    turns = read("conversations").select(F.lit("conversations"), F.expr("conv_id * 1000 + turn"), "text")
    return documents.union(pages).union(turns)


def write_results(outbound: DataFrame) -> DataFrame:
    """Outbound rows with what the broker said; ``event_id`` must be kept in them."""
    return outbound.withColumn("write_error", F.when(F.col("event_id") % 47 == 0, "broker down"))


#: A poll takes a file of at most this many events.
POLL_EVENTS = 1 << 20


#: A poll's file has row groups of this size, so that a micro-batch is read by many tasks.
POLL_ROW_GROUP_BYTES = 4 << 20


def poll_log(spark: SparkSession, sf_dir: str, path: str, polls: slice = slice(None)) -> ParquetLog:
    """The records as a log that is taken in four polls or more, by ``event_id``; a file and
    micro-batch each. ``polls`` are those to be written now.

    The records are dealt to a folder per poll in one pass, so that a poll's file is written
    from its own records and no others are read.
    """
    table = events(spark, sf_dir)
    ids = (in_partitions(table).dropna(subset=PARTITION_KEYS).agg(F.max("event_id")).first()[0] or 0) + 1
    number = max(4, -(-ids // POLL_EVENTS))
    numbered = records(table).drop("batch_id")
    poll = F.expr(f"event_id * {number} div {ids}").alias("_poll")
    folder = work_dir(spark, "polls")
    wanted = list(range(number)[polls])
    now = numbered.select("*", poll).filter(F.col("_poll").isin(wanted))
    now.write.partitionBy("_poll").parquet(folder)
    dealt = spark.read.schema(T.StructType([*numbered.schema, T.StructField("_poll", T.LongType())])).parquet(folder)
    log = ParquetLog(path, numbered.schema, max_bytes_per_trigger=1, row_group_bytes=POLL_ROW_GROUP_BYTES)
    for k in wanted:
        log.write(dealt.filter(F.col("_poll") == k).drop("_poll").coalesce(1), k)
    return log


TOPICS = ["app.click", "app.view", "app.purchase", "app.signup", "app.error"]


def in_partition_1(batch: pa.RecordBatch) -> list[bool]:
    return [p == 1 for p in batch.column("partition").to_pylist()]


def key_ends_in_7(batch: pa.RecordBatch) -> list[bool]:
    return [k is not None and k.endswith(b"7") for k in batch.column("key").to_pylist()]


def k_in_range(topic: str, message: object, fields: dict[str, str]) -> str | None:
    """The same refusal as ``handler``, by raising."""
    if isinstance(message, dict) and isinstance(message.get("k"), int) and message["k"] >= 90:
        raise ValueError("k out of range")
    return None
