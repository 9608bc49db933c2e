"""Positions in the log: resume, commit, lag."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from culvert.functions.results import column_named, computed_once
from culvert.session import written_once

STARTS = ("stored", "earliest", "latest")
COMMIT_MODES = ("after_process", "periodic")

PARTITION = ["topic", "partition"]

#: Ranges of a condition on positions; a plan with thousands would take longer than it saves.
MAX_RANGES = 256


def resume_from(
    records: DataFrame,
    committed: DataFrame,
    high_watermarks: DataFrame,
    start: str = "stored",
) -> DataFrame:
    """Records at or after the committed position of their partition.

    ``start`` decides for partitions without one: ``earliest`` reads all of it,
    ``latest`` only what lies at or behind the high watermark. ``stored`` names
    no position of its own and begins at the end, as a new streaming query does.
    A partition in neither table has appeared since: all of it is read.

    There is one position per partition. They are written to the working folder
    once, so that Spark knows their size when it plans the join: a small table is
    broadcast, and a large one is joined by shuffle. They also become a filter that
    reaches the scan (``behind``), so that files and row groups in front of the positions
    are not read.
    """
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}: {start!r}")
    own = [column_named(name) for name in records.columns]
    if start == "earliest":
        positions = committed.select(*PARTITION, F.col("next_offset").alias("_start"))
    else:
        positions = high_watermarks.join(committed, PARTITION, "full").select(
            *PARTITION, F.coalesce("next_offset", "high_watermark").alias("_start")
        )
    positions = written_once(positions, "positions")
    first = F.coalesce("_start", F.lit(0))
    pushed = behind(positions, "_start")
    records = records if pushed is None else records.filter(pushed)
    return records.join(positions, PARTITION, "left").filter(F.col("offset") >= first).select(*own)


def behind(positions: DataFrame, offset_col: str = "next_offset", most: int = MAX_RANGES) -> Column | None:
    """A condition that holds for all records at or behind the positions, and for those of
    partitions that have none. It is made of comparisons with literals, which a Parquet
    scan tests against the least and largest values of a row group.

    Up to ``most`` partitions get a range each, and the condition is exact. Beyond that a
    topic gets one range from its least position on; beyond ``most`` topics there is no
    condition (None). At most that many rows come to the driver.
    """
    start = F.coalesce(F.col(offset_col), F.lit(0))
    rows = positions.select(*PARTITION, start.alias("start")).filter("topic IS NOT NULL AND partition IS NOT NULL")
    single = rows.limit(most + 1).collect()
    by_topic: dict[str, list[Column]] = {}
    if len(single) <= most:
        numbers: dict[str, list[int]] = {}
        for r in single:
            by_topic.setdefault(r.topic, []).append((F.col("partition") == r.partition) & (F.col("offset") >= r.start))
            numbers.setdefault(r.topic, []).append(r.partition)
        for topic, known in numbers.items():
            by_topic[topic].append(~F.col("partition").isin(known) | F.col("partition").isNull())
    else:
        whole = rows.groupBy("topic").agg(
            F.min("start").alias("start"), F.min("partition").alias("first"), F.max("partition").alias("last"),
            F.count_distinct("partition").alias("n"),
        )
        coarse = whole.limit(most + 1).collect()
        if len(coarse) > most:
            return None
        for r in coarse:
            # A partition in a gap has no position, so all of it is to be read.
            least = r.start if r.n == r.last - r.first + 1 else 0
            outside = (F.col("partition") < r.first) | (F.col("partition") > r.last) | F.col("partition").isNull()
            by_topic[r.topic] = [F.col("offset") >= least, outside]
    if not by_topic:
        return None
    topic = F.col("topic")
    kept = [(topic == name) & functools.reduce(Column.__or__, any_of) for name, any_of in by_topic.items()]
    return functools.reduce(Column.__or__, [*kept, ~topic.isin(list(by_topic)), topic.isNull()])


def committed_positions(processed: DataFrame, eligible: Column | None = None, commit: str = "after_process") -> DataFrame:
    """``topic, partition, next_offset`` after the rows of ``processed``.

    With ``after_process`` only rows that are ``eligible`` count. A failed row
    in front of a later eligible one is passed over, since a partition has one
    position. With ``periodic`` every row counts, whatever became of it, and
    nothing but its place is read. Of bridged rows the place is that of ``source``.
    """
    if commit not in COMMIT_MODES:
        raise ValueError(f"commit must be one of {COMMIT_MODES}: {commit!r}")
    if commit == "after_process":
        outcome = [name for name in ("status", "error") if name in processed.columns]
        processed = computed_once(processed, *outcome).filter(F.col("status") == "ok" if eligible is None else eligible)
    if "source" in processed.columns:
        processed = processed.select(*(F.col(f"source.{name}") for name in (*PARTITION, "offset")))
    return processed.groupBy(*PARTITION).agg((F.max("offset") + 1).alias("next_offset"))


def starting_offsets(positions: DataFrame, offset_col: str = "next_offset") -> DataFrame:
    """One row with the text Kafka's ``startingOffsets`` option takes, as ``starting_offsets``.

    A Kafka source given this text begins at the positions, so that nothing in
    front of them is read; ``resume_from`` does the same to a table. There is
    one entry per partition of the subscribed topics.
    """
    entry = F.struct(F.col("partition").cast("string").alias("key"), F.col(offset_col).alias("value"))
    topics = positions.groupBy("topic").agg(F.map_from_entries(F.collect_list(entry)).alias("offsets"))
    everything = F.map_from_entries(F.collect_list(F.struct("topic", "offsets")))
    return topics.agg(F.to_json(everything).alias("starting_offsets"))


def offset_range(positions: DataFrame, high_watermarks: DataFrame, start: str = "stored") -> DataFrame:
    """``topic, partition, first, end`` of what is still to be read of every partition; from
    ``first`` up to, but not including, ``end``.

    ``start`` decides for partitions without position as in ``resume_from``. A position
    behind the end of its partition leaves nothing to read.
    """
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}: {start!r}")
    fallback = F.lit(0).cast("long") if start == "earliest" else F.col("high_watermark")
    first = F.coalesce("next_offset", fallback)
    return high_watermarks.join(positions, PARTITION, "left").select(
        *PARTITION, F.least(first, F.col("high_watermark")).alias("first"), F.col("high_watermark").alias("end")
    )


def range_options(ranges: DataFrame) -> dict[str, str]:
    """``startingOffsets`` and ``endingOffsets`` of a Kafka batch read of exactly these ranges."""
    options = {"startingOffsets": "first", "endingOffsets": "end"}
    return {name: starting_offsets(ranges, column).first().starting_offsets for name, column in options.items()}


def consumer_lag(records: DataFrame, high_watermarks: DataFrame) -> DataFrame:
    """``topic, partition, lag`` per fetched partition, zero for one without records.

    Every record read counts, failed ones too.
    """
    last = records.groupBy(*PARTITION).agg(F.max("offset").alias("_last"))
    return high_watermarks.join(last, PARTITION, "left").select(
        *PARTITION, lag_of(F.col("high_watermark"), F.col("_last")).alias("lag")
    )


def lag_of(high_watermark: Column, last_offset: Column) -> Column:
    behind = F.greatest(high_watermark - (last_offset + 1), F.lit(0))
    return F.coalesce(behind, F.lit(0)).cast("double")
