"""Logs of records: Kafka, or Parquet files with the same columns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from culvert import schemas
from culvert.operators.offsets import STARTS
from culvert.sources.files import exists, move, remove


@dataclass(frozen=True)
class KafkaLog:
    """A Kafka cluster. ``options`` go to Spark's Kafka source and sink as they are (TLS, SASL, ...).

    A micro-batch of a stream takes at most ``max_offsets_per_trigger`` records, so that a
    job that starts on a long log, or far behind, does not persist all of it at once.
    """

    bootstrap_servers: str
    options: dict[str, str] = field(default_factory=dict)
    max_offsets_per_trigger: int = 50_000_000

    def connection(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, **self.options}

    def read_options(self, topics: Sequence[str], start: str | None = None) -> dict[str, str]:
        """Options to read ``topics``. ``start`` only counts for a query without checkpoint.

        ``stored`` leaves the position to the checkpoint; a query that has none
        yet begins at the end. Positions kept elsewhere go in as ``options``,
        with the text of ``starting_offsets`` under ``startingOffsets``.
        """
        options = {"subscribe": ",".join(_distinct(topics)), "includeHeaders": "true"}
        if start is not None:
            if start not in STARTS:
                raise ValueError(f"start must be one of {STARTS}: {start!r}")
            options["startingOffsets"] = "earliest" if start == "earliest" else "latest"
        return {**options, **self.connection()}

    def stream_options(self, topics: Sequence[str], start: str) -> dict[str, str]:
        """Options to stream ``topics`` in bounded micro-batches; an own
        ``maxOffsetsPerTrigger`` among the ``options`` counts more."""
        bound = {"maxOffsetsPerTrigger": str(self.max_offsets_per_trigger)}
        return {**bound, **self.read_options(topics, start)}

    def write(self, records: DataFrame, batch_id: int | None = None) -> None:
        """Append ``records``, each to the topic its row names. A replayed batch is sent again."""
        outbound = records.select("topic", "key", "value", "headers")
        outbound.write.format("kafka").options(**self.connection()).save()


@dataclass(frozen=True)
class ParquetLog:
    """A folder of Parquet files with the columns of a record.

    With ``by_topic`` the files are laid out by topic, so that a reader of some
    topics skips the others. That is for few topics; destinations derived from
    event topics can be as many as the devices that send, and stay a plain column.

    ``in_order`` names the columns by whose ranges the rows are laid into files, and sorted
    within them, so that a reader of a range skips the other files and row groups.

    With ``once`` a batch that is there stays as it is, so that a file stream behind the log
    sees none of its files twice, however often the batch is replayed. Its files are written
    to a folder that readers pass over, and appear together by one rename; the file system
    has to rename folders as one step, which HDFS does and plain object stores do not.

    With ``row_group_bytes`` a file is split into row groups of about that size, each of which
    another task can read.
    """

    path: str
    schema: T.StructType = schemas.RECORDS
    by_topic: bool = False
    max_bytes_per_trigger: int = 64 << 30
    in_order: tuple[str, ...] = ()
    once: bool = False
    row_group_bytes: int | None = None

    def _row_group_bytes(self) -> int | None:
        """Small row groups where the rows are in order, else as Spark makes them."""
        return self.row_group_bytes or (16 << 20 if self.in_order else None)

    def write(self, records: DataFrame, batch_id: int | None = None) -> None:
        """Append ``records``; a batch written twice replaces itself.

        The files of a replayed batch have new names, so a file stream that has read the
        batch before reads it again: it should drop repeated rows by ``batch_id``, or the
        log be written ``once``.
        """
        spark, staged = records.sparkSession, ""
        if self.once and batch_id is not None:
            if exists(spark, f"{self.path}/batch_id={batch_id}"):
                return
            staged = f"{self.path}/_staged/{uuid.uuid4().hex}"
        if self.by_topic:
            # Groups a topic's rows into few files and, unlike repartition, splits a topic too big for one task.
            records = records.hint("rebalance", "topic")
        if self.in_order:
            records = records.repartitionByRange(*self.in_order).sortWithinPartitions(*self.in_order)
        if batch_id is None:
            writer, path = records.write.mode("append"), self.path
        else:
            writer, path = records.write.mode("overwrite"), staged or f"{self.path}/batch_id={batch_id}"
        if self.by_topic:
            writer = writer.partitionBy("topic")
        if group := self._row_group_bytes():
            writer = writer.option("parquet.block.size", group)
        writer.parquet(path)
        if staged and not move(spark, staged, f"{self.path}/batch_id={batch_id}"):
            remove(spark, staged)  # another run of the batch was first

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches written so far, in the schema they were written with."""
        return spark.read.parquet(self.path)


Log = KafkaLog | ParquetLog


def _distinct(topics: Sequence[str]) -> list[str]:
    if not topics:
        raise ValueError("at least one topic is needed")
    return list(dict.fromkeys(topics))


def subscribed(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    """The records of exactly these topics; the filter reaches the Parquet scan."""
    return records.filter(F.col("topic").isin(*_distinct(topics)))


def read_records(spark: SparkSession, source: Log, topics: Sequence[str]) -> DataFrame:
    """All records of ``topics`` as a batch table."""
    if isinstance(source, KafkaLog):
        return spark.read.format("kafka").options(**source.read_options(topics)).load()
    return subscribed(spark.read.schema(source.schema).parquet(source.path), topics)


def stream_records(spark: SparkSession, source: Log, topics: Sequence[str], start: str = "stored") -> DataFrame:
    """The records of ``topics`` as a stream.

    A file stream knows no end to begin at: it reads every file not yet in the
    checkpoint, and each micro-batch takes files up to ``max_bytes_per_trigger``.
    """
    if isinstance(source, KafkaLog):
        return spark.readStream.format("kafka").options(**source.stream_options(topics, start)).load()
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}: {start!r}")
    if start == "latest":
        raise ValueError("a file stream cannot start at the end of the log")
    reader = spark.readStream.schema(source.schema).option("maxBytesPerTrigger", source.max_bytes_per_trigger)
    return subscribed(reader.parquet(source.path), topics)


def write_records(outbound: DataFrame, target: Log, batch_id: int | None = None) -> None:
    """Write outbound records, each to the topic its row names."""
    target.write(outbound, batch_id)


def write_dlq(dead: DataFrame, target: Log, batch_id: int | None = None) -> None:
    """Write dead-letter records as ``build_dlq`` made them."""
    target.write(dead, batch_id)
