"""What a running job keeps between micro-batches: positions, counters, histograms.

A job writes what a batch has changed under the batch's id and nothing else. A batch that is
replayed replaces what it wrote before. The newest row of a key counts; from time to time the
newest rows are folded into a snapshot, and what it holds is removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from culvert import schemas
from culvert.sources.files import children, remove

_BATCH, _UPTO = "batch_id=", "upto="


@dataclass(frozen=True)
class ChangeLog:
    """A table of ``schema`` with one current row per ``keys``, as changes by batch.

    ``batch_id=N`` holds the rows that batch N changed, ``snapshots/upto=N`` the
    current rows after all batches up to N, and how many of them changed anything. A reader
    takes the newest snapshot and the entries behind it, so it sees the same before, while
    and after entries are folded. A snapshot is one file, which is there whole or not: it
    has as many rows as there are keys, not as there are records.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]

    def _entries(self, spark: SparkSession) -> list[int]:
        return _numbers(spark, self.path, _BATCH)

    def _snapshot(self, spark: SparkSession) -> int:
        """The last batch that is folded; -1 without a snapshot."""
        return max(_numbers(spark, f"{self.path}/snapshots", _UPTO), default=-1)

    def append(self, changed: DataFrame, batch_id: int) -> None:
        """Write the current rows of the keys that the batch has changed."""
        rows = changed.select(*self.schema.names)
        rows.write.mode("overwrite").parquet(f"{self.path}/{_BATCH}{batch_id}")

    def _read(self, spark: SparkSession) -> DataFrame:
        """All rows that count, with ``batch_id`` and ``batches``, where null stands for a
        single batch; and one row without keys for the batches in the snapshot."""
        upto = self._snapshot(spark)
        folders = [f"{self.path}/{_BATCH}{n}" for n in self._entries(spark) if n > upto]
        whole = T.StructType([*self.schema.fields, _long("batches"), _long("batch_id")])
        rows = spark.createDataFrame([], whole)
        if folders:
            reader = spark.read.schema(T.StructType([*self.schema.fields, _long("batch_id")]))
            rows = rows.unionByName(
                reader.option("basePath", self.path).parquet(*folders), allowMissingColumns=True
            )
        if upto >= 0:
            folded = spark.read.schema(T.StructType([*self.schema.fields, _long("batches")])).parquet(
                f"{self.path}/snapshots/{_UPTO}{upto}"
            )
            rows = rows.unionByName(folded.withColumn("batch_id", F.lit(upto).cast("long")))
        return rows

    def newest(self, spark: SparkSession) -> DataFrame:
        """The current row of every key."""
        return self._newest(self._read(spark))

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [name for name in self.schema.names if name not in self.keys]
        last = F.max_by(F.struct(*values), "batch_id").alias("last")
        current = rows.filter("batches IS NULL").groupBy(*self.keys).agg(last)
        return current.select(*self.keys, "last.*").select(*self.schema.names)

    def batches(self, spark: SparkSession) -> DataFrame:
        """One row ``n``: how many batches have changed anything."""
        return self._batches(self._read(spark), self._snapshot(spark))

    def _batches(self, rows: DataFrame, upto: int) -> DataFrame:
        single = F.count_distinct(F.when(F.col("batch_id") > upto, F.col("batch_id")))
        return rows.agg((single + F.coalesce(F.sum("batches"), F.lit(0))).alias("n"))

    def compact(self, spark: SparkSession) -> int:
        """Fold all entries there are into a new snapshot; the last batch in it. The one
        before goes with the entries; a crash in between leaves only what no reader takes."""
        upto, before = max(self._entries(spark), default=-1), self._snapshot(spark)
        if upto > before:
            rows = self._read(spark)
            keyless = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            number = self._batches(rows, before).select(*keyless, F.col("n").alias("batches"))
            current = self._newest(rows).withColumn("batches", F.lit(None).cast("long"))
            current.unionByName(number).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/snapshots/{_UPTO}{upto}"
            )
        folded = max(upto, before)
        for n in self._entries(spark):
            if n <= folded:
                remove(spark, f"{self.path}/{_BATCH}{n}")
        for n in _numbers(spark, f"{self.path}/snapshots", _UPTO):
            if n < folded:
                remove(spark, f"{self.path}/snapshots/{_UPTO}{n}")
        return folded


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    return [int(name.removeprefix(prefix)) for name in children(spark, folder) if name.startswith(prefix)]


def position_log(path: str) -> ChangeLog:
    """Committed positions of a running job, ``topic, partition, next_offset``; its
    ``batches`` are the commits."""
    return ChangeLog(path, schemas.COMMITTED, ("topic", "partition"))


def counter_log(path: str, by: Sequence[str] = ("topic", "status")) -> ChangeLog:
    """Counters that only grow, as ``n`` per text columns ``by``."""
    return ChangeLog(path, T.StructType([*(T.StructField(name, T.StringType()) for name in by), _long("n")]), tuple(by))


def histogram_log(path: str, bounds: Sequence[float], by: Sequence[str] = ("topic",)) -> ChangeLog:
    """Histograms as ``duration_histogram`` makes them."""
    reals = [T.StructField(name, T.DoubleType()) for name in ("total", "shortest", "longest")]
    buckets = [_long(f"bucket_{i}") for i in range(len(bounds) + 1)]
    keys = [T.StructField(name, T.StringType()) for name in by]
    return ChangeLog(path, T.StructType([*keys, _long("n"), *reals, *buckets]), tuple(by))
