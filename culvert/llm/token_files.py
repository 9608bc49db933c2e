"""Token ids in ORC: run-length coded integers, row indexes, Bloom filters on the ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from culvert.llm.tokens import encoder, portions

SCHEMA = "doc_id long, block int, block_start long, n_tokens long, ids array<int>"
#: Bytes of a stripe, the unit that readers take in parallel.
STRIPE_BYTES = 16 << 20
#: Rows behind one entry of the row index and one Bloom filter.
INDEX_ROWS = 2000
#: Rows handed to Spark at a time.
ROWS = 512


def _encoded(path: str, end_id: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block, start = encoder(path), TaskContext.get().partitionId(), 0
        for part in portions(batches):
            found, sizes = tokens.lists(part.column("text"))
            values = np.insert(found.astype(np.int32), np.cumsum(sizes), end_id)
            sizes += 1
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values)
            )
            columns = {
                "doc_id": part.column("doc_id").cast(pa.int64()),
                "block": pa.array(np.full(len(sizes), block, np.int32)),
                "block_start": pa.array(start + ends - sizes),
                "n_tokens": pa.array(sizes),
                "ids": ids,
            }
            encoded = pa.RecordBatch.from_pydict(columns)
            for i in range(0, part.num_rows, ROWS):
                yield encoded.slice(i, ROWS)
            start += int(sizes.sum())

    return of


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, partitions: int | None = None
) -> None:
    """Ids of every text, each closed by ``end_id``, as ORC files under ``path``.

    The texts are range-partitioned and sorted by ``doc_id`` (nulls first), so a file holds
    one range: a reader that wants some ids skips files and stripes by their minima and
    maxima, and row groups by their Bloom filters. ``block`` numbers the files in that
    order and ``block_start`` counts the ids in front of a document within its block. A
    null text counts as empty. Rows that repeat an id are written each, in any order among
    themselves. A text of any length is one row of one file. An empty table gives files
    without rows. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    wanted = docs.select("doc_id", "text")
    ranges = (
        wanted.repartitionByRange(partitions, "doc_id")
        if partitions
        else wanted.repartitionByRange("doc_id")
    )
    rows = ranges.sortWithinPartitions("doc_id").mapInArrow(_encoded(vocabulary, end_id), SCHEMA)
    (
        rows.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as they are; filters on ``doc_id`` reach the indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = lists.flatten().to_numpy().astype("<u4")
        ends = np.cumsum(lists.value_lengths().to_numpy())
        data, sizes = memoryview(values).cast("B"), np.diff(ends, prepend=0)
        sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        columns = {name: batch.column(name) for name in ("doc_id", "block", "block_start")}
        columns["n_tokens"] = pa.array(sizes.astype(np.int64))
        columns["ids_crc32"] = pa.array(sums, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def digest(tokens: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32``, counted from the ids themselves.

    What is gathered for ``start`` is one row per block.
    """
    rows = tokens.mapInArrow(
        _digested, "doc_id long, block int, block_start long, n_tokens long, ids_crc32 long"
    )
    sizes = tokens.groupBy("block").agg(F.sum("n_tokens").alias("size"))
    before = sizes.selectExpr(
        "block", "sum(size) OVER (ORDER BY block ROWS UNBOUNDED PRECEDING) - size AS before"
    )
    return rows.join(before, "block").select(
        "doc_id",
        (F.col("before") + F.col("block_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
