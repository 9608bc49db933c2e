"""What a task holds at a time: row groups, batches and blocks of bounded size."""

import glob
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from culvert.llm import mixing, phrases


def test_rows_of_megabytes_are_written_in_small_row_groups(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.bytes(1 << 20)) for i in range(24)]
    table = mixing.stored(spark.createDataFrame(rows, "bucket int, keys binary").coalesce(1), "groups")
    files = [f for path in table.inputFiles() for f in glob.glob(path.removeprefix("file://"))]
    metadata = [pq.ParquetFile(f).metadata for f in files]
    sizes = [m.row_group(i).total_byte_size for m in metadata for i in range(m.num_row_groups)]
    assert sum(sizes) >= 24 << 20 and max(sizes) <= mixing.GROUP_BYTES + (2 << 20)
    assert sorted((r.bucket, bytes(r["keys"])) for r in table.collect()) == rows


def test_sums_of_bits_go_out_by_order():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 50_000, dtype=np.uint64))
    counts = rng.integers(1, 9, len(keys)).astype(np.uint64)
    batch = pd.DataFrame([(keys.tobytes(), counts.tobytes())], columns=["keys", "counts"])
    frames = list(mixing._bit_rows(iter([batch])))
    assert [f["number"].unique().tolist() for f in frames] == [[i] for i in range(len(mixing.ORDERS))]
    for frame in frames:
        assert sum(np.frombuffer(x, np.float32).sum() for x in (*frame["zeros"], *frame["ones"])) == 8 * counts.sum()
        assert max(len(x) for x in frame["slots"]) <= 4 << mixing.PART_BITS


def test_scoring_needs_the_stretched_tables_alone():
    rng = np.random.default_rng(3)
    tables = [rng.integers(0, 9, (2, 1 << bits), np.uint16) for bits in mixing.SLOT_BITS]
    model, keys = mixing.fresh_model(tables), rng.integers(0, 1 << 48, 5000, dtype=np.uint64)
    for table, counts in zip(mixing.stretched_tables(model), tables, strict=True):
        assert (table == mixing._stretched(*counts.astype(np.float32))).all()
    told = mixing._Costs(mixing.replace(model, tables=[]), mixing.stretched_tables(model))
    assert (told(keys) == mixing._Costs(model)(keys)).all()


class _All:
    value = np.full(1 << (phrases.FILTER_BITS - 6), ~np.uint64(0))


@pytest.mark.parametrize(
    "step, megabytes",
    [
        (phrases._words, 60),
        (phrases._suffixes(_All, None, (2,)), 120),
        (phrases._suffixes(_All, _All, (3, 4)), 120),
    ],
)
def test_a_block_takes_little_beside_its_words(step, megabytes):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(350)) for _ in range(3200)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * len(texts)})
    assert batch.column("text").nbytes >= phrases.BLOCK_BYTES
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows and peak < megabytes << 20
