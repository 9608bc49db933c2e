"""The log that running jobs poll: a file per poll, read by many tasks."""

from pathlib import Path

import pyarrow.parquet as pq

from conftest import TESTDATA
from culvert.plans import tables

SF = f"{TESTDATA}/sf0.001"


def test_a_poll_is_one_file_of_many_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "POLL_ROW_GROUP_BYTES", 4096)
    log = str(tmp_path / "log")
    for polls in (slice(0, 3), slice(3, None)):
        tables.poll_log(spark, SF, log, polls)
    want = {row.event_id: row for row in tables.records(tables.events(spark, SF)).drop("batch_id").collect()}
    ids, seen = max(want) + 1, {}
    for k in range(4):
        (file,) = Path(log, f"batch_id={k}").glob("*.parquet")
        assert pq.ParquetFile(file).num_row_groups > 1
        for row in spark.read.parquet(str(file)).collect():
            assert row.event_id * 4 // ids == k
            seen[row.event_id] = row
    assert seen == want
