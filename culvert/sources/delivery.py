"""Sends whose outcome is known row by row.

A log is written whole or not at all. A sender is asked on the executors for each batch of
rows, and answers for each row; what it answers is written as a table, and positions and
metrics are taken from that.
"""

from __future__ import annotations

import io
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from culvert.functions.results import column_named
from culvert.session import written_once

#: Handed a batch of rows, gives an error text or None for each.
Send = Callable[[pa.RecordBatch], Sequence[str | None]]

#: Rows of one call of a sender.
CALL_ROWS = 1000


def send_rows(
    rows: DataFrame, connect: Callable[[], Send], carry: Sequence[str | Column], calls_of: int = CALL_ROWS
) -> DataFrame:
    """Send ``rows``; what came of each as ``write_error`` (null: acknowledged) and
    ``duration_s``, the seconds its call took, beside the columns ``carry``.

    ``connect`` makes one sender per task. A call that raises fails its rows, and the others
    go on. The rows are sent once, here: the outcomes are a written table. A task that is
    lost is run again with all its rows, so a row is sent at least once.
    """
    kept = rows.select(*carry).schema
    schema = T.StructType([*kept.fields, T.StructField("write_error", T.StringType()), T.StructField("duration_s", T.DoubleType())])
    own = [column_named(name) for name in rows.columns]
    carried = [c if isinstance(c, Column) else column_named(c) for c in carry]
    names = [f"__carry_{i}" for i in range(len(kept))]
    whole = rows.select(*own, *(c.alias(name) for c, name in zip(carried, names, strict=True)))
    sent = whole.mapInArrow(_sending(connect, rows.columns, names, kept.names, calls_of), schema)
    return written_once(sent, "sent")


def _sending(connect, own: Sequence[str], carried: Sequence[str], kept: Sequence[str], calls_of: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = None
        for batch in batches:
            for i in range(0, batch.num_rows, calls_of):
                send = connect() if send is None else send
                part = batch.slice(i, calls_of)
                n, begin = part.num_rows, time.perf_counter()
                try:
                    errors = list(send(part.select(list(own))))
                    if len(errors) != n:
                        errors = [f"the sender answered for {len(errors)} of {n} rows"] * n
                except Exception as e:  # the call failed: all its rows did
                    errors = [str(e) or type(e).__name__] * n
                took = time.perf_counter() - begin
                columns = [part.column(name) for name in carried]
                columns += [pa.array(errors, pa.string()), pa.array([took] * n, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "write_error", "duration_s"])

    return of


@dataclass(frozen=True)
class FileSend:
    """Sends rows as Parquet files under ``path``, one per call. ``refuses`` names the rows
    that are not taken, with a reason (a boolean mask over the batch)."""

    path: str
    columns: tuple[str, ...]
    refuses: Callable[[pa.RecordBatch], Sequence[bool]] | None = None
    reason: str = "refused"

    def __call__(self) -> Send:
        from pyarrow import fs, parquet

        target, folder = fs.FileSystem.from_uri(self.path)
        target.create_dir(folder)

        def send(batch: pa.RecordBatch) -> list[str | None]:
            refused = [False] * batch.num_rows if self.refuses is None else list(self.refuses(batch))
            taken = pa.Table.from_batches([batch.select(list(self.columns))]).filter(pa.array([not r for r in refused], pa.bool_()))
            if taken.num_rows:
                buffer = io.BytesIO()
                parquet.write_table(taken, buffer)
                with target.open_output_stream(f"{folder}/{uuid.uuid4().hex}.parquet") as out:
                    out.write(buffer.getvalue())
            return [self.reason if r else None for r in refused]

        return send
