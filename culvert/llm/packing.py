"""Cost-balanced packing of token ids into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from culvert.llm.tokens import encoder, portions

CAPACITY = 1024
#: Cost of attending within a piece of n ids: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 512
#: Sequences that are balanced against each other.
POOL = 256
#: Texts packed between two batches of pieces.
ROWS = 256

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def cost(length):
    return LINEAR * length + QUADRATIC * length * length


def assign(lengths: np.ndarray, capacities: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Fills the sequences: (item, start in it, length, sequence, offset) per piece, and
    (item, start, length) of what found no room.

    The longest item goes first, to the sequence of the lowest cost that has room for all
    of it. If none has, it is cut to fill the cheapest with any room.
    """
    room, price = capacities.astype(np.int64).copy(), np.zeros(len(capacities))
    placed, left = [], []
    for item in np.argsort(-lengths, kind="stable").tolist():
        start, rest = 0, int(lengths[item])
        while rest:
            fits = np.flatnonzero(room >= rest)
            if not len(fits):
                fits = np.flatnonzero(room)
                if not len(fits):
                    left.append((item, start, rest))
                    break
            to = int(fits[np.argmin(price[fits])])
            length = min(rest, int(room[to]))
            placed.append((item, start, length, to, int(capacities[to] - room[to])))
            room[to] -= length
            price[to] += cost(length)
            start, rest = start + length, rest - length
    return placed, left


def closing(total: int, capacity: int) -> np.ndarray:
    """Full sequences for ``total`` ids, and powers of two for what is left of them."""
    full, rest = divmod(total, capacity)
    powers = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return np.array([capacity] * full + powers, np.int64)


class _Packer:
    def __init__(self, partition: int, capacity: int, pool: int):
        self.next_id, self.capacity, self.limit = partition << 33, capacity, pool * capacity
        self.pool: list[tuple[int | None, int, np.ndarray, int]] = []  # doc, start, ids, tokens
        self.size = 0
        self.rows: list[tuple] = []

    def _emit(self, doc, start, ids, tokens, sequence, offset) -> None:
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        self.rows.append((doc, start, len(ids), crc, tokens, sequence, offset))

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        """What fills whole sequences does so; the rest waits in the pool."""
        tokens, full = len(ids), len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self._emit(doc, start, ids[start : start + self.capacity], tokens, self.next_id, 0)
            self.next_id += 1
        if tokens > full:
            self.pool.append((doc, full, ids[full:].copy(), tokens))
            self.size += tokens - full
        if self.size >= self.limit:
            self.flush(np.full(self.size // self.capacity, self.capacity))

    def flush(self, capacities: np.ndarray) -> None:
        lengths = np.array([len(x[2]) for x in self.pool], np.int64)
        placed, left = assign(lengths, capacities)
        for item, start, length, to, offset in placed:
            doc, first, ids, tokens = self.pool[item]
            self._emit(doc, first + start, ids[start : start + length], tokens, self.next_id + to, offset)
        self.next_id += len(capacities)
        self.pool = [
            (doc, first + start, ids[start : start + length], tokens)
            for item, start, length in left
            for doc, first, ids, tokens in [self.pool[item]]
        ]
        self.size = sum(len(x[2]) for x in self.pool)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        self.rows = []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _packed(path: str, close_id: int, capacity: int, pool: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        packer = _Packer(TaskContext.get().partitionId(), capacity, pool)
        for part in portions(batches):
            ids, sizes = tokens.lists(part.column("text"))
            ends = np.cumsum(sizes)
            rows = zip(part.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True)
            for i, (doc, start, stop) in enumerate(rows, 1):
                packer.add(doc, np.append(ids[start:stop], tokens.dtype.type(close_id)))
                if i % ROWS == 0:
                    yield packer.take()
            yield packer.take()
        if packer.size:
            packer.flush(closing(packer.size, capacity))
        yield packer.take()

    return of


def pack(
    docs: DataFrame, vocabulary: str, close_id: int, capacity: int = CAPACITY, pool: int = POOL
) -> DataFrame:
    """One row per piece of a document: where its ids start in the document, how many they
    are, their crc32, and their place: ``sequence_id`` and ``offset``.

    Every task packs the texts it reads, ``pool`` sequences at a time, without a shuffle: a
    document's whole sequences as they come, the rest by descending length into the
    sequence of the lowest attention cost that has room. A pool is filled to the last id.
    What remains at the end of a task fills sequences whose lengths are powers of two, so
    nothing is padded. Sequence numbers begin at 2**33 times the number of the task, and
    the same scan gives the same pieces when a task is run again.

    A null or empty text is one piece, ``close_id``. Repeated rows are packed each. Of
    pieces of one length the first read goes first, of sequences of one cost the first with
    room is taken. A text of any length is encoded whole and cut. An empty table gives no
    pieces. Of the table only ``doc_id`` and ``text`` are read, whatever else it holds.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _packed(vocabulary, close_id, capacity, pool), SCHEMA
    )
