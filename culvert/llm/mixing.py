"""Language-model scoring by logistic context mixing over the bits of a text.

Every bit is predicted by several hashed contexts, the bytes before it by order and the
bits of its own byte. Weights chosen by a gate mix the predictions in the logistic domain,
and a table of outcomes refines the mixture. Counts come from all training texts. The
weights are learned online over all training events, each seen as if its own occurrence
were not yet counted, and the refining table is gathered behind them.

A prediction depends on a byte and the ``max(ORDERS)`` bytes before it, so corpus events
are gathered as counts of such n-grams, and a scoring task works out the cost of an n-gram
once. A unigram base score per text is gathered in the same scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from culvert.llm import shared, wordhash
from culvert.llm.shared import remainder

#: Bytes of context per predictor, and bits of its table of hashed contexts. With 4 bytes
#: per place this bounds what is broadcast, whatever the size of the corpus.
ORDERS = (1, 2, 3, 4, 5)
SLOT_BITS = (16, 18, 20, 21, 22)
#: Added to the counts of both bits.
DELTA = 0.4
LIMIT = 8.0
#: Passes of online learning, n-grams per step, and its rate.
PASSES, STEP, RATE = 2, 2048, 0.05
#: Steps of the refining table and the weight of its starting values.
BINS, PRIOR = 24, 50.0
#: Words that share one list of distinct words.
SEGMENT_WORDS = 1 << 18
#: Bytes worked on at a time, when n-grams are gathered and when texts are scored.
BLOCK_BYTES, SCORED_BYTES = 1 << 20, 1 << 18
#: Bytes of gathered n-grams that a task hands on at a time.
SENT_BYTES = 4 << 20
#: Bytes of a row group of what is written between steps. A row may hold megabytes, and a
#: task that writes or reads holds a row group.
GROUP_BYTES = 4 << 20
#: Bits of the range of a table that one task sums.
PART_BITS = 16
#: Bits of the cache of costs of a scoring task.
CACHE_BITS = 20

_SPAN = max(ORDERS)
_END = 0xFF  # no byte of UTF-8; ends a text, and stands in front of it


def stored(df: DataFrame, name: str) -> DataFrame:
    return shared.stored(df, name, GROUP_BYTES)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One code per byte of each text and its end: the byte behind the bytes before it.
    And where the codes of each text begin, with their number last."""
    count = len(offsets) - 1
    sizes = np.diff(offsets)
    begin = offsets[:-1] + _SPAN * (np.arange(count) + 1)
    buffer = np.full(int(offsets[-1]) + _SPAN * (count + 1), _END, np.uint64)
    if len(data):
        buffer[np.repeat(begin - offsets[:-1], sizes) + np.arange(len(data))] = data
    code = np.zeros(len(buffer) - _SPAN, np.uint64)
    for place in range(_SPAN + 1):
        code = (code << np.uint64(8)) | buffer[place : place + len(code)]
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    at = np.repeat(begin - _SPAN - first[:-1], sizes + 1) + np.arange(first[-1])
    return code[at], first


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.add.reduceat(counts, new)


def _blocks(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    size = batch.column("text").nbytes // max(1, batch.num_rows)
    step = max(1, most // max(1, size))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


_GATHERED = "kind string, bucket int, segment long, keys binary, a binary, b binary, c binary, d binary, e binary"


def _gather(buckets: int):
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    names = [x.split()[0] for x in _GATHERED.split(", ")]

    def rows_of(columns: dict) -> pa.RecordBatch:
        kinds = {"kind": pa.string(), "bucket": pa.int32(), "segment": pa.int64()}
        return pa.RecordBatch.from_pydict(
            {name: pa.array(x, kinds.get(name, pa.binary())) for name, x in columns.items()}
        )

    def word_rows(hashes, text, train, keys, segment) -> pa.RecordBatch:
        """Per bucket: distinct words, their training counts, numbers of texts that have
        them, those texts, and how often each has the word. The first bucket has the keys of
        the texts."""
        order = np.argsort(hashes, kind="stable")
        hashes, text = hashes[order], text[order]
        word = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool)
        pair = word.copy()
        if len(hashes):
            pair[1:] |= text[1:] != text[:-1]
        at = np.flatnonzero(pair)
        times = np.diff(np.append(at, len(hashes)))
        words = np.flatnonzero(word[at])
        spread = np.diff(np.append(words, len(at)))
        known = np.add.reduceat(times * train[text[at]], words) if len(at) else times
        unique = hashes[at][words] if len(at) else hashes
        cuts = np.concatenate([[0], np.searchsorted(unique, edges), [len(unique)]])
        pairs = np.append(words, len(at))
        parts = [
            (unique[a:b], known[a:b].astype(np.uint32), spread[a:b].astype(np.uint32),
             text[at][pairs[a] : pairs[b]].astype(np.uint32), times[pairs[a] : pairs[b]].astype(np.uint32))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]
        columns = {"kind": ["words"] * buckets, "bucket": range(buckets), "segment": [segment] * buckets}
        columns["keys"] = [keys.tobytes(), *[None] * (buckets - 1)]
        columns |= {name: [p[i].tobytes() for p in parts] for i, name in enumerate("abcde")}
        return rows_of(columns)

    def gram_rows(keys, counts) -> Iterator[pa.RecordBatch]:
        # A context and all bytes that follow it share a bucket.
        bucket = np.searchsorted(edges, wordhash.mixed(keys >> np.uint64(8)), "right")
        order = np.argsort(bucket, kind="stable")
        keys, counts = keys[order], counts[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        step = max(1, SENT_BYTES * buckets // max(1, 16 * len(keys)))
        for i in range(0, buckets, step):
            some = spans[i : i + step]
            columns = {"kind": ["grams"] * len(some), "bucket": range(i, i + len(some))}
            columns["a"] = [keys[a:b].tobytes() for a, b in some]
            columns["b"] = [counts[a:b].astype(np.uint64).tobytes() for a, b in some]
            none = {name: [None] * len(some) for name in ("segment", "keys", "c", "d", "e")}
            yield rows_of({name: (columns | none)[name] for name in names})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, text, train, keys = [], [], [], []
        segment, texts, held = TaskContext.get().partitionId() << 33, 0, 0
        grams, waiting = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), []
        for batch in batches:
            for part in _blocks(batch, BLOCK_BYTES):
                data, offsets = wordhash.bytes_of(part.column("text"))
                keys.append(part.column("key").to_numpy())
                taught = ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                words = wordhash.words_of(data, offsets, wordhash.NOT_BLANK, wordhash.LOWER)
                hashes.append(words.hashes)
                text.append(words.text + texts)
                train.append(taught)
                texts += part.num_rows
                held += len(words.hashes)
                codes, at = ngrams(data, offsets)
                found, times = np.unique(codes[np.repeat(taught, np.diff(at))], return_counts=True)
                waiting.append((found, times))
                if sum(len(k) for k, _ in waiting) > 1 << 20:
                    grams = _summed(*(np.concatenate(x) for x in zip(grams, *waiting, strict=True)))
                    waiting = []
                if held >= SEGMENT_WORDS:
                    yield word_rows(*map(np.concatenate, (hashes, text, train, keys)), segment)
                    hashes, text, train, keys = [], [], [], []
                    segment, texts, held = segment + 1, 0, 0
        if texts:
            yield word_rows(*map(np.concatenate, (hashes, text, train, keys)), segment)
        yield from gram_rows(*_summed(*(np.concatenate(x) for x in zip(grams, *waiting, strict=True))))

    return of


def _word_counts(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket of words: per segment the sums over each text's words of log10(c + 1)
    and the numbers of known words; and a row with the distinct and all training words."""
    split = lambda name, kind: [np.frombuffer(x, kind) for x in group[name]]
    words, known, spread, text, times = split("a", np.uint64), *(split(x, np.uint32) for x in "bcde")
    _, number = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(number, np.concatenate(known).astype(float))
    rows, at = [], 0
    for i, (segment, keys) in enumerate(zip(group["segment"], group["keys"], strict=True)):
        own = total[number[at : at + len(words[i])]]
        at += len(words[i])
        each = np.repeat(own, spread[i])
        sums = np.bincount(text[i], times[i] * np.log10(each + 1))
        seen = np.bincount(text[i], times[i] * (each > 0)).astype(np.int64)
        rows.append((segment, keys, sums.tobytes(), seen.tobytes(), None, None))
    rows.append((None, None, None, None, int((total > 0).sum()), int(total.sum())))
    return pd.DataFrame(rows, columns=["segment", "keys", "sums", "seen", "distinct", "total"])


def _text_sums(group: pd.DataFrame) -> pd.DataFrame:
    """Of one segment: the sums of its texts over all buckets, in bucket order. A bucket's
    list ends with the last text that has a word in it."""
    order = group.sort_values("bucket")
    keys = np.frombuffer(order["keys"].iloc[0], np.int64)
    sums, seen = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
    for a, b in zip(order["sums"], order["seen"], strict=True):
        part = np.frombuffer(a, float)
        sums[: len(part)] += part
        seen[: len(part)] += np.frombuffer(b, np.int64)
    return pd.DataFrame({"key": keys, "log_sum": sums, "n_known": seen})


def _slots(order: int, bits: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Place of (context, bits of the byte so far) in the table of an order."""
    code = ((context & np.uint64((1 << 8 * order) - 1)) << np.uint64(8)) | node
    if 8 * order + 8 <= bits:
        return code.astype(np.int64)
    code = (code + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
    return ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def _bit_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sparse sums for the tables: (order, range, slots, zeros, ones)."""
    for batch in batches:
        for a, b in zip(batch["keys"], batch["counts"], strict=True):
            keys, counts = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64).astype(float)
            for number, (order, bits) in enumerate(zip(ORDERS, SLOT_BITS, strict=True)):
                rows, node, slots, ones = [], np.ones(len(keys), np.uint64), [], []
                for place in range(7, -1, -1):
                    bit = (keys >> np.uint64(place)) & np.uint64(1)
                    slots.append(_slots(order, bits, keys >> np.uint64(8), node))
                    ones.append(bit == 1)
                    node = (node << np.uint64(1)) | bit
                slot, one = np.concatenate(slots), np.concatenate(ones)
                unique, at = np.unique(slot, return_inverse=True)
                each = np.tile(counts, 8)
                n1 = np.bincount(at, each * one, len(unique))
                n0 = np.bincount(at, each * ~one, len(unique))
                size = 1 << min(bits, PART_BITS)
                cuts = np.searchsorted(unique, np.arange(0, (1 << bits) + 1, size))
                for part, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                    if y > x:
                        within = (unique[x:y] - part * size).astype(np.uint32)
                        rows.append((number, part, within.tobytes(), n0[x:y].astype(np.float32).tobytes(), n1[x:y].astype(np.float32).tobytes()))
                yield pd.DataFrame(rows, columns=["number", "part", "slots", "zeros", "ones"])


def _table_part(group: pd.DataFrame) -> pd.DataFrame:
    """One range of a table: both counts, held to 16 bits at their proportion."""
    number, part = int(group["number"].iloc[0]), int(group["part"].iloc[0])
    size = 1 << min(SLOT_BITS[number], PART_BITS)
    n = np.zeros((2, size))
    for slots, zeros, ones in zip(group["slots"], group["zeros"], group["ones"], strict=True):
        at = np.frombuffer(slots, np.uint32)
        n[0][at] += np.frombuffer(zeros, np.float32)
        n[1][at] += np.frombuffer(ones, np.float32)
    most = n.max(axis=0)
    scale = np.where(most > 65535, 65535 / np.maximum(most, 1), 1.0)
    n = np.where(n > 0, np.maximum(np.rint(n * scale), 1), 0).astype(np.uint16)
    return pd.DataFrame([(number, part, n.tobytes())], columns=["number", "part", "counts"])


@dataclass(frozen=True)
class Model:
    """``tables``: counts of both bits per order, (2, slots); ``weights``: (gate, order);
    ``refined``: probability of a one per (byte before, step of the mixture)."""

    tables: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray


_STEPS = np.linspace(-LIMIT, LIMIT, BINS)


def _stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + DELTA) / (n0 + DELTA)), -LIMIT, LIMIT).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def fresh_model(tables: list[np.ndarray]) -> Model:
    steps = np.tile(_sigmoid(_STEPS), (256, 1))
    return Model(tables, np.full((256, len(ORDERS)), 0.4), steps)


def _inputs(model: Model, keys: np.ndarray, node: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Predictions of one bit in the logistic domain, (orders, n), with one occurrence of
    the bit taken out of the counts."""
    out = np.empty((len(ORDERS), len(keys)), np.float32)
    for i, (order, bits) in enumerate(zip(ORDERS, SLOT_BITS, strict=True)):
        at = _slots(order, bits, keys >> np.uint64(8), node)
        n0, n1 = model.tables[i][0][at].astype(np.float32), model.tables[i][1][at].astype(np.float32)
        out[i] = _stretched(np.maximum(n0 - (1 - bit), 0), np.maximum(n1 - bit, 0))
    return out


def stretched_tables(model: Model) -> list[np.ndarray]:
    """What scoring reads of the tables; of the size of the counts, worked out by ranges."""
    out = [np.empty(t.shape[1], np.float32) for t in model.tables]
    for table, counts in zip(out, model.tables, strict=True):
        for i in range(0, len(table), 1 << 16):
            table[i : i + (1 << 16)] = _stretched(*counts[:, i : i + (1 << 16)].astype(np.float32))
    return out


def _refine(model: Model, before: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The refined probability, the lower step and the share of the upper one."""
    at = (np.clip(x, -LIMIT, LIMIT) + LIMIT) * ((BINS - 1) / (2 * LIMIT))
    low = np.minimum(at.astype(np.int64), BINS - 2)
    high = at - low
    p = model.refined[before, low] * (1 - high) + model.refined[before, low + 1] * high
    return p, low, high


def cost_bits(model: Model, keys: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Bits that each n-gram's last byte costs. ``tables``: ``stretched_tables`` of the model."""
    total, context = np.zeros(len(keys)), keys >> np.uint64(8)
    node = np.ones(len(keys), np.uint64)
    before = ((keys >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
    for place in range(7, -1, -1):
        bit = ((keys >> np.uint64(place)) & np.uint64(1)).astype(np.int64)
        weights, x = model.weights[node.astype(np.int64)], np.zeros(len(keys))
        for i, (order, bits) in enumerate(zip(ORDERS, SLOT_BITS, strict=True)):
            x += weights[:, i] * tables[i][_slots(order, bits, context, node)]
        p = (_sigmoid(np.clip(x, -30, 30)) + _refine(model, before, x)[0]) / 2
        p = np.clip(p, 1e-6, 1 - 1e-6)
        total -= np.log2(np.where(bit == 1, p, 1 - p))
        node = (node << np.uint64(1)) | bit.astype(np.uint64)
    return total


def learn(model: Model, keys: np.ndarray, counts: np.ndarray) -> tuple[Model, float, np.ndarray]:
    """One online pass over n-grams and how often each occurs: the model with new weights,
    its cost in bits, and the outcomes per step for the refining table, (2, 256, BINS)."""
    weights = model.weights.copy()
    outcomes = np.zeros((2, 256, BINS))
    bits, order = 0.0, np.argsort(wordhash.mixed(keys))
    for i in range(0, len(keys), STEP):
        key = keys[order[i : i + STEP]]
        times = counts[order[i : i + STEP]].astype(float)
        node = np.ones(len(key), np.uint64)
        before = ((key >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
        for place in range(7, -1, -1):
            bit = ((key >> np.uint64(place)) & np.uint64(1)).astype(np.int64)
            gate = node.astype(np.int64)
            x = _inputs(model, key, node, bit.astype(np.float32))
            mixed = np.clip((x * weights[gate].T).sum(axis=0), -30, 30)
            p = np.clip(_sigmoid(mixed), 1e-6, 1 - 1e-6)
            bits -= float((times * np.log2(np.where(bit == 1, p, 1 - p))).sum())
            slope = np.empty((len(ORDERS), 256))
            bend = np.empty((len(ORDERS), 256))
            for k in range(len(ORDERS)):
                slope[k] = np.bincount(gate, times * (bit - p) * x[k], 256)
                bend[k] = np.bincount(gate, times * p * (1 - p) * x[k] * x[k], 256)
            mass = np.bincount(gate, times, 256)
            weights += (RATE * slope / (bend + 0.05 * mass + 1e-9)).T * (mass > 0)[:, None]
            at = (np.clip(mixed, -LIMIT, LIMIT) + LIMIT) * ((BINS - 1) / (2 * LIMIT))
            low = np.minimum(at.astype(np.int64), BINS - 2)
            for step, share in ((low, 1 - (at - low)), (low + 1, at - low)):
                place_of = before * BINS + step
                outcomes[0] += np.bincount(place_of, times * share, 256 * BINS).reshape(256, BINS)
                outcomes[1] += np.bincount(place_of, times * share * bit, 256 * BINS).reshape(256, BINS)
            node = (node << np.uint64(1)) | bit.astype(np.uint64)
    return replace(model, weights=weights), bits, outcomes


def fit(grams: DataFrame) -> Model:
    """The model of gathered n-grams: (keys, counts), one row per bucket.

    The tables are summed by range on the executors; the driver takes their bounded whole.
    In each pass every bucket learns online from the weights of the pass before, and the
    weights are averaged by the events they have seen.
    """
    spark = grams.sparkSession
    parts = (
        grams.mapInPandas(_bit_rows, "number int, part int, slots binary, zeros binary, ones binary")
        .groupBy("number", "part")
        .applyInPandas(_table_part, "number int, part int, counts binary")
    )
    tables = [np.zeros((2, 1 << bits), np.uint16) for bits in SLOT_BITS]
    for row in parts.toLocalIterator():
        size = 1 << min(SLOT_BITS[row.number], PART_BITS)
        found = np.frombuffer(row.counts, np.uint16).reshape(2, size)
        tables[row.number][:, row.part * size : (row.part + 1) * size] = found
    model = fresh_model(tables)
    for _ in range(PASSES):
        told = spark.sparkContext.broadcast(model)

        def one_pass(batches: Iterator[pd.DataFrame], told=told) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for a, b in zip(batch["keys"], batch["counts"], strict=True):
                    keys, counts = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    if len(keys):
                        after, _, outcomes = learn(told.value, keys, counts)
                        row = (int(counts.sum()), after.weights.tobytes(), outcomes.tobytes())
                        yield pd.DataFrame([row], columns=["events", "weights", "outcomes"])

        learned = sorted(
            (r.events, bytes(r.weights), bytes(r.outcomes))
            for r in grams.mapInPandas(one_pass, "events long, weights binary, outcomes binary").toLocalIterator()
        )
        told.unpersist()
        if not learned:
            break
        events = sum(n for n, _, _ in learned)
        weights, outcomes = np.zeros((256, len(ORDERS))), np.zeros((2, 256, BINS))
        for n, w, o in learned:
            weights += n / events * np.frombuffer(w).reshape(256, len(ORDERS))
            outcomes += np.frombuffer(o).reshape(2, 256, BINS)
        refined = (outcomes[1] + PRIOR * _sigmoid(_STEPS)) / (outcomes[0] + PRIOR)
        model = replace(model, weights=weights, refined=refined)
    return model


class _Costs:
    """Costs of n-grams, remembered by hash; what is forgotten is worked out again. With the
    ``tables`` stretched, those of the model are not read."""

    def __init__(self, model: Model, tables: list[np.ndarray] | None = None):
        self.model, self.tables = model, stretched_tables(model) if tables is None else tables
        self.keys = np.full(1 << CACHE_BITS, ~np.uint64(0), np.uint64)
        self.bits = np.zeros(1 << CACHE_BITS, np.float32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.bits[at].astype(np.float64)
        missed = np.flatnonzero(self.keys[at] != keys)
        if len(missed):
            unique, where = np.unique(keys[missed], return_inverse=True)
            found = np.concatenate(
                [cost_bits(self.model, unique[i : i + 65536], self.tables) for i in range(0, len(unique), 65536)]
            ).astype(np.float32)
            out[missed] = found[where]
            place = ((unique * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            self.keys[place] = unique
            stays = self.keys[place] == unique  # of n-grams of one place one stays
            self.bits[place[stays]] = found[stays]
        return out


def _scored(told):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = _Costs(*told.value)
        for batch in batches:
            for part in _blocks(batch, SCORED_BYTES):
                data, offsets = wordhash.bytes_of(part.column("text"))
                inside = wordhash.NOT_BLANK[data]
                begins = inside.copy()
                begins[1:] &= ~inside[:-1]
                cut = offsets[:-1][offsets[:-1] < len(data)]
                begins[cut] = inside[cut]
                before = np.concatenate([[0], np.cumsum(begins)])
                codes, first = ngrams(data, offsets)
                bits = np.add.reduceat(costs(codes), first[:-1]) if len(first) > 1 else np.zeros(0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": part.column("key"),
                        "doc_id": part.column("doc_id"),
                        "held_out": part.column("held_out"),
                        "n_words": pa.array(np.diff(before[offsets]), pa.int64()),
                        "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                        "bits": pa.array(bits, pa.float64()),
                    }
                )

    return of


def holds_out(doc_id: Column, divisor: int = 7, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is held out."""
    return F.coalesce(remainder(doc_id, divisor) == rest, F.lit(True))


def score(docs: DataFrame, divisor: int = 7, rest: int = 2) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens`` (words and an end),
    ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram, log10), ``score`` (log10
    of the model's probability of the bytes and the end) and ``bits_per_byte``.

    Learned from the texts that are not held out, whole. The words of a segment are sent
    once, to buckets by hash, and their counts come back as sums per text; n-grams are
    summed per task before they are sent. No key is hot, as a task sends each once.

    A null or empty text is its end alone. With nothing to learn from, a token is sure
    (score 0 of 1 kind) and the model has no counts. Repeated rows are scored each. A text
    of any length is scored whole. An empty table gives an empty result. Only ``doc_id``
    and ``text`` are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        holds_out(F.col("doc_id"), divisor, rest).alias("held_out"),
        # Told by what a row holds: another scan might number the rows otherwise.
        F.xxhash64(docs["doc_id"].cast("long"), "text").alias("key"),
    )
    gathered = numbered.select("key", "text", "held_out").mapInArrow(_gather(buckets), _GATHERED)
    gathered = stored(gathered, "mixing-gathered")

    def counts_of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return _word_counts(group).assign(bucket=key[0])

    counted = gathered.filter("kind = 'words'").groupBy("bucket").applyInPandas(
        counts_of,
        "bucket int, segment long, keys binary, sums binary, seen binary, distinct long, total long",
    )
    counted = stored(counted, "mixing-counted")
    words = counted.agg(
        F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")
    ).first()
    ends = numbered.filter(~F.col("held_out")).count()
    total, distinct = int(words["total"]) + ends, int(words["distinct"]) + (ends > 0)

    def merged(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, np.uint64) for x in group["a"]]
        times = [np.frombuffer(x, np.uint64) for x in group["b"]]
        found, sums = _summed(np.concatenate(keys), np.concatenate(times))
        return pd.DataFrame([(found.tobytes(), sums.tobytes())], columns=["keys", "counts"])

    grams = gathered.filter("kind = 'grams'").groupBy("bucket").applyInPandas(merged, "keys binary, counts binary")
    model = fit(stored(grams, "mixing-grams"))
    # A scoring task reads the stretched tables alone, so they go out in place of the counts.
    told = spark.sparkContext.broadcast((replace(model, tables=[]), stretched_tables(model)))
    scored = numbered.mapInArrow(
        _scored(told), "key long, doc_id long, held_out boolean, n_words long, n_bytes long, bits double"
    )
    # Rows of one key hold the same id and text, and so have the same sums.
    base = counted.filter("segment IS NOT NULL").groupBy("segment").applyInPandas(
        _text_sums, "key long, log_sum double, n_known long"
    ).groupBy("key").agg(F.min("log_sum").alias("log_sum"), F.min("n_known").alias("n_known"))
    n_tokens = F.col("n_words") + 1
    whole = F.lit(math.log10(total + distinct + 1))
    return scored.join(base, "key").select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_sum") + math.log10(ends + 1) - n_tokens * whole).alias("base_score"),
        (-F.col("bits") * math.log10(2)).alias("score"),
        (F.col("bits") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
