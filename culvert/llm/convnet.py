"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from culvert.llm.shared import remainder

#: Bytes of a chunk and from one chunk to the next; every byte of a text is in a chunk.
CHUNK, STEP = 512, 448
#: Numbers per byte, bytes under a filter, bytes from one place of a filter to the next.
EMBED, WIDTH, STRIDE = 8, 8, 2
FILTERS, HIDDEN = 32, 16
#: Bounds of what is fitted on the driver: labelled texts per class, and bytes of a text.
TRAINING, TRAINING_BYTES = 1500, 16_384
EPOCHS, LEARNING_RATE, DECAY, SEED = 8, 4e-3, 1e-5, 20
#: Chunks under one matrix product.
CHUNKS = 64
THRESHOLD = 0.7


@dataclass(frozen=True)
class Network:
    embed: np.ndarray  # (257, EMBED); the last row stands for no byte
    filters: np.ndarray  # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray
    hidden: np.ndarray  # (FILTERS, HIDDEN)
    hidden_bias: np.ndarray
    out: np.ndarray  # (HIDDEN,)
    out_bias: np.ndarray  # (1,)

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def chunks_of(text: str | None) -> np.ndarray:
    """Overlapping chunks that cover all bytes of a text; at least one, 256 for no byte."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    count = max(1, -(-(len(data) - (CHUNK - STEP)) // STEP))
    padded = np.full((count - 1) * STEP + CHUNK, 256, np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def _windows(net: Network, chunks: np.ndarray) -> np.ndarray:
    """(chunks, places, WIDTH * EMBED): the numbers under each place of the filters."""
    numbers = net.embed[chunks].reshape(len(chunks), CHUNK * EMBED)
    seen = np.lib.stride_tricks.sliding_window_view(numbers, WIDTH * EMBED, axis=1)
    return seen[:, :: STRIDE * EMBED]


def _forward(net: Network, chunks: np.ndarray):
    windows = np.ascontiguousarray(_windows(net, chunks))
    places = windows.reshape(-1, WIDTH * EMBED) @ net.filters
    places = places.reshape(len(chunks), -1, places.shape[1])
    best = places.argmax(axis=1)
    pooled = np.maximum(np.take_along_axis(places, best[:, None, :], 1)[:, 0] + net.bias, 0)
    hidden = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    return windows, best, pooled, hidden, hidden @ net.out + net.out_bias[0]


def chunk_logits(net: Network, chunks: np.ndarray) -> np.ndarray:
    """Max-pooled filters of each chunk, combined into one number per chunk."""
    found = []
    for i in range(0, len(chunks), CHUNKS):
        part = chunks[i : i + CHUNKS]
        windows = np.ascontiguousarray(_windows(net, part))
        places = windows.reshape(-1, WIDTH * EMBED) @ net.filters
        pooled = np.maximum(places.reshape(len(part), -1, places.shape[1]).max(axis=1) + net.bias, 0)
        found.append(np.maximum(pooled @ net.hidden + net.hidden_bias, 0) @ net.out + net.out_bias[0])
    return np.concatenate(found)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(net: Network, texts: list[str | None]) -> np.ndarray:
    """Probability of label 1: the mean of a text's chunk numbers through a sigmoid."""
    parts, sizes, pending = [], [], 0
    logits: list[np.ndarray] = []
    for text in texts:
        parts.append(chunks_of(text))
        sizes.append(len(parts[-1]))
        pending += sizes[-1]
        if pending >= CHUNKS:
            logits.append(chunk_logits(net, np.concatenate(parts)))
            parts, pending = [], 0
    if parts:
        logits.append(chunk_logits(net, np.concatenate(parts)))
    sizes = np.array(sizes)
    starts = np.cumsum(sizes) - sizes
    return _sigmoid(np.add.reduceat(np.concatenate(logits), starts) / sizes) if texts else np.zeros(0)


def train(
    texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, rate: float = LEARNING_RATE, seed: int = SEED
) -> Network:
    """Fits by Adam; a text's loss is that of the mean of its chunks. Both labels weigh
    alike. The same texts in the same order give the same network."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    net = Network(
        draw(257, EMBED, scale=0.5), draw(WIDTH * EMBED, FILTERS, scale=0.15), np.zeros(FILTERS, np.float32),
        draw(FILTERS, HIDDEN, scale=0.25), np.zeros(HIDDEN, np.float32), draw(HIDDEN, scale=0.3), np.zeros(1, np.float32),
    )
    parts = net.parts()
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    chunks = [chunks_of(t) for t in texts]
    weight = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    for _ in range(epochs):
        order, batches, batch, size = rng.permutation(len(texts)), [], [], 0
        for i in order.tolist():
            batch.append(i)
            size += len(chunks[i])
            if size >= CHUNKS:
                batches.append(batch)
                batch, size = [], 0
        for batch in [*batches, batch] if batch else batches:
            seen = np.concatenate([chunks[i] for i in batch])
            sizes = np.array([len(chunks[i]) for i in batch])
            owner = np.repeat(np.arange(len(batch)), sizes)
            windows, best, pooled, hidden, logits = _forward(net, seen)
            means = np.bincount(owner, logits, len(batch)) / sizes
            want = labels[batch]
            slope = (weight[want] * (_sigmoid(means) - want) / len(batch)).astype(np.float32)
            down = (slope / sizes)[owner].astype(np.float32)  # of each chunk's number
            d_hidden = down[:, None] * net.out * (hidden > 0)
            d_pooled = (d_hidden @ net.hidden.T) * (pooled > 0)
            # Only the place of each maximum takes part.
            at = windows[np.arange(len(seen))[:, None], best]  # (chunks, FILTERS, WIDTH * EMBED)
            d_filters = np.einsum("cfw,cf->wf", at, d_pooled)
            d_at = d_pooled[:, :, None] * net.filters.T[None]
            places = best[:, :, None] * STRIDE + np.arange(WIDTH)
            symbols = seen[np.arange(len(seen))[:, None, None], places]
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, symbols.ravel(), d_at.reshape(-1, EMBED))
            slopes = [
                d_embed, d_filters, d_pooled.sum(0), pooled.T @ d_hidden, d_hidden.sum(0),
                hidden.T @ down, np.array([down.sum()], np.float32),
            ]
            step += 1
            for p, g, m, v in zip(parts, slopes, first, second, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = TRAINING, most_bytes: int = TRAINING_BYTES, **options
) -> Network | None:
    """A network from (doc_id, text) and (doc_id, label); None unless both labels occur.

    Fitted on the driver on a bounded sample: per label at most ``sample`` texts of at most
    ``most_bytes`` bytes. The labels are sampled first, by a hash of the id, to about one
    and a half times as many, so what is broadcast to the scan of the texts is bounded too.
    """
    usable = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64(F.lit(7), "doc_id")
    point = F.pmod(order, F.lit(1 << 30)) / (1 << 30)
    chance = F.when(F.col("label") == 1, 1.5 * sample / counts[1]).otherwise(1.5 * sample / counts[0])
    chosen = usable.filter(point < chance).withColumn("order", order)
    short = docs.filter(F.octet_length("text") <= most_bytes)
    rows = short.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "order").toPandas()
    rows = rows.sort_values(["order", "doc_id", "text"], kind="stable").groupby("label").head(sample)
    if rows["label"].nunique() < 2:
        return None
    return train(rows["text"].tolist(), rows["label"].to_numpy(np.int64), **options)


def score(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on).

    A text is scored whole, by all its chunks. A null or empty text is one chunk without
    bytes. When nothing was learned all scores are 0.5. Ties and repeated rows are scored
    each; own columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    others = docs.drop("score", "predicted")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = part.column("text").to_pylist()
                found = np.full(len(texts), 0.5) if net is None else score_texts(net, texts)
                columns = {name: part.column(name) for name in part.schema.names}
                columns["score"] = pa.array(found.astype(float))
                columns["predicted"] = pa.array((found >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema.fields)
    return others.mapInArrow(scored, f"{schema}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, divisor: int = 4, rest: int = 2, **options) -> DataFrame:
    """``score`` with a network of the labelled rows whose crc32 of the id as text does not
    leave ``rest``, and ``held_out``. Of ``labels`` only ``doc_id`` and ``quality`` are
    read; where an id is labelled twice the larger label counts."""
    left = F.coalesce(remainder("doc_id", divisor) == rest, F.lit(True))
    marked = docs.withColumn("held_out", left)
    own = labels.groupBy("doc_id").agg(F.max("quality").alias("label"))
    taught = F.coalesce(remainder("doc_id", divisor) != rest, F.lit(False))
    training = marked.filter(~F.col("held_out")).select("doc_id", "text")
    return score(marked, fit(training, own.filter(taught), **options))
