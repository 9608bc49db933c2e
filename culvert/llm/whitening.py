"""Whitening of embedding vectors by a polarisation covariance.

Covariances are differences of variances: of two dimensions and their sum,
``2 * cov(i, j) = var(i + j) - var(i) - var(j)``. So all that is aggregated are squares of
centred values, one per dimension and one per sum of two dimensions. Vectors are whole
numbers, and so are the sums: nothing is rounded before the matrix is divided.

The mean of a dimension is ``m + r / n`` with whole ``m`` and ``0 <= r < n``. The squares of
``x - m`` stay small however many vectors there are, and what the rest ``r`` adds is known:
``sum((n * x - S) ** 2) = n * n * sum((x - m) ** 2) - n * r * r``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from culvert.llm.shared import stored

#: Steps of one between two whole numbers of an entry.
SCALE = 256
#: Entries whose whole number is this large or larger count as not finite: with some of them
#: the sums of a table would no longer be whole numbers of 38 digits.
LARGEST = 1 << 40
#: An eigenvalue below this share of the largest one is rounding: its component has no length.
FLAT = 1e-12
#: Vectors looked at together.
ROWS = 4096

_WHOLE = pa.decimal128(38, 0)


def whole_vector(vector: str | Column, scale: int = SCALE) -> Column:
    """``floor(scale * entry)`` of every entry, null for a vector that is null, empty, or
    holds an entry that is null, not finite or too large."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    vector = vector.cast("array<double>")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale) >= float(LARGEST)))
    usable = (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _added(squares: np.ndarray) -> list[int]:
    """Exact column sums of squares; ``squares`` holds the values to be squared."""
    most = int(np.abs(squares).max(initial=0)) ** 2
    step = (1 << 62) // max(most, 1)
    if not step:  # a square alone passes 64 bits
        return [sum(int(v) * int(v) for v in column) for column in squares.T]
    parts = [squares[i : i + step] for i in range(0, len(squares), step)]
    return [sum(x) for x in zip(*((p * p).sum(axis=0).tolist() for p in parts), strict=True)]


def _sums(width: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(i, n, total) per dimension and task."""
        n, totals = 0, [0] * width
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                x = _matrix(batch.column("x").slice(i, ROWS), width)
                n += len(x)
                totals = [a + b for a, b in zip(totals, x.sum(axis=0).tolist(), strict=True)]
        if n:
            columns = [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64())]
            columns.append(pa.array([Decimal(t) for t in totals], _WHOLE))
            yield pa.RecordBatch.from_arrays(columns, ["i", "n", "total"])

    return of


def _squares(means: np.ndarray):
    width = len(means)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(i, j, total) per task: sums of squares of the centred dimension i, where j = i,
        and of the sum of the centred dimensions i < j."""
        totals = [[0] * (width - i) for i in range(width)]
        some = False
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                some = True
                y = _matrix(batch.column("x").slice(k, ROWS), width) - means
                for i in range(width):
                    sums = y[:, i:] + y[:, i : i + 1]
                    sums[:, 0] = y[:, i]
                    totals[i] = [a + b for a, b in zip(totals[i], _added(sums), strict=True)]
        for i in range(width if some else 0):
            columns = [
                pa.array([i] * (width - i), pa.int32()),
                pa.array(range(i, width), pa.int32()),
                pa.array([Decimal(t) for t in totals[i]], _WHOLE),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return of


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with the sum ``S`` per dimension; ``values`` and ``vectors``
    (one per row) of the covariance, falling; the share of variance ``explained`` by each."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole parts of the means, and the rests below n."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([m for m, _ in parts], np.int64), np.array([r for _, r in parts], np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers on all components, each divided by the root of its
        eigenvalue; nan on a component without length."""
        means, rests = self.centre()
        centred = (x - means).astype(np.float64) - rests / self.n
        flat = self.values <= FLAT * max(self.values[0], 0.0)
        roots = np.sqrt(np.where(flat, 1.0, self.values))
        out = centred @ self.vectors.T / roots
        out[:, flat] = np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n * x - S) ** 2``, exact at any size."""
        means, rests = self.centre()
        y = x - means
        most = (self.n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * self.width
        if most < 1 << 62:
            z = self.n * y - rests
            return (z * z).sum(axis=1).tolist()
        rest = [int(r) for r in rests]
        return [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y]


def covariance_of(n: int, sums: tuple[int, ...], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance with divisor n from sums of squares centred at the whole means; every
    entry is rounded once."""
    rest = [s % n for s in sums]
    width = len(sums)

    def spread(i: int, j: int) -> int:  # n ** 3 times the variance of i, or of i + j
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares[i, j] - n * r * r

    own = [spread(i, i) for i in range(width)]
    out = np.empty((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(own[i], n**3))
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = float(Fraction(spread(i, j) - own[i] - own[j], 2 * n**3))
    return out


def fit(fitting: DataFrame, width: int) -> Whitening:
    """The whitening of the distinct vectors ``fitting.x``, all of ``width`` entries.

    The driver takes one row per dimension and one per pair of dimensions, whatever the
    number of vectors; each task sends as many.
    """
    rows = (
        fitting.mapInArrow(_sums(width), "i int, n long, total decimal(38,0)")
        .groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect()
    )
    by_dimension = {r.i: int(r.total) for r in rows}
    n, sums = int(rows[0].n), tuple(by_dimension[i] for i in range(width))
    means = np.array([s // n for s in sums], np.int64)
    squares = (
        fitting.mapInArrow(_squares(means), "i int, j int, total decimal(38,0)")
        .groupBy("i", "j")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    matrix = covariance_of(n, sums, {(r.i, r.j): int(r.total) for r in squares})
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1].copy(), vectors.T[::-1].copy()
    # Either sign would do; the largest entry of a component is positive.
    lead = vectors[np.arange(width), np.abs(vectors).argmax(axis=1)]
    vectors *= np.where(lead < 0, -1.0, 1.0)[:, None]
    trace = float(np.trace(matrix))
    return Whitening(n, sums, values, vectors, values / trace if trace > 0 else np.zeros(width))


def _products(model: Whitening, components: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(sums, products) of the whitened vectors of a task."""
        sums, products = np.zeros(components), np.zeros((components, components))
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                w = model.project(_matrix(batch.column("x").slice(k, ROWS), model.width))[:, :components]
                sums += w.sum(axis=0)
                products += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array([sums.tolist()]), pa.array([products.ravel().tolist()])], ["sums", "products"]
        )

    return of


def identity_error(fitting: DataFrame, model: Whitening, components: int) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over
    the components that have a length; measured on the vectors, not on the matrix."""
    found = fitting.mapInArrow(_products(model, components), "sums array<double>, products array<double>")
    sums, products = np.zeros(components), np.zeros(components * components)
    for k, out in (("sums", sums), ("products", products)):
        rows = found.select(F.posexplode(k)).groupBy("pos").agg(F.sum("col").alias("total"))
        for r in rows.collect():
            out[r.pos] = r.total
    mean = sums / model.n
    off = products.reshape(components, components) / model.n - np.outer(mean, mean) - np.eye(components)
    there = ~np.isnan(np.diag(off))
    return float(np.abs(off[np.ix_(there, there)]).max()) if there.any() else None


def _whitened(model: Whitening, components: int, error: float | None):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                x = _matrix(part.column("x"), model.width)
                w = model.project(x)[:, :components]
                ends = pa.array(np.arange(len(x) + 1) * components, pa.int32())
                values = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([model.n] * len(x), pa.int64()),
                        pa.array([Decimal(d) for d in model.deviations(x)], _WHOLE),
                        pa.ListArray.from_arrays(ends, values),
                        pa.array([model.explained[:components].tolist()] * len(x), pa.list_(pa.float64())),
                        pa.array([error] * len(x), pa.float64()),
                    ],
                    ["id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return of


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int | None = None
) -> DataFrame:
    """Per usable row: ``id``, ``n`` (distinct vectors fitted), ``deviation`` (sum over the
    dimensions of ``(n * x - S) ** 2``), ``whitened`` and ``explained`` (arrays, one entry per
    component, by falling eigenvalue) and ``identity_error``.

    The model is fitted to each distinct whole-number vector once, so copies weigh nothing
    however many; the copies of a task are merged before they are sent. Three passes read
    the distinct vectors, none holds more than some thousand of them.

    A vector that is null, empty, or holds a null, non-finite or overlarge entry is left
    out. The vectors that remain must be of one length: those of another length than most
    distinct ones have (ties: the longer) are left out too. On a component without variance
    ``whitened`` is null. Without usable vectors the result is empty. Rows that repeat an id
    are whitened each; null ids stay null. Only the two named columns are read, so others
    may have any name.
    """
    rows = embeddings.select(
        embeddings[id_col].cast("long").alias("id"), whole_vector(embeddings[vector_col]).alias("x")
    ).filter("x IS NOT NULL")
    distinct = stored(rows.select("x").distinct(), "whitening-vectors")
    widths = distinct.groupBy(F.size("x").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    schema = (
        "id long, n long, deviation decimal(38,0), whitened array<double>, "
        "explained array<double>, identity_error double"
    )
    if most is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    fitting = distinct.filter(F.size("x") == most.width)
    model = fit(fitting, most.width)
    taken = min(components or most.width, most.width)
    error = identity_error(fitting, model, taken)
    return rows.filter(F.size("x") == most.width).mapInArrow(_whitened(model, taken, error), schema)


def per_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1. ``deviation`` is a long, null
    where it passes 64 bits."""
    entries = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "entry")
    return whitened.select(
        F.col("id").alias("vec_id"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "identity_error", entries
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "entry.whitened",
        "entry.explained",
        "identity_error",
    )
