"""Whitening against plain numpy and fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from cases import TESTDATA

from culvert.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, scale=256):
    """(n, {vec_id: deviation}, covariance, distinct vectors) with exact sums."""
    usable = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in usable})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    deviation = {i: sum((n * x[d] - sums[d]) ** 2 for d in range(width)) for i, x in usable}
    centred = [[Fraction(x[d] * n - sums[d], n) for d in range(width)] for x in fit]
    cov = [[float(sum(c[a] * c[b] for c in centred) / n) for b in range(width)] for a in range(width)]
    return n, deviation, np.array(cov), np.array(fit, float)


def sample(n=60, width=5, seed=3):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(width, width)) * np.array([3.0, 1.5, 0.7, 0.3, 0.1])[:width]
    return [(i, (rng.normal(size=width) @ mixing.T + 2).tolist()) for i in range(n)]


def test_matches_a_plain_version(spark):
    rows = sample()
    rows += [(1000, rows[0][1]), (1000, rows[0][1]), (None, rows[1][1])]  # copies weigh nothing
    odd = [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0]), (2003, [math.nan] * 5), (2004, [1.0, math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA)
    found = whitening.per_component(whitening.whiten(df, components=4)).collect()
    n, deviation, cov, fit = plain(rows)
    assert len(found) == 4 * len(rows) and n == 60
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors.T[::-1]
    mean = fit.mean(axis=0)
    assert {r.n for r in found} == {n}
    for r in found:
        if r.vec_id is not None:
            assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        assert r.identity_error < 1e-9
    by_component = {c: {r.vec_id: r.whitened for r in found if r.component == c} for c in range(1, 5)}
    for c, ours in by_component.items():
        theirs = {i: float((np.floor(256 * np.float32(v).astype(float)) - mean) @ vectors[c - 1]) / math.sqrt(values[c - 1]) for i, v in rows}
        sign = 1 if ours[5] * theirs[5] > 0 else -1
        assert all(ours[i] == pytest.approx(sign * theirs[i], abs=1e-8) for i in theirs)


def test_covariances_come_from_variances_alone(spark):
    rows = sample(40, 3, 9)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    x = df.select(whitening.whole_vector("embedding").alias("x")).distinct()
    model = whitening.fit(x, 3)
    n, _, cov, _ = plain(rows)
    rebuilt = model.vectors.T @ np.diag(model.values) @ model.vectors
    assert np.allclose(rebuilt, cov, rtol=1e-12) and model.n == n


def test_sums_are_exact_beyond_64_bits():
    y = np.array([[3_000_000_000, -1], [2_000_000_000, 5], [-4_100_000_000, 7]], np.int64)
    assert whitening._added(y) == [sum(int(v) ** 2 for v in column) for column in y.T]
    model = whitening.Whitening(10**9, (5 * 10**9 + 3, -7), np.ones(2), np.eye(2), np.ones(2))
    x = np.array([[900, -4], [5, 0]], np.int64)
    wanted = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x]
    assert model.deviations(x) == wanted and wanted[0] > 2**63


def test_a_deviation_beyond_64_bits_is_null_and_kept_whole_elsewhere(spark):
    df = spark.createDataFrame([(1, [2.0**28, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, 0.0], 0)], SCHEMA)
    whole = whitening.whiten(df)
    assert {r.id: int(r.deviation) for r in whole.collect()}[1] > 2**63
    assert {r.vec_id: r.deviation for r in whitening.per_component(whole).collect()}[1] is None


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0], 0) for i in range(8)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in found)
    assert found[0].identity_error < 1e-9
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    alone = whitening.whiten(same).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in alone] == [(1, 0, [None, None], None)] * 2


def test_other_lengths_empty_tables_and_clashing_names(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [2.0, 1.0], 0), (3, [1.0, 1.0, 1.0], 0), (4, [0.0, 0.5], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' AS x", "'own' AS id", "'own' AS n", "'own' AS whitened")
    assert sorted({r.vec_id for r in whitening.per_component(whitening.whiten(df)).collect()}) == [1, 2, 4]
    nothing = spark.createDataFrame([], SCHEMA)
    assert whitening.per_component(whitening.whiten(nothing)).count() == 0
    unusable = spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)
    assert whitening.whiten(unusable).count() == 0


def test_query_over_the_given_table(spark):
    found = queries.QUERIES["op11_whitening"](spark, f"{TESTDATA}/sf0.001").toPandas()
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviation, cov, _ = plain([(r.vec_id, r.embedding) for r in rows])
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(found) == 4 * len(rows) and set(found["n"]) == {n}
    assert all(deviation[i] == d for i, d in zip(found["vec_id"], found["deviation"], strict=True))
    for c, group in found.groupby("component"):
        assert group["explained"].iloc[0] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-4
