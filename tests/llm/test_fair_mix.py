"""The mix of sources against a plain queue, and its promises."""

import hashlib
import math
from collections import defaultdict

import brute
import pytest
from cases import DOCS, TESTDATA, odd_docs, odd_frame, with_clashes
from compare import connect, difference
from pyspark.sql import functions as F

from culvert.llm import fair_mix, queries


def shares(sizes, weights=(5, 2, 1), repeats=3):
    """Targets by sharing again and again what full sources leave."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= repeats * sizes[s]}
        if not full:
            out |= {s: weight[s] * (left / total) for s in open_}
            break
        out |= {s: float(repeats * sizes[s]) for s in full}
        left -= sum(repeats * sizes[s] for s in full)
        open_ -= full
    return out


def plain(rows):
    """Sorted (doc_id, size, target, taken)."""
    docs = [(i, s, len(brute.BLANK_WORD.findall(t or ""))) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    goals, packets, taken = shares(sizes), [], [0] * len(docs)
    rank = {s: k for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    turn = lambda k: (hashlib.md5(f"mix {'' if docs[k][0] is None else docs[k][0]}".encode()).hexdigest(), docs[k][2], k)
    for s in sizes:
        mine, at = sorted((k for k in range(len(docs)) if docs[k][1] == s), key=turn), 0
        for _ in range(3):
            for k in mine:
                words = min(docs[k][2], math.ceil(goals[s]) - at)
                if words > 0:
                    packets.append(((at + words) / goals[s], rank[s], at, k, words))
                at += docs[k][2]
    left = sum(sizes.values())
    for *_, k, words in sorted(packets):
        taken[k] += min(words, left)
        left -= min(words, left)
    return sorted((str(d[0]), d[2], round(goals[d[1]], 6), n) for d, n in zip(docs, taken, strict=True))


def found_in(df):
    return sorted((str(r.doc_id), r["size"], round(r.target, 6), r.taken) for r in fair_mix.mix(df).collect())


def rows_of(sources):
    out = []
    for s, sizes in sources.items():
        out += [(len(out) + i, "w " * n, None, s, 0) for i, n in enumerate(sizes)]
    return out


CASES = {
    "one source": {"a": [3, 5, 0, 9]},
    "a small source among large ones": {"a": [1, 2], "b": [400, 30], "c": [50] * 20, None: [7]},
    "all small but one": {"a": [2], "b": [1], "c": [0], "d": [9000, 1], "é": [3], "Z": [4]},
    "many small ones": {f"s{i}": [i % 5, 3, 40 - i] for i in range(25)},
}


@pytest.mark.parametrize("name", CASES)
def test_matches_a_plain_queue(spark, name):
    rows = rows_of(CASES[name])
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert found_in(df) == plain([(r[0], r[1], r[3]) for r in rows])


def test_odd_texts(spark):
    rows = [*odd_docs(), (77, "long " * 400_000, "en", "src1", 0)]
    df = with_clashes(spark.createDataFrame(rows, DOCS)).withColumns({c: F.lit("own") for c in ("size", "row", "rank", "target", "turn", "of")})
    assert found_in(df) == plain([(r[0], r[1], r[3]) for r in rows])
    assert found_in(odd_frame(spark).limit(0)) == []


def test_without_words_nothing_is_taken(spark):
    rows = [(1, None, None, "a", 0), (2, "", None, None, 0), (3, " \n", None, "a", 0)]
    found = fair_mix.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r["size"], r.target, r.taken, r.first_at) for r in found] == [(0, 0.0, 0, None)] * 3


def test_taken_words_meet_the_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    first = fair_mix.mix(docs).toPandas()
    again = fair_mix.mix(docs.repartition(13)).toPandas()
    order = lambda p: sorted(p[["doc_id", "taken", "first_at"]].fillna(-1).itertuples(index=False, name=None))
    assert order(first) == order(again)
    assert first["taken"].sum() == first["size"].sum()
    assert (first["taken"] <= 3 * first["size"]).all()
    sums = first.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert (sums["taken"] - sums["target"]).abs().max() <= len(sums)


def test_running_sums_over_hot_values(spark):
    df = spark.range(5000).selectExpr("id", "if(id < 4000, 'hot', cast(id as string)) AS k", "id % 7 AS v")
    found = fair_mix.running(df.repartition(6), [F.asc("k"), F.asc("id")], ["v"], "sums").collect()
    total = 0
    for r in sorted(found, key=lambda r: (r.k, r.id)):
        assert r.v_before == total
        total += r.v


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = connect(f"{TESTDATA}/{sf}")
    df = queries.QUERIES["op13_fair_mix"](spark, f"{TESTDATA}/{sf}")
    assert difference(df, con, queries.ORACLES["op13_fair_mix"]) is None
