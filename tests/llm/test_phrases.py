"""Phrase mining against counting every phrase, and the sort by itself."""

import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, TESTDATA, odd_docs, odd_frame, with_clashes
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st

from culvert.llm import phrases, queries


def collocations(rows, least=30, top=2000):
    """Rows of the result from (text, lang) pairs."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            cuts = [(2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            longer = [b for h, b in f.items() if b >= least and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if not any(100 * b >= 80 * a for b in longer):
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def found_in(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def sample(n=60, seed=4):
    rng = random.Random(seed)
    stock = ["New York", "the of", "La Paz", "a b c d", "é ü", "red", "blue\tgreen", "x", "y"]
    marks = [" ", " ", " ", "  ", ". ", ", ", "\n", "\t", "!", "? ", ": ", "; "]
    texts = ["".join(rng.choice(stock) + rng.choice(marks) for _ in range(30)) for _ in range(n)]
    return [(i, t, rng.choice(["en", "fr", None, "und"]), "s", 0) for i, t in enumerate(texts)]


def test_matches_a_plain_version(spark):
    rows = sample()
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for least, top in ((30, 2000), (5, 2000), (2, 7)):
        want = collocations([(r[1], r[2]) for r in rows], least, top)
        assert want and found_in(df, least=least, top=top) == want


def test_odd_texts(spark):
    rows = [*odd_docs(), (None, "one two " * 40 + "one" * 70_000, None, None, None)]
    df = with_clashes(spark.createDataFrame(rows, DOCS)).withColumns({"w0": phrases.F.lit("own"), "f": phrases.F.lit(1)})
    assert found_in(df, least=3) == collocations([(r[1], r[2]) for r in rows], least=3)
    assert found_in(odd_frame(spark).limit(0)) == []


def test_a_text_of_several_blocks_and_many_blocks(spark, monkeypatch):
    long = ("alpha beta gamma. " * 50_000) + "beta gamma delta"  # nearly 1 MB
    rows = [(1, long, "en", "s", 0), (2, "alpha beta gamma delta " * 40, "en", "s", 0)]
    assert found_in(spark.createDataFrame(rows, DOCS)) == collocations([(r[1], r[2]) for r in rows])
    # The same from blocks of one text each: sums do not depend on how texts are merged.
    texts = pa.RecordBatch.from_pydict({"text": [r[1] for r in rows], "lang": ["en", "en"]})
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 1)
    apart = Counter()
    for batch in phrases._words(iter([texts])):
        apart.update(dict(zip(batch["word"].to_pylist(), batch["f"].to_pylist(), strict=True)))
    assert apart == {"alpha": 50_040, "beta": 50_041, "gamma": 50_041, "delta": 41}


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = sample(30)
    monkeypatch.setattr(phrases, "frequent_filter", lambda spark, h: np.full(1 << (phrases.FILTER_BITS - 6), ~np.uint64(0)))
    found = found_in(spark.createDataFrame(rows, DOCS), least=4)
    assert found == collocations([(r[1], r[2]) for r in rows], least=4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 3, st.integers(1, 9)), max_size=60), st.integers(1, 30))
def test_partitions_are_weighted_counts(rows, least):
    keys = np.array([r[:3] for r in rows], np.uint64).reshape(-1, 3)
    at, sums = phrases.partitions(keys, np.array([r[3] for r in rows], np.int64), least)
    want = Counter()
    for *key, weight in rows:
        want[tuple(key)] += weight
    got = {tuple(int(v) for v in keys[i]): int(s) for i, s in zip(at, sums, strict=True)}
    assert got == {k: w for k, w in want.items() if w >= least} and len(got) == len(at)


def test_sorted_rows_are_cut_between_portions(monkeypatch):
    monkeypatch.setattr(phrases, "SORTED_ROWS", 4)
    rng = np.random.default_rng(1)
    words = np.sort(rng.integers(1, 9, 50))
    batches = [
        pa.RecordBatch.from_pydict({"w0": words[i : i + 3], "w1": words[i : i + 3] + 1, "weight": np.ones(len(words[i : i + 3]), np.int64), "portion": words[i : i + 3].astype(np.int32)})
        for i in range(0, 50, 3)
    ]
    got = Counter()
    for batch in phrases._sorted(2, 1)(iter(batches)):
        for w, f in zip(batch["w0"].to_pylist(), batch["f"].to_pylist(), strict=True):
            assert w not in got
            got[w] = f
    assert got == Counter(words.tolist())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = connect(f"{TESTDATA}/{sf}")
    df = queries.QUERIES["op12_phrases"](spark, f"{TESTDATA}/{sf}")
    assert difference(df, con, queries.ORACLES["op12_phrases"]) is None
