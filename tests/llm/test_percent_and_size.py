"""The Jaccard join at other shingle sizes and percents than its own."""

import functools

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, edited, pairs, words

from culvert.llm import jaccard


def copies():
    """Families with a few edits each, so that many pairs lie between the two rules."""
    rows = []
    for family in range(40):
        base = words((3, 6, 9, 14, 25, 40, 80, 200)[family % 8], family + 500, 5000)
        rows.append(" ".join(base))
        for seed in range(6):
            edits = (0, 1, 1, 2, 3, 6)[seed]
            rows.append(" ".join(edited(base, edits, family * 70 + seed)))
    return [(len(rows) - i, t, "en", "s", 0) for i, t in enumerate(rows)]


@pytest.fixture
def five_words(monkeypatch):
    monkeypatch.setattr(brute, "shingle_set", functools.partial(brute.shingle_set, size=5))


@pytest.mark.parametrize("percent", [75, 80, 85])
def test_linked_sets_of_five_words_share_a_mark(five_words, percent):
    texts = [t for _, t, *_ in copies()]
    found, counts = jaccard.sets_of(pa.array(texts), 5)
    sets = [set(x.tolist()) for x in np.split(found, np.cumsum(counts)[:-1])]
    assert [len(s) for s in sets] == [len(brute.shingle_set(t)) for t in texts]
    marks, owner = jaccard.marks_of(found, counts, percent)
    own = [set(marks[owner == i].tolist()) for i in range(len(sets))]
    links = 0
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links += 1
                assert own[i] & own[j]
    assert links > 50


def test_a_set_meets_linked_ones_in_the_next_frame_at_most():
    upper = jaccard._plan(80)["upper"]
    for size in range(1, 5000):
        frame, far = np.searchsorted(upper, [size, size * 100 // 80])
        assert far - frame <= 1
    with pytest.raises(ValueError):
        jaccard._plan(74)


def test_classes_of_five_words_equal_brute_force(spark, five_words):
    rows = copies()
    docs = spark.createDataFrame(rows, DOCS)
    want = brute.jaccard_classes(pairs(rows), 80)
    got = jaccard.classes(docs, 80, block=3, size=5).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {rows[i][0]: own for i, own in want.items()}
    kept = {r.doc_id for r in jaccard.representatives(docs, 80, 5).collect()}
    assert kept == {own for _, own in want.values()}
    # The looser rule joins what the operator's own leaves apart.
    assert len(kept) < jaccard.representatives(docs, 90, 5).count()


def test_unrelated_short_sets_share_no_mark():
    """Random sets that have nothing in common: no empty part, and nothing else, joins them."""
    rng = np.random.default_rng(5)
    for low, high, percent in ((8, 20, 90), (15, 40, 90), (1, 12, 90), (8, 20, 80)):
        counts = rng.integers(low, high + 1, 60_000)
        found = rng.integers(0, 1 << 63, int(counts.sum()), dtype=np.uint64) * np.uint64(2)
        text = np.repeat(np.arange(len(counts)), counts)
        found = found[np.lexsort((found, text))]
        marks, owner = jaccard.marks_of(found, counts, percent)
        order = np.lexsort((owner, marks))
        marks, owner = marks[order], owner[order]
        assert not ((marks[1:] == marks[:-1]) & (owner[1:] != owner[:-1])).any()


@pytest.mark.parametrize("size", [4, 9, 10, 14, 20])
def test_sets_whose_equal_parts_are_all_empty_still_meet(size):
    """Every set that differs in as much as it may, however its shingles fall into parts."""
    rng = np.random.default_rng(size)
    for _ in range(3000):
        base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        other = base.copy()
        while True:
            nxt = other.copy()
            nxt[rng.integers(len(nxt))] = rng.integers(0, 1 << 63, dtype=np.uint64)
            nxt = np.unique(nxt)
            common = len(np.intersect1d(base, nxt))
            if 100 * common < 90 * (len(base) + len(nxt) - common):
                break
            other = nxt
        marks, owner = jaccard.marks_of(np.concatenate([base, other]), np.array([len(base), len(other)]))
        assert set(marks[owner == 0].tolist()) & set(marks[owner == 1].tolist())


@pytest.mark.parametrize("size", [3, 5, 9, 14, 20, 45, 120])
@pytest.mark.parametrize("percent", [75, 80, 85, 90])
def test_sets_that_differ_as_much_as_they_may_share_a_mark(size, percent):
    rng = np.random.default_rng(size)
    for _ in range(1500 if size < 45 else 300):
        base = other = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        while True:
            kind, nxt = rng.integers(3), other
            if kind:  # one shingle less, or another one
                nxt = np.delete(nxt, rng.integers(len(nxt)))
            if kind < 2:
                nxt = np.unique(np.append(nxt, rng.integers(0, 1 << 63, dtype=np.uint64)))
            common = len(np.intersect1d(base, nxt))
            if 100 * common < percent * (len(base) + len(nxt) - common) or not len(nxt):
                break
            other = nxt
        marks, owner = jaccard.marks_of(np.concatenate([base, other]), np.array([len(base), len(other)]), percent)
        assert set(marks[owner == 0].tolist()) & set(marks[owner == 1].tolist())
