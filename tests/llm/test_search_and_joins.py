"""Decontamination and the Jaccard join against brute force."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, TESTDATA, edited, odd_docs, odd_frame, pairs, with_clashes, words
from compare import connect, difference
from pyspark.sql import functions as F

from culvert.llm import decontamination, jaccard, queries

SF = f"{TESTDATA}/sf0.01"
ITEMS = [
    (1, " ".join(words(300, 1)[40:65])),
    (2, "One, two!"),
    (3, "Naïve café"),
    (4, "w1 w2 w3 never seen at all in any of the texts here"),
    (5, None),
    (6, "..."),
    (10, "same line here\nother line same line here " + " ".join(words(60, 3)[:9])),
    (10, "SPAM spam spam"),
    (None, "one two three"),
]


def test_contamination_of_odd_texts(spark):
    rows = odd_docs()
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("terms", F.lit("own"))
    got = decontamination.decontaminate(with_clashes(odd_frame(spark)), items).collect()
    known = [(i, t) for i, t in ITEMS if i is not None]
    want = brute.contamination(pairs(rows), [*known, ("null", ITEMS[-1][1])])
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, [x or "null" for x in r["items"]]) for r in got)
    assert found == sorted((str(rows[i][0]), n, hit, own) for i, (n, hit, own) in want.items())
    assert sum(hit > 0 for _, hit, _ in want.values()) > 10


def test_contamination_without_documents_or_items(spark):
    docs, items = odd_frame(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    clean = decontamination.decontaminate(docs, items.limit(0))
    assert clean.filter("n_hit > 0").count() == 0 and clean.count() == len(odd_docs())
    left = decontamination.clean(with_clashes(docs), items)
    assert left.columns == with_clashes(docs).columns
    assert left.filter(F.col("text").contains("spam")).count() == 0


def test_contamination_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = brute.contamination(pairs(rows), [tuple(r) for r in items])
    got = {r.doc_id: r for r in queries.op6_positional_index(spark, SF).collect()}
    for i, r in enumerate(rows):
        n, hit, own = want[i]
        row = got[r.doc_id]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, hit, len(own), hit > 0)
        assert row.items_sha256 == brute.items_digest(own)


def test_contamination_query_equals_sql(spark):
    con = connect(SF)
    assert difference(queries.op6_positional_index(spark, SF), con, decontamination.ORACLE) is None


def test_an_index_of_all_terms_finds_the_same(spark):
    docs, items = odd_frame(spark), spark.createDataFrame(ITEMS[:4], "item_id long, text string")
    windows = decontamination.items_of(items)
    small = decontamination.build_index(docs, decontamination.vocabulary_of(windows))
    whole = decontamination.build_index(docs, None, segment_words=50)
    total = whole.postings.agg(F.sum("n")).first()[0]
    assert total == sum(len(decontamination.words(t)) for _, t, *_ in odd_docs())
    found = [
        sorted((r.row, r.n_hit, *r["items"]) for r in decontamination.hits(x, decontamination.search(x, windows, None)).collect())
        for x in (small, whole)
    ]
    assert found[0] == found[1]
    blocks = decontamination.search(whole, windows, None, windows_at_once=3)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, decontamination.search(whole, windows, None).collect()))


def test_near_matches_need_all_terms_close_together(spark):
    texts = ["the red fox sleeps now", "fox the red sleeps", "the red big lazy old fox", "the red fox", "red fox"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = decontamination.items_of(spark.createDataFrame([(1, "The red fox")], "item_id long, text string"))
    index = decontamination.build_index(docs)
    rows = decontamination.search(index, items, slop=2).collect()
    found = {(r.kind, r.segment, r.position) for r in rows}
    firsts = {(d.segment, d["first"]): d.doc_id for d in index.documents.collect()}

    def doc(segment, position):
        return firsts[max(k for k in firsts if k[0] == segment and k[1] <= position)]

    kinds = {(kind, doc(segment, position)) for kind, segment, position in found}
    assert ("phrase", 0) in kinds and ("phrase", 3) in kinds
    assert ("near", 1) in kinds and not any(d in (2, 4) for _, d in kinds)


def test_phrases_start_from_the_rarest_list():
    lists = [np.array([1, 5, 9, 20]), np.array([6, 21]), np.array([7, 10, 22])]
    assert decontamination.phrase(lists).tolist() == [5, 20]
    assert decontamination.phrase([np.array([3]), np.array([9])]).tolist() == []


def copies_and_near_copies():
    """Families of texts at all distances, with copies, of many sizes."""
    rows = []
    for family in range(45):
        base = words((3, 5, 9, 11, 14, 20, 33, 60, 120, 300)[family % 10], family + 100, 5000)
        rows.append(" ".join(base))
        for seed in range(6):
            rows.append(" ".join(edited(base, (0, 1, 1, 2, 4, 9)[seed], family * 50 + seed)))
    hot = words(150, 7, 5000)
    rows += [" ".join(hot)] * 30 + [" ".join(edited(hot, seed % 9, seed)) for seed in range(120)]
    return [(len(rows) - i, t, "en", "s", 0) for i, t in enumerate(rows)]


def same_classes(got, rows):
    want = brute.jaccard_classes(pairs(rows))
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got)
    expected = sorted((str(rows[i][0]), n, own) for i, (n, own) in want.items())
    # Rows without shingles stand for themselves.
    expected = [(d, n, None if d == "None" and n == 0 else c) for d, n, c in expected]
    assert found == expected


@pytest.mark.parametrize("block", [3, 512])
def test_classes_of_families_equal_brute_force(spark, block):
    rows = copies_and_near_copies()
    same_classes(jaccard.classes(spark.createDataFrame(rows, DOCS), block=block).collect(), rows)


def test_classes_of_odd_texts(spark):
    rows = odd_docs()
    docs = with_clashes(odd_frame(spark))
    same_classes(jaccard.classes(docs).collect(), rows)
    assert jaccard.classes(docs.limit(0)).count() == 0
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    # One row of each class, and every text without words.
    want = brute.jaccard_classes(pairs(rows))
    wordless = sum(n == 0 for n, _ in want.values())
    assert kept.count() == len({own for n, own in want.values() if n}) + wordless


def test_class_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    same_classes(queries.op10_token_groups(spark, SF).collect(), [tuple(r) for r in rows])


def test_class_query_equals_sql(spark):
    assert difference(queries.op10_token_groups(spark, SF), connect(SF), queries.CLASSES) is None


def test_linked_sets_always_share_a_mark():
    texts = [t for _, t, *_ in copies_and_near_copies()]
    found, counts = jaccard.sets_of(pa.array(texts))
    ends = np.cumsum(counts)
    sets = [set(found[e - n : e].tolist()) for n, e in zip(counts, ends, strict=True)]
    assert [len(s) for s in sets] == [len(brute.shingle_set(t)) for t in texts]
    marks, owner = jaccard.marks_of(found, counts)
    own = [set(marks[owner == i].tolist()) for i in range(len(sets))]
    links = 0
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                links += 1
                assert own[i] & own[j]
    assert links > 300


@pytest.mark.parametrize("group", [1, 4, 32, 1000])
def test_opened_groups_hold_every_link(group):
    texts = [t for _, t, *_ in copies_and_near_copies()]
    found, counts = jaccard.sets_of(pa.array(texts))
    ends = np.cumsum(counts)
    sets = [found[e - n : e] for n, e in zip(counts, ends, strict=True)]
    got = dict(jaccard._forest(list(range(len(sets))), sets, 90, group))
    want = brute.jaccard_classes([(i, t) for i, t in enumerate(texts)])
    assert [got.get(i, i) for i in range(len(sets))] == [own for _, own in want.values()]


def test_components_of_a_chain(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
