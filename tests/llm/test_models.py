"""Learned operators: language, quality classifier, language model; and the pipeline."""

import functools
import math

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, TESTDATA, odd_docs, odd_frame, pairs, with_clashes
from pyspark.sql import functions as F

import corpus_pipeline
from culvert.llm import convnet, jaccard, language, mixing, quality, queries, wordhash

SF = f"{TESTDATA}/sf0.01"


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_language_of_held_out_texts(spark):
    got = queries.op3_language_kernel(spark, SF).join(read(spark, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert len(rows) == 1000
    assert all(r.held_out == (brute.left(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = read(spark, "documents").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    blind = docs.withColumn("lang", F.when(~held, F.col("lang")))
    cols = ["doc_id", "lang_pred", "score"]
    one, two = (sorted(map(tuple, language.identify(d).select(*cols).collect())) for d in (docs, blind))
    assert one == two


def test_language_of_odd_texts(spark):
    docs = with_clashes(odd_frame(spark))
    got = language.identify(docs)
    rows = got.collect()
    assert len(rows) == len(odd_docs()) and set(docs.columns) <= set(got.columns)
    for r in rows:
        undetermined = not (r.text and any(c.isalpha() for c in r.text))
        assert (r.lang_pred == "und") == undetermined and (r.score == 0 or not undetermined)
        assert r.held_out == (r.doc_id is None or brute.left(r.doc_id, 5) == 0)
    assert language.identify(docs.limit(0)).count() == 0
    unlabelled = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.filter("lang_pred <> 'und' OR score <> 0").count() == 0


def test_kernel_is_the_cosine_of_gram_sets():
    texts = ["the cat and the hat", "der Hut und die Katze", "Été", "", None]
    sets = [set(language.codes_of(t).tolist()) if t else set() for t in texts]
    grams = np.array(sorted(sets[0] | sets[1]))
    marks = np.stack([[g in s for g in grams] / np.sqrt(len(s)) for s in sets[:2]], axis=1).astype(np.float32)
    model = language.Model(["a"], grams, marks, np.zeros((2, 1)))
    got = language.kernel(texts, model, model.table())
    for i, s in enumerate(sets):
        for j in range(2):
            want = len(s & sets[j]) / math.sqrt(max(len(s), 1) * len(sets[j]))
            assert got[i, j] == pytest.approx(want, abs=1e-5)


def test_classifier_of_held_out_texts(spark):
    rows = queries.op8_byte_convnet(spark, SF).join(read(spark, "labels").select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (brute.left(r.doc_id, 4) == 2) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.93
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_classifier_of_odd_texts(spark):
    docs = with_clashes(odd_frame(spark))
    labels = spark.createDataFrame([(18, 1), (18, 0), (33, 0), (36, 0), (21, 1), (None, 1)], "doc_id long, quality int")
    got = convnet.classify(docs, labels, epochs=1)
    assert got.count() == len(odd_docs()) and set(docs.columns) <= set(got.columns)
    assert got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert convnet.classify(docs.limit(0), labels).count() == 0
    unlabelled = convnet.classify(docs, labels.limit(0))
    assert unlabelled.filter("score <> 0.5 OR predicted <> 0").count() == 0


def test_chunks_cover_every_byte():
    for size in (0, 1, convnet.CHUNK, convnet.CHUNK + 1, 5 * convnet.STEP + 3):
        text = "".join(chr(33 + i % 90) for i in range(size))
        chunks = convnet.chunks_of(text)
        seen = {}
        for i, chunk in enumerate(chunks):
            for j, byte in enumerate(chunk.tolist()):
                assert seen.setdefault(i * convnet.STEP + j, byte) == byte
        assert [seen[i] for i in range(size)] == [ord(c) for c in text]


def test_gradient_of_the_network():
    """The loss falls along the step that training takes."""
    texts = ["a b c " * 40, "!!! ### " * 30, "d e f " * 50, "%%% $$$ " * 40] * 6
    labels = np.array([1, 0, 1, 0] * 6)
    scores = convnet.score_texts(convnet.train(texts, labels, epochs=12, rate=0.01), texts)
    assert ((scores > 0.5) == labels).all()


def test_scores_do_not_depend_on_the_batch():
    net = convnet.train(["a b c " * 40, "!!! ### " * 300], np.array([1, 0]), epochs=1)
    texts = ["abc " * 3000, None, "", "xyz", "! # " * 900]
    together = convnet.score_texts(net, texts)
    alone = np.concatenate([convnet.score_texts(net, [t]) for t in texts])
    assert together == pytest.approx(alone, abs=1e-5)


def check_unigrams(got, rows):
    want = brute.unigram_scores(pairs(rows))
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.held_out, r.train_tokens, r.base_score) for r in got)
    expected = sorted((str(rows[i][0]), n, known, held, total, base) for i, (held, n, known, total, base) in want.items())
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_language_model_of_odd_texts(spark):
    rows = odd_docs()
    docs = with_clashes(odd_frame(spark))
    got = mixing.score(docs).collect()
    check_unigrams(got, rows)
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    assert mixing.score(docs.limit(0)).count() == 0
    untaught = mixing.score(docs.filter("doc_id IS NULL")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in untaught)


def test_language_model_query(spark):
    rows = [tuple(r) for r in read(spark, "documents").collect()]
    got = queries.op7_context_mixing(spark, SF).collect()
    check_unigrams(got, rows)
    held = [r for r in got if r.held_out]
    assert np.mean([r.bits_per_byte for r in held]) < 2.6


def test_probabilities_of_all_bytes_add_up():
    keys = np.array([int.from_bytes(b"abcde", "big") << 8 | b for b in range(256)], np.uint64)
    texts = pa.array(["abcdef abcdeg " * 20, "xyz " * 30])
    codes, _ = mixing.ngrams(*wordhash.bytes_of(texts))
    found, counts = np.unique(codes, return_counts=True)
    tables = [np.zeros((2, 1 << bits), np.uint16) for bits in mixing.SLOT_BITS]
    for number, (order, bits) in enumerate(zip(mixing.ORDERS, mixing.SLOT_BITS, strict=True)):
        node = np.ones(len(found), np.uint64)
        for place in range(7, -1, -1):
            bit = (found >> np.uint64(place)) & np.uint64(1)
            at = mixing._slots(order, bits, found >> np.uint64(8), node)
            np.add.at(tables[number], (bit.astype(int), at), counts.astype(np.uint16))
            node = (node << np.uint64(1)) | bit
    model, _, _ = mixing.learn(mixing.fresh_model(tables), found, counts)
    bits = mixing.cost_bits(model, keys, mixing.stretched_tables(model))
    assert (2.0 ** -bits).sum() == pytest.approx(1, abs=1e-3)
    assert bits[ord("f")] < 4 < bits[ord("q")]
    costs = mixing._Costs(model)
    assert costs(keys) == pytest.approx(bits, abs=1e-4) and costs(keys) == pytest.approx(bits, abs=1e-4)


def test_ngrams_are_the_bytes_before():
    texts = ["ab", "", "xyz"]
    codes, first = mixing.ngrams(*wordhash.bytes_of(pa.array(texts)))
    assert first.tolist() == [0, 3, 4, 8]
    for i, text in enumerate(texts):
        stream = b"\xff" * 5 + text.encode() + b"\xff"
        want = [int.from_bytes(stream[k : k + 6], "big") for k in range(len(text) + 1)]
        assert codes[first[i] : first[i + 1]].tolist() == want


def test_pipeline_stages_keep_what_they_should(spark, monkeypatch):
    docs = read(spark, "documents")
    labels = read(spark, "labels")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        rows, ids = kept.collect(), {r.doc_id for r in before.collect()}
        assert {r.doc_id for r in rows} <= ids
        if name == "quality_rules":
            verdict = {r.doc_id: r.kept for r in quality.judge(before, labels).select("doc_id", "quality.kept").collect()}
            assert {r.doc_id for r in rows} == {d for d, k in verdict.items() if k}
        if name == "language_id":
            assert len(rows) == len(ids)  # all of them are in a learned language
        if name == "near_duplicates":
            monkeypatch.setattr(brute, "shingle_set", functools.partial(brute.shingle_set, size=5))
            classes = brute.jaccard_classes([(r.doc_id, r.text) for r in before.collect()], 85)
            assert {r.doc_id for r in rows} == {own for _, own in classes.values()}
        if name == "decontaminate":
            items = [tuple(r) for r in read(spark, "benchmark").collect()]
            found = brute.contamination([(r.doc_id, r.text) for r in before.collect()], items)
            clean = {r.doc_id for i, r in enumerate(before.collect()) if not found[i][1]}
            assert {r.doc_id for r in rows} == clean
    left = {r.doc_id for r in kept.collect()}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == left


def test_pipeline_takes_odd_documents(spark):
    docs = with_clashes(odd_frame(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_words_of_slices_and_nulls():
    column = pa.array(["a B", None, "", "c\x0bd", " x y", "Z" * 70 + " z"])
    for piece in (column, column.slice(2), column.slice(1, 4)):
        found = wordhash.words_of(*wordhash.bytes_of(piece), wordhash.NOT_BLANK, wordhash.LOWER)
        want = [brute.BLANK_WORD.findall(brute.lower(t)) for t in piece.to_pylist()]
        assert found.per_text().tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        assert len(set(found.hashes.tolist())) == len(set(flat))


