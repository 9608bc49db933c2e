"""Token files and packing: exact round trips."""

import collections
import zlib

import numpy as np
import pytest
from cases import TESTDATA, odd_docs, odd_frame, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from culvert.llm import packing, queries, token_files, tokens

PATH = tokens.vocabulary(queries.VOCABULARY)
ENCODER = tokens.Encoder(PATH)
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text, end):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_cached_words_give_the_tokenizers_ids_on_odd_texts():
    texts = [t for _, t, *_ in odd_docs()] + [" a", "a\nb", "a \nb", "a\n b", "\n\na", "  a", "a  ", "don't 've", "\x00 a", "a​ b"]
    for text, found in zip(texts, ENCODER.encode(texts), strict=True):
        assert np.frombuffer(found, ENCODER.dtype).tolist() == PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t.,%'!asdt1é½²你😀́ ​<|>")), max_size=40), min_size=1, max_size=4))
def test_cached_words_give_the_tokenizers_ids(texts):
    for text, found in zip(texts, ENCODER.encode(texts), strict=True):
        assert np.frombuffer(found, ENCODER.dtype).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_a_small_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    monkeypatch.setattr(tokens, "TEXTS", 2)
    texts = [t for _, t, *_ in odd_docs()]
    assert tokens.Encoder(PATH).encode(texts) == ENCODER.encode(texts)


def written(spark, docs, tmp_path, **options):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, PATH, end_id=2, **options)
    return token_files.read_tokens(spark, path)


@pytest.mark.parametrize("partitions", [None, 5])
def test_token_files_round_trip(spark, tmp_path, partitions):
    rows = odd_docs()
    files = written(spark, with_clashes(odd_frame(spark)), tmp_path, partitions=partitions)
    got = [tuple(r) for r in token_files.digest(files).orderBy("start").collect()]
    texts = collections.Counter((i, zlib.crc32(ids_of(t, 2).tobytes())) for i, t, *_ in rows)
    assert collections.Counter((i, crc) for i, _, _, crc in got) == texts
    start, before = 0, None
    for doc_id, at, n, _ in got:
        assert at == start and (before is None or before <= doc_id)
        start, before = start + n, doc_id
    by_id = {r.doc_id: r.ids for r in files.collect()}
    assert by_id[57] == ids_of(rows[19][1], 2).tolist()


def test_token_files_of_nothing(spark, tmp_path):
    assert token_files.digest(written(spark, odd_frame(spark).limit(0), tmp_path)).count() == 0


def test_token_files_hold_indexes_and_bloom_filters(spark, tmp_path):
    import glob

    from pyarrow import orc

    files = written(spark, odd_frame(spark), tmp_path, partitions=2)
    assert any(b"DOUBLE" in open(p, "rb").read() or orc.ORCFile(p).nstripes for p in glob.glob(f"{tmp_path}/tokens/*.orc"))
    plan = files.filter(F.col("doc_id") == 57)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,57)]" in plan
    assert files.filter(F.col("doc_id") == 57).count() == 1


def test_token_query_equals_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: tuple(r)[1:] for r in queries.op2_token_files(spark, f"{TESTDATA}/sf0.001").collect()}
    start = 0
    for doc_id, text in docs:
        ids = ids_of(text, 2)
        assert got[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


def check_pieces(rows, pieces, capacity):
    """Every id in one piece, sequences without gaps and of full or power-of-two length."""
    wanted = collections.Counter()
    for doc_id, text, *_ in rows:
        wanted[doc_id] += len(ids_of(text, 0))
    got, sequences = collections.Counter(), collections.defaultdict(list)
    texts = {doc_id: ids_of(text, 0) for doc_id, text, *_ in rows}
    unique = collections.Counter(r[0] for r in rows)
    for p in pieces:
        got[p.doc_id] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        if unique[p.doc_id] == 1:
            ids = texts[p.doc_id]
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    assert got == wanted
    short = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0 or at == capacity
        short += at < capacity
    return short


@pytest.mark.parametrize("capacity, pool", [(1024, 256), (64, 3)])
def test_packing_odd_texts(spark, capacity, pool):
    docs = with_clashes(odd_frame(spark)).coalesce(1)
    pieces = packing.pack(docs, PATH, 0, capacity, pool).collect()
    assert check_pieces(odd_docs(), pieces, capacity) <= capacity.bit_length()
    assert packing.pack(docs.limit(0), PATH, 0).count() == 0


def test_packing_query_loses_nothing(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()]
    pieces = queries.op4_cost_packing(spark, f"{TESTDATA}/sf0.001").collect()
    check_pieces(rows, pieces, 1024)


def test_the_longest_goes_to_the_cheapest_with_room():
    placed, left = packing.assign(np.array([5, 9, 7, 6, 5]), np.array([16, 16]))
    assert left == []
    where = {item: to for item, _, _, to, _ in placed}
    assert where[1] == 0 and where[2] == 1  # 9, then 7 to the empty one
    assert where[3] == 1  # 6 to the cheaper, which holds 7
    assert sum(length for *_, length, _, _ in placed) == 32


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=40), st.integers(0, 6))
def test_assignment_fills_what_it_can(lengths, count):
    placed, left = packing.assign(np.array(lengths, np.int64), np.full(count, 32))
    total = sum(lengths)
    assert sum(p[2] for p in placed) == min(total, 32 * count)
    assert sum(p[2] for p in placed) + sum(x[2] for x in left) == total
    closed, rest = packing.assign(np.array(lengths, np.int64), packing.closing(total, 32))
    assert rest == [] and sum(p[2] for p in closed) == total
