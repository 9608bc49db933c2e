"""Words are looked up as columns: what reaches the tokenizer, what stays remembered, and texts
that are dealt in other portions."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from cases import odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from culvert.llm import queries, tokens

PATH = tokens.vocabulary(queries.VOCABULARY)
PLAIN = Tokenizer.from_file(PATH)


class Listening:
    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def given_ids(encoder, texts):
    return [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]


def test_a_run_of_blanks_does_not_send_the_whole_text_to_the_tokenizer():
    encoder = tokens.Encoder(PATH)
    encoder.tokenizer = Listening(encoder.tokenizer)
    line = "one two three four five six, seven. "
    text = " " + line * 500 + " end\n and" + " é" * 500 + "  "
    assert given_ids(encoder, [text]) == [ids_of(text)]
    assert encoder.tokenizer.chars < 100


def test_a_remembered_word_takes_few_bytes():
    words = [f"w{i:06d}" for i in random.Random(1).sample(range(1_000_000), 100_000)]
    encoder = tokens.Encoder(PATH)
    encoder.encode(["warm up"])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        encoder.encode([" ".join(words)])
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert held < 60 * len(words)


def test_long_words_and_old_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 100)
    encoder = tokens.Encoder(PATH)
    for i in range(20):
        text = " ".join([f"x{i}y{j}" for j in range(50)] + [f"{i}" * 5000])
        assert given_ids(encoder, [text, text]) == [ids_of(text)] * 2
        assert len(encoder.known.words) <= 200 and encoder.known.words.nbytes <= 2 * 100 * tokens.WORD_BYTES
    assert encoder.known.places(pa.array([" x19y7", " x0y7"])).tolist()[1] == -1


@pytest.mark.parametrize("size, asked, most", [(1, 1, 1), (50, 20, 3), (4000, 300, 1000)])
def test_texts_in_other_portions_give_the_same_ids(monkeypatch, size, asked, most):
    monkeypatch.setattr(tokens, "TEXT_BYTES", size)
    monkeypatch.setattr(tokens, "ASKED_BYTES", asked)
    monkeypatch.setattr(tokens, "CACHE_WORDS", most)
    texts = [t for _, t, *_ in odd_docs()] + [None, "", " ", "é é", "é é", "a<|endoftext|> b c", " <|endoftext|>"]
    encoder = tokens.Encoder(PATH)
    for _ in range(2):
        assert given_ids(encoder, texts) == [ids_of(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("  \n\tä.'s1é½你😀́ ​ \x85\x7f<|>")), max_size=30), max_size=6))
def test_cuts_beside_any_characters_are_exact(texts):
    assert given_ids(tokens.encoder(PATH), texts) == [ids_of(t) for t in texts]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_lists_of_slices_and_large_strings(kind):
    texts = ["x", None, "one two", "", "thrée four  five", " six"]
    ids, sizes = tokens.encoder(PATH).lists(pa.array(texts, kind)[1:5])
    assert sizes.tolist() == [len(ids_of(t)) for t in texts[1:5]]
    assert ids.tolist() == [i for t in texts[1:5] for i in ids_of(t)]
    ids, sizes = tokens.encoder(PATH).lists(pa.array([], kind))
    assert len(ids) == len(sizes) == 0


def test_portions_keep_all_rows_in_their_order(monkeypatch):
    monkeypatch.setattr(tokens, "TEXT_BYTES", 10)
    texts = ["abc", None, "d" * 50, "", "ef", "g" * 10, "h", "i" * 9, "jk", None]
    table = pa.table({"doc_id": range(len(texts)), "text": texts})
    for most in (1, 3, 100):
        found = list(tokens.portions(table.to_batches(max_chunksize=most)))
        assert [r for b in found for r in b.to_pylist()] == table.to_pylist()
        assert all(b.num_rows == 1 or sum(len(t or "") for t in b["text"].to_pylist()) <= 10 for b in found)
        assert len(found) < len(texts)
    assert list(tokens.portions([])) == []
