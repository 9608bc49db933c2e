"""Words are told from the marks and line ends beside them before they are looked up."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

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
    return PLAIN.encode(text, add_special_tokens=False).ids


def given_ids(encoder, texts):
    return [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]


def test_a_word_with_other_marks_does_not_go_to_the_tokenizer_again():
    encoder = tokens.Encoder(PATH)
    encoder.tokenizer = Listening(encoder.tokenizer)
    words = [f"wörtér{i}" for i in range(300)]
    texts = [" ".join(f"{w}{mark}" for w in words) for mark in ("", ".", ",", "###", "!?", ".\nAnd")]
    assert given_ids(encoder, texts) == [ids_of(t) for t in texts]
    assert encoder.tokenizer.chars < 2 * sum(len(w) + 1 for w in words)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("  \n\n\t\r's're.,#<|>aZ1é½Ⅷ²́…我😀\xa0\x85 \x1c​")), max_size=40), max_size=6))
def test_cuts_beside_marks_and_line_ends_are_exact(texts):
    assert given_ids(tokens.encoder(PATH), texts) == [ids_of(t) for t in texts]


def test_characters_of_every_kind_beside_each_other():
    chars = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000] + ["﻿", "￿", "𐐀", "𝟘", "😀", "\U0010ffff"]
    texts = [f"x{c}y {c}1{c}\n{c}! a{c}{c}'s{c}." for c in chars]
    assert given_ids(tokens.Encoder(PATH), texts) == [ids_of(t) for t in texts]


@pytest.mark.parametrize("text", ["a.<|endoftext|>.b", "x,<|endoftext|>", " <|endoftext|>\nFoo.", "a<|end. of<|endoftext|>"])
def test_special_tokens_beside_marks(text):
    texts = ["one, two.", text, "three.\nfour"]
    assert given_ids(tokens.Encoder(PATH), texts) == [ids_of(t) for t in texts]


def test_another_pattern_is_not_cut_at_marks(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    other.save(path := str(tmp_path / "other.json"))
    texts = ["one, two. three.\nfour's (five)", "in.the", " a,b ."]
    expected = [other.encode(t, add_special_tokens=False).ids for t in texts]
    assert given_ids(tokens.Encoder(path), texts) == expected
