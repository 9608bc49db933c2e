"""Words that the cache does not know go to the tokenizer in short texts."""

import numpy as np

from culvert.llm import queries, tokens


class Listening:
    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.words += [t.count(" ") for t in texts]
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_unknown_words_go_in_short_texts():
    encoder = tokens.Encoder(tokens.vocabulary(queries.VOCABULARY))
    plain, encoder.tokenizer = encoder.tokenizer, Listening(encoder.tokenizer)
    text = " ".join(f"wörd{i}, it's{i}\nQ{i}" for i in range(2500))
    found = np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist()
    assert found == plain.encode(text, add_special_tokens=False).ids
    assert sum(encoder.tokenizer.words) == 5000 - 1 and max(encoder.tokenizer.words) <= 100
