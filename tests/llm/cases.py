"""Small tables with the odd cases every operator has to take."""

import random

from pyspark.sql import functions as F

TESTDATA = "/root/testdata"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, stems=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(stems)}" for _ in range(n)]


def edited(base, edits, seed):
    rng, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def odd_docs():
    base = words(300, 1)
    texts = [
        None,
        "",
        "  \n\t ",
        "one",
        "One two",
        "one TWO three",
        " ".join(base),
        " ".join(base),  # an exact copy
        " ".join(base).upper().replace("W", "w"),  # a copy but for case
        *(" ".join(edited(base, edits, seed)) for seed, edits in enumerate((1, 2, 3, 5, 8, 13, 40))),
        " ".join(words(20_000, 2)),
        "spam " * 200,
        "a%% b## c** d$$ e&& f|| <g> " * 12,
        "same line here\nother line\nsame line here\n" + " ".join(words(60, 3)),
        "naïve café über straße " * 20,
        "你好 世界 " * 30,
        "x" * 5000,
        "a\x0bb\x0cc\rd\x00e\u00a0f\u2003g " * 9,
        "<|endoftext|> it's  two   blanks\n\n\nand 12,5 ½ x² e\u0301",
    ]
    rows = [(i * 3, t, ("en", "fr", None)[i % 3], f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows.append((18, texts[6], "en", "src0", 0))  # a repeated row
    rows.append((None, texts[6], "en", "src0", 0))  # no id
    rows.append((None, "no id and only these few words", None, None, None))
    return rows


def odd_frame(spark):
    return spark.createDataFrame(odd_docs(), DOCS)


def with_clashes(df):
    """The same rows with columns whose names the operators use themselves."""
    names = ("quality", "score", "kept", "n_words", "words", "key", "sid", "row", "segment", "rule",
             "host", "held_out", "predicted", "lang_pred", "token", "licences", "block", "n", "unit")
    return df.withColumns({name: F.lit("own") for name in names})


def pairs(rows):
    return [(r[0], r[1]) for r in rows]
