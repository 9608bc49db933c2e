"""Language identification by a string kernel: presence of n-grams of several lengths,
Nyström landmarks, and kernel ridge regression of one language against the rest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from culvert.llm.shared import remainder

#: Lengths of the n-grams, in bytes of the folded text.
SPECTRUM = (1, 2, 3)
#: Landmark and training texts per language: the bounds of what is fitted on the driver.
LANDMARKS, TRAINING = 16, 500
#: Weight of the ridge.
RIDGE = 1e-3
#: Texts whose kernel values are computed as one matrix product.
BATCH = 256
#: Languages with fewer labelled texts are learned all the same; their number is the
#: number of columns of the model.
UNDETERMINED = "und"
#: Scores below which the pipeline takes a text for no known language. Nine in ten texts of a
#: language left out of the learning lie below, one in a thousand held-out texts of the others.
MIN_SCORE = 0.32

# Symbols of the kernel: 0 for what is no letter, 1-26 for a-z, 27 on for bytes beyond ASCII.
_SYMBOLS = 155
_FOLD = np.zeros(256, np.int32)
_FOLD[97:123] = _FOLD[65:91] = np.arange(1, 27)
_FOLD[128:] = np.arange(27, 155)
_OFFSETS = {n: sum(_SYMBOLS**k for k in range(1, n)) for n in SPECTRUM}
_SIZE = sum(_SYMBOLS**n for n in SPECTRUM)


def codes_of(text: str) -> np.ndarray:
    """Codes of all n-grams of a whole text, with repeats. Runs of other characters than
    letters count as one."""
    symbols = _FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    symbols = np.concatenate([[0], symbols, [0]]).astype(np.int32)
    symbols = symbols[np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))]
    parts, code = [], symbols
    for n in SPECTRUM:
        if n > 1:
            code = code[:-1] * _SYMBOLS + symbols[n - 1 :]
        parts.append(code + _OFFSETS[n])
    return np.concatenate(parts)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass(frozen=True)
class Model:
    """``grams``: codes that occur in a landmark, ascending; ``landmarks``: their presence,
    normed, one column per landmark; ``weights``: landmarks by languages."""

    languages: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        """Column of each code, or -1."""
        at = np.full(_SIZE, -1, np.int16 if len(self.grams) < 1 << 15 else np.int32)
        at[self.grams] = np.arange(len(self.grams))
        return at


def presence(texts: list[str | None], table: np.ndarray, width: int) -> np.ndarray:
    """One row per text: 1 / norm where it holds a gram, else 0. The norm is that of all
    distinct grams of the text, also of those that no landmark has."""
    found = np.zeros((len(texts), width), np.float32)
    norms = np.ones((len(texts), 1), np.float32)
    last = np.empty(_SIZE, np.int64)  # place of a code's last occurrence in the text at hand
    for row, norm, text in zip(found, norms, texts, strict=True):
        if text:
            codes = codes_of(text)
            places = np.arange(len(codes))
            last[codes] = places
            norm[0] = np.sqrt(np.count_nonzero(last[codes] == places))
            at = table[codes]
            row[at[at >= 0]] = 1.0
    return found / norms


def kernel(texts: list[str | None], model: Model, table: np.ndarray) -> np.ndarray:
    """Kernel of each text with each landmark: the cosine of their gram sets."""
    return presence(texts, table, len(model.grams)) @ model.landmarks


def _sampled(docs: DataFrame, counts: dict[str, int], per_language: int, seed: int) -> DataFrame:
    """About ``per_language`` rows of every ``lang``, chosen by a hash of the id; one and a
    half times as many are to be expected at most, whatever the number of rows."""
    chances = [
        F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * per_language / n))
    ]
    point = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    return docs.filter(point < F.element_at(F.create_map(*chances), F.col("lang")))


def _collected(sample: DataFrame, per_language: int, seed: int, column: str) -> pd.DataFrame:
    """The sample on the driver, cut to ``per_language`` rows per language in hash order."""
    ordered = sample.withColumn("__order", F.xxhash64(F.lit(seed), "doc_id"))
    rows = ordered.select("lang", "doc_id", "__order", column).toPandas()
    rows = rows.sort_values(["lang", "__order", "doc_id"], kind="stable")
    return rows.groupby("lang", sort=True).head(per_language)


def fit(
    training: DataFrame,
    landmarks: int = LANDMARKS,
    sample: int = TRAINING,
    ridge: float = RIDGE,
) -> Model | None:
    """A model from (doc_id, text, lang); None if no row has a text with letters and a
    language.

    Per language ``landmarks`` texts span the kernel space and ``sample`` texts fit the
    regression. The executors reduce a landmark to its gram codes and a training text to
    its kernel values, so what the driver gathers does not depend on the texts' lengths.
    """
    usable = training.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select("doc_id", "text", "lang")
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [np.unique(codes_of(t)).tolist() for t in batch["text"]]
            yield batch[["lang", "doc_id"]].assign(codes=codes)

    chosen = _collected(
        _sampled(usable, counts, landmarks, 1).mapInPandas(grams, "lang string, doc_id long, codes array<int>"),
        landmarks, 1, "codes",
    )
    if chosen.empty:
        return None
    sets = [np.asarray(x, np.int64) for x in chosen["codes"]]
    known = np.unique(np.concatenate(sets))
    matrix = np.zeros((len(known), len(sets)), np.float32)
    for column, codes in enumerate(sets):
        matrix[np.searchsorted(known, codes), column] = 1 / np.sqrt(len(codes))
    languages = sorted(chosen["lang"].unique())
    bare = Model(languages, known, matrix, np.zeros((len(sets), len(languages))))

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = bare.table()
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                part = batch.iloc[i : i + BATCH]
                found = kernel(part["text"].tolist(), bare, table)
                yield part[["lang", "doc_id"]].assign(kernel=found.astype(float).tolist())

    rows = _collected(
        _sampled(usable, counts, sample, 2).mapInPandas(values, "lang string, doc_id long, kernel array<double>"),
        sample, 2, "kernel",
    )
    rows = rows[rows["lang"].isin(languages)]
    # Nyström: features are the kernel values times the inverse root of the landmarks' kernel.
    among = (matrix.T @ matrix).astype(float)
    size, vectors = np.linalg.eigh(among)
    kept = size > 1e-6 * size.max()
    root = vectors[:, kept] / np.sqrt(size[kept])
    if rows.empty:
        features, target = among @ root, chosen["lang"].to_numpy()
    else:
        features, target = np.stack(rows["kernel"].to_numpy()) @ root, rows["lang"].to_numpy()
    wanted = (target[:, None] == np.array(languages)[None, :]).astype(float)
    # Languages count alike, however many texts they have.
    share = (wanted / np.maximum(wanted.sum(axis=0), 1)).sum(axis=1, keepdims=True)
    left = features.T @ (share * features) + ridge * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(left, features.T @ (share * wanted))
    return Model(languages, known, matrix, weights)


def predict(
    docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Every row of ``docs`` with the predicted language and its score, the largest
    regression value held between 0 and 1, in columns of these ``names``.

    A null text, one without letters, and any text when nothing was learned are ``und``
    with score 0. Texts are scored whole, ``BATCH`` at a time, from ``text`` alone; ties
    go to the language that sorts first. Own columns of these names are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    others = docs.drop(*names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = model.table() if model else None
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                texts = part.column("text").to_pylist()
                known = [model is not None and has_letter(t) for t in texts]
                langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if model:
                    found = kernel(texts, model, table) @ model.weights
                    best = found.argmax(axis=1)
                    top = np.clip(found[np.arange(len(texts)), best], 0.0, 1.0)
                    langs = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
                    scores = np.where(known, top, 0.0)
                columns = {name: part.column(name) for name in part.schema.names}
                columns |= {names[0]: pa.array(langs, pa.string()), names[1]: pa.array(scores)}
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema.fields)
    return others.mapInArrow(scored, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def holds_out(doc_id: Column, divisor: int) -> Column:
    """Whether crc32 of the id as text leaves 0; a null id is held out."""
    return F.coalesce(remainder(doc_id, divisor) == 0, F.lit(True))


def identify(
    docs: DataFrame,
    divisor: int = 5,
    names: tuple[str, str, str] = ("lang_pred", "score", "held_out"),
    **options,
) -> DataFrame:
    """``predict`` with a model of the rows that are not held out, and whether a row is.
    ``names``: of the language, the score and the mark of held-out rows."""
    marked = docs.withColumn(names[2], holds_out(F.col("doc_id"), divisor))
    model = fit(marked.filter(~F.col(names[2])), **options)
    return predict(marked, model, names[:2])
