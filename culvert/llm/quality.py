"""Quality rules in plain Columns: base counts per text, then a log-likelihood ratio
of hashed word n-grams between a trusted target and the raw corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from culvert.functions.results import computed_once
from culvert.llm.shared import fresh, stored, words_of

#: Buckets that unigrams and bigrams are hashed into; the size of the model.
BUCKETS = 1 << 14
#: By how much every bucket of the target is drawn to its share in the corpus: what the target
#: holds little evidence of has a ratio near 1. In mean occurrences of a bucket in the target,
#: so that a text is judged alike in a table of any size.
SMOOTHING = 1.75
#: Mean log ratio (nats per n-gram) below which a text is rejected.
THRESHOLD = -0.045
#: Weights are whole multiples of 1 / SCALE, so sums do not depend on their order.
SCALE = 1_000_000

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_buckets(hashes: Column, buckets: int) -> Column:
    """Bucket of each word and of each pair of neighbouring words."""
    pairs = F.transform(
        F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(F.get(hashes, i), h), F.lit(buckets)).cast("int"),
    )
    singles = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return F.concat(singles, pairs)


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that the text holds at least twice."""
    none = F.expr("CAST(array() AS array<bigint>)")
    windows = F.when(
        F.size(hashes) >= 3,
        F.transform(
            F.slice(hashes, 3, F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda h, i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), h),
        ),
    ).otherwise(none)

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(ordered: Column) -> Column:
            again = F.filter(
                ordered,
                lambda x, j: x["h"].eqNullSafe(F.get(ordered, j - 1)["h"])
                | x["h"].eqNullSafe(F.get(ordered, j + 1)["h"]),
            )
            spread = F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
            return F.size(F.array_distinct(F.flatten(spread)))

        return _let(placed, twice)

    return _let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0),
    ).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def base_counts(text: Column, words: Column, hashes: Column) -> dict[str, Column]:
    """The counts that need no corpus; all are 0 for a null or empty text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(hashes),
    }


def ratio_weights(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING
) -> DataFrame:
    """One row with the weight of every bucket: the log of its occurrences in the target
    (documents labelled quality 1) over those expected from its share in the raw corpus
    (all documents), both with ``smoothing`` times the target's mean count of a bucket added.

    The counts cover every word of every text. Only ``buckets`` sums leave a task.
    Without a target or a corpus all weights are 0.
    """
    trusted = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("trusted_id"))
        .distinct()
        # The same join at every size; only the ids are held in memory, a part at a time.
        .hint("shuffle_hash")
    )
    grams = gram_buckets(F.col("hashes"), buckets)
    counts = (
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
        .select(F.col("trusted_id").isNotNull().alias("target"), words_of("text").alias("words"))
        .select("target", _hashes(F.col("words")).alias("hashes"))
        .select("target", F.explode(grams).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("target").alias("target"))
    )
    every = (
        docs.sparkSession.range(0, buckets, 1, 1)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .na.fill(0)
    )
    lists = every.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("n_raw"),
        F.sum("target").alias("n_target"),
    )
    def weight(x: Column) -> Column:
        expected = F.col("n_target") * x["raw"] / F.col("n_raw")
        added = F.col("n_target") * smoothing / buckets
        ratio = F.log((x["target"] + added) / (expected + added))
        some = (F.col("n_raw") > 0) & (F.col("n_target") > 0)
        return F.when(some, F.round(ratio * SCALE).cast("long")).otherwise(F.lit(0).cast("long"))

    return lists.select(F.transform("all", weight).alias("weights"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    name: str = "quality",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Every row of ``docs`` with one more column, ``name``: a struct of the base
    counts, ``n_grams``, ``score`` (mean log ratio per n-gram), ``base_failed`` and ``kept``.

    The bucket counts are one shuffle of the texts to meet their labels and one of at
    most ``buckets`` rows per task. Judging itself is row by row: the weights (``buckets``
    longs, whatever the size of the corpus) enter as a scalar subquery.

    A null or empty text has no words, fails the base rules and is not kept; its score
    is 0. Repeated rows are judged each. A null ``doc_id`` never belongs to the target. A
    text of any length is counted whole, in one row. An empty table gives an empty result.
    Only ``doc_id`` and ``text`` are read; an own column ``name`` is replaced.
    """
    weights = stored(ratio_weights(docs, labels, buckets, smoothing), "quality-weights").scalar()
    words, hashes, model = fresh("words"), fresh("hashes"), fresh("weights")
    prepared = docs.withColumn(words, words_of("text")).withColumn(hashes, _hashes(F.col(words)))
    grams = gram_buckets(F.col(hashes), buckets)
    total = F.aggregate(grams, F.lit(0).cast("long"), lambda s, b: s + F.get(F.col(model), b))
    counts = base_counts(F.col("text"), F.col(words), F.col(hashes))
    n_words = F.size(words)
    figures = F.struct(
        *[column.alias(x) for x, column in counts.items()],
        (n_words + F.greatest(n_words - 1, F.lit(0))).cast("long").alias("n_grams"),
        total.alias("total"),
    )
    counted = computed_once(prepared.withColumn(model, weights).withColumn(name, figures), name)
    q = lambda x: F.col(f"{name}.{x}")
    failed = (q("n_words") < MIN_WORDS) | (
        100 * q("n_repeat_words") > MAX_REPEAT_PERCENT * q("n_words")
    )
    score = F.when(q("n_grams") > 0, q("total") / SCALE / q("n_grams")).otherwise(F.lit(0.0))
    return counted.drop(words, hashes, model).withColumn(
        name,
        F.struct(
            *[q(x).alias(x) for x in (*counts, "n_grams")],
            score.alias("score"),
            failed.alias("base_failed"),
            (~failed & (score >= threshold)).alias("kept"),
        ),
    )
