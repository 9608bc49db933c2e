"""Phrases that belong together, mined with multikey three-way quicksort.

Every word of a piece begins a suffix, of which the first words up to a depth count. Suffixes
are routed by their leading words, so all suffixes that begin with one phrase meet in one
partition. There the suffix pointers are sorted word by word: around a pivot word a partition
falls into the smaller, the equal and the larger ones, and the equal ones go on with their
next word. What is equal to the full depth is a phrase, and the size of that partition its
count. A partition that is smaller than the least count is abandoned, whatever it holds.

Depth rises in three rounds: words, pairs, runs of three and four. What a round abandoned does
not set out in the next: a filter of fixed size tells the frequent words, then the frequent
pairs. It may let an infrequent one pass, which is then abandoned after routing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from culvert.llm import wordhash
from culvert.llm.shared import stored

#: A phrase is a candidate from this count on.
LEAST = 30
#: Words of the longest phrase.
LONGEST = 4
#: A candidate goes if a longer one around it has this share of its count, in percent.
INSIDE_PERCENT = 80
#: Scores are 2 * SCALE / 2 at most, where phrase and parts always occur together.
SCALE = 2_000_000
#: Phrases reported per language.
TOP = 2000
#: The language of texts that have none.
UNKNOWN = "und"
#: 2 ** FILTER_BITS places in a filter: 4 MB, at every size of the corpus.
FILTER_BITS = 25
#: Bytes of text whose equal suffixes are merged before they are sent.
BLOCK_BYTES = 6 << 20
#: Bytes of text that are cut into words at a time, which takes some fifty times as many.
CUT_BYTES = 1 << 19
#: Suffixes sorted together; equal ones are never parted.
SORTED_ROWS = 1 << 19
#: Portions of a partition by hash, of which as many are sorted together as SORTED_ROWS take.
PORTIONS = 4096
#: Places that the rows of one key are dealt over in a join.
SALTS = 16

_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~_PIECE_ENDS
_IN_WORD[[0x20, 0x09]] = False


def partitions(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` of a weight of ``least`` or more: a row of each, and weights.

    Multikey three-way quicksort of pointers to the rows, all partitions of a round at once.
    """
    at, starts, level = np.arange(len(keys)), np.zeros(min(1, len(keys)), np.int64), np.zeros(1, np.int64)
    rows, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(at):
        sizes = np.diff(np.append(starts, len(at)))
        part = np.repeat(np.arange(len(starts)), sizes)
        word = keys[at, level[part]]
        pivot = word[starts + sizes // 2][part]
        side = (word >= pivot).view(np.int8) + (word > pivot).view(np.int8)  # smaller, equal, larger
        # Stable places of the three sides of every partition.
        cell = part * 3 + side
        cells = np.bincount(cell, minlength=3 * len(starts))
        begin = np.cumsum(cells) - cells
        place = np.empty(len(at), np.int64)
        for k in range(3):
            mine = np.flatnonzero(side == k)
            owner = part[mine]
            seen = np.arange(len(mine)) - np.searchsorted(owner, np.arange(len(starts)))[owner]
            place[mine] = begin[owner * 3 + k] + seen
        moved = np.empty_like(at)
        moved[place] = at
        there = np.flatnonzero(cells)
        weight = np.add.reduceat(weights[moved], begin[there])
        depth, equal = level[there // 3], there % 3 == 1
        done = equal & (depth + 1 == keys.shape[1])
        enough = weight >= least
        rows.append(moved[begin[there[done & enough]]])
        sums.append(weight[done & enough])
        goes_on = enough & ~done
        at = moved[np.repeat(goes_on, cells[there])]
        level = (depth + equal)[goes_on]
        kept = cells[there[goes_on]]
        starts = np.cumsum(kept) - kept
    return np.concatenate(rows), np.concatenate(sums)


def pieces_of(text: pa.Array, lang: pa.Array) -> tuple[np.ndarray, np.ndarray, wordhash.Words, np.ndarray]:
    """Of all words of the texts: ids that tell language and word, whether the next word
    follows in the same piece, the words, and the bytes."""
    data, offsets = wordhash.bytes_of(text)
    words = wordhash.words_of(data, offsets, _IN_WORD, wordhash.LOWER)
    kinds = lang.dictionary_encode()
    if isinstance(kinds, pa.ChunkedArray):
        kinds = kinds.combine_chunks()
    names = kinds.dictionary.to_pylist()
    salt = np.array([_name_hash(x) for x in names] or [0], np.uint64)
    of_text = salt[kinds.indices.to_numpy(zero_copy_only=False).astype(np.int64)] if len(text) else salt[:0]
    ids = wordhash.mixed(words.hashes ^ of_text[words.text])
    ids[ids == 0] = 1  # 0 stands for no word
    ends = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_PIECE_ENDS[data], out=ends[1:])
    follows = np.zeros(len(ids), bool)
    if len(ids):
        follows[:-1] = (words.text[1:] == words.text[:-1]) & (ends[words.starts[1:]] == ends[words.ends[:-1]])
    return ids, follows, words, data


def _name_hash(name: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(name.encode())


def run_hash(words: list[np.ndarray]) -> np.ndarray:
    """One hash of a run of words, by their ids."""
    h = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        h = wordhash.mixed(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """About BLOCK_BYTES of text at a time; a longer text is a block of its own."""
    held, size = [], 0
    for batch in batches:
        step = max(1, BLOCK_BYTES * batch.num_rows // max(1, batch.column("text").nbytes))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            held.append(part)
            size += part.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _cut(block: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    """The texts of a block in their order, about CUT_BYTES at a time, and where they begin."""
    step = max(1, CUT_BYTES * block.num_rows // max(1, block.column("text").nbytes))
    for i in range(0, block.num_rows, step):
        yield block.slice(i, step), i


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    table = pa.Table.from_batches(held)
    # Offsets of 64 bits: many long texts may pass 2 GB together.
    table = table.set_column(table.schema.get_field_index("text"), "text", table["text"].cast(pa.large_string()))
    return table.combine_chunks().to_batches()[0]


def _rows(columns: dict[str, np.ndarray | list], step: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for i in range(0, n, step):
        yield pa.RecordBatch.from_pydict({k: pa.array(v[i : i + step]) for k, v in columns.items()})


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, word, f) of the distinct words of a block."""
    for block in _blocks(batches):
        parts, folded, size = [], [], 0
        for texts, before in _cut(block):
            ids, _, words, data = pieces_of(texts.column("text"), texts.column("lang"))
            found, first, times = np.unique(ids, return_index=True, return_counts=True)
            parts.append((found, times, words.text[first] + before, words.starts[first] + size, words.ends[first] + size))
            folded.append(wordhash.LOWER[data].tobytes())
            size += len(data)
        if not sum(len(p[0]) for p in parts):
            continue
        ids, times, text, starts, ends = map(np.concatenate, zip(*parts, strict=True))
        found, first, place = np.unique(ids, return_index=True, return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, place, times)
        langs = block.column("lang").take(pa.array(text[first])).to_pylist()
        whole = b"".join(folded)
        spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
        spelled_out = [whole[a:b].decode("utf-8", "replace") for a, b in spans]
        yield from _rows({"id": found.view(np.int64), "lang": langs, "word": spelled_out, "f": sums})


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def frequent_filter(spark: SparkSession, hashes: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** FILTER_BITS places of the 64-bit ``hashes.h``: what is not set is not
    among them. Its size does not depend on how many there are."""
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    cells = hashes.groupBy(F.shiftright(slot, 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h >> %d & 63 as int))" % (64 - FILTER_BITS))).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for batch in cells.toArrow().to_batches():
        at = batch.column("cell").to_numpy()
        out[at] = batch.column("bits").to_numpy().view(np.uint64)
    return out


def _distinct(ids: np.ndarray, at: np.ndarray, depth: int, deepest: int, step: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """The distinct runs of ``depth`` words that begin ``at`` some places, and how many of each."""
    runs = np.empty(len(at), np.uint64)
    for i in range(0, len(at), step):
        runs[i : i + step] = run_hash([ids[at[i : i + step] + k] for k in range(depth)])
    _, first, times = np.unique(runs, return_index=True, return_counts=True)
    first = at[first]
    del runs, at
    for i in range(0, len(first), step):
        some = first[i : i + step]
        out = {f"w{k}": ids[some + k].view(np.int64) for k in range(depth)}
        out |= {f"w{k}": np.zeros(len(some), np.int64) for k in range(depth, deepest)}
        yield from _rows(out | {"weight": times[i : i + step]}, step)


def _suffixes(words, pairs, depths: tuple[int, ...]):
    """(w0.., weight) of the distinct runs of a block, as deep as ``depths``; only runs of
    words, and of pairs, that may be frequent set out. Shallower runs end in zeros."""
    deepest = max(depths)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            parts = []
            for texts, _ in _cut(block):
                ids, follows, _, _ = pieces_of(texts.column("text"), texts.column("lang"))
                # whether the word and its next are a pair that may be frequent
                known = _passes(words.value, ids)
                pair = follows & known
                pair[:-1] &= known[1:]
                if pairs is not None:
                    at = np.flatnonzero(pair)
                    pair[at] = _passes(pairs.value, run_hash([ids[at], ids[at + 1]]))
                parts.append((ids, pair))
            ids, pair = map(np.concatenate, zip(*parts, strict=True))
            for depth in depths:
                run = pair.copy()
                for k in range(1, depth - 1):
                    run[:-k] &= pair[k:]
                    run[-k:] = False
                yield from _distinct(ids, np.flatnonzero(run), depth, deepest)

    return of


def _sorted(depth: int, least: int):
    """Partitions of the routed suffixes; the rows come by ascending portion."""
    names = [f"w{k}" for k in range(depth)]

    def found(batch: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.column_stack([batch.column(c).to_numpy().view(np.uint64) for c in names])
        rows, sums = partitions(keys, batch.column("weight").to_numpy(), least)
        yield from _rows({c: keys[rows, k].view(np.int64) for k, c in enumerate(names)} | {"f": sums})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SORTED_ROWS:
                continue
            table = pa.Table.from_batches(held)
            portion = table.column("portion").to_numpy()
            cut = int(np.searchsorted(portion, portion[-1]))
            if cut:  # the last portion may go on in the next batch
                yield from found(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).to_batches()
                size -= cut
        if held:
            yield from found(pa.Table.from_batches(held).combine_chunks())

    return of


def _round(texts: DataFrame, words, pairs, depths: tuple[int, ...], least: int) -> DataFrame:
    """(w0.., f) of the runs that are frequent."""
    names = [f"w{k}" for k in range(max(depths))]
    schema = ", ".join(f"{c} long" for c in names)
    suffixes = texts.mapInArrow(_suffixes(words, pairs, depths), f"{schema}, weight long")
    return (
        suffixes.withColumn("portion", F.pmod(F.xxhash64(F.lit("portion"), *names), F.lit(PORTIONS)).cast("int"))
        .repartition(*names)
        .sortWithinPartitions("portion")
        .mapInArrow(_sorted(len(names), least), f"{schema}, f long")
    )


def _dealt(table: DataFrame) -> DataFrame:
    """The rows of a small side once for each salt."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(*by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")


def frequent_runs(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (``id, lang, word, f``), runs of 1 to LONGEST words (``ids``, ``f``) that occur
    ``least`` times or more, and the number of words (``lang, n``)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    every = texts.mapInArrow(_words, "id long, lang string, word string, f long")
    counted = stored(every.groupBy("id", "lang", "word").agg(F.sum("f").alias("f")), "phrase-words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words = counted.filter(F.col("f") >= least)
    known = spark.sparkContext.broadcast(frequent_filter(spark, words.select(F.col("id").alias("h"))))
    pairs = stored(_round(texts, known, None, (2,), least), "phrase-pairs")
    hashed = pairs.mapInArrow(_pair_hashes, "h long")
    met = spark.sparkContext.broadcast(frequent_filter(spark, hashed))
    longer = stored(_round(texts, known, met, tuple(range(3, LONGEST + 1)), least), "phrase-runs")
    names = [f"w{k}" for k in range(LONGEST)]
    runs = (
        words.select(F.array("id").alias("ids"), "f")
        .union(pairs.select(F.array("w0", "w1"), "f"))
        .union(longer.select(F.array_remove(F.array(*names), 0), "f"))
    )
    return words, runs, totals


def _pair_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [batch.column(c).to_numpy().view(np.uint64) for c in ("w0", "w1")]
        yield pa.RecordBatch.from_pydict({"h": pa.array(run_hash(words).view(np.int64))})


def scored(runs: DataFrame) -> DataFrame:
    """(ids, a, l, r, score) of the candidates that stand in no longer one of nearly their
    count. A candidate's score is that of its weakest cut, ties to the first.

    Products are decimals of 38 digits, quotients whole.
    """
    candidates = runs.filter(F.size("ids") >= 2).withColumnRenamed("f", "a")
    cuts = candidates.select(
        "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    ).select(
        "ids", "a", "k", F.expr("slice(ids, 1, k)").alias("head"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("tail")
    )
    known = _dealt(runs)
    for side, name in (("head", "l"), ("tail", "r")):
        part = known.select(F.col("ids").alias(side), F.col("f").alias(name), "salt")
        cuts = cuts.withColumn("salt", _salt("ids", "k")).join(part, [side, "salt"]).drop("salt")
    score = F.expr(f"cast({SCALE} * cast(a as decimal(26,0)) as decimal(38,0)) div (cast(l as decimal(20,0)) + r)")
    weakest = cuts.withColumn("score", score).groupBy("ids").agg(
        F.min("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = F.expr(
        "filter(flatten(transform(sequence(2, size(ids) - 1), m -> "
        "transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m)))), x -> size(x) >= 2)"
    )
    around = (
        candidates.filter(F.size("ids") > 2)
        .select(F.explode(inner).alias("ids"), F.col("a").alias("f"))
        .groupBy("ids")
        .agg(F.max("f").alias("most"))
    )
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    hidden = F.coalesce(100 * whole("most") >= INSIDE_PERCENT * whole("a"), F.lit(False))
    return (
        weakest.join(around, "ids", "left")
        .filter(~hidden)
        .select("ids", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    )


def spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with its ``lang`` and ``phrase`` in place of ``ids``."""
    rest = [c for c in found.columns if c != "ids"]
    places = found.select("ids", *rest, F.posexplode("ids").alias("place", "id"))
    named = places.withColumn("salt", _salt("ids", "place")).join(
        _dealt(words.select("id", "lang", "word")), ["id", "salt"]
    )
    by_place = F.array_sort(F.collect_list(F.struct("place", "word")))
    return named.groupBy("ids", *rest).agg(
        F.min("lang").alias("lang"), F.array_join(by_place["word"], " ").alias("phrase")
    ).drop("ids")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are those between blanks and tabs, with A-Z in lower case; no phrase runs over one
    of ``. , ; : ! ?`` or a line end, nor over the end of a text. ``a``, ``l`` and ``r`` count
    all occurrences, overlapping ones included, of the phrase and of the two parts of its
    weakest cut, ``n`` all words of the language. Equal scores and counts go by the bytes of
    the phrase, so ranks are settled.

    Equal suffixes of 6 MB of text are merged before they are sent, so a phrase reaches its
    partition once per block, however hot it is, and a partition is sorted in portions of
    half a million and more. Words and runs are told apart by 64-bit hashes.

    Null texts have no words, texts without language are ``und``. Repeated rows count each
    time. A text of any length is worked through whole. Empty tables, and languages without
    a frequent phrase, give no rows. Only ``text`` and ``lang`` are read.
    """
    words, runs, totals = frequent_runs(docs, least)
    found = spelled(scored(runs), words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each portion of a language first, so that no task ranks all of one.
    portion = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = found.withColumn("portion", portion).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "portion").orderBy(*order))
    ).filter(F.col("place") <= top)
    ranked = best.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for ``collocations``.
ORACLE = f"""
WITH piece AS (
  SELECT lang, doc, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS piece FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, row_number() OVER () AS doc,
      regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS p FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, m, w[i : i + m - 1] AS g FROM (
    SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i
    FROM words, (SELECT unnest(range(1, {LONGEST + 1})) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, g, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= {LEAST}),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cut AS (SELECT lang, m, g, f AS a, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
part AS (
  SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r,
    CAST((CAST({SCALE} AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : c.k]
  JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1 :]),
weakest AS (
  SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, g[i : i + s - 1] AS g, max(f) AS most FROM (
    SELECT lang, g, f, s, unnest(range(1, m - s + 2)) AS i
    FROM f, (SELECT unnest(range(2, {LONGEST})) AS s) WHERE m > s) GROUP BY ALL),
named AS (
  SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, score
  FROM weakest w LEFT JOIN inside s ON s.lang = w.lang AND s.g = w.g
  WHERE NOT coalesce(100 * CAST(most AS HUGEINT) >= {INSIDE_PERCENT} * CAST(a AS HUGEINT), false)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
