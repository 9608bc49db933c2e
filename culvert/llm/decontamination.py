"""Benchmark decontamination by a positional inverted index over the training texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from culvert.llm import wordhash
from culvert.llm.shared import fresh, stored

WINDOW = 10
#: Words beyond its length within which the terms of a window count as close.
SLOP = 3
#: Words of text in one segment of the index: what one task searches at a time.
SEGMENT_WORDS = 1 << 20
#: Windows searched in one pass over the index; a larger benchmark takes more passes.
WINDOWS_AT_ONCE = 200_000
#: Texts whose words are cut out at a time.
ROWS = 256

_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if wordhash.ALPHANUMERIC[c] else 32 for c in range(256)
)

POSTINGS = "segment long, term string, n long, positions array<int>"
DOCUMENTS = "segment long, row long, doc_id long, first int, n_words long"


def words(text: str | None) -> list[str]:
    """Lower-case words of a text: runs of a-z, 0-9 and what is beyond ASCII; none of a null."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return [w.decode("utf-8", "surrogatepass") for w in found]


def hashes_of(terms: list[str]) -> np.ndarray:
    column = pa.array(terms, pa.string())
    found = wordhash.words_of(*wordhash.bytes_of(column), wordhash.ALPHANUMERIC, wordhash.LOWER)
    return found.hashes


def items_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows to search for: (item_id, number, terms). An item of fewer words is one
    window, an item without words none. An item without id is called ``null``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                found = words(text)
                if found:
                    count = max(1, len(found) - window + 1)
                    rows += [(item, i, found[i : i + window]) for i in range(count)]
            yield pd.DataFrame(rows, columns=["item_id", "number", "terms"])

    named = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    wanted = benchmark.select(named.alias("item_id"), "text")
    return wanted.mapInPandas(cut, "item_id string, number int, terms array<string>")


@dataclass(frozen=True)
class Index:
    """``postings``: per segment and term the ascending positions of the term, counted
    through all texts of the segment with one position free between two texts.
    ``documents``: per text its segment and first position."""

    postings: DataFrame
    documents: DataFrame


class _Segment:
    """Words of the texts read so far: vocabulary numbers, or hashes and their strings."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.strings: dict[int, str] = {}
        self.docs: list[tuple] = []
        self.place = 0


def _segments(vocabulary: list[str] | None, segment_words: int):
    """Rows of both tables of the index, told apart by a null ``term``."""
    if vocabulary is not None:
        known = hashes_of(vocabulary)
        order = np.argsort(known)
        known, names = known[order], [vocabulary[i] for i in order.tolist()]

    def add(segment: _Segment, part: pa.RecordBatch) -> None:
        data, offsets = wordhash.bytes_of(part.column("text"))
        found = wordhash.words_of(data, offsets, wordhash.ALPHANUMERIC, wordhash.LOWER)
        counts = found.per_text()
        # One place is free behind every text.
        firsts = segment.place + np.cumsum(counts + 1) - (counts + 1)
        at = np.arange(len(found.hashes)) + found.text + segment.place
        if vocabulary is None:
            unique, where = np.unique(found.hashes, return_index=True)
            for h, i in zip(unique.tolist(), where.tolist(), strict=True):
                if h not in segment.strings:
                    raw = wordhash.LOWER[data[found.starts[i] : found.ends[i]]].tobytes()
                    segment.strings[h] = raw.decode("utf-8", "surrogatepass")
            segment.parts.append((found.hashes, at))
        elif len(known):
            number = np.minimum(np.searchsorted(known, found.hashes), len(known) - 1)
            asked = known[number] == found.hashes
            segment.parts.append((number[asked].astype(np.uint64), at[asked]))
        columns = (part.column(c).to_pylist() for c in ("row", "doc_id"))
        segment.docs += zip(*columns, firsts.tolist(), counts.tolist(), strict=True)
        segment.place += int(counts.sum()) + len(counts)

    def closed(segment: _Segment, number: int) -> pa.RecordBatch:
        ids = np.concatenate([x for x, _ in segment.parts] or [np.zeros(0, np.uint64)])
        at = np.concatenate([x for _, x in segment.parts] or [np.zeros(0, np.int64)])
        order = np.argsort(ids, kind="stable")
        ids, at = ids[order], at[order].astype(np.int32)
        cuts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
        ends = np.append(cuts, len(ids))
        of = segment.strings.__getitem__ if vocabulary is None else names.__getitem__
        n, docs = len(cuts), segment.docs
        lists = [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at)),
            pa.nulls(len(docs), pa.list_(pa.int32())),
        ]
        row, doc, first, count = zip(*docs, strict=True) if docs else ((),) * 4
        blank, none = [None] * n, [None] * len(docs)
        return pa.RecordBatch.from_pydict(
            {
                "segment": pa.array(np.full(n + len(docs), number, np.int64)),
                "term": pa.array([of(i) for i in ids[cuts].tolist()] + none, pa.string()),
                "n": pa.array(np.diff(ends).tolist() + none, pa.int64()),
                "positions": pa.concat_arrays(lists),
                "row": pa.array([*blank, *row], pa.int64()),
                "doc_id": pa.array([*blank, *doc], pa.int64()),
                "first": pa.array([*blank, *first], pa.int32()),
                "n_words": pa.array([*blank, *count], pa.int64()),
            }
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment = TaskContext.get().partitionId() << 33, _Segment()
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                add(segment, batch.slice(i, ROWS))
                if segment.place >= segment_words:
                    yield closed(segment, number)
                    number, segment = number + 1, _Segment()
        if segment.docs:
            yield closed(segment, number)

    return of


def build_index(
    docs: DataFrame,
    vocabulary: list[str] | None = None,
    segment_words: int = SEGMENT_WORDS,
    row_col: str | None = None,
) -> Index:
    """Index of every word of every text, written to the shared folder.

    A task indexes the texts it reads, without a shuffle, as segments of about
    ``segment_words`` words each; a longer text is one segment. With a ``vocabulary`` only
    postings of its terms are stored, since no others are asked for. Null texts have no
    words; rows that repeat an id are indexed each. ``row`` is the column ``row_col``, or a
    number that holds within this index only: another scan may number the rows otherwise.
    """
    row = F.monotonically_increasing_id() if row_col is None else docs[row_col]
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], row.alias("row"))
    both = keyed.mapInArrow(
        _segments(vocabulary, segment_words),
        f"{POSTINGS}, row long, doc_id long, first int, n_words long",
    )
    rows = stored(both, "positional-index")
    documents = rows.filter("term IS NULL").select("segment", "row", "doc_id", "first", "n_words")
    return Index(rows.filter("term IS NOT NULL").select("segment", "term", "n", "positions"), documents)


def phrase(lists: list[np.ndarray]) -> np.ndarray:
    """First positions where term i stands i places on, from the rarest list to the most
    frequent."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        wanted, have = starts + i, lists[i]
        at = np.searchsorted(have, wanted)
        starts = starts[(at < len(have)) & (have[np.minimum(at, len(have) - 1)] == wanted)]
    return starts


def close_together(lists: list[np.ndarray], span: int) -> np.ndarray:
    """First positions of spans of ``span`` places that hold every term and begin with one
    of them; anchored at the postings of the rarest term."""
    rarest = min(lists, key=len)
    starts = np.unique((rarest[:, None] - np.arange(span)[None, :]).ravel())
    begins = np.zeros(len(starts), bool)
    for have in sorted(lists, key=len):
        at = np.searchsorted(have, starts)
        value = have[np.minimum(at, len(have) - 1)]
        inside = (at < len(have)) & (value < starts + span)
        begins |= inside & (value == starts)
        starts, begins = starts[inside], begins[inside]
        if not len(starts):
            break
    return starts[begins]


MATCHES = "segment long, item_id string, number int, kind string, position int, length int"


def _search(windows: list[tuple[str, int, list[str]]], slop: int | None):
    """Matches of the windows in one segment."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, _, terms in windows for w in terms}))}
    width = max((len(terms) for _, _, terms in windows), default=1)
    matrix = np.full((len(windows), width), len(vocabulary), np.int64)
    for i, (_, _, terms) in enumerate(windows):
        matrix[i, : len(terms)] = [vocabulary[w] for w in terms]

    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        lists: list[np.ndarray | None] = [None] * len(vocabulary)
        present = np.zeros(len(vocabulary) + 1, bool)
        present[-1] = True
        for term, positions in zip(group["term"], group["positions"], strict=True):
            number = vocabulary.get(term)
            if number is not None:
                lists[number], present[number] = np.asarray(positions, np.int64), True
        rows = []
        for i in np.flatnonzero(present[matrix].all(axis=1)).tolist():
            item, number, terms = windows[i]
            own = [lists[vocabulary[w]] for w in terms]
            exact = phrase(own)
            rows += [(key[0], item, number, "phrase", int(p), len(terms)) for p in exact]
            if slop is not None:
                span = len(terms) + slop
                near = close_together([lists[vocabulary[w]] for w in set(terms)], span)
                taken = np.concatenate([exact + d for d in range(-slop, 1)]) if len(exact) else exact
                rows += [
                    (key[0], item, number, "near", int(p), span) for p in near if p not in taken
                ]
        names = ["segment", "item_id", "number", "kind", "position", "length"]
        return pd.DataFrame(rows, columns=names)

    return of


def search(
    index: Index, items: DataFrame, slop: int | None = SLOP, windows_at_once: int = WINDOWS_AT_ONCE
) -> DataFrame:
    """Matches of the windows ``items``: exact phrases, and ``near`` ones, where all terms of
    a window lie within its length and ``slop`` words (None: phrases only).

    Positions count within the segment. The windows go to the tasks in blocks of about
    ``windows_at_once``, each one pass over the index; postings meet by segment, whose size
    is bounded, so no term is a hot key.
    """
    spark = index.postings.sparkSession
    count = items.count()
    blocks = -(-count // windows_at_once)
    found = spark.createDataFrame([], MATCHES)
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "number"), F.lit(blocks)) == block)
        windows = [(r.item_id, r.number, list(r.terms)) for r in mine.collect()]
        terms = spark.createDataFrame(
            [(w,) for w in sorted({w for _, _, x in windows for w in x})], "term string"
        )
        asked = index.postings.join(F.broadcast(terms), "term", "left_semi")
        found = found.union(
            asked.groupBy("segment").applyInPandas(_search(windows, slop), MATCHES)
        )
    return found


def hits(index: Index, matches: DataFrame) -> DataFrame:
    """Per text of the index: ``row``, ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    match) and ``items`` (their ids, distinct and sorted as strings).

    A match never runs over the free place between two texts, as no term stands there.
    """

    def spans(key: tuple, documents: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        documents = documents.sort_values("first")
        first = documents["first"].to_numpy()
        counts = np.zeros(len(first), np.int64)
        items: list[set[str]] = [set() for _ in first]
        if len(found):
            length = int(first[-1] + documents["n_words"].iloc[-1]) + 2
            edges = np.zeros(length + int(found["length"].max()), np.int64)
            begin = found["position"].to_numpy()
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + found["length"].to_numpy(), -1)
            at = np.flatnonzero(np.cumsum(edges) > 0)
            counts = np.bincount(np.searchsorted(first, at, "right") - 1, minlength=len(first))
            owner = np.searchsorted(first, begin, "right") - 1
            for i, item in zip(owner.tolist(), found["item_id"], strict=True):
                items[i].add(item)
        return pd.DataFrame(
            {
                "row": documents["row"],
                "doc_id": documents["doc_id"].astype("Int64"),
                "n_words": documents["n_words"],
                "n_hit": counts,
                "items": [sorted(x) for x in items],
            }
        )

    distinct = matches.select("segment", "item_id", "position", "length").distinct()
    return (
        index.documents.groupBy("segment")
        .cogroup(distinct.groupBy("segment"))
        .applyInPandas(spans, "row long, doc_id long, n_words long, n_hit long, items array<string>")
    )


def vocabulary_of(items: DataFrame, most: int = 1 << 20) -> list[str] | None:
    """The terms of the windows, or None, meaning all terms, if they are more than ``most``."""
    terms = items.select(F.explode("terms").alias("term")).distinct()
    found = [r.term for r in terms.limit(most + 1).collect()]
    return sorted(found) if len(found) <= most else None


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, row_col: str | None = None
) -> DataFrame:
    """``hits`` of exact windows of the benchmark in every text of ``docs``.

    Null and empty texts have no words and no hits; a benchmark without words hits
    nothing. Repeated rows are reported each, in ``row`` numbers of the scan. Clashing
    names in either table do not matter, as only ids and texts are read.
    """
    items = stored(items_of(benchmark, window), "benchmark-windows")
    index = build_index(docs, vocabulary_of(items), row_col=row_col)
    return hits(index, search(index, items, slop=None))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with the columns they have."""
    row = fresh("row")
    # Written once with their numbers: another scan of ``docs`` might number them otherwise.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination-rows")
    found = decontaminate(numbered, benchmark, window, row)
    hit = found.filter("n_hit > 0").select(F.col("row").alias(row))
    return numbered.join(stored(hit, "contaminated"), row, "left_anti").select(*docs.columns)


#: DuckDB SQL for ``op6_positional_index``.
ORACLE = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT id, w, least(len(w), {WINDOW}) AS n FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT id, n, array_to_string(w[i : i + n - 1], ' ') AS terms
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS terms
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hit AS (SELECT doc_id, i, n, id FROM place JOIN win USING (n, terms)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
