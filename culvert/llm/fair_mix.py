"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, served again from the start when it ends.
A packet, a document's turn in its queue, has the virtual finish time *words of the source up
to its end divided by the target of the source*. All packets are sorted by that time and
served until the budget is used up, which by then gives every source its target.

Running sums over a sorted table are taken by ranges: each task sums its range, and the sums
of the ranges before it are added. So no task sees all of a source, however large.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from culvert.llm import wordhash
from culvert.llm.shared import stored

#: Weights of the sources in their order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: A document is taken so many times at most.
REPEATS = 3
#: What the hash that shuffles a source begins with.
SEED = "mix"
#: Places that the documents of one source are dealt over in a join.
SALTS = 32
#: Bytes of text counted at a time.
BLOCK_BYTES = 4 << 20


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of words in place of the text."""
    for batch in batches:
        step = max(1, BLOCK_BYTES * batch.num_rows // max(1, batch.column("text").nbytes))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            data, offsets = wordhash.bytes_of(part.column("text"))
            inside = wordhash.NOT_BLANK[data]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            cut = offsets[:-1][offsets[:-1] < len(data)]
            begins[cut] = inside[cut]
            size = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
            columns = {"doc_id": part.column("doc_id"), "source": part.column("source")}
            yield pa.RecordBatch.from_pydict(columns | {"size": pa.array(size, pa.int64())})


def _summed(names: Sequence[str]):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with their range and the sums of the rows before them in it."""
        number, sums = TaskContext.get().partitionId(), [0] * len(names)
        for batch in batches:
            out = batch.append_column("range", pa.array(np.full(batch.num_rows, number, np.int32)))
            for k, name in enumerate(names):
                values = batch.column(name).to_numpy(zero_copy_only=False)
                ends = sums[k] + np.cumsum(values)
                out = out.append_column(f"{name}_before", pa.array(ends - values))
                sums[k] = int(ends[-1]) if len(ends) else sums[k]
            yield out

    return of


def running(df: DataFrame, order: Sequence[Column], values: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``<value>_before``: the sum over all rows before a row in ``order``.

    The table is range-partitioned, sorted and written once; what is gathered is one row
    per range. Rows that are equal in ``order`` should be alike in all that matters.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    added = ", ".join(f"{v}_before long" for v in values)
    ranges = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_summed(values), f"{fields}, range int, {added}"),
        name,
    )
    totals = ranges.groupBy("range").agg(*(F.sum(v).alias(f"_{v}") for v in values))
    firsts = totals.selectExpr(
        "range", *(f"sum(_{v}) OVER (ORDER BY range ROWS UNBOUNDED PRECEDING) - _{v} AS _{v}" for v in values)
    )
    before = [(F.col(f"{v}_before") + F.col(f"_{v}")).alias(f"{v}_before") for v in values]
    return ranges.join(F.broadcast(firsts), "range").select(*df.columns, *before)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size`` with ``target`` and ``rank``, the place of the source by code
    point, null last.

    The sources share all words by weight; none gets more than ``repeats`` times what it
    has, and what that frees is shared by weight among the others. Filled by rising ratio
    of room to weight, the sources that stop short come first, so one level tells all.
    """
    ranked = running(
        sources.withColumn("one", F.lit(1).cast("long")), [F.asc_nulls_last("source")], ["one"], "mix-ranks"
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("one_before", F.lit(len(weights))) + 1).cast("int"))
    room = ranked.select(
        "source",
        "source_size",
        F.col("one_before").alias("rank"),
        weight.cast("long").alias("weight"),
        (F.col("source_size") * repeats).alias("room"),
    ).withColumn("ratio", F.col("room") / F.col("weight"))
    filled = stored(running(room, [F.asc("ratio"), F.asc("rank")], ["room", "weight"], "mix-levels"), "mix-levels")
    whole = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    # Water level if this source and all behind it are not full yet.
    level = (F.lit(whole.size) - F.col("room_before")) / (F.lit(whole.weight) - F.col("weight_before"))
    open_ = filled.filter(F.col("ratio") > level).agg(F.min(F.struct("ratio", "rank", level.alias("level"))).alias("x")).first().x
    if open_ is None:  # no source holds a word
        share = F.col("room").cast("double")
    else:
        tie = (F.col("ratio") == open_.ratio) & (F.col("rank") < open_.rank)
        full = (F.col("ratio") < open_.ratio) | tie
        share = F.when(full, F.col("room").cast("double")).otherwise(F.col("weight") * F.lit(open_.level))
    return filled.select("source", "source_size", "rank", share.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, seed: str = SEED
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size`` (words), ``source_size``, ``target`` (of
    its source), ``taken`` (words the mix takes, repeats counted) and ``first_at``, the words
    of the mix in front of its first packet (null where nothing is taken).

    The budget is the number of words of all documents. A source is shuffled by the md5 of
    ``seed`` and id, alike in every run. A document in service at the moment when all
    targets are met is cut there into two packets, so that a source misses its target by a
    word or two however long its documents are; packets that begin later lie beyond the
    budget and are not made.

    Null and empty texts have no words and are taken with none. A null source is a source of
    its own, the last one. A null id is shuffled as an empty text. Rows that repeat an id are
    documents each; rows alike in id, source and size may stand for one another. An empty
    table gives no rows. Only ``doc_id``, ``text`` and ``source`` are read.
    """
    sized = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "source", "text").mapInArrow(
        _sized, "doc_id long, source string, size long"
    )
    # The rows are written with their numbers, which later steps join by.
    rows = stored(sized.withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    goals = stored(goals, "mix-targets")
    turn = F.md5(F.concat(F.lit(f"{seed} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    queued = running(
        rows.withColumn("turn", turn),
        [F.asc_nulls_last("source"), F.asc("turn"), F.asc("size"), F.asc("row")],
        ["size"],
        "mix-queues",
    )
    # A source begins where the running sum of its first document does.
    starts = queued.groupBy("source").agg(F.min("size_before").alias("start"))
    named = stored(goals.join(starts.withColumnRenamed("source", "of"), F.expr("source <=> of")).drop("of"), "mix-sources")
    served = _beside(queued, named)
    begin = F.col("size_before") - F.col("start") + F.col("epoch") * F.col("source_size")
    goal = F.ceil("target").cast("long")
    packets = (
        served.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .select("row", "rank", "target", begin.alias("begin"), F.least("size", goal - begin).alias("words"))
        .filter("words > 0")
        .withColumn("end", F.col("begin") + F.col("words"))
        .select("row", "rank", "end", "words", (F.col("end") / F.col("target")).alias("finish"))
    )
    budget = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words")).first().words
    order = [F.asc("finish"), F.asc("rank"), F.asc("end")]
    left = F.lit(budget) - F.col("words_before")
    sent = (
        running(packets, order, ["words"], "mix-order")
        .filter(left > 0)
        .groupBy("row")
        .agg(F.sum(F.least("words", left)).alias("taken"), F.min("words_before").alias("first_at"))
    )
    return served.join(sent, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_at"
    )


def _beside(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source; the rows of one source are dealt over SALTS
    places, and the table of sources goes to each."""
    dealt = sources.withColumnRenamed("source", "of").withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salted = rows.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    return salted.join(dealt, F.expr("source <=> of AND salt = at")).drop("of", "at", "salt")


#: DuckDB SQL for ``mix`` with the weights, repeats and seed above.
ORACLE = f"""
WITH doc AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5('{SEED} ' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn, row_number() OVER () AS id FROM documents),
source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM doc GROUP BY source),
room AS (
  SELECT *, {REPEATS} * source_size AS room, list_extract({list(WEIGHTS)}, 1 + rank % {len(WEIGHTS)}) AS weight FROM source),
level AS (
  SELECT *, room / weight AS ratio,
    (sum(source_size) OVER () - sum(room) OVER (ORDER BY room / weight, rank) + room)
    / (sum(weight) OVER () - sum(weight) OVER (ORDER BY room / weight, rank) + weight) AS level FROM room),
open AS (SELECT ratio, rank, level FROM level WHERE ratio > level ORDER BY ratio, rank LIMIT 1),
goal AS (
  SELECT l.source, l.source_size, l.rank, CASE WHEN o.rank IS NULL OR (l.ratio, l.rank) < (o.ratio, o.rank)
    THEN CAST(room AS DOUBLE) ELSE weight * o.level END AS target
  FROM level l LEFT JOIN open o ON true),
queue AS (
  SELECT d.*, source_size, rank, target,
    sum(size) OVER (PARTITION BY rank ORDER BY turn, size, id) - size AS start
  FROM doc d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
packet AS (
  SELECT *, words + start_at AS stop, (words + start_at) / target AS finish FROM (
    SELECT id, rank, target, start + epoch * source_size AS start_at,
      least(size, CAST(ceil(target) AS BIGINT) - (start + epoch * source_size)) AS words
    FROM queue, (SELECT unnest(range(0, {REPEATS})) AS epoch)) WHERE words > 0),
line AS (SELECT *, sum(words) OVER (ORDER BY finish, rank, stop) - words AS before FROM packet),
sent AS (
  SELECT id, CAST(sum(least(words, budget - before)) AS BIGINT) AS taken, CAST(min(before) AS BIGINT) AS first_at
  FROM line, (SELECT sum(size) AS budget FROM doc) WHERE before < budget GROUP BY id)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0) AS taken, first_at
FROM queue LEFT JOIN sent USING (id)
"""
