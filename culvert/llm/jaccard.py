"""Exact Jaccard self-join of documents on word shingles with a token-group matrix.

Similar documents are brought together first. A document's shingles are dealt into as many
parts as two linked documents can differ in, and some more; the hash of a part is a *mark*
(below 85 percent, of two parts together). Linked documents have a mark in common,
unrelated ones hardly ever, so documents connected by marks are a family, and no link leaves
a family. Families are compared in units of at
most two blocks. In a unit documents next to each other in min-hash order form groups. The
matrix holds the union of shingles of every group, a document's overlap with a union bounds
its overlap with every member, and only groups whose bound allows a link are opened.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from culvert.llm import wordhash
from culvert.llm.shared import fresh, stored

#: Words of a shingle, where a caller names no other number.
SHINGLE = 3
#: Two documents link if 100 * intersection >= PERCENT * union, or the caller's percent.
PERCENT = 90
#: Documents of a group in the matrix, and of a block; larger families are cut into blocks,
#: and each two blocks meet in a unit.
GROUP, BLOCK = 32, 512
#: Parts of fewer shingles are no marks, so a sentence that many documents share makes none;
#: below 90 percent parts are smaller, and it takes one shingle less.
LEAST = 3
#: Below this percent parts hold so few shingles that a part alone says little; there two parts
#: together are a mark (``pair_marks``), which takes twice as many marks.
PARTS_FROM = 85
#: Bytes of text hashed at a time.
BLOCK_BYTES = 1 << 20

# The sizes of sets are cut into frames; a pair is compared in the frame of the larger.
_FRAME_BITS = 6
_FRAMES = (1 << _FRAME_BITS) - 1


@functools.cache
def _plan(percent: int) -> dict[str, np.ndarray]:
    """Per frame: its largest size, the parts of a set, the parts that two linked sets share
    at least, and the groups that ``pair_marks`` deals the parts into.

    A frame is a third larger than the one before, so sets linked at 75 percent or more are
    in the same frame or in neighbours.
    """
    if not 75 <= percent <= 100:
        raise ValueError(f"{percent} percent: sets linked below 75 can be two frames apart")
    upper = [1]
    while len(upper) < _FRAMES:
        upper.append(max(upper[-1] + 1, upper[-1] * 4 // 3))
    # union - intersection <= (1 - t) * union and a + b >= (1 + t) * union
    differ = [2 * u * (100 - percent) // (100 + percent) for u in upper]
    spare = [max(2, d // 2) if percent < PARTS_FROM else 1 + max(1, d // 4) for d in differ]
    parts = [d + n if d else 1 for d, n in zip(differ, spare, strict=True)]
    need = [p - d for p, d in zip(parts, differ, strict=True)]
    groups = [max(1, 4 * n // 5) for n in need]
    plan = (("upper", upper), ("parts", parts), ("need", need), ("groups", groups))
    return {name: np.array(x, np.int64) for name, x in plan}


def sets_of(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, one text after the other; and how many."""
    words = wordhash.words_of(*wordhash.bytes_of(column), wordhash.NOT_BLANK, wordhash.LOWER)
    found, counts = wordhash.shingles(words, size)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(found)
    order = order[np.argsort(text[order], kind="stable")]
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.bincount(text[new], minlength=len(counts))


def _prefix(
    found: np.ndarray, counts: np.ndarray, percent: int, chosen: np.ndarray, number: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n - ceil(t * n) + 1`` shingles of the chosen sets as marks.

    Linked sets have ``t`` of either set in common. Of what they have in common, the first in
    the order of all shingles stands in both prefixes: were it behind the prefix of a set,
    that set would have fewer than ``t`` of its shingles left to share.
    """
    length = np.where(chosen, counts - -(-counts * percent // 100) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), length)
    # The shingles of a set are ascending, so these are its first ones.
    ahead = found[(np.cumsum(counts) - counts)[owner] + wordhash.within(length)]
    kind = number[owner].astype(np.uint64)
    mark = wordhash.mixed(wordhash.mixed(ahead ^ np.uint64(0x2545F4914F6CDD1D)) + kind)
    return (mark & ~np.uint64(_FRAMES)) | kind, owner


def _dealt(found: np.ndarray, counts: np.ndarray, chosen: np.ndarray, parts: np.ndarray):
    """The shingles of the chosen sets dealt into their parts: where each set's parts begin,
    the hash of each part's content, the shingles it holds, and the set it is of."""
    text = np.repeat(np.arange(len(counts)), counts)
    mine = chosen[text]
    shingle, at = found[mine], text[mine]
    first = np.cumsum(parts) - parts
    slot = first[at] + ((shingle >> np.uint64(16)) % parts[at].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(int(parts.sum()), np.uint64)
    np.add.at(sums, slot, wordhash.mixed(shingle ^ np.uint64(0x5BD1E995)))
    held = np.bincount(slot, minlength=len(sums))
    return first, sums, held, np.repeat(np.arange(len(counts)), parts)


def pair_marks(
    found: np.ndarray, counts: np.ndarray, percent: int, chosen: np.ndarray, number: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of two parts together, for the chosen sets in the frames ``number``.

    The parts of a set are dealt into fewer groups than two linked sets share parts, so some
    group has two parts that both share, and those two are a mark of both unless both are
    empty. If in every group all shared parts are empty, each set has that many empty parts
    to spare (``need - groups`` beyond one in each group), and marks its prefix as well.
    """
    plan = _plan(percent)
    parts = np.where(chosen, plan["parts"][number], 0)
    groups, need = plan["groups"][number], plan["need"][number]
    first, sums, held, of = _dealt(found, counts, chosen, parts)
    whole = parts == 1  # too small to differ in anything: the set is its mark
    out, owner = [wordhash.mixed(wordhash.mixed(sums[first[whole]]))], [np.flatnonzero(whole)]
    step = 1
    while True:
        # Parts of one group are ``groups`` apart.
        pairs = np.where(whole, 0, np.maximum(parts - step * groups, 0))
        if not pairs.any():
            break
        set_ = np.repeat(np.arange(len(counts)), pairs)
        place = wordhash.within(pairs)
        a = first[set_] + place
        b = a + step * groups[set_]
        some = held[a] + held[b] > 0
        a, b, set_, place = a[some], b[some], set_[some], place[some]
        at = (place * 64 + step).astype(np.uint64)
        mark = wordhash.mixed(wordhash.mixed(sums[a]) + np.uint64(0x9E3779B97F4A7C15) * at)
        out.append(wordhash.mixed(mark ^ wordhash.mixed(sums[b] + np.uint64(0xC2B2AE3D27D4EB4F))))
        owner.append(set_)
        step += 1
    mark, owner_of = np.concatenate(out), np.concatenate(owner)
    kind = number[owner_of].astype(np.uint64)
    mark = (wordhash.mixed(mark + kind) & ~np.uint64(_FRAMES)) | kind
    # Empty parts beyond one in each group.
    begin = np.cumsum(groups) - groups
    group = begin[of] + (np.arange(len(sums)) - first[of]) % groups[of]
    spare = np.maximum(np.bincount(group[held == 0], minlength=int(groups.sum())) - 1, 0)
    spared = np.bincount(np.repeat(np.arange(len(counts)), groups), spare, len(counts))
    risk = chosen & ~whole & (spared >= need - groups)
    more, more_of = _prefix(found, counts, percent, risk, number)
    return np.concatenate([mark, more]), np.concatenate([owner_of, more_of])


def marks_of(
    found: np.ndarray, counts: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Marks of each set and the set each belongs to. The last bits of a mark tell its frame.

    Of the parts of a set, two linked sets share ``need`` or more, since what they differ in
    touches no more than the others. If a part that they share is large enough, it is
    a mark of both. If all are smaller, both sets have ``need`` such parts and mark all that
    are not empty. If all are empty, both have ``need`` empty parts, and mark their prefix as
    well. An empty part itself is no mark, as all sets with an empty part of that number
    would share it. Below PARTS_FROM percent the marks are those of ``pair_marks``.
    """
    plan = _plan(percent)
    frame = np.searchsorted(plan["upper"], counts)
    # A set also meets larger ones of the next frame.
    reaches = (counts * 100 // percent > plan["upper"][frame]) & (counts > 0)
    out, owner = [], []
    for shift, chosen in ((0, counts > 0), (1, reaches)):
        number = np.minimum(frame + shift, _FRAMES - 1)
        if percent < PARTS_FROM:
            mark, of = pair_marks(found, counts, percent, chosen, number)
            out.append(mark)
            owner.append(of)
            continue
        parts, need = np.where(chosen, plan["parts"][number], 0), plan["need"][number]
        first, sums, held, of = _dealt(found, counts, chosen, parts)
        large = held >= (LEAST if percent >= 90 else LEAST - 1)
        small = parts - np.bincount(of[large], minlength=len(counts))
        large |= (small >= need)[of] & (held > 0)
        empty = np.bincount(of[held == 0], minlength=len(counts))
        place = (np.arange(len(sums)) - first[of]).astype(np.uint64)
        kind = number[of].astype(np.uint64)
        mark = wordhash.mixed(
            wordhash.mixed(sums) + place * np.uint64(0x9E3779B97F4A7C15) + kind * np.uint64(0xC2B2AE3D27D4EB4F)
        )
        mark = (mark & ~np.uint64(_FRAMES)) | kind
        out.append(mark[large])
        owner.append(of[large])
        more, more_of = _prefix(found, counts, percent, chosen & (empty >= need) & (empty > 0), number)
        out.append(more)
        owner.append(more_of)
    return np.concatenate(out), np.concatenate(owner)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about BLOCK_BYTES of text; a longer text is a slice of its own."""
    sizes = batch.column("text").nbytes // max(1, batch.num_rows)
    step = max(1, BLOCK_BYTES // max(1, sizes))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def _set_ids(found: np.ndarray, counts: np.ndarray) -> list[int | None]:
    ends = np.cumsum(counts)
    data = memoryview(np.ascontiguousarray(found)).cast("B") if len(found) else memoryview(b"")
    return [
        int(np.uint64(xxhash.xxh3_64_intdigest(data[8 * (e - n) : 8 * e])).astype(np.int64)) if n else None
        for n, e in zip(counts.tolist(), ends.tolist(), strict=True)
    ]


def _described(size: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                found, counts = sets_of(part.column("text"), size)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": part.column("key"),
                        "doc_id": part.column("doc_id"),
                        "place": part.column("place"),
                        "n": pa.array(counts, pa.int64()),
                        "sid": pa.array(_set_ids(found, counts), pa.int64()),
                    }
                )

    return of


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections as the pairs, as one pair per node: the node and its smallest."""
    root: dict[int, int] = {}

    def top(i: int) -> int:
        while root.setdefault(i, i) != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for x, y in set(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        root[max(x, y)] = min(x, y)
    pairs = [(i, top(i)) for i in root if top(i) != i]
    found = np.array(pairs, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _marked(size: int, percent: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (mark, sid, low): each mark of a task once, with ``low`` = ``sid`` the first set
        that has it; and for every set that shares a mark with another of the task one row of
        the set and the smallest it is connected with there, under a mark of its own. So a mark
        that many documents have is sent once per task."""
        marks, sids = [], []
        for batch in batches:
            for part in _blocks(batch):
                found, counts = sets_of(part.column("text"), size)
                ids = np.array([x or 0 for x in _set_ids(found, counts)], np.int64)
                mark, owner = marks_of(found, counts, percent)
                marks.append(mark)
                sids.append(ids[owner])
        mark = np.concatenate(marks or [np.zeros(0, np.uint64)])
        sid = np.concatenate(sids or [np.zeros(0, np.int64)])
        order = np.argsort(mark, kind="stable")
        mark, sid = mark[order], sid[order]
        new = np.ones(len(mark), bool)
        new[1:] = mark[1:] != mark[:-1]
        first = sid[np.maximum.accumulate(np.where(new, np.arange(len(mark)), 0))]
        other = ~new & (first != sid)
        node, low = _stars(sid[other], first[other])
        pair = wordhash.mixed(wordhash.mixed(node.view(np.uint64)) + low.view(np.uint64))
        columns = [
            np.concatenate([mark[new], pair]).view(np.int64),
            np.concatenate([sid[new], node]),
            np.concatenate([sid[new], low]),
        ]
        for i in range(0, len(columns[0]), 1 << 17):
            rows = [pa.array(x[i : i + (1 << 17)]) for x in columns]
            yield pa.RecordBatch.from_arrays(rows, ["mark", "sid", "low"])

    return of


def _cut(groups: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """(unit, sid): the members of every group, cut into blocks of which each two meet."""
    own, met = F.pmod(F.xxhash64(member), F.col("blocks")), F.col("met")
    return (
        groups.withColumn("blocks", blocks)
        .select(group, member, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met"))
        .select(
            F.xxhash64(group, F.least("own", met), F.greatest("own", met)).alias("unit"), F.col(member).alias("sid")
        )
    )


def _forest(
    sids: list[int], sets: list[np.ndarray], percent: int, group: int = GROUP
) -> list[tuple[int, int]]:
    """(document, smallest document it is linked with over others) within one unit."""
    order = sorted(range(len(sids)), key=lambda i: (sets[i][0], sids[i]))  # by min-hash
    sids, sets = [sids[i] for i in order], [sets[i] for i in order]
    root = list(range(len(sids)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    which = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles that one document has alone are in no overlap.
    several = times[column] > 1
    which, column = which[several], np.unique(column[several], return_inverse=True)[1]
    width = int(column.max()) + 1 if len(column) else 0
    there = np.zeros((len(sets), width), np.float32)
    there[which, column] = 1
    starts = np.arange(0, len(sets), group)
    unions = np.maximum.reduceat(there, starts, axis=0)
    bounds = there @ unions.T
    for number, start in enumerate(starts.tolist()):
        # A link needs percent of the document in common; a pair is met in its later document.
        open_to = np.flatnonzero(100 * np.rint(bounds[:, number]) >= percent * sizes)
        open_to = open_to[open_to > start]
        if not len(open_to):
            continue
        members = np.arange(start, min(start + group, len(sets)))
        common = np.rint(there[open_to] @ there[members].T)
        union = sizes[open_to][:, None] + sizes[members][None, :] - common
        linked = (100 * common >= percent * union) & (open_to[:, None] > members[None, :])
        for a, b in zip(*np.nonzero(linked), strict=True):
            x, y = top(int(open_to[a])), top(int(members[b]))
            if x != y:
                low, high = (x, y) if sids[x] < sids[y] else (y, x)
                root[high] = low
    return [(sids[i], sids[top(i)]) for i in range(len(sids)) if top(i) != i]


def _compared(percent: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []

        def closed(rows) -> pa.RecordBatch:
            links, i = [], 0
            while i < len(rows):
                j = i
                while j < len(rows) and rows[j][0] == rows[i][0]:
                    j += 1
                members = {sid: data for _, sid, data in rows[i:j]}
                if len(members) > 1:
                    sets = [np.frombuffer(x, np.uint64) for x in members.values()]
                    links += _forest(list(members), sets, percent)
                i = j
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            held += list(zip(*(batch.column(c).to_pylist() for c in ("unit", "sid", "shingles")), strict=True))
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:
                cut -= 1
            if cut:
                yield closed(held[:cut])
                held = held[cut:]
        if held:
            yield closed(held)

    return of


def _whole_sets(size: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(sid, shingles) of the texts whose set is the one asked for."""
        for batch in batches:
            for part in _blocks(batch):
                found, counts = sets_of(part.column("text"), size)
                ids, ends = _set_ids(found, counts), np.cumsum(counts).tolist()
                rows = [
                    (sid, found[e - n : e].tobytes())
                    for sid, asked, n, e in zip(ids, part.column("sid").to_pylist(), counts.tolist(), ends, strict=True)
                    if sid == asked
                ]
                a, b = zip(*rows, strict=True) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.binary())], ["sid", "shingles"])

    return of


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each linked node reaches.

    Every round points each node to its smallest neighbour, follows the pointers once more,
    and replaces both ends of every edge by what they point to; an edge whose ends meet is
    done. Edges get fewer each round, and it ends when none are left. The tables of a
    round are written to the shared folder.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(links.select(larger, smaller).filter("a <> b").distinct(), "link-edges")
    labels = None
    while labels is None or edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        low = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
                "node", F.least("node", "low").alias("low")
            ),
            "link-pointers",
        )
        far = low.select(F.col("node").alias("low"), F.col("low").alias("to"))
        jump = stored(low.join(far, "low").select("node", "to"), "link-pointers")
        if labels is None:
            labels = jump.select("node", F.col("to").alias("root"))
        else:
            met = jump.select(F.col("node").alias("root"), "to")
            moved = labels.join(met, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            labels = stored(moved, "link-labels")
        ends = [jump.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab"]
        pointed = edges.join(ends[0], "a").join(ends[1], "b")
        larger, smaller = F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b")
        edges = stored(pointed.select(larger, smaller).filter("a <> b").distinct(), "link-edges")
    return labels


def classes(
    docs: DataFrame,
    percent: int = PERCENT,
    block: int = BLOCK,
    size: int = SHINGLE,
    key_col: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``key`` (its column ``key_col``, else a number of the row),
    ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links, its own
    included) and ``first`` (whether the row is the one that stands for its class).

    ``docs`` is read three times, and each scan may be split in another way. So nothing is
    joined on numbers given while scanning: texts meet their sets by id, or by a hash of the
    text where there is none, and the number of a row is written with its set.

    Texts of one set are one node however often they occur. A mark is sent once per task,
    a mark's sets become a star of edges and not pairs, and a family is compared in units
    of two blocks at most. A unit returns at most one link per document.

    A null text, or one without words, has no shingles and stands alone. A row without an
    id has the smallest id it reaches, or null. Rows that repeat an id and text are copies.
    A text of any length is one set. An empty table gives an empty result. Only ``doc_id``
    and ``text`` are read, so other columns may have any name.
    """
    key = F.monotonically_increasing_id() if key_col is None else docs[key_col]
    doc_id = docs["doc_id"].cast("long")
    place = F.coalesce(doc_id, F.xxhash64(docs["text"]))
    texts = docs.select(doc_id.alias("doc_id"), docs["text"], key.alias("key"), place.alias("place"))
    schema = "key long, doc_id long, place long, n long, sid long"
    sets = stored(texts.mapInArrow(_described(size), schema), "jaccard-sets")
    marks = texts.select("text").mapInArrow(_marked(size, percent), "mark long, sid long, low long")
    lowest = F.min("low").over(Window.partitionBy("mark"))
    edges = marks.select("sid", lowest.alias("low")).filter("sid <> low").distinct()
    families = components(stored(edges.toDF("a", "b"), "jaccard-edges"))
    sizes = families.groupBy("root").agg(F.count("*").alias("times"))
    units = _cut(families.join(sizes, "root"), "root", "node", F.ceil(F.col("times") / block).cast("int"))
    units = stored(units, "jaccard-units")
    # The shingles of the documents in some unit, from one text each.
    asked = units.select("sid").distinct()
    wanted = sets.join(asked, "sid").groupBy("sid").agg(F.min("place").alias("place"))
    whole = (
        texts.select("place", "text")
        .join(wanted, "place")
        .select("sid", "text")
        .mapInArrow(_whole_sets(size), "sid long, shingles binary")
        .dropDuplicates(["sid"])
    )
    links = (
        units.join(whole, "sid")
        .select("unit", "sid", "shingles")
        .repartition("unit")
        .sortWithinPartitions("unit", "sid")
        .mapInArrow(_compared(percent), "a long, b long")
    )
    roots = components(stored(links, "jaccard-links"))
    least = sets.filter("sid IS NOT NULL").groupBy("sid").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "key")).alias("least")
    )
    rooted = stored(
        least.join(roots, least["sid"] == roots["node"], "left").select(
            "sid", F.coalesce("root", "sid").alias("root"), "least"
        ),
        "jaccard-roots",
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("lowest"))
    named = rooted.join(lowest, "root").select(F.col("sid").alias("of"), "lowest")
    return (
        sets.join(named, sets["sid"] == named["of"], "left")
        .select(
            "key",
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("lowest.doc_id")).alias("component_id"),
            F.coalesce(F.col("lowest.key") == F.col("key"), F.lit(True)).alias("first"),
        )
    )


def representatives(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stand for their class: of linked documents the one of the
    smallest id, of repeated rows the first; with the columns they have."""
    key = fresh("key")
    # Written once with their numbers: another scan of ``docs`` might number them otherwise.
    numbered = stored(docs.withColumn(key, F.monotonically_increasing_id()), "jaccard-rows")
    found = classes(numbered, percent, size=size, key_col=key)
    firsts = found.filter("first").select(F.col("key").alias(key))
    # The same join at every size; only the keys are held in memory, a part at a time.
    return numbered.join(firsts.hint("shuffle_hash"), key).select(*docs.columns)
