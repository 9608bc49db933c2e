"""Routing by a table of rules, for rule sets too large for one CASE.

A rule ``(ord, pattern, kafka_topic)`` matches a topic exactly if the topic's
levels equal the pattern's once the levels under a wildcard are masked. So a
rule is turned into a *shape* (which levels are masked, and whether ``#``
follows) and a *masked text*; a topic, masked by the same shape, matches by
equality. Matching thus needs hash lookups only, never a test of every topic
against every rule.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from culvert.functions.patterns import RESERVED
from culvert.functions.results import column_named
from culvert.operators.routing import check_default, finish_route
from culvert.session import lasting, written_once
from culvert.sources.files import remove

# Up to these bounds the rules are broadcast; beyond them they are joined by shuffle.
MAX_BROADCAST_RULES = 100_000
MAX_LOOKUPS = 16

# Up to this many rules are taken to the driver and checked there, without a table of their own.
MAX_LOCAL_RULES = 2_000

# Up to this many shapes a topic is masked by each; beyond it, it walks down the trie of levels.
MAX_MASKS = 64

# A topic with more than one in this many of the events is hot, so fewer topics than that are.
HOT_TOPICS = 1_000

# The events of a hot topic are spread over this many keys when they meet their topic's match.
SALTS = 32

HIT = "struct<mapping_ord:int,_target:string,_key_field:string,_key_level:int,_key_rest:boolean>"


def _is_wild(level: Column) -> Column:
    return level.startswith("+")


def _masked(levels: Column, any_rest: Column, is_masked) -> Column:
    """Levels as one text: a masked level reads ``+``, a literal one starts with ``=``, any rest is ``#``.

    So the text tells the shape too, and no text of one shape equals one of another.
    """
    marked = F.transform(levels, lambda level, i: F.when(is_masked(level, i), "+").otherwise(F.concat(F.lit("="), level)))
    return F.concat(F.array_join(marked, "/"), F.when(any_rest, "/#").otherwise(""))


def _masked_topic(levels: Column, any_rest: Column, mask: Column) -> Column:
    """A topic's first levels, masked as ``mask`` (one character per level) says."""
    kept = F.slice(levels, 1, F.length(mask))
    return _masked(kept, any_rest, lambda _, i: F.substring(mask, i + 1, F.lit(1)) == "+")


def _masked_topic_for(levels: Column, any_rest: bool, mask: str) -> Column:
    """The same for a shape known on the driver: plain concatenation instead of a lambda."""
    parts = [
        F.lit("+") if how == "+" else F.concat(F.lit("="), F.get(levels, F.lit(i))) for i, how in enumerate(mask)
    ]
    return F.concat(F.concat_ws("/", *parts) if parts else F.lit(""), F.lit("/#" if any_rest else ""))


def shaped_rules(rules: DataFrame) -> DataFrame:
    """One row per distinct rule form: ``any_rest, mask, masked, hit``.

    Of rules with equal form only the first can ever match. A ``#`` before the
    last level matches nothing, so such rules drop out. ``hit`` is what a match
    gives: order, target, and where the key is found, if the rules have a column
    ``key`` (``fields.x``, or null for no key): the level that captures ``x``, the
    rest behind it for ``#x``, or else the field of that name.
    """
    key = F.col("key") if "key" in rules.columns else F.lit(None).cast("string")
    name = F.regexp_replace(key, r"^fields\.", "")
    last = F.element_at("_levels", -1)
    captures = F.transform("_levels", lambda level, i: F.when(level == F.concat(F.lit("+"), name), i))
    shaped = (
        rules.withColumn("_levels", F.split("pattern", "/"))
        .withColumn("any_rest", last.startswith("#"))
        .withColumn("_rest", F.coalesce(last == F.concat(F.lit("#"), name), F.lit(False)))
        .withColumn("_level", F.when(F.col("_rest"), F.size("_levels") - 1).otherwise(F.array_max(captures)))
        .withColumn(
            "_levels",
            F.when(F.col("any_rest"), F.slice("_levels", 1, F.size("_levels") - 1)).otherwise(F.col("_levels")),
        )
        .filter(~F.exists("_levels", lambda level: level.startswith("#")))
        .withColumn("mask", F.array_join(F.transform("_levels", lambda level: F.when(_is_wild(level), "+").otherwise("=")), ""))
        .withColumn("masked", _masked(F.col("_levels"), F.col("any_rest"), lambda level, _: _is_wild(level)))
        .withColumn(
            "hit", F.struct(F.col("ord").cast("int"), "kafka_topic", name, F.col("_level").cast("int"), "_rest").cast(HIT)
        )
    )
    return shaped.groupBy("any_rest", "mask", "masked").agg(F.min_by("hit", "ord").alias("hit"))


@dataclass(frozen=True)
class CompiledRules:
    """Rules as they were when they were read: ``shaped``, their shapes where those are few
    enough to look up one by one, whether they are few enough to mask topics by each, and
    what was written for them."""

    shaped: DataFrame
    shapes: list[Row] | None
    few: bool
    version: object = None
    paths: tuple[str, ...] = ()


def compile_rules(
    rules: DataFrame,
    max_broadcast_rules: int = MAX_BROADCAST_RULES,
    max_lookups: int = MAX_LOOKUPS,
    max_masks: int = MAX_MASKS,
    before: CompiledRules | None = None,
) -> CompiledRules:
    """The rules read once and checked; what is counted is what is matched. ``before`` is
    given back if the rules have not changed since.

    A small table comes to the driver in one job and stays part of the plan. Of a larger
    one the shaped rules are written, and its version is a hash over all rules.
    """
    few = rules.limit(MAX_LOCAL_RULES + 1).collect()
    if len(few) <= MAX_LOCAL_RULES:
        version: object = Counter(tuple(r) for r in few)
        if before is not None and before.version == version:
            return before
        _check_few(few, "key" in rules.columns)
        columns = {f.name: [r[f.name] for r in few] for f in rules.schema}
        arrays = [pa.array(columns[f.name], to_arrow_type(f.dataType)) for f in rules.schema]
        local = rules.sparkSession.createDataFrame(pa.Table.from_arrays(arrays, rules.columns))
        shaped, paths = shaped_rules(local), ()
    else:
        row = F.xxhash64(*rules.columns)
        version = tuple(rules.agg(F.count("*"), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first())
        if before is not None and before.version == version:
            return before
        with lasting():
            written = written_once(rules, "rules")
            _check_many(written)
            shaped = written_once(shaped_rules(written), "shaped-rules")
        paths = tuple({path.rsplit("/", 1)[0] for df in (written, shaped) for path in df.inputFiles()})
    shapes = shaped.groupBy("any_rest", "mask").count().limit(max(max_lookups, max_masks) + 1).collect()
    looked_up = len(shapes) <= max_lookups and sum(shape["count"] for shape in shapes) <= max_broadcast_rules
    return CompiledRules(shaped, shapes if looked_up else None, len(shapes) <= max_masks, version, paths)


def forget(compiled: CompiledRules) -> None:
    """Remove what was written for rules that are no longer used."""
    for path in compiled.paths:
        remove(compiled.shaped.sparkSession, path)


def _several(ord_: object) -> ValueError:
    return ValueError(f"several rules have ord {ord_}")


def _no_field(key: str) -> ValueError:
    return ValueError(f'a key must read "fields.<name>": {key!r}')


def _check_few(rules: Sequence[Row], keyed: bool) -> None:
    for ord_, n in Counter(r["ord"] for r in rules).items():
        if n > 1:
            raise _several(ord_)
    for r in rules if keyed else ():
        if r["key"] is not None and not r["key"].startswith("fields."):
            raise _no_field(r["key"])


def _check_many(rules: DataFrame) -> None:
    """Two rules of one order have no first."""
    twice = rules.groupBy("ord").count().filter("count > 1").limit(1).collect()
    if twice:
        raise _several(twice[0]["ord"])
    keys = rules.filter(~F.col("key").startswith("fields.")).limit(1).collect() if "key" in rules.columns else []
    if keys:
        raise _no_field(keys[0]["key"])


def _may_match(topic: Column, any_rest: Column, mask: Column) -> Column:
    """False for a reserved topic under a form that starts with a wildcard."""
    starts_wild = mask.startswith("+") | (any_rest & (mask == ""))
    return ~(topic.startswith(RESERVED) & starts_wild)


def route_by_table(
    df: DataFrame,
    rules: DataFrame | CompiledRules,
    default: str = "error",
    max_broadcast_rules: int = MAX_BROADCAST_RULES,
    max_lookups: int = MAX_LOOKUPS,
    max_masks: int = MAX_MASKS,
) -> DataFrame:
    """Same columns as ``route``, for rules ``(ord, pattern, kafka_topic[, key])`` given as a table,
    or as ``compile_rules`` has read them.

    The rules are read once and must differ in ``ord``. Few shapes and a bounded
    number of rules: one broadcast hash lookup per shape, and the events are not
    shuffled at all. Otherwise the distinct topics are matched by equi-joins and
    joined back on the topic: masked by every shape, or, beyond ``max_masks`` shapes, in a
    walk down the trie of the rules' levels. All ways give the same rows. Since a table may grow
    from one way into the other, a stream is routed in its micro-batches, as
    ``run_produce`` does.
    """
    check_default(default)
    if df.isStreaming:
        raise ValueError("route a stream by a table within its micro-batches: run_produce takes the rules")
    if isinstance(rules, DataFrame):
        rules = compile_rules(rules, max_broadcast_rules, max_lookups, max_masks)
    if rules.shapes is not None:
        matched = _match_by_lookups(df, rules.shaped, rules.shapes)
    else:
        matched = _match_by_topic_join(df, rules.shaped, rules.few)
    fields = F.col("fields") if "fields" in df.columns else F.lit(None).cast("map<string,string>")
    levels, level = F.split("topic", "/"), F.col("_key_level")
    rest = F.array_join(F.slice(levels, level + 1, F.greatest(F.size(levels) - level, F.lit(0))), "/")
    captured = F.when(F.col("_key_rest"), rest).otherwise(F.get(levels, level))
    # A field that is not there reads as empty text, so the key is empty, not null.
    key = F.coalesce(captured, F.try_element_at(fields, F.col("_key_field")), F.lit(""))
    keyed = matched.withColumns({
        "_key": F.when(F.col("_key_field").isNotNull(), key).cast("binary"),
        "_key_error": F.lit(None).cast("string"),
    })
    return finish_route(keyed.drop("_key_field", "_key_level", "_key_rest"), default)


def _match_by_lookups(df: DataFrame, shaped: DataFrame, shapes: Sequence[Row]) -> DataFrame:
    own = [column_named(name) for name in df.columns]
    topic, levels = F.col("topic"), F.col("_levels")
    df = df.withColumn("_levels", F.split(topic, "/"))
    hits = []
    for i, shape in enumerate(sorted(shapes, key=lambda s: (s["any_rest"], s["mask"]))):
        any_rest, mask = shape["any_rest"], shape["mask"]
        fits = F.size(levels) >= len(mask) if any_rest else F.size(levels) == len(mask)
        probe = F.when(
            fits & _may_match(topic, F.lit(any_rest), F.lit(mask)), _masked_topic_for(levels, any_rest, mask)
        )
        # Every lookup uses the same rows, so Spark broadcasts them once. Their number passed the bound.
        rows = shaped.select(F.col("masked").alias(f"_masked_{i}"), F.col("hit").alias(f"_hit_{i}"))
        df = df.withColumn(f"_masked_{i}", probe).join(F.broadcast(rows), f"_masked_{i}", "left")
        hits.append(F.col(f"_hit_{i}"))
    if hits:
        first = F.least(*hits) if len(hits) > 1 else hits[0]
    else:
        first = F.lit(None).cast(HIT)
    return df.withColumn("_hit", first).select(*own, "_hit.*")


def _match_by_topic_join(df: DataFrame, shaped: DataFrame, few: bool) -> DataFrame:
    topics = df.filter(F.col("topic").isNotNull()).groupBy("topic").agg(F.count("*").alias("_n"))
    topics = written_once(topics, "topics")
    found = _by_masks(topics.select("topic"), shaped) if few else _by_trie(topics.select("topic"), shaped)
    hits = _joinable(shaped.select("masked", "hit"))
    matches = found.join(hits, "masked").groupBy("topic").agg(F.min("hit").alias("_hit"))
    return _join_by_topic(df, written_once(matches, "matches"), topics)


def _joinable(table: DataFrame) -> DataFrame:
    """``table`` for a join that may broadcast it only up to the bound on rules. Spark would
    judge by the size of its compressed files, many times less than its rows on the driver."""
    return table if table.count() <= MAX_BROADCAST_RULES else table.hint("merge")


def _by_masks(topics: DataFrame, shaped: DataFrame) -> DataFrame:
    """``topic, masked`` for every shape that fits the topic; the shapes are few."""
    # A topic of n levels can meet a rule of n levels, or a rule with # behind 0 to n levels.
    forms = F.concat(
        F.array(F.struct(F.lit(False).alias("any_rest"), F.size("_levels").alias("n_levels"))),
        F.transform(
            F.sequence(F.lit(0), F.size("_levels")),
            lambda n: F.struct(F.lit(True).alias("any_rest"), n.alias("n_levels")),
        ),
    )
    # Masks of one form, in one row each: at most two rows per number of levels.
    masks = written_once(
        shaped.groupBy("any_rest", F.length("mask").alias("n_levels")).agg(F.collect_set("mask").alias("masks")), "masks"
    )
    return (
        topics.withColumn("_levels", F.split("topic", "/"))
        .select("topic", "_levels", F.inline(forms))
        .join(F.broadcast(masks), ["any_rest", "n_levels"])
        .select("topic", "_levels", "any_rest", F.explode("masks").alias("mask"))
        .filter(_may_match(F.col("topic"), F.col("any_rest"), F.col("mask")))
        .select("topic", _masked_topic(F.col("_levels"), F.col("any_rest"), F.col("mask")).alias("masked"))
    )


def _by_trie(topics: DataFrame, shaped: DataFrame) -> DataFrame:
    """``topic, masked`` for the rules that the topic reaches, found level by level.

    The trie's nodes are the beginnings of the masked texts, one row each. The frontier
    holds the nodes that topics have reached; one join per level takes it to the next,
    along the topic's own level and along ``+``. So a topic meets the nodes on its ways and
    no others, whatever the number of shapes. The frontier of a level is written, as the
    next one and the result both read it.
    """
    whole = F.split(F.regexp_replace("masked", "/#$", ""), "/")
    levels = F.when(F.length("mask") == 0, F.array().cast("array<string>")).otherwise(whole)
    nodes = shaped.select(levels.alias("levels")).select(
        F.explode(F.sequence(F.lit(0), F.size("levels"))).alias("depth"), "levels"
    )
    nodes = written_once(
        nodes.select("depth", F.array_join(F.slice("levels", 1, F.col("depth")), "/").alias("node")).distinct(), "trie"
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    nodes = _joinable(nodes)
    frontier = topics.withColumns({"_levels": F.split("topic", "/"), "node": F.lit("")})
    reached = []
    for depth in range(deepest + 1):
        if depth:
            level = F.get("_levels", F.lit(depth - 1))
            # A topic is not led from the top into a wildcard if it is reserved.
            steps = F.array(F.concat(F.lit("="), level), F.lit("+"))
            if depth == 1:
                steps = F.when(F.col("topic").startswith(RESERVED), F.slice(steps, 1, 1)).otherwise(steps)
            way = F.when(F.lit(depth == 1), F.col("step")).otherwise(F.concat_ws("/", "node", "step"))
            there = nodes.filter(F.col("depth") == depth).select(F.col("node").alias("_node"))
            frontier = (
                frontier.filter(F.size("_levels") >= depth)
                .withColumn("step", F.explode(steps))
                .withColumn("node", way)
                .join(there, F.col("node") == F.col("_node"))
                .select("topic", "_levels", "node")
            )
            frontier = written_once(frontier, "frontier")
        exact = frontier.filter(F.size("_levels") == depth).select("topic", F.col("node").alias("masked"))
        rest = frontier.select("topic", F.concat("node", F.lit("/#")).alias("masked"))
        if depth == 0:
            rest = rest.filter(~F.col("topic").startswith(RESERVED))
        reached += [exact, rest]
    return functools.reduce(DataFrame.union, reached)


def _join_by_topic(df: DataFrame, matches: DataFrame, topics: DataFrame) -> DataFrame:
    """Left join of the events with their topic's match, whatever share of them one topic
    holds: the match of a hot topic stands under ``SALTS`` keys, and an event takes one by
    its place. ``topics`` says how many events (``_n``) a topic has."""
    own = [column_named(name) for name in df.columns]
    total = topics.agg(F.sum("_n")).first()[0] or 0
    hot = topics.filter(F.col("_n") * HOT_TOPICS > F.lit(total).cast("decimal(38,0)")).select(
        F.col("topic").alias("_hot")
    )
    salts = hot.select("_hot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt_of"))
    salted = matches.join(F.broadcast(salts), F.col("topic") == F.col("_hot"), "left").select(
        F.col("topic").alias("_of"), "_hit", F.coalesce("_salt_of", F.lit(0)).alias("_salt_of")
    )
    # What has no topic meets nothing, but is a key as well.
    spreads = F.col("_hot").isNotNull() | F.col("topic").isNull()
    place = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    spread = df.join(F.broadcast(hot), F.col("topic") == F.col("_hot"), "left").withColumn(
        "_salt", F.when(spreads, place).otherwise(F.lit(0))
    )
    salted = salted if matches.count() <= MAX_BROADCAST_RULES else salted.hint("merge")
    same = (spread["topic"] == salted["_of"]) & (spread["_salt"] == salted["_salt_of"])
    return spread.join(salted, same, "left").select(*own, "_hit.*")
