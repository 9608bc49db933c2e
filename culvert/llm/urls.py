"""URL filter: explicit rules first, then a tree of path templates per host whose
branches are judged by the smoothed share of labelled-bad pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from culvert.llm.shared import fresh, stored

#: Levels of the tree; deeper segments share one last level, ``**``.
MAX_DEPTH = 4
#: A branch keeps its name if it holds this many pages and this share of its node's pages.
MIN_SUPPORT = 5
MIN_SHARE = 0.01
#: Sibling branches whose bad shares differ by less than this many standard errors are merged.
SAME_BELOW = 1.96
#: Weight, in pages, of the parent's purity in a template's own.
SMOOTHING = 5.0
#: Templates of at least this share of bad pages are rejected.
REJECT_FROM = 0.8
#: The pages of one template are spread over this many join keys.
SALTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, such as ``example.org/es/``."""

    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``action``; else null."""
    fits = [
        F.when(
            ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}")))
            & F.startswith(path, F.lit(rule.path)),
            F.struct(F.lit(rule.text).alias("text"), F.lit(rule.action).alias("action")),
        )
        for rule in sorted(rules, key=lambda r: -len(r.text))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<text:string,action:string>")


def shape_of(path: Column, depth: int) -> Column:
    """Segments with every run of digits made ``#``; those beyond ``depth`` become ``**``."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shaped = F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    return F.when(
        F.size(segments) > depth, F.concat(F.slice(shaped, 1, depth), F.array(F.lit("**")))
    ).otherwise(shaped)


def _branches(paths: DataFrame, level: int, min_support: int, min_share: float) -> DataFrame:
    """For (host, node, segment): the branch it belongs to.

    A segment is variable, ``*``, unless it holds enough pages itself. What keeps its name
    is at most ``1 / min_share`` segments per node; neighbours by bad share among them are
    merged as long as their shares cannot be told apart.
    """
    step = (
        paths.filter(F.size("shape") > level)
        .groupBy("host", "node", F.get("shape", F.lit(level)).alias("segment"))
        .agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    )
    totals = step.groupBy("host", "node").agg(F.sum("n").alias("total"))
    named = step.join(totals, ["host", "node"]).filter(
        (F.col("n") >= min_support) & (F.col("n") >= min_share * F.col("total"))
    )
    share = F.col("bad") / F.col("labelled")
    order = Window.partitionBy("host", "node", F.col("labelled") > 0).orderBy("share", "segment")
    before = lambda name: F.lag(name).over(order)
    pooled = (F.col("bad") + before("bad")) / (F.col("labelled") + before("labelled"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / before("labelled")))
    apart = F.col("share") - before("share") >= SAME_BELOW * error
    marked = named.withColumn("share", F.when(F.col("labelled") > 0, share)).withColumn(
        # With no labels there is nothing to compare: such branches stay apart.
        "new", F.when(F.col("labelled") > 0, F.coalesce(apart & (error > 0), error == 0, F.lit(True))).otherwise(True)
    )
    marked = marked.withColumn(
        "new", F.when((F.col("labelled") > 0) & (before("share") == F.col("share")), False).otherwise(F.col("new"))
    )
    merged = marked.withColumn("part", F.sum(F.col("new").cast("int")).over(order))
    part = Window.partitionBy("host", "node", F.col("labelled") > 0, "part")
    names = F.array_join(F.sort_array(F.collect_set("segment").over(part)), "|")
    return merged.select(F.col("host"), F.col("node"), F.col("segment"), names.alias("branch"))


def _evidence(paths: DataFrame, node: str, level: int) -> DataFrame:
    """For (host, node): labelled and bad pages of its own, and those of other hosts whose
    paths begin with the same shapes. A host as a whole has no shape to share."""
    own = paths.groupBy(
        "host", F.col(node).alias("at"), F.concat_ws("/", F.slice("shape", 1, level)).alias("prefix")
    ).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    others = [F.lit(0).alias("other_labelled"), F.lit(0).alias("other_bad")]
    if level:
        everywhere = own.groupBy("prefix").agg(
            F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
        )
        own = own.join(everywhere, "prefix")
        others = [
            F.sum(F.col(f"all_{name}") - F.col(name)).alias(f"other_{name}") for name in ("labelled", "bad")
        ]
    return own.groupBy("host", "at").agg(
        F.sum("labelled").alias("node_labelled"), F.sum("bad").alias("node_bad"), *others
    )


def templates(
    pages: DataFrame,
    max_depth: int = MAX_DEPTH,
    min_support: int = MIN_SUPPORT,
    min_share: float = MIN_SHARE,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """One row per (host, shape) of ``pages`` (host, path, bad: boolean, null unlabelled)
    with its ``template`` and that template's smoothed ``purity``, the share of bad pages.

    The pages are counted by host and shape once; the tree grows on those counts. A
    template's purity is drawn to that of the same shapes on other hosts, this one to its
    parent's, and the host's to that of all pages.
    """
    paths = (
        pages.groupBy("host", shape_of(F.col("path"), max_depth).alias("shape"))
        .agg(
            F.count("*").alias("n"),
            F.count("bad").alias("labelled"),
            F.count_if("bad").alias("bad"),
        )
        .withColumn("key", F.concat_ws("/", "shape"))
    )
    paths = stored(paths, "url-shapes").withColumn("node", F.lit(""))
    nodes = ["node_0"]
    paths = paths.withColumn("node_0", F.col("node"))
    for level in range(max_depth + 1):
        branches = _branches(paths, level, min_support, min_share)
        at = F.get("shape", F.lit(level))
        paths = (
            paths.withColumn("segment", at)
            .join(branches, ["host", "node", "segment"], "left")
            .withColumn(
                "node",
                F.when(
                    F.col("segment").isNotNull(),
                    F.concat("node", F.lit("/"), F.coalesce("branch", F.lit("*"))),
                ).otherwise(F.col("node")),
            )
            .drop("segment", "branch")
            .withColumn(f"node_{level + 1}", F.col("node"))
        )
        paths = stored(paths, f"url-level-{level}")
        nodes.append(f"node_{level + 1}")
    prior = paths.agg(
        F.coalesce(F.sum("bad") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0)).alias("prior")
    )
    judged = paths.withColumn("purity", prior.scalar())
    for number, node in enumerate(nodes):
        of_node = _evidence(paths, node, number)
        same = F.lit(False) if number == 0 else F.col(node) == F.col(nodes[number - 1])
        before = (F.col("other_bad") + smoothing * F.col("purity")) / (F.col("other_labelled") + smoothing)
        own = (F.col("node_bad") + smoothing * before) / (F.col("node_labelled") + smoothing)
        judged = (
            judged.withColumn("at", F.col(node))
            .join(of_node, ["host", "at"])
            .withColumn("purity", F.when(same, F.col("purity")).otherwise(own))
            .drop("at", "node_labelled", "node_bad", "other_labelled", "other_bad")
        )
    return judged.select("host", "key", F.col("node").alias("template"), "purity")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    reject_from: float = REJECT_FROM,
    max_depth: int = MAX_DEPTH,
    salts: int = SALTS,
) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule``, ``template``, ``purity``
    and ``verdict``.

    The longest fitting rule decides. The pages that rules decide are the labelled ones;
    a page without a rule takes the verdict of its template, blocked from ``reject_from``
    on. The pages meet their template on (host, shape), spread over ``salts`` keys, as one
    host may hold a third of all rows.

    A null url, or one without ``://``, has an empty host and path. Repeated rows are
    judged each; an empty table gives an empty result; own columns of these names are
    replaced. Only ``url`` is read.
    """
    found, key, salt = fresh("rule"), fresh("key"), fresh("salt")
    placed = (
        pages.drop("rule", "template", "purity", "verdict")
        .withColumn("host", host_of(F.col("url")))
        .withColumn("path", path_of(F.col("url")))
    )
    ruled = placed.withColumn(found, first_rule(F.col("host"), F.col("path"), rules))
    evidence = ruled.select("host", "path", (F.col(f"{found}.action") == "block").alias("bad"))
    tree = templates(evidence, max_depth).select(
        "host",
        F.col("key").alias(key),
        "template",
        "purity",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(salt),
    )
    shaped = F.concat_ws("/", shape_of(F.col("path"), max_depth))
    spread = F.pmod(F.xxhash64(F.col("url"), F.monotonically_increasing_id()), F.lit(salts))
    own = F.when(F.col("purity") >= reject_from, "block").otherwise("allow")
    return (
        ruled.withColumn(key, shaped)
        .withColumn(salt, spread.cast("int"))
        .join(tree, ["host", key, salt], "left")
        .withColumn("rule", F.col(f"{found}.text"))
        .withColumn("verdict", F.coalesce(F.col(f"{found}.action"), own))
        .drop(found, key, salt)
    )
