"""URL filters: listed rules, and a tree of path templates judged by the labels
of the urls below them. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.shared import settled

WILD, MERGED = "*", "~"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// to the next of / ? #, ASCII letters in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next of ? #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or NULL.

    Rules are (verdict, host, path); one fits its host and all subdomains, if
    the path starts with the rule's. Of equally long ones the first counts.
    """
    out = None
    for verdict, of, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        value = F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if out is None else out


def look_of(segment: Column) -> Column:
    """The segment with what looks variable replaced: numbers, hex strings and
    long strings."""
    hexed = segment.rlike("^(?=.*[0-9])[0-9a-fA-F-]{8,}$") & ~segment.rlike("^[0-9]+$")
    return (
        F.when(hexed, F.lit("{hex}"))
        .when(F.length(segment) > 40, F.lit("{long}"))
        .otherwise(F.regexp_replace(segment, "[0-9]+", "{n}"))
    )


def segments_of(path: Column) -> Column:
    """The path's segments; those that read like a mark of a template are escaped."""
    marks = F.create_map(F.lit(WILD), F.lit("%2A"), F.lit(MERGED), F.lit("%7E"))
    return F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.coalesce(F.try_element_at(marks, s), s)
    )


def templates(
    urls: DataFrame,
    max_children: int = 20,
    min_share: float = 0.05,
    support: int = 5,
    z: float = 2.0,
    weight: float = 10.0,
) -> DataFrame:
    """The template of every host and list of segments, with the labels and the
    smoothed purity of the template.

    `urls` has host, path and `bad` (true, false, or NULL for no label). It is
    counted by host and path first; the tree is grown on these counts, from
    the root of each host down. A group deviates from another if it has
    `support` labels and their shares of bad ones differ by `z` standard errors.
    - a segment becomes what it looks like (`{n}`, `{hex}`, `{long}`), unless it
      deviates from the node's other segments of that look;
    - a segment of a node with more than `max_children` children becomes `*`
      if it has less than `min_share` of the node's urls, unless it deviates
      from the rest of the node;
    - siblings whose share of bad labels differs from their parent's by less
      than `z` standard errors, or that have fewer than `support` labels, are
      merged as `~`;
    - a branch's purity is its share of bad labels, smoothed by `weight` labels
      at the purity of its parent, a host's by the share over all urls. A
      branch with all labels of its parent keeps the parent's purity.
    A node whose labels are all alike, or no more than `support`, cannot be
    parted further; its template ends with what the next segments look like.
    Segments that all urls of a node have in common are passed in one step, so
    there are as many rounds as there are forks on a path, however long it is.
    """
    one = F.lit(1)
    counted = settled(
        urls.select("host", segments_of(F.col("path")).alias("segments"), F.col("bad").cast("int").alias("bad"))
        .groupBy("host", "segments")
        .agg(F.count(one).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    total = counted.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    prior = (total["b"] or 0) / total["l"] if total["l"] else 0.0
    names = ("n", "labelled", "bad")
    sums = [F.sum(c).alias(c) for c in names]
    ends = [F.min("first").alias("first"), F.max("last").alias("last")]

    def smoothed(above) -> Column:
        return (F.col("bad") + weight * above) / (F.col("labelled") + F.lit(weight))

    def node(purity: Column) -> list[Column]:
        """What is said of a node: purity, whether it can be parted, and the
        segments that all its urls have in common next: those that the first
        and the last one in order share."""
        same = F.transform(F.arrays_zip("first", "last"), lambda x: F.coalesce(x["first"] == x["last"], F.lit(False)))
        differs = F.array_position(same, F.lit(False)).cast("int")
        common = F.when(differs > 0, F.slice("first", F.lit(1), differs - 1)).otherwise(F.col("first"))
        mixed = (F.col("labelled") > support) & (F.col("bad") > 0) & (F.col("bad") < F.col("labelled"))
        live = mixed & (F.col("first") != F.col("last"))
        return [
            purity.alias("node_purity"),
            live.alias("node_live"),
            F.when(live, common).otherwise(F.array().cast("array<string>")).alias("common"),
        ]

    def entered(template: Column) -> Column:
        return F.concat_ws("/", template, "common")

    hosts = (
        counted.groupBy("host")
        .agg(*sums, F.min("segments").alias("first"), F.max("segments").alias("last"))
        .select(F.col("host").alias("_host"), *node(smoothed(F.lit(prior))))
    )
    # rest: the segments below the node that the row is at.
    state = settled(
        counted.join(hosts, F.col("host") == F.col("_host")).select(
            "host",
            "segments",
            *names,
            F.slice("segments", F.size("common") + 1, F.size("segments")).alias("rest"),
            F.col("node_purity").alias("purity"),
            F.col("node_live").alias("live"),
            entered(F.lit("")).alias("template"),
        )
    )
    done = [state.filter(~F.col("live"))]

    def deviates(of: str) -> Column:
        """Does a group differ from the rest of the larger one, by the pooled share?"""
        all_bad, all_labelled = F.col(f"_{of}_bad"), F.col(f"_{of}_labelled")
        pooled = F.try_divide(all_bad, all_labelled)
        others = all_labelled - F.col("labelled")
        rate, rest = F.try_divide(F.col("bad"), F.col("labelled")), F.try_divide(all_bad - F.col("bad"), others)
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, F.col("labelled")) + F.try_divide(one, others)))
        return F.coalesce((F.col("labelled") >= support) & (F.abs(rate - rest) > z * spread), F.lit(False))

    at = ["host", "template"]
    while not (here := state.filter("live")).isEmpty():
        here = here.withColumn("seg", F.get("rest", F.lit(0)))
        below = F.slice("rest", 2, F.greatest(F.size("rest"), one))
        children = settled(
            here.filter(F.col("seg").isNotNull())
            .withColumn("below", below)
            .groupBy(*at, "seg")
            .agg(*sums, F.first("purity").alias("above"), F.min("below").alias("first"), F.max("below").alias("last"))
            .withColumn("look", look_of(F.col("seg")))
        )
        looks = children.groupBy(*at, "look").agg(*(F.sum(c).alias(f"_look_{c}") for c in names))
        named = settled(
            children.join(looks, [*at, "look"]).withColumn(
                "name", F.when(deviates("look"), F.col("seg")).otherwise(F.col("look"))
            )
        )
        kinds = named.groupBy(*at, "name").agg(*sums, F.first("above").alias("above"), *ends)
        parents = children.groupBy(*at).agg(*(F.sum(c).alias(f"_node_{c}") for c in names))
        width = kinds.groupBy(*at).agg(F.count(one).alias("_kids"))
        wild = (F.col("_kids") > max_children) & (F.col("n") < min_share * F.col("_node_n")) & ~deviates("node")
        kinds = settled(
            kinds.join(parents, at).join(width, at).withColumn("branch", F.when(wild, WILD).otherwise(F.col("name")))
        )
        branches = kinds.groupBy(*at, "branch").agg(
            *sums, F.first("_node_labelled").alias("_node_labelled"), F.first("_node_bad").alias("_node_bad")
        )
        siblings = branches.groupBy(*at).agg(F.count(one).alias("_siblings"))
        rate = F.try_divide(F.col("_node_bad"), F.col("_node_labelled"))
        error = F.sqrt(F.try_divide(rate * (1 - rate), F.col("labelled")))
        alike = (F.col("labelled") < support) | (
            F.abs(F.try_divide(F.col("bad"), F.col("labelled")) - rate) <= z * error
        )
        into = F.when((F.col("_siblings") > 1) & F.coalesce(alike, F.lit(True)), MERGED).otherwise(F.col("branch"))
        merged = branches.join(siblings, at).select(*at, "branch", into.alias("into"))
        kinds = settled(kinds.join(merged, [*at, "branch"]))
        whole = F.col("labelled") == F.col("_node_labelled")
        nodes = (
            kinds.groupBy(*at, "into")
            .agg(*sums, F.first("above").alias("above"), F.first("_node_labelled").alias("_node_labelled"), *ends)
            .select(*at, "into", *node(F.when(whole, F.col("above")).otherwise(smoothed(F.col("above")))))
        )
        steps = (
            named.select(*at, "seg", "name")
            .join(kinds.select(*at, "name", "into"), [*at, "name"])
            .join(nodes, [*at, "into"])
            .select(*(F.col(c).alias(f"_{c}") for c in (*at, "seg")), "into", "node_purity", "node_live", "common")
        )
        same = (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")) & (F.col("seg") == F.col("_seg"))
        stays = F.col("into").isNull()
        state = settled(
            here.join(steps, same, "left").select(
                "host",
                "segments",
                *names,
                F.when(stays, F.col("rest"))
                .otherwise(F.slice("rest", F.coalesce(F.size("common"), one) + 2, F.size("rest") + 1))
                .alias("rest"),
                F.coalesce("node_purity", "purity").alias("purity"),
                F.coalesce("node_live", F.lit(False)).alias("live"),
                F.when(stays, F.col("template"))
                .otherwise(entered(F.concat_ws("/", "template", "into")))
                .alias("template"),
            )
        )
        done.append(state.filter(~F.col("live")))
    leaves = settled(reduce(DataFrame.unionAll, done).withColumn("next", look_of(F.get("rest", F.lit(0)))))
    ended = leaves.groupBy(*at).agg(
        *(F.sum(c).alias(f"template_{c}") for c in ("labelled", "bad")),
        F.min("next").alias("_least"),
        F.max("next").alias("_most"),
    )
    tail = F.when(F.col("_least") == F.col("_most"), F.col("_least")).when(F.col("_least").isNotNull(), WILD)
    return settled(
        leaves.select(*at, "segments", "purity").join(ended, at).select(
            "host",
            "segments",
            F.concat_ws("/", "template", tail).alias("template"),
            "template_labelled",
            "template_bad",
            "purity",
        )
    )


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labels: DataFrame | None = None,
    reject: float = 0.5,
    support: int = 5,
    **options,
) -> DataFrame:
    """Every page's host, path, rule, verdict, template and purity.

    `pages` has page_id and url; `labels` has page_id and `bad`. The verdict is
    that of the longest listed rule; where none fits, `block` if the url's
    template has at least `support` labels and a purity of `reject` or more,
    else `allow`. A NULL url, or one without ://, has an empty host and path.
    Repeated rows are judged one by one; other columns are ignored. Labels
    without a page, and NULLs, are left out; of several, the worst counts.
    """
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    if labels is None:
        known = parsed.withColumn("bad", F.lit(None).cast("boolean"))
    else:
        worst = labels.select("page_id", "bad").dropna().groupBy("page_id").agg(F.max("bad").alias("bad"))
        known = parsed.join(worst, "page_id", "left")
    tree = templates(known, support=support, **options).withColumnRenamed("host", "_host")
    parted = parsed.withColumn("_segments", segments_of(F.col("path")))
    found = parted.join(tree, (F.col("host") == F.col("_host")) & (F.col("_segments") == F.col("segments")), "left")
    rejected = (F.col("template_labelled") >= support) & (F.col("purity") >= reject)
    found = found.withColumn("_listed", listed(F.col("host"), F.col("path"), rules))
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("_listed.rule").alias("rule"),
        F.coalesce(
            F.col("_listed.verdict"), F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        "template",
        "purity",
    )
