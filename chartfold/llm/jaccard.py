"""N-gram Jaccard join of texts by a MinHash LSH forest."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import released, whole_text
from chartfold.llm.components import components, forest
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

SHINGLE = 5
THRESHOLD = 0.8
# Tries of the forest and the longest prefix in each.
TREES = 20
DEPTH = 6
RECALL = 0.998
# Texts that meet in one task, at most twice as many; small clusters are put
# together until they have about PACK.
BLOCK = 1024
SMALL = 64
PACK = 512
# Texts whose signatures are held at once.
SIGNED = 1_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """The published finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of texts.

    Words are what white space parts, in lower case. A text of fewer words than
    a shingle has one, of all its words; a text without words has none.
    """

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.powers = np.ones(1, dtype=_U)
        self.inverses = np.ones(1, dtype=_U)
        self.factors = _mix(np.arange(1, size + 1, dtype=_U) * _BASE) | _U(1)

    def _grow(self, n: int) -> None:
        n = max(n, 2 * len(self.powers))
        steps = np.full(n, _BASE)
        back = np.full(n, _INVERSE)
        steps[0] = back[0] = 1
        self.powers, self.inverses = np.cumprod(steps), np.cumprod(back)

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, dtype=_U)
        data = np.frombuffer(" ".join(words).encode("utf-8", "replace"), dtype=np.uint8).astype(_U)
        if len(data) > len(self.powers):
            self._grow(len(data))
        total = np.concatenate(([_U(0)], np.cumsum((data + _U(1)) * self.powers[: len(data)])))
        # The one byte that is a space and nothing else parts the words.
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))
        word = _mix((total[ends] - total[starts]) * self.inverses[starts])
        k = min(self.size, len(word))
        n = len(word) - k + 1
        shingle = np.zeros(n, dtype=_U)
        for i in range(k):
            shingle += word[i : i + n] * self.factors[i]
        return np.unique(_mix(shingle))


class Signer:
    """MinHash lanes: `trees` times `depth` minima of hashed shingles."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, seed: int = 11):
        random = np.random.default_rng(seed)
        lanes = trees * depth
        self.trees, self.depth = trees, depth
        self.a = random.integers(0, 1 << 63, lanes, dtype=_U) * _U(2) + _U(1)
        self.b = random.integers(0, 1 << 63, lanes, dtype=_U)
        self.mixers = random.integers(0, 1 << 63, depth, dtype=_U) * _U(2) + _U(1)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=_U)
        for start in range(0, len(shingles), 512):
            part = shingles[start : start + 512, None] * self.a + self.b
            np.minimum(least, part.min(axis=0), out=least)
        return (least >> _U(32)).astype(np.uint32)

    def prefixes(self, lanes: np.ndarray, depth: int) -> np.ndarray:
        """Keys (rows x trees) of the first `depth` lanes of every tree."""
        lanes = lanes.reshape(-1, self.trees, self.depth)[:, :, :depth].astype(_U)
        return _mix((lanes * self.mixers[:depth]).sum(axis=2) + np.arange(self.trees, dtype=_U) * _BASE)


def found_rate(similarity: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """The probability that a pair of texts shares a prefix in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def _intersections(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a[i] and b[j], for all pairs (i, j).

    By products of incidence matrices over the shingles that both sides have,
    or pair by pair, whichever costs less; both are exact.
    """
    one, other = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(one, other)
    if not len(shared):
        return np.zeros(len(i), dtype=np.int64)
    if len(i) * 20e-6 <= len(a) * len(b) * len(shared) * 5e-11:
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j)], dtype=np.int64)

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(shared, flat)
        hit = shared[np.minimum(at, len(shared) - 1)] == flat
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]

    rows_a, columns_a = places(a, one)
    rows_b, columns_b = places(b, other)
    total = np.zeros((len(a), len(b)), dtype=np.float32)
    wide = max(256, 8_000_000 // (len(a) + len(b)))
    for start in range(0, len(shared), wide):
        width = min(wide, len(shared) - start)
        parts = []
        for rows, columns, n in ((rows_a, columns_a, len(a)), (rows_b, columns_b, len(b))):
            part = np.zeros((n, width), dtype=np.float32)
            here = (columns >= start) & (columns < start + width)
            part[rows[here], columns[here] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return total[i, j].astype(np.int64)


def _verify(a: pd.DataFrame, b: pd.DataFrame, same: bool, depth: int, signer: Signer, threshold: float, tree: int):
    """Links among the texts of a and b that share a prefix of `depth` lanes but,
    below the full depth, none of one lane more: (i, j, similarity). With `tree`
    not -1, only pairs for which that is the first tree with a shared prefix."""
    lanes = [np.stack([np.frombuffer(x, np.uint32) for x in side["lanes"]]) for side in (a, b)]

    def met(k: int, trees: range) -> np.ndarray:
        left, right = (signer.prefixes(x, k) for x in lanes)
        out = np.zeros((len(a), len(b)), dtype=bool)
        for t in trees:
            out |= left[:, t][:, None] == right[:, t][None, :]
        return out

    if tree < 0:
        pairs = met(depth, range(signer.trees))
    else:
        pairs = met(depth, range(tree, tree + 1)) & ~met(depth, range(tree))
    if depth < signer.depth:
        pairs &= ~met(depth + 1, range(signer.trees))
    if same:
        pairs = np.triu(pairs, 1)
    i, j = np.nonzero(pairs)
    if not len(i):
        return i, j, np.zeros(0)
    left = list(a["shingles"])
    right = left if same else list(b["shingles"])
    inter = _intersections(left, right, i, j)
    sizes = [np.array([len(s) for s in x]) for x in (left, right)]
    union = sizes[0][i] + sizes[1][j] - inter
    # The comparison of whole numbers must not hang on a rounded product.
    close = inter >= np.ceil(threshold * union - 1e-9)
    return i[close], j[close], inter[close] / union[close]


def classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, kept (and `_h1`, `_h2`,
    two hashes of the text).

    Documents whose sets of word shingles have a Jaccard similarity of at least
    `threshold` are linked. `n_links` counts the other documents linked to one
    directly, copies included; `class_id` is the smallest doc_id reachable by
    links, and the documents of that id and of the class's first text are kept.

    Equal texts are one node of the join, with a count. Nodes are signed, and
    meet if they share a prefix of `depth` lanes in one of `trees` tries. Each
    link found is verified exactly, and stands for one over its chance of being
    found, which estimates how many were missed; prefixes are shortened by one
    lane as long as the estimated recall is below `recall`. Nodes that meet form
    clusters. A large one is verified by pairs of blocks, or, if that copies
    fewer texts (as with chains of unlike texts), prefix by prefix, each pair
    under the first prefix that it shares. Only counts and a spanning forest of
    links leave a task.

    NULL and empty texts, and such of white space only, link with equal texts
    and no others. Rows may repeat; each counts. A NULL doc_id is no class id
    unless a whole class has none. Extra columns are ignored.
    """
    signer = Signer(trees, depth)
    one = F.lit(1)
    text = whole_text()
    hashed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(one, text).alias("h2"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(shingle)
        for batch in (b[i : i + SIGNED] for b in batches for i in range(0, len(b), SIGNED)):
            # One set at a time, as all of them take as much memory as the texts.
            lanes = [signer.sign(s).tobytes() if len(s) else None for s in map(shingles, batch["text"])]
            yield batch[["doc_id", "h1", "h2"]].assign(lanes=lanes)

    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = hashed.withColumn("doc_id", F.col("doc_id").cast("string"))
    signed = sent.mapInPandas(partial(released, sign), "doc_id string, h1 bigint, h2 bigint, lanes binary").withColumn(
        "doc_id", F.col("doc_id").cast(kind)
    )
    # Copies are combined before the shuffle; a node keeps one signature.
    nodes = signed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first"), F.count(one).alias("copies"), F.first("lanes").alias("lanes")
    )
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()))
    with_words = nodes.filter(F.col("lanes").isNotNull())

    def keys_at(k: int) -> DataFrame:
        def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    lanes = np.stack([np.frombuffer(x, np.uint32) for x in batch["lanes"]])
                    found = signer.prefixes(lanes, k).astype(np.int64)
                    yield pd.DataFrame(
                        {
                            "node": np.repeat(batch["node"].to_numpy(), trees),
                            "tree": np.tile(np.arange(trees, dtype=np.int32), len(batch)),
                            "key": found.ravel(),
                        }
                    )

        return with_words.select("node", "lanes").mapInPandas(partial(released, keys), "node bigint, tree int, key bigint")

    def verified_at(k: int) -> DataFrame:
        keys = keys_at(k)
        shared = settled(
            keys.groupBy("tree", "key")
            .agg(F.min("node").alias("low"), F.count(one).alias("n"))
            .filter("n > 1")
            .select(F.col("tree").alias("_tree"), F.col("key").alias("_key"), "low", "n")
        )
        same_prefix = (F.col("tree") == F.col("_tree")) & (F.col("key") == F.col("_key"))
        met = settled(keys.join(shared, same_prefix).select("node", "tree", "key", "low", "n"))
        clusters = settled(components(met.select(F.col("node").alias("u"), F.col("low").alias("v"))))
        sizes = clusters.groupBy("component").agg(F.count(one).alias("n")).withColumnRenamed("component", "_of")
        # A cluster of several blocks is verified by pairs of blocks, or by the
        # prefixes that its nodes share, whichever copies fewer texts.
        copied = F.col("n") * F.ceil(F.col("n") / BLOCK)
        by_prefix = (
            shared.join(clusters, F.col("low") == F.col("node"))
            .groupBy("component")
            .agg(F.sum(copied).alias("by_prefix"))
            .withColumnRenamed("component", "_prefixed")
        )
        sizes = settled(
            sizes.join(by_prefix, F.col("_of") == F.col("_prefixed")).select("_of", "n", (F.col("by_prefix") < copied).alias("parted"))
        )
        unit = clusters.join(sizes, F.col("component") == F.col("_of"))
        whole = unit.filter(~F.col("parted")).select(F.col("node").alias("_node"), F.lit(-1).alias("tree"), F.col("component").alias("unit"), "n")
        parted = unit.filter("parted").select(F.col("node").alias("_parted"))
        prefixed = met.join(parted, F.col("low") == F.col("_parted")).select(
            F.col("node").alias("_node"), "tree", F.col("key").alias("unit"), "n"
        )
        spread = settled(whole.unionAll(prefixed))
        packs = max(1, math.ceil(spread.count() / PACK))
        small = F.col("n") <= SMALL
        spread = spread.select(
            "_node",
            "tree",
            "unit",
            F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
            # Small clusters share a task; a large one has tasks of its own.
            F.when(small, F.pmod(F.xxhash64("tree", "unit"), F.lit(packs))).otherwise(F.col("unit")).alias("pack"),
            F.when(small, F.lit(-2)).otherwise(F.col("tree")).alias("of_tree"),
        )
        wanted = settled(
            with_words.join(spread, F.col("node") == F.col("_node")).select(
                F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first", "node", "copies", "lanes", "tree", "unit", "blocks", "pack", "of_tree"
            )
        )
        # One row of each node: the text of its first document.
        texts = hashed.join(
            wanted,
            (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & F.col("doc_id").eqNullSafe(F.col("first")),
        ).select("node", "copies", "lanes", "tree", "unit", "blocks", "pack", "of_tree", "text")
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        meets = texts.withColumn("block", block).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        meets = meets.withColumns({"low_block": F.least("block", "other"), "high_block": F.greatest("block", "other")})

        def verify(group: pd.DataFrame) -> pd.DataFrame:
            shingles = Shingler(shingle)
            group = group.drop_duplicates(["tree", "unit", "node"])
            group["shingles"] = [shingles(t) for t in group["text"]]
            low, high = group["low_block"].iloc[0], group["high_block"].iloc[0]
            out = []
            for (tree, _), cluster in group.groupby(["tree", "unit"]):
                a, b = cluster[cluster["block"] == low], cluster[cluster["block"] == high]
                same = low == high
                if not len(a) or not len(b):
                    continue
                i, j, similarity = _verify(a, b, same, k, signer, threshold, tree)
                if not len(i):
                    continue
                ids = np.sort(cluster["node"].to_numpy())
                at = np.searchsorted(ids, a["node"].to_numpy()[i]), np.searchsorted(ids, b["node"].to_numpy()[j])
                links = np.bincount(at[0], b["copies"].to_numpy()[j], len(ids))
                links += np.bincount(at[1], a["copies"].to_numpy()[i], len(ids))
                weight = 1 / found_rate(similarity, trees, k)
                stands = np.bincount(at[0], weight, len(ids))
                pairs = np.bincount(at[0], minlength=len(ids))
                root = forest(len(ids), *at)
                some = np.flatnonzero(links > 0)
                out.append(
                    pd.DataFrame(
                        {
                            "node": ids[some],
                            "links": links[some].astype(np.int64),
                            "low": ids[root[some]],
                            "pairs": pairs[some],
                            "stands": stands[some],
                        }
                    )
                )
            schema = {"node": "int64", "links": "int64", "low": "int64", "pairs": "int64", "stands": "float64"}
            return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=t) for c, t in schema.items()})

        return settled(
            meets.groupBy("of_tree", "pack", "low_block", "high_block").applyInPandas(
                verify, "node bigint, links bigint, low bigint, pairs bigint, stands double"
            )
        )

    found = None
    # Prefixes of one lane find all but 1e-14 of the pairs at 0.8, so this ends with the recall.
    for k in range(depth, 0, -1):
        new = verified_at(k)
        found = new if found is None else found.unionAll(new)
        sums = found.agg(F.sum("pairs").alias("pairs"), F.sum("stands").alias("stands")).first()
        if not sums["pairs"] or sums["pairs"] >= recall * sums["stands"]:
            break
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("u"), F.col("low").alias("v")))
    told = settled(
        nodes.select("node", "h1", "h2", "first", "copies")
        .join(counts.withColumnRenamed("node", "_counted"), F.col("node") == F.col("_counted"), "left")
        .join(reached.withColumnRenamed("node", "_reached"), F.col("node") == F.col("_reached"), "left")
        .select(
            "node",
            "h1",
            "h2",
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    # The first document of a class is in the node that has its id.
    heads = settled(
        told.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("no"), "first", "node")).alias("head"))
    )
    named = settled(
        told.join(heads.withColumnRenamed("component", "_component"), F.col("component") == F.col("_component")).select(
            F.col("h1").alias("_h1"),
            F.col("h2").alias("_h2"),
            "n_links",
            F.col("head.first").alias("class_id"),
            (F.col("node") == F.col("head.node")).alias("_heads"),
        )
    )
    return (
        hashed.drop("text")
        .join(named, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
        .select(
            "doc_id",
            "class_id",
            "n_links",
            (F.col("_heads") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
            "_h1",
            "_h2",
        )
    )


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `docs` with one document of each class, all columns kept.

    `found` is what `classes` says about `docs`. Of rows with the id and text of
    a kept document, one stays, picked by a hash of all its columns, which may
    have any names.
    """
    kept = settled(found.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("_h1").alias("kept_h1"), F.col("_h2").alias("kept_h2")))
    once = settled(kept.distinct())
    text = whole_text()
    # The columns of `docs` go into one, so that they clash with nothing here.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("kept_id"))
        & (F.col("h1") == F.col("kept_h1"))
        & (F.col("h2") == F.col("kept_h2"))
    )
    stay = rows.join(once, same, "left_semi")
    if once.count() < kept.count():
        stay = stay.groupBy("id", "h1", "h2").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return stay.select("row.*")
