"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import numbered
from chartfold.llm.components import components, forest
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# Vectors that the codebooks are fitted on, and more if words get fewer than so many.
SAMPLE = 8_000
PER_WORD = 8
# Vectors in a cell of the grid, about.
OCCUPANCY = 256
# Members and probes of a cell that meet in one task, at most.
BLOCK = 1_000


@dataclass
class MultiIndex:
    """Two codebooks, for the halves of unit vectors, and the number of cells
    of their grid that a search visits."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    def cells(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The `visits` nearest cells of each vector, nearest first.

        What a multi-sequence traversal visits: the cell of the i-th and j-th
        nearest words cannot be among the first n unless (i + 1)(j + 1) <= n.
        """
        near, ranks = [], []
        half = self.first.shape[1]
        for part, words in ((unit[:, :half], self.first), (unit[:, half:], self.second)):
            d = (part * part).sum(1)[:, None] - 2 * part @ words.T + (words * words).sum(1)[None, :]
            order = np.argsort(d, axis=1, kind="stable")[:, :visits]
            ranks.append(order)
            near.append(np.take_along_axis(d, order, axis=1))
        at = [
            (i, j)
            for i in range(near[0].shape[1])
            for j in range(min(near[1].shape[1], visits // (i + 1)))
        ]
        i, j = np.array(at).T
        total = near[0][:, i] + near[1][:, j]
        best = np.argsort(total, axis=1, kind="stable")[:, :visits]
        words = ranks[0][np.arange(len(unit))[:, None], i[best]], ranks[1][np.arange(len(unit))[:, None], j[best]]
        return (words[0] * len(self.second) + words[1]).astype(np.int32)


def words_for(total: int) -> int:
    """Words of each codebook, so that the cells grow with the vectors."""
    return max(2, round((total / OCCUPANCY) ** 0.5))


def _codebook(points: np.ndarray, words: int, random: np.random.Generator, rounds: int = 15) -> np.ndarray:
    """k-means; a word that loses all points stays where it was."""
    book = points[random.choice(len(points), min(words, len(points)), replace=False)]
    for _ in range(rounds):
        norms = (book * book).sum(1)[None, :]
        # By blocks, as the words grow with the points.
        near = np.concatenate([(norms - 2 * part @ book.T).argmin(axis=1) for part in _blocks(points)])
        size = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, points)
        book = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], book)
    return book


def _blocks(points: np.ndarray, size: int = 1_000) -> list[np.ndarray]:
    return [points[start : start + size] for start in range(0, len(points), size)]


def fit(unit: np.ndarray, words: int, threshold: float, recall: float, seed: int = 5) -> MultiIndex:
    """Codebooks of a sample of unit vectors, and the visits that reach `recall`.

    The visits are those which find the cell of a vector moved from the sample
    by exactly the least similarity, the hardest case, in any direction, and of
    the sample's own neighbours, with the wanted frequency.
    """
    random = np.random.default_rng(seed)
    half = unit.shape[1] // 2
    index = MultiIndex(_codebook(unit[:, :half], words, random), _codebook(unit[:, half:], words, random), 1)
    asked = unit[random.choice(len(unit), min(2000, len(unit)), replace=False)]
    aside = random.normal(size=asked.shape)
    aside -= (aside * asked).sum(1)[:, None] * asked
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    moved = threshold * asked + np.sqrt(1 - threshold**2) * aside / np.where(length > 0, length, 1)
    pairs = []
    for start, part in enumerate(_blocks(asked, 100)):
        similar = part @ unit.T
        i, j = np.nonzero((similar >= threshold) & (similar < 1 - 1e-12))
        pairs.append((i + 100 * start, j))
    a, b = (np.concatenate(ends) for ends in zip(*pairs, strict=True))
    cells = len(index.first) * len(index.second)
    needed = 1
    for x, y in ((asked, moved), (asked[a], unit[b])):
        if len(x):
            if len(x) > 20_000:
                pick = random.choice(len(x), 20_000, replace=False)
                x, y = x[pick], y[pick]
            home = index.cells(y, 1)[:, 0]
            visits = 1
            while True:
                found = (index.cells(x, visits) == home[:, None]).any(axis=1).mean()
                if found >= recall or visits >= cells:
                    break
                visits = min(cells, visits + max(1, visits // 4))
            needed = max(needed, visits)
    index.visits = needed
    return index


def _padded(vectors: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        out[i, : min(size, len(v))] = v[:size]
    return out


def _arrays(embeddings: DataFrame) -> list[np.ndarray]:
    """The vectors of a bounded table of one column, eight bytes a number."""
    return [v.values.to_numpy() for chunk in embeddings.toArrow().column(0).chunks for v in chunk]


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small parts stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, recall: float = 0.99, sample: int = SAMPLE
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    `vectors` has vec_id, embedding (array of numbers) and label. Vectors of
    equal, non-NULL label and of equal length are linked if the cosine of what
    the index finds is at least `threshold`, in double precision; all vectors
    are indexed; the codebooks are fitted on `sample` of them, or 8 per word if
    these are more (a word for 16 sqrt(n): 50,000 of 10 billion). `component_id` is the smallest vec_id reachable by links.
    Vectors that are NULL, empty, zero or hold a NULL or a part that is not
    finite, and such without id or label, link with nothing and are their own
    component. Equal vectors are searched once and all counted; repeated rows
    are vectors of their own. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit_for = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    # Two seeds make 128 bits that stand for the vector.
    keys = ["label", "_h1", "_h2"]
    marked = rows.withColumn("_fit", F.coalesce(fit_for, F.lit(False))).withColumns(
        {"_h1": F.xxhash64("embedding"), "_h2": F.xxhash64(F.lit(1), "embedding")}
    )
    groups = marked.filter("_fit").groupBy(*keys).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # Groups of different vectors may have one vec_id, so they get numbers.
    groups = numbered(groups, "rep")
    # Only one vector of each group goes on.
    single = marked.filter("_fit").join(groups, keys).filter(F.col("vec_id") == F.col("least"))
    single = single.dropDuplicates(["rep"]).select(
        "rep", "label", "embedding", F.size("embedding").alias("size"), "copies"
    )
    single = settled(single)
    total = single.count()
    words = words_for(total)
    drawn = single.orderBy(F.xxhash64("embedding"), "rep").limit(max(sample, PER_WORD * words))
    chosen = _arrays(drawn.select("embedding"))
    if not chosen:
        return rows.select(
            "vec_id",
            F.lit(0).cast("bigint").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    width = max(2, max(map(len, chosen)))
    index = fit(_unit(_padded(chosen, width)), words, threshold, recall)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cells = index.cells(_unit(_padded(list(batch["embedding"]), width)), index.visits)
                batch["probes"] = list(cells)
                batch["home"] = cells[:, 0]
                yield batch

    placed = settled(
        single.mapInPandas(
            place,
            f"rep bigint, label {single.schema['label'].dataType.simpleString()}, embedding array<double>, "
            "size int, copies bigint, probes array<int>, home int",
        )
    )
    cell = ["label", "size", "cell"]
    probes = placed.select("label", "size", F.explode("probes").alias("cell"), "rep", "copies", "embedding", "home")
    members = placed.select("label", "size", F.col("home").alias("cell"), "rep", "copies", "embedding", "probes")
    sizes = settled(
        members.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("m"))
        .join(probes.groupBy(*cell).agg(F.count(F.lit(1)).alias("p")), cell)
        .select(
            *(F.col(c).alias(f"_{c}") for c in cell),
            F.ceil(F.col("m") / BLOCK).cast("int").alias("m_blocks"),
            F.ceil(F.col("p") / BLOCK).cast("int").alias("p_blocks"),
        )
    )
    same = (F.col("label") == F.col("_label")) & (F.col("size") == F.col("_size")) & (F.col("cell") == F.col("_cell"))

    def dealt(df, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        """Each row is in one block of its own side and meets all of the other's."""
        block = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int").alias(own_block)
        return df.join(sizes, same).withColumn(own_block, block).withColumn(
            other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        )

    column = [*cell, "_mb", "_pb", "rep", "copies", "embedding"]
    both = dealt(members, "m_blocks", "p_blocks", "_mb", "_pb").select(
        *column, "probes", F.lit(None).cast("int").alias("home")
    ).unionAll(
        dealt(probes, "p_blocks", "m_blocks", "_pb", "_mb").select(
            *column, F.lit(None).cast("array<int>").alias("probes"), "home"
        )
    )

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        here = group["cell"].iloc[0]
        is_probe = group["home"].notna().to_numpy()
        m, p = group[~is_probe], group[is_probe]
        if not len(m) or not len(p):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("rep", "links", "low")})
        m_unit = _unit(np.stack(list(m["embedding"])))
        p_unit = _unit(np.stack(list(p["embedding"])))
        m_rep, p_rep = m["rep"].to_numpy(), p["rep"].to_numpy()
        m_copies, p_copies = m["copies"].to_numpy(), p["copies"].to_numpy()
        home = p["home"].to_numpy().astype(np.int64)
        m_probes = np.stack(list(m["probes"]))
        m_links, p_links = np.zeros(len(m), np.int64), np.zeros(len(p), np.int64)
        reps = np.unique(np.concatenate((m_rep, p_rep)))
        m_at, p_at = np.searchsorted(reps, m_rep), np.searchsorted(reps, p_rep)
        root = np.arange(len(reps))
        for start in range(0, len(p), 256):
            part = slice(start, start + 256)
            close = p_unit[part] @ m_unit.T >= threshold
            i, j = np.nonzero(close & (p_rep[part][:, None] != m_rep[None, :]))
            if not len(i):
                continue
            i += start
            np.add.at(p_links, i, m_copies[j])
            # The member finds the prober itself, unless it does not visit its cell.
            unseen = ~(m_probes[j] == home[i][:, None]).any(axis=1)
            np.add.at(m_links, j[unseen], p_copies[i[unseen]])
            ends = np.concatenate((np.arange(len(reps)), p_at[i])), np.concatenate((root, m_at[j]))
            root = forest(len(reps), *ends)
        links = np.zeros(len(reps), np.int64)
        np.add.at(links, p_at, p_links)
        np.add.at(links, m_at, m_links)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(reps))))
        return pd.DataFrame({"rep": reps[some], "links": links[some], "low": reps[root[some]]})

    met = settled(both.groupBy(*cell, "_mb", "_pb").applyInPandas(verify, "rep bigint, links bigint, low bigint"))
    counts = met.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(met.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    linked = settled(counts.join(joined, F.col("rep") == F.col("node"), "left").select("rep", "links", "component"))
    # The smallest vec_id of each component, whose number says nothing of it.
    lowest = settled(
        linked.join(groups.select(F.col("rep").alias("_rep"), "least"), F.col("rep") == F.col("_rep"))
        .groupBy("component")
        .agg(F.min("least").alias("lowest"))
        .withColumnRenamed("component", "_component")
    )
    found = settled(
        linked.join(lowest, F.col("component") == F.col("_component"), "left").select(
            F.col("rep").alias("_rep"), "links", "lowest"
        )
    )
    wide = marked.select("vec_id", "_fit", *keys).join(
        groups.select(*(F.col(k).alias(f"_of{k}") for k in keys), "rep", "least", "copies"),
        F.col("_fit")
        & (F.col("label") == F.col("_oflabel"))
        & (F.col("_h1") == F.col("_of_h1"))
        & (F.col("_h2") == F.col("_of_h2")),
        "left",
    )
    wide = wide.join(found, F.col("rep") == F.col("_rep"), "left")
    component = F.coalesce("lowest", "least", "vec_id")
    return wide.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
