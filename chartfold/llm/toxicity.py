"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import numbered, ranked, released, whole_text
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# Labelled rows to learn from, and terms in the model, at most.
SAMPLE = 12_000
TERMS = 4_096
# Updates of the model at least, so that few rows are gone over more often.
STEPS = 1_500
# A pair of terms is judged by the documents with both, one and the other of
# them, if each are so many (fewer cannot tell); a group counts the pairs of two
# blocks of so many terms (below 2^15).
PAIR_ROWS = 5
BLOCK = 16_384
# Documents whose terms are laid out at once.
DOCS = 100
# Letters of a word that are a term of their own.
STEMS = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[int]:
    """Signed 64-bit hashes of a text's distinct lower-case words and stems."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(word)
        for n in STEMS:
            if len(word) > n:
                found.add(word[:n] + "*")
    digest = xxhash.xxh64_intdigest
    return {digest(t) - (1 << 63) for t in found}


def _explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # Few documents at once: one of them may have as many terms as a thousand others.
        for start in range(0, len(batch), DOCS):
            part = batch.iloc[start : start + DOCS]
            sets = [np.fromiter(terms(t), dtype=np.int64) for t in part["text"]]
            sizes = [len(s) for s in sets]
            yield pd.DataFrame(
                {
                    "row": np.repeat(part["row"].to_numpy(), sizes),
                    "toxic": np.repeat(part["toxic"].to_numpy(), sizes),
                    "term": np.concatenate(sets),
                }
            )


@dataclass
class Model:
    """score = sigmoid(bias + sum of weights + sum over pairs of <factor, factor>)."""

    terms: np.ndarray  # sorted hashes
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def of(self, active: np.ndarray) -> float:
        f = self.factors[active]
        both = f.sum(axis=0)
        pairs = 0.5 * float((both * both - (f * f).sum(axis=0)).sum())
        z = self.bias + float(self.weights[active].sum()) + pairs
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def fit(
    rows: list[tuple[np.ndarray, int]],
    known: np.ndarray,
    rank: int = 4,
    epochs: int | None = None,
    rate: float = 0.05,
    decay: float = 1e-4,
    batch: int = 256,
    seed: int = 7,
) -> Model:
    """Learns by AdaGrad over (indices of active terms, label) pairs.

    Both labels have the same total weight. Rows come in a fixed order, so the
    same rows give the same model. Without `epochs` there are 30, or more until
    `STEPS` updates are made.
    """
    random = np.random.default_rng(seed)
    n, size = len(rows), len(known)
    labels = np.array([y for _, y in rows], dtype=np.float64)
    positive = labels.sum()
    bias, weights = 0.0, np.zeros(size)
    factors = random.normal(0, 0.05, (size, rank))
    if not n or not size or positive in (0, n):
        share = positive / n if n else 0.0
        return Model(known, math.log((share * n + 0.5) / ((1 - share) * n + 20)), weights, factors * 0)
    balance = np.where(labels == 1, n / (2 * positive), n / (2 * (n - positive)))
    g_bias, g_weights, g_factors = 1e-8, np.full(size, 1e-8), np.full((size, rank), 1e-8)
    if epochs is None:
        epochs = max(30, math.ceil(STEPS / math.ceil(n / batch)))
    for _ in range(epochs):
        order = random.permutation(n)
        for start in range(0, n, batch):
            part = order[start : start + batch]
            lengths = np.array([len(rows[i][0]) for i in part])
            active = np.concatenate([rows[i][0] for i in part])
            owner = np.repeat(np.arange(len(part)), lengths)
            f = factors[active]
            both = np.zeros((len(part), rank))
            np.add.at(both, owner, f)
            squares = np.bincount(owner, (f * f).sum(axis=1), len(part))
            z = bias + np.bincount(owner, weights[active], len(part)) + 0.5 * ((both * both).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) * balance[part] / len(part)
            g = error.sum()
            g_bias += g * g
            bias -= rate * g / math.sqrt(g_bias)
            g = np.bincount(active, error[owner], size) + decay * weights
            g_weights += g * g
            weights -= rate * g / np.sqrt(g_weights)
            g = decay * factors
            np.add.at(g, active, error[owner, None] * (both[owner] - f))
            g_factors += g * g
            factors -= rate * g / np.sqrt(g_factors)
    return Model(known, bias, weights, factors)


def _tally(slices: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """How many of these documents hold each term of a block."""
    total = np.zeros(BLOCK, dtype=np.int64)
    for start in range(0, len(rows), DOCS):
        total += np.bincount(np.concatenate([slices[r] for r in rows[start : start + DOCS]]), minlength=BLOCK)
    return total


def _effects(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], n_all: int, n_bad: int) -> pd.DataFrame:
    """The largest interaction of each term of two blocks with one of the other
    block (or of its own): (at, _pair)."""
    a, b = (int(k) for k in key)
    toxic, xs, ys = [], [], []
    for batch in batches:
        toxic += list(batch["toxic"])
        xs += list(batch["xs"])
        ys += list(batch["ys"])
    toxic = np.array(toxic, dtype=bool)
    flat = np.concatenate(xs)
    owner = np.repeat(np.arange(len(xs), dtype=np.int32), [len(x) for x in xs])
    holders = owner[np.argsort(flat, kind="stable")]
    held = np.bincount(flat, minlength=BLOCK)
    starts = np.cumsum(held) - held
    everything, is_bad = np.arange(len(ys)), np.flatnonzero(toxic)
    have, have_bad = _tally(ys, everything), _tally(ys, is_bad)
    best = np.zeros((2, BLOCK))
    for i in np.flatnonzero(held):
        rows = holders[starts[i] : starts[i] + held[i]]
        marked = toxic[rows]
        with_bad = _tally(ys, rows[marked])
        both = with_bad + _tally(ys, rows[~marked])
        j = np.flatnonzero((both >= PAIR_ROWS) & (have - both >= PAIR_ROWS) & (held[i] - both >= PAIR_ROWS))
        if a == b:
            j = j[j > i]
        if not len(j):
            continue
        c11, b11 = both[j], with_bad[j]
        c10, c01 = held[i] - c11, have[j] - c11
        b10, b01 = marked.sum() - b11, have_bad[j] - b11
        cells = (
            (1, b11, c11),
            (-1, b10, c10),
            (-1, b01, c01),
            (1, n_bad - b11 - b10 - b01, n_all - c11 - c10 - c01),
        )
        effect, variance = np.zeros(len(j)), np.zeros(len(j))
        for sign, bad, count in cells:
            r = (bad + 0.5) / (count + 1)
            effect += sign * r
            variance += r * (1 - r) / (count + 1)
        z = np.abs(effect) / np.sqrt(variance)
        best[0, i] = max(best[0, i], z.max())
        best[1, j] = np.maximum(best[1, j], z)
    at = np.concatenate((a * BLOCK + np.arange(BLOCK), b * BLOCK + np.arange(BLOCK)))
    told = pd.DataFrame({"at": at, "_pair": best.ravel()})
    return told[told["_pair"] > 0]


def pair_signs(active: DataFrame, counts: DataFrame, labels: dict[int, int], pair_z: float) -> DataFrame:
    """Terms (term, _pair) that tell the label together with another: `_pair` is
    the largest interaction of a pair they are in, if it is at least `pair_z`.

    The interaction of two terms is r11 - r10 - r01 + r00, the shares of toxic
    documents among those with both, one, the other and none, in standard
    errors of it. It is 0 where the terms' effects add up. Terms are numbered
    and parted into blocks; a document's terms are sent, block by block, to the
    groups that count pairs of blocks. A group holds what the sample has of two
    blocks, and there are as many groups as the number of terms asks for.
    """
    often = counts.filter(F.col("p") + F.col("n") >= 2 * PAIR_ROWS).select("term")
    numbers = settled(ranked(numbered(often), [], into="at").select("term", "at"))
    blocks = math.ceil(numbers.count() / BLOCK)
    n_all, n_bad = len(labels), sum(labels.values())
    seen = active.join(numbers, "term").groupBy("row").agg(F.first("toxic").alias("toxic"), F.collect_list("at").alias("terms"))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), DOCS):
                part = batch.iloc[start : start + DOCS]
                rows = []
                for toxic, held in zip(part["toxic"], part["terms"]):
                    held = np.sort(held)
                    ends = np.searchsorted(held, np.arange(blocks + 1) * BLOCK)
                    cut = [(held[i:j] % BLOCK).astype(np.int16) for i, j in zip(ends, ends[1:])]
                    rows += [
                        (a, b, toxic, cut[a], cut[b])
                        for a in range(blocks)
                        for b in range(a, blocks)
                        if len(cut[a]) or len(cut[b])
                    ]
                yield pd.DataFrame(rows, columns=["a", "b", "toxic", "xs", "ys"])

    def judged(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from released(lambda: iter([_effects(key, batches, n_all, n_bad)]))

    dealt = seen.mapInPandas(partial(released, deal), "a int, b int, toxic int, xs array<smallint>, ys array<smallint>")
    found = dealt.groupBy("a", "b").applyInPandas(judged, "at bigint, _pair double")
    best = found.groupBy("at").agg(F.max("_pair").alias("_pair")).filter(F.col("_pair") >= pair_z)
    return settled(best.join(numbers, "at").select("term", "_pair"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    size: int = TERMS,
    z: float = 4.0,
    pair_z: float = 6.0,
    **options,
) -> Model:
    """A model from at most `sample` labelled documents, half of them of each
    label as far as there are, chosen by a hash of their id.

    `docs` has doc_id and text, `labels` doc_id and toxic; of several labels of
    an id the worst counts, of several texts one. The ids are drawn before any
    text is moved. The terms of the model are those whose share among the toxic
    documents of the sample differs from that among the others by `z` standard
    errors, and those that tell the label by `pair_z` only together with
    another (see `pair_signs`); the `size` most distinct ones. What they weigh
    is up to the fit. Terms and pairs are counted on the executors; only the
    active terms of the sample's documents reach the driver.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().filter(F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id", F.lit("toxic")), F.col("doc_id")]
    halves = [known.filter(F.col("toxic") == y).orderBy(*order).limit(sample // 2) for y in (0, 1)]
    drawn = halves[0].unionAll(halves[1]).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    chosen = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))
    chosen = settled(chosen.withColumn("row", F.monotonically_increasing_id()))
    judged = {r["row"]: r["toxic"] for r in chosen.select("row", "toxic").orderBy("row").collect()}
    toxic = sum(judged.values())
    clean = len(judged) - toxic
    active = settled(chosen.mapInPandas(partial(released, _explode), "row bigint, toxic int, term bigint"))
    counts = settled(
        active.groupBy("term")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
        .filter(F.col("p") + F.col("n") >= 3)
    )
    both = (F.col("p") + F.col("n")) / F.lit(max(1, clean + toxic))
    error = F.sqrt(both * (1 - both) * F.lit(1 / max(1, clean) + 1 / max(1, toxic)))
    difference = F.abs(F.col("p") / F.lit(max(1, toxic)) - F.col("n") / F.lit(max(1, clean)))
    told = (
        counts.withColumn("_z", F.try_divide(difference, error))
        .join(pair_signs(active, counts, judged, pair_z), "term", "left")
        .withColumn("_sign", F.greatest(F.col("_z") / z, F.col("_pair") / pair_z))
        .filter(F.col("_sign") >= 1)
        .orderBy(F.col("_sign").desc(), "term")
        .limit(size)
        .select("term")
    )
    known = np.sort(np.array([r["term"] for r in told.collect()], dtype=np.int64))
    pairs = active.join(F.broadcast(active.sparkSession.createDataFrame([(int(t),) for t in known], "term bigint")), "term")
    held: dict[int, list[int]] = {}
    for r in pairs.groupBy("row").agg(F.collect_list("term").alias("terms")).collect():
        held[r["row"]] = r["terms"]
    rows = [
        (np.searchsorted(known, np.sort(np.array(held.get(row, []), dtype=np.int64))), label) for row, label in judged.items()
    ]
    return fit(rows, known, **options)


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """Every document's score, in column `into`, from 0 to 1, higher the likelier it is toxic.

    Whole texts are read and nothing else of the row; NULL and empty texts have
    no term and get the score of the bias. `docs` keeps its other columns. Repeated rows get equal scores.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = {int(t): i for i, t in enumerate(model.terms)}
        for texts in batches:
            out = []
            for text in texts:
                active = sorted(i for i in map(index.get, terms(text)) if i is not None)
                out.append(model.of(np.array(active, dtype=np.int64)))
            yield pd.Series(out, dtype="float64")

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from released(of, batches)

    return docs.withColumn(into, scored(whole_text()))
