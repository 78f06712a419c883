"""Language identification: each document as a mixture of languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import released, whole_text
from chartfold.shared import send_by_value

send_by_value(__name__)

# Documents to learn each language from, about.
SAMPLE = 5_000
# Buckets of hashed trigrams.
BUCKETS = 1 << 16
UNDETERMINED = "und"
UNKNOWN = "unknown"


_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter, made once in each process."""
    # A cached function would be sent to the tasks by the name of this module,
    # which executors need not have.
    if not _TABLE:
        _TABLE.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _TABLE[0]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter, words bounded by zeros, and
    the places where words start among them."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    padded = np.zeros(len(codes) + 2, dtype=np.uint64)
    letter = np.zeros(len(codes) + 2, dtype=bool)
    letter[1:-1] = _letters()[codes]
    padded[1:-1] = np.where(letter[1:-1], codes, 0)
    at = np.flatnonzero(letter)
    mixed = padded[at - 1] * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ padded[at]) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ padded[at + 1]) * np.uint64(0x165667B19E3779F9)
    return (mixed >> np.uint64(48)).astype(np.int64), np.flatnonzero(~letter[at - 1])


@dataclass
class Model:
    """Log-probabilities of trigram buckets, a column for each language and a
    last one for text of none of them (all buckets alike)."""

    languages: list[str]
    logs: np.ndarray


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            counts = np.zeros(BUCKETS, dtype=np.int64)
            for text in texts:
                if text:
                    counts += np.bincount(trigrams(text)[0], minlength=BUCKETS)
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})


def learn(labelled: DataFrame, sample: int = SAMPLE, smoothing: float = 0.5) -> Model:
    """Counts trigrams of about `sample` different texts of each language (text,
    lang), chosen by a hash of them; a text counts once, however many copies it
    has. NULL languages are left out; what reaches the driver is one number for
    each language and bucket."""
    text = whole_text()
    rows = labelled.select(text.alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("h")).dropna()
    # Copies are dropped in the tasks first, so none of them moves.
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.full((BUCKETS, 1), -np.log(BUCKETS)))
    span = 1 << 30
    limits = F.create_map(
        *(F.lit(v) for lang, n in sorted(sizes.items()) for v in (lang, min(span, span * sample // max(1, n))))
    )
    near = rows.filter(F.pmod("h", F.lit(span)) < F.element_at(limits, F.col("lang")))
    chosen = near.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")
    found = chosen.mapInPandas(partial(released, _count), "lang string, bucket bigint, n bigint")
    counts = {lang: np.zeros(BUCKETS) for lang in sorted(sizes)}
    for r in found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["lang"]][r["bucket"]] = r["n"]
    logs = [np.log((c + smoothing) / (c.sum() + smoothing * BUCKETS)) for c in counts.values()]
    return Model(list(counts), np.stack([*logs, np.full(BUCKETS, -np.log(BUCKETS))], axis=1))


def proportions(likelihood: np.ndarray, rounds: int = 30, close: float = 1e-3) -> np.ndarray:
    """Maximum-likelihood shares of the columns in the rows, by expectation-maximisation."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(rounds):
        weighted = likelihood * share
        new = (weighted / weighted.sum(axis=1, keepdims=True)).mean(axis=0)
        moved = np.abs(new - share).max()
        share = new
        if moved < close:
            break
    return share


def mixture(model: Model, text: str) -> np.ndarray | None:
    """Shares of the model's columns in a text; None if it has no letter.

    Starting from all languages, the least is given up as long as that lowers
    the Bayesian information criterion; languages given up have share 0.
    """
    buckets, starts = trigrams(text)
    if not len(starts):
        return None
    logs = np.add.reduceat(model.logs[buckets], starts, axis=0)
    top = logs.max(axis=1, keepdims=True)
    # No word is held impossible in any language.
    likelihood = np.exp(np.maximum(logs - top, -60.0))
    words = len(likelihood)
    chosen = np.arange(likelihood.shape[1])
    share = proportions(likelihood)

    def criterion(columns: np.ndarray, of: np.ndarray) -> float:
        return -2 * float(np.log(likelihood[:, columns] @ of).sum()) + (len(columns) - 1) * np.log(words)

    best = criterion(chosen, share)
    while len(chosen) > 1:
        # Languages without half a word go at once.
        keep = share * words >= 0.5
        if keep.all() or not keep.any():
            keep = np.arange(len(chosen)) != share.argmin()
        fewer = chosen[keep]
        of = proportions(likelihood[:, fewer])
        now = criterion(fewer, of)
        if now >= best:
            break
        chosen, share, best = fewer, of, now
    full = np.zeros(likelihood.shape[1])
    full[chosen] = share
    return full


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `lang_pred`, `score`, `unknown` and `lang_shares`.

    `lang_pred` is the learned language of the largest share and `score` that
    share; `unknown` is the share of words unlike any learned language, and
    `lang_shares` has the share of each selected language. A text that is NULL
    or has no letter is `und` with score 0. Whole texts are read and nothing
    else of the row; columns of these names are replaced.
    """

    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                share = mixture(model, text) if model.languages else None
                if share is None:
                    out.append((UNDETERMINED, 0.0, 0.0, {}))
                    continue
                known = share[:-1]
                if known.max() > 0:
                    first = int(known.argmax())
                else:
                    buckets, _ = trigrams(text)
                    first = int(model.logs[buckets, :-1].sum(axis=0).argmax())
                shares = {n: float(s) for n, s in zip([*model.languages, UNKNOWN], share) if s > 0}
                out.append((model.languages[first], float(min(1.0, known[first])), float(share[-1]), shares))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "unknown", "lang_shares"])

    @F.pandas_udf("lang_pred string, score double, unknown double, lang_shares map<string, double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from released(told, batches)

    found = docs.withColumn("_language", of(whole_text()))
    return found.withColumns(
        {c: F.col(f"_language.{c}") for c in ("lang_pred", "score", "unknown", "lang_shares")}
    ).drop("_language")
