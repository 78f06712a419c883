"""Quality rules: a decision list learned by sequential covering, applied as one
conditional expression. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import whole_text

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Labelled rows that the list is learned from, at most.
SAMPLE = 20_000

FEATURES = (
    "n_words",
    "word_length",
    "symbol_share",
    "digit_share",
    "upper_share",
    "mark_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "words_a_line",
)


def _blankless(text: Column) -> Column:
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and shares of each text, beside `doc_id`.

    Words are runs without the six ASCII spaces. Every step is a column of its
    own, so arrays used more than once are made once. NULL counts as empty;
    shares of nothing are 0. Windows of words are compared by 64-bit hashes.
    """
    at = docs.select("doc_id", whole_text().alias("_text"))
    at = at.withColumns(
        {
            "_words": F.filter(F.split("_text", f"[{SPACE}]+"), lambda w: w != ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
            "word_chars": F.length(_blankless(F.col("_text"))).cast("bigint"),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint"),
            "_digits": F.length("_text") - F.length(F.translate("_text", "0123456789", "")),
            "_upper": F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")),
            "_letters": F.length(F.regexp_replace("_text", r"[^\p{L}]+", "")),
        }
    )
    at = at.select(
        "doc_id",
        "_digits",
        "_upper",
        "_letters",
        "word_chars",
        "n_symbols",
        F.size("_words").cast("bigint").alias("n_words"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")))
    at = at.withColumn(
        "_windows",
        F.transform(starts, lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW)))),
    ).drop("_hashes")
    # Only texts with a repeated window go on; the rest keep NULL arrays.
    at = at.withColumn("_again", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    at = at.withColumn(
        "_sorted",
        F.when(F.col("_again"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    ).drop("_windows", "_again")
    twin = lambda x, j: (x["h"] == F.get("_sorted", j - 1)["h"]) | (x["h"] == F.get("_sorted", j + 1)["h"])
    at = at.withColumn(
        "_places",
        F.sort_array(
            F.filter(F.transform("_sorted", lambda x, j: F.when(twin(x, j), x["i"])), lambda i: i.isNotNull())
        ),
    ).drop("_sorted")
    gaps = F.transform(
        "_places",
        lambda p, j: F.when(j == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get("_places", j - 1))),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, g: total + g)
    at = at.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_places")

    def share(part, whole) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))

    return at.withColumns(
        {
            "word_length": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "digit_share": share("_digits", "word_chars"),
            "upper_share": share("_upper", "_letters"),
            "mark_share": F.lit(1.0) - share("_letters", "word_chars"),
            "dup_line_share": share("n_dup_lines", "_n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "distinct_share": share("_distinct", "n_words"),
            "words_a_line": share("n_words", "_n_lines"),
        }
    ).drop("_digits", "_upper", "_letters", "_distinct", "_n_lines")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        x = F.col(self.feature)
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], rows: int) -> np.ndarray:
    hit = np.ones(rows, dtype=bool)
    for c in rule:
        hit &= c.holds(values)
    return hit


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, conditions: int, cuts: int) -> Rule:
    """Adds the condition of the largest FOIL gain until no good row is covered."""
    rule: Rule = ()
    hit = np.ones(len(bad), dtype=bool)
    while len(rule) < conditions and bad[hit].any() and (~bad[hit]).any():
        p0, n0 = bad[hit].sum(), (~bad[hit]).sum()
        best, choice = 1e-9, None
        for name in FEATURES:
            x, y = values[name][hit], bad[hit]
            order = np.argsort(x, kind="stable")
            xs, below = x[order], np.concatenate(([0], np.cumsum(y[order])))
            edges = np.flatnonzero(xs[1:] > xs[:-1]) + 1
            if len(edges) > cuts:
                edges = edges[np.linspace(0, len(edges) - 1, cuts).astype(int)]
            for above in (False, True):
                p = p0 - below[edges] if above else below[edges]
                total = len(xs) - edges if above else edges
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / total) - np.log2(p0 / (p0 + n0))), 0)
                if len(gain) and gain.max() > best:
                    k = int(gain.argmax())
                    best, choice = gain[k], Condition(name, above, float((xs[edges[k]] + xs[edges[k] - 1]) / 2))
        if choice is None:
            break
        rule += (choice,)
        hit &= choice.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drops last conditions as long as that is no worse on rows not grown from."""

    def worth(r: Rule) -> float:
        hit = _covered(r, values, len(bad))
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def cover(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    rules: int = 12,
    conditions: int = 4,
    cuts: int = 256,
    precision: float = 0.9,
    support: int = 3,
) -> list[Rule]:
    """An ordered list of rules that reject: grow one on two thirds of the rows,
    prune it on the rest, accept it if its Laplace-smoothed precision there is
    high enough, take away what it covers, and go on."""
    found: list[Rule] = []
    for _ in range(rules):
        held = np.arange(len(bad)) % 3 == 0
        part = lambda rows: {k: v[rows] for k, v in values.items()}
        rule = _prune(_grow(part(~held), bad[~held], conditions, cuts), part(held), bad[held])
        if not rule:
            break
        hit = _covered(rule, values, len(bad))
        p, n = bad[hit & held].sum(), (~bad[hit & held]).sum()
        if p < support or (p + 1) / (p + n + 2) < precision:
            break
        found.append(rule)
        values, bad = part(~hit), bad[~hit]
    return found


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> list[Rule]:
    """A decision list from at most `sample` labelled rows, chosen by hash.

    `labels` has doc_id and quality (1 good, 0 bad); NULLs are left out, of
    several labels of one id the best counts. Only the statistics of the
    sampled rows, a bounded table, reach the driver.
    """
    order = [F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")]
    known = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").alias("_quality"))
    chosen = known.orderBy(*order).limit(sample).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # An id may repeat in the documents; the bound holds all the same.
    texts = texts.orderBy(*order).limit(sample)
    found = statistics(texts).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = found.orderBy(*order).select("_quality", *FEATURES).collect()
    values = {f: np.array([r[f] for r in rows], dtype=np.float64) for f in FEATURES}
    return cover(values, np.array([r["_quality"] == 0 for r in rows], dtype=bool), **options)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, from 1; NULL where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column()
        out = F.when(holds, F.lit(k)) if out is None else out.when(holds, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics of every document and `rule`, the first rule that rejects it.

    NULL and empty texts have zero counts and shares and are judged like any
    text; repeated rows are judged one by one; columns of `docs` other than
    doc_id and text are ignored.
    """
    return statistics(docs).withColumn("rule", verdict(rules))
