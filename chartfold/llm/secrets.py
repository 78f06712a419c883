"""Secret scans: known forms by pattern, unknown ones by a battery of randomness
tests under false-discovery control."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import released, whole_text
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# The forms that are always secrets, with the least length that
# counts, and the group it counts for.
FORMS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    # Runs shorter than 16 would be dropped; the pattern leaves them out at once.
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
RANDOM = "random"
KINDS = (*(f[0] for f in FORMS), RANDOM)

# What is tested: 12 and more characters of base64 or its like.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}")
# Ordinary ones consist of words in a usual case and numbers, either one to each
# part, or of four characters on average (random strings: about two). They are
# no secrets, but tell how random ordinary strings of a length look.
_ATOM = re.compile(r"[0-9]+|[A-Z]?[a-z]+|[A-Z]+")
_PARTS = re.compile(r"(?>[0-9]+|[A-Z]?[a-z]+|[A-Z]*)(?:[+/_-](?>[0-9]+|[A-Z]?[a-z]+|[A-Z]*))*=*")
# Results of the battery that a task keeps for strings that come again.
CACHE = 10_000

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Encodings by alphabet; the first that holds all characters is inferred.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("upper36", _DIGITS + _UPPER),
    ("lower36", _DIGITS + _LOWER),
    ("base62", _DIGITS + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("any", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
_RANKS = tuple((name, {c: i for i, c in enumerate(a)}) for name, a in ENCODINGS)

# Bins of the combined p-value. Lengths fall into bins a fifth wider each.
P_BINS = 100
# Distinct strings that a stratum's cut is set from; with fewer, its neighbours
# in length are counted with it, and at last all strata.
POOL = 100


def stratum(encoding: str, length: int) -> int:
    """A number for the encoding and the bin of the length."""
    return int(4 * math.log2(length)) * len(ENCODINGS) + [n for n, _ in ENCODINGS].index(encoding)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, degrees: float) -> float:
    """Upper tail by the cube-root normal form, exact enough for a cut."""
    if x <= 0:
        return 1.0
    z = ((x / degrees) ** (1 / 3) - (1 - 2 / (9 * degrees))) / math.sqrt(2 / (9 * degrees))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str) -> tuple[str, float]:
    """The inferred encoding and the probability that a uniformly random string
    of it looks at most as random as `token`.

    Three tests: chi-squared of the characters' counts against uniform, runs
    above and below the middle of the alphabet, and correlation of neighbours'
    ranks. Their p-values are combined as Fisher does.
    """
    body = token.rstrip("=")
    name, ranks = next((n, r) for n, r in _RANKS if all(c in r for c in body))
    size, n = len(ranks), len(body)
    at = np.array([ranks[c] for c in body])
    counts = np.bincount(at, minlength=size)
    chi2 = float(((counts - n / size) ** 2).sum() * size / n)
    # The exact variance under uniform draws, for the few characters a token has.
    spread = math.sqrt(2 * (size - 1) * (n - 1) / n) or 1.0
    scaled = (chi2 - (size - 1)) / spread * math.sqrt(2 * (size - 1)) + size - 1
    p_counts = _chi2_tail(scaled, size - 1)
    high = at >= size / 2
    ups = int(high.sum())
    downs = n - ups
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if ups and downs:
        mean = 1 + 2 * ups * downs / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _normal_tail((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    x = at - at.mean()
    total = float((x * x).sum())
    serial = float((x[1:] * x[:-1]).sum()) / total if total else 1.0
    p_serial = _normal_tail((serial + 1 / n) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (p_counts, p_runs, p_serial))
    half = fisher / 2
    return name, math.exp(-half) * (1 + half + half * half / 2)


def known_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known forms, leftmost and apart per kind, in
    code points."""
    spans = []
    for order, (kind, pattern, group, least) in enumerate(FORMS):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                spans.append((m.start(), order, m.end(), kind))
    return [(start, end, kind) for start, _, end, kind in sorted(spans)]


def ordinary(token: str) -> bool:
    atoms = _ATOM.findall(token)
    return 4 * len(atoms) <= sum(map(len, atoms)) or _PARTS.fullmatch(token) is not None


def _tested(token: str) -> dict:
    name, p = battery(token)
    return {
        "stratum": stratum(name, len(token)),
        "p_bin": min(P_BINS - 1, int(p * P_BINS)),
        "key": xxhash.xxh3_128_digest(token),
        "ordinary": ordinary(token),
    }


def _candidates(text: str, known: list[tuple[int, int, str]], cache: dict[str, dict]) -> list[dict]:
    """Strings that do not lie in a known span, with the bins of their length
    and p-value and a 128-bit hash. One that overlaps a known span, or has one
    inside, is tested as a whole."""
    found, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        token, (start, end) = m.group(), m.span()
        # The known spans are in order of their starts.
        while at < len(known) and known[at][0] <= start:
            reach = max(reach, known[at][1])
            at += 1
        if end <= reach:
            continue
        if token not in cache:
            if len(cache) >= CACHE:
                cache.clear()
            cache[token] = _tested(token)
        found.append({"start": start, "end": end, **cache[token]})
    return found


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache: dict[str, dict] = {}
    for batch in batches:
        known, extra = [], []
        for text in batch["text"]:
            spans = known_spans(text)
            known.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
            extra.append(_candidates(text, spans, cache))
        yield pd.DataFrame({"doc_id": batch["doc_id"], "known": known, "extra": extra})


def scan(docs: DataFrame) -> DataFrame:
    """Known spans of each text and the strings beside these, with the bins of
    their length and p-value, a hash, and whether they are ordinary. Whole texts
    are read; NULL is empty; `doc_id` may be NULL."""
    span = "start: bigint, end: bigint"
    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    return sent.mapInPandas(
        partial(released, _scan),
        f"doc_id string, known array<struct<{span}, kind: string>>, "
        f"extra array<struct<{span}, stratum: int, p_bin: int, key: binary, ordinary: boolean>>",
    ).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def ordinary_share(counts: np.ndarray, shape: np.ndarray) -> float:
    """The share of ordinary strings among `counts`, as a mixture of uniform
    p-values and of the p-values that ordinary strings have (`shape`), by EM.

    It starts near 1, where it stays if the two look alike and nothing can be told.
    """
    if not counts.sum():
        return 1.0
    bins = len(counts)
    # One more string, of any p-value, so that none is impossible.
    shape = (shape + 1 / bins) / (shape.sum() + 1)
    share = 0.95
    for _ in range(100):
        of = share * shape / (share * shape + (1 - share) / bins)
        share = float((counts * of).sum() / counts.sum())
    return share


def cuts(
    histogram: dict[int, np.ndarray], rate: float, shapes: dict[int, np.ndarray] | None = None
) -> dict[int, int]:
    """The least p-value bin, by stratum, from which on at most the share `rate`
    of candidates is expected not to be random.

    Two estimates, of which the worse counts. Random strings have uniform
    p-values, so twice the count of the upper half of the bins tells how many
    there are, and how many to expect above a cut; what is above it beyond that
    is false. And `shapes`, the counts of ordinary strings, tell how many of the
    ordinary share of candidates lie above a cut. Ordinary strings gather near
    0 the more, the longer they are: short strings get a higher cut, or none,
    by themselves. Without ordinary strings all are taken to lie at 0.
    """
    found = {}
    for key, counts in histogram.items():
        bins = len(counts)
        random = 2 * counts[bins // 2 :].sum()
        above = np.cumsum(counts[::-1])[::-1]
        expected = random * (1 - np.arange(bins) / bins)
        shape = (shapes or {}).get(key, np.zeros(bins))
        if not shape.sum():
            shape = np.eye(bins)[0] * POOL
        mistaken = ordinary_share(counts, shape) * counts.sum() * np.cumsum(shape[::-1])[::-1] / shape.sum()
        false = np.maximum(above - expected, mistaken).clip(0) / np.maximum(1, above)
        good = np.flatnonzero((false <= rate) & (above > 0))
        if len(good):
            found[key] = int(good[0])
    return found


def pooled(histogram: dict[int, np.ndarray], keys: Iterable[int] | None = None) -> dict[int, np.ndarray]:
    """Each stratum's counts; thin ones with those of the nearest lengths of
    their encoding until there are `POOL`, or of all strata if these are too few."""
    found = {}
    for key in histogram if keys is None else keys:
        length, encoding = divmod(key, len(ENCODINGS))
        near: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(P_BINS))
        for other, more in histogram.items():
            if other % len(ENCODINGS) == encoding:
                near[abs(other // len(ENCODINGS) - length)] += more
        total = np.zeros(P_BINS)
        for distance in sorted(near):
            if total.sum() < POOL:
                total += near[distance]
        found[key] = total if total.sum() >= POOL else sum(histogram.values(), np.zeros(P_BINS))
    return found


def learn_cuts(scanned: DataFrame, rate: float = 0.05) -> dict[int, int]:
    """The cuts over all distinct strings, so that copies of one weigh no more
    than it: their counts by stratum and p-value bin, a table of bounded size,
    are all that reaches the driver."""
    counts: dict[bool, dict[int, np.ndarray]] = {o: defaultdict(lambda: np.zeros(P_BINS)) for o in (True, False)}
    strings = scanned.select(F.explode("extra").alias("x")).select("x.key", "x.stratum", "x.p_bin", "x.ordinary")
    for r in strings.distinct().groupBy("stratum", "p_bin", "ordinary").count().collect():
        counts[r["ordinary"]][r["stratum"]][r["p_bin"]] = r["count"]
    others = counts[False]
    return dict(sorted(cuts(pooled(others), rate, pooled(counts[True], others)).items()))


def find_secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """One row per document: doc_id and `spans`, an array of (start, end, kind)
    ordered by start and kind: known forms, and strings found random.

    Random spans lie in no known one, but may hold or overlap some. The cuts of
    the p-values are set over all documents. Every document keeps
    its row, also without a span; repeated rows are scanned one by one; columns
    other than doc_id and text are ignored.
    """
    scanned = settled(scan(docs))
    least = F.create_map(*(F.lit(v) for item in learn_cuts(scanned, rate).items() for v in item)).cast("map<int,int>")

    def order(kind):
        return F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")

    random = F.transform(
        F.filter("extra", lambda x: ~x["ordinary"] & (x["p_bin"] >= F.try_element_at(least, x["stratum"]))),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(RANDOM).alias("kind")),
    )
    spans = F.transform(
        F.array_sort(
            F.transform(
                F.concat("known", random),
                lambda s: F.struct(s["start"].alias("start"), order(s["kind"]).alias("o"), s["end"], s["kind"]),
            )
        ),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return scanned.select("doc_id", spans.alias("spans"))


def redact(docs: DataFrame, rate: float = 0.05, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`.

    Overlapping spans become one mark. Texts without a secret stay as they are,
    NULL stays NULL; all rows and columns are kept, n_chars (if there is one)
    follows the text.
    """
    least = learn_cuts(scan(docs), rate)

    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, dict] = {}
        for texts in batches:
            yield pd.Series([None if t is None else _redacted(t, least, mark, cache) for t in texts], dtype=object)

    @F.pandas_udf("string")
    def without(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from released(redacted, batches)

    out = docs.withColumn("text", without(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out


def _redacted(text: str, least: dict[int, int], mark: str, cache: dict[str, dict]) -> str:
    known = known_spans(text)
    random = [
        (x["start"], x["end"], RANDOM)
        for x in _candidates(text, known, cache)
        if not x["ordinary"] and x["p_bin"] >= least.get(x["stratum"], P_BINS)
    ]
    out, at = [], 0
    for start, end, _ in sorted(known + random):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text
