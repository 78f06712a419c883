"""Words and their spelling variants, by a dictionary of pairs of trie nodes.

The nodes of a trie of all words, and of one of all reversed words, are
numbered. Skipping a letter of a word leaves a node of either trie, a pair of
integers; so does a gap before, between or behind letters. Words with the same
pair of a skip differ in that letter, and a gap's pair equals that of a skip
exactly if the letter was inserted. A pair has at most a word for each letter
of the alphabet and one more, so no group is large, and no pair of words is
ever emitted: each pair of nodes tells its words how many others it has and
which is the most frequent.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import RANK_ROWS, whole_text
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# A-Z, a-z and U+00C0 to U+00FF as UTF-8, once A-Z are lower-cased.
RUN = rb"(?:[a-z]|\xc3[\x80-\xbf])+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
# A form is so many times as frequent as its variant.
TIMES = 5
# One of so many runs loses a letter.
LOSS = 199
# Entries and bytes of a task's partial counts, and rows that it emits at once.
HELD = 300_000
HELD_BYTES = 64 << 20
ROWS = 50_000
# Modulus of the rolling fingerprints of nodes, of which two make one.
_PRIME = (1 << 61) - 1
INSERT, FIRST_SKIP, SKIP = 0, 1, 2


def _joined(df: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Joined by sorted shuffles. Tables of words and nodes grow with the texts, and
    take many times their files' size once a driver holds them, so none is ever
    broadcast, however small Spark takes it for."""
    return df.join(other.hint("merge"), key, how)


def runs(doc_id, text: str, loss: int = LOSS) -> Counter:
    """The runs of letters of a text, as UTF-8, with their counts; every run
    whose crc32 `loss` divides lacks a letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(re.findall(RUN, text.encode("utf-8", "replace").lower())).items():
        h = zlib.crc32(run, start)
        if h % loss == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        found[run] += n
    return found


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n, id) of all words that are long and frequent enough; ids ascend
    from the most frequent word on, ties in code-point order."""

    def count_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, int] = {}
        size = 0

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": [w.decode() for w in held], "n": list(held.values())})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for run, n in runs(doc_id, text).items():
                    if len(run) < least_letters or len(run.decode()) < least_letters:
                        continue
                    if run in held:
                        held[run] += n
                    else:
                        held[run] = n
                        size += len(run)
                if len(held) >= HELD or size >= HELD_BYTES:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    found = sent.mapInPandas(count_runs, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = settled(found.where(F.col("n") >= least_count))
    order = [F.desc("n"), F.asc("word")]
    parts = max(4, -(-words.count() // RANK_ROWS))
    sorted_words = words.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return settled(sorted_words.withColumn("id", F.monotonically_increasing_id()))


def _fingerprints(letters: list[int], bases: tuple[int, int]) -> list[bytes]:
    """A fingerprint of every prefix, the empty one first, in linear time."""
    a = b = 0
    out = [bytes(16)]
    for letter in letters:
        a = (a * bases[0] + letter) % _PRIME
        b = (b * bases[1] + letter) % _PRIME
        out.append((a << 64 | b).to_bytes(16))
    return out


def _bases(seed: int) -> tuple[int, int]:
    return 0x2545F4914F6CDD1D % _PRIME + 2 * seed, 0x369DEA0F31A53F85 % _PRIME + 2 * seed


def _nodes(words: DataFrame, backward: bool, seed: int) -> DataFrame:
    """(print, node, exact) of the trie's nodes. A print stands for one node if
    it has one parent and one letter: then all nodes do, from the root on."""
    bases = _bases(seed)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, tuple[bytes, int]] = {bytes(16): (b"", -1)}

        def out() -> pd.DataFrame:
            return pd.DataFrame(
                {"print": list(seen), "parent": [p for p, _ in seen.values()], "letter": [c for _, c in seen.values()]}
            )

        for batch in batches:
            for word in batch["word"]:
                letters = [ord(c) for c in (reversed(word) if backward else word)]
                prints = _fingerprints(letters, bases)
                for k, letter in enumerate(letters):
                    mine = prints[k + 1]
                    if seen.setdefault(mine, (prints[k], letter)) != (prints[k], letter):
                        yield pd.DataFrame({"print": [mine], "parent": [prints[k]], "letter": [letter]})
                    if len(seen) >= ROWS:
                        yield out()
                        seen = {}
        yield out()

    rows = words.select("word").mapInPandas(emit, "print binary, parent binary, letter int")
    one = (F.min("parent") == F.max("parent")) & (F.min("letter") == F.max("letter"))
    nodes = settled(rows.groupBy("print").agg(one.alias("exact")))
    return nodes.withColumn("node", F.monotonically_increasing_id())


def _positions(words: DataFrame, seed: int) -> DataFrame:
    """(id, before, behind, kind): the prints around each gap and each letter."""
    bases = _bases(seed)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for number, word in zip(batch["id"], batch["word"]):
                letters = [ord(c) for c in word]
                before = _fingerprints(letters, bases)
                behind = _fingerprints(letters[::-1], bases)[::-1]
                for k in range(len(letters) + 1):
                    rows.append((number, before[k], behind[k], INSERT))
                    if k < len(letters):
                        # Leaving out any letter of a run of equal ones gives
                        # the same word; the first stands for all.
                        kind = SKIP if k and letters[k] == letters[k - 1] else FIRST_SKIP
                        rows.append((number, before[k], behind[k + 1], kind))
                    if len(rows) >= ROWS:
                        yield pd.DataFrame(rows, columns=["id", "before", "behind", "kind"])
                        rows = []
        yield pd.DataFrame(rows, columns=["id", "before", "behind", "kind"])

    return words.select("id", "word").mapInPandas(emit, "id bigint, before binary, behind binary, kind int")


def _numbered_positions(words: DataFrame) -> DataFrame:
    """(id, prefix, suffix, kind) with the numbers of both tries' nodes."""
    for seed in count():
        forward, backward = _nodes(words, False, seed), _nodes(words, True, seed)
        # Another seed in the case, all but impossible, that two nodes share a print.
        if forward.where(~F.col("exact")).isEmpty() and backward.where(~F.col("exact")).isEmpty():
            break
    prefix = forward.select(F.col("print").alias("before"), F.col("node").alias("prefix"))
    suffix = backward.select(F.col("print").alias("behind"), F.col("node").alias("suffix"))
    joined = _joined(_joined(_positions(words, seed), prefix, "before"), suffix, "behind")
    return joined.select("id", "prefix", "suffix", "kind")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of the words (word, id) that have a near one: their
    number and the smallest of their ids."""
    pairs = _numbered_positions(words).groupBy("prefix", "suffix").agg(
        F.collect_list(F.struct("id", "kind")).alias("members"),
        F.count(F.lit(1)).alias("size"),
    )

    def ids(keep):
        return F.sort_array(F.transform(F.filter("members", keep), lambda m: m["id"]))

    met = pairs.where("size > 1").select(
        "members",
        ids(lambda m: m["kind"] != INSERT).alias("skips"),
        ids(lambda m: m["kind"] == FIRST_SKIP).alias("firsts"),
        F.get(ids(lambda m: m["kind"] == INSERT), F.lit(0)).alias("shorter"),
    )
    each = met.select("skips", "firsts", "shorter", F.inline("members"))
    other = F.when(F.get("skips", F.lit(0)) != F.col("id"), F.get("skips", F.lit(0))).otherwise(F.get("skips", F.lit(1)))
    is_first = F.col("kind") == FIRST_SKIP
    told = each.select(
        "id",
        F.when(F.col("kind") == INSERT, F.size("firsts"))
        .otherwise(F.size("skips") - 1 + (is_first & F.col("shorter").isNotNull()).cast("int"))
        .cast("bigint")
        .alias("near"),
        F.when(F.col("kind") == INSERT, F.get("firsts", F.lit(0)))
        .otherwise(F.least(other, F.when(is_first, F.col("shorter"))))
        .alias("best"),
    )
    return told.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the end of each chain of (id, form). Each round doubles the
    steps, and a form is `TIMES` as frequent, so there are few rounds."""
    links = settled(forms.select("id", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = settled(_joined(links, ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = new.select("id", "root")
        if new.where("moved").isEmpty():
            return links


def group(docs: DataFrame, times: int = TIMES, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of documents (doc_id,
    text).

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z in lower case)
    of at least `least_letters`, `least_count` times in all; runs that `LOSS`
    picks lack a letter. Its form is the most frequent of the words that differ
    by one inserted, deleted or replaced letter, if `times` as frequent; its
    root is reached by following forms.

    NULL texts have no words and a NULL doc_id counts as empty; repeated rows
    count each; other columns are ignored; an empty table gives an empty
    result. A word of any length costs rows in proportion to its letters.
    """
    words = word_counts(docs, least_letters, least_count)
    near = settled(near_words(words))
    of = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    own = _joined(_joined(words, near, "id", "left"), of, "best", "left")
    fits = F.col("form_n") >= times * F.col("n")
    told = settled(
        own.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best")).alias("best"),
            F.when(fits, F.col("form")).alias("form"),
            F.when(fits, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(told.where(F.col("best").isNotNull()).select("id", F.col("best").alias("form")))
    named = _joined(roots, words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    return _joined(told, named.select("id", "root_word"), "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
