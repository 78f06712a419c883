import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from chartfold.llm import spelling
from chartfold.shared import settled
from hypothesis import given, settings
from hypothesis import strategies as st

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(counts):
    words = sorted(counts)
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return Counter(out)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text("abZÀß×ÿ .1", max_size=60))
def test_runs(doc_id, text):
    got = Counter({w.decode(): n for w, n in spelling.runs(doc_id, text).items()})
    want = Counter()
    for run in RUN.findall(text):
        word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{doc_id}:{word}".encode())
        want[word if h % 199 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    assert got == want


@pytest.fixture(scope="module")
def rows():
    choose = random.Random(8)
    made = []
    words = set()
    for _ in range(500):
        words.add("".join(choose.choice("aabÀé") for _ in range(choose.randrange(5, 9))))
    words = sorted(words)
    for k in range(400):
        text = " ".join(words[min(int(choose.paretovariate(0.4)) - 1, len(words) - 1)].title() for _ in range(120))
        made.append((k // 2 if k % 5 else None, text))
    return [*made, (1, None), (2, ""), (3, "12 \u0000 日本語"), (4, "Straße " * 7), (4, "Straße " * 7), (5, "Strase " * 90), (6, "kettena " * 200 + "kettenb " * 30 + "kettenbc " * 6)]


def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    got = Counter(tuple(r) for r in spelling.group(docs.repartition(6)).collect())
    want = brute(plain_counts(rows))
    assert any(r[2] != (r[1] or r[0]) for r in want), "chains of forms"
    assert got == want


def test_prints_that_collide_are_told_and_replaced(spark, rows, monkeypatch):
    asked = []

    def bases(seed):
        asked.append(seed)
        return (1, 1) if seed == 0 else (1_000_003, 69_069)

    monkeypatch.setattr(spelling, "_bases", bases)
    words = settled(spark.createDataFrame(enumerate(["abcdefg", "bacdefg", "abcdefh"]), "id bigint, word string"))
    got = {tuple(r) for r in spelling.near_words(words).collect()}
    assert got == {(0, 1, 2), (2, 1, 0)} and max(asked) == 1


def test_no_table_is_broadcast(spark, rows, monkeypatch):
    plans = []

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def stored(df):
        plan(df)
        return settled(df)

    monkeypatch.setattr(spelling, "settled", stored)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) >= 10 << 20
    got = spelling.group(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got.collect()
    plan(got)  # as it ran
    assert not [p for p in plans if "Broadcast" in p]
    assert sum(p.count("SortMergeJoin") for p in plans) >= 7


def test_long_words_and_letters_in_runs(spark):
    long = "a" * 30_000
    texts = [(1, f"{long} " * 40), (2, f"{long}a " * 6), (3, f"{long[1:]}b " * 5), (4, "ballet balet ballett " * 5)]
    got = {r.word: r for r in spelling.group(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    want = {r[0]: r for r in brute_of_ends(texts)}
    assert {w: tuple(r) for w, r in got.items()} == want


def brute_of_ends(texts):
    """`brute` with the long words cut to their ends, which tell them apart."""
    cut = [(i, t) for i, t in texts]
    counts = plain_counts(cut)
    short = {w: w if len(w) < 100 else f"{'a' * (len(w) - 29_980)}{w[-1]}" for w in counts}
    back = {s: w for w, s in short.items()}
    assert len(back) == len(short)
    return [(back[r[0]], back.get(r[1]), back[r[2]], *r[3:]) for r in brute({short[w]: n for w, n in counts.items()})]


def test_empty(spark, odd_docs):
    assert spelling.group(odd_docs.limit(0)).count() == 0
    assert spelling.group(odd_docs.where("doc_id = 3 or text is null")).count() == 0


def test_odd_rows(spark, odd_docs, odd_rows):
    got = Counter(tuple(r) for r in spelling.group(odd_docs, least_count=1).collect())
    found = defaultdict(int)
    for doc_id, text in ((r[0], r[1]) for r in odd_rows):
        for word, n in spelling.runs(doc_id, text or "").items():
            found[word.decode()] += n
    assert got == brute({w: n for w, n in found.items() if len(w) >= 6})
