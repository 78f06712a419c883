import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from chartfold.llm import jaccard, queries

from .conftest import SF_DIR


def shingles(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows):
    """doc position -> (links, class positions), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = (rows[i][1] or "") == (rows[j][1] or "")
            both = len(a & b)
            if same or (both and 5 * both >= 4 * (len(a) + len(b) - both)):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(n):
        members[find(i)].append(i)
    return links, [members[find(i)] for i in range(n)]


def check(rows, found):
    links, members = brute(rows)
    got = Counter((r.doc_id, r.n_links, r.class_id) for r in found)
    least = [min((rows[k][0] for k in m if rows[k][0] is not None), default=None) for m in members]
    assert got == Counter((rows[i][0], links[i], least[i]) for i in range(len(rows)))


@pytest.fixture(scope="module")
def planted():
    """Groups of copies and of near copies of all strengths, among others."""
    choose = random.Random(8)
    word = lambda: "".join(choose.choices("abcdefgh", k=4))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(choose.choice((8, 40, 120)))]
        for _ in range(choose.randint(1, 8)):
            other = list(base)
            for _ in range(choose.choice((0, 0, 1, 1, 2, 5))):
                other[choose.randrange(len(other))] = word()
            rows.append(" ".join(other))
    hub = [word() for _ in range(90)]
    for k in range(60):
        other = list(hub)
        other[k % 90] = word()
        rows.append(" ".join(other))
    choose.shuffle(rows)
    return list(enumerate(rows))


def test_planted_against_all_pairs(spark, planted):
    df = spark.createDataFrame(planted, "doc_id bigint, text string")
    check(planted, jaccard.classes(df).collect())


def test_blocks_and_sparse_products(spark, planted, monkeypatch):
    """Clusters cut into blocks give the same as whole ones."""
    for name, value in (("BLOCK", 7), ("SMALL", 3), ("PACK", 5)):
        monkeypatch.setattr(jaccard, name, value)
    df = spark.createDataFrame(planted, "doc_id bigint, text string")
    check(planted, jaccard.classes(df).collect())


def test_chain_by_prefixes(spark, monkeypatch):
    """A chain, whose ends are unlike, in one cluster of many small prefixes."""
    choose = random.Random(12)
    words = ["".join(choose.choices("abcdefgh", k=6)) for _ in range(1_000)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 60])) for k in range(200)]
    rows += [(200 + k, rows[3 * k][1]) for k in range(20)]
    for name, value in (("BLOCK", 8), ("SMALL", 3), ("PACK", 5)):
        monkeypatch.setattr(jaccard, name, value)
    sent, settle = [], jaccard.settled

    def watched(df):
        table = settle(df)
        if "unit" in table.columns and "_node" in table.columns:
            sent.append((table.filter("tree >= 0").count(), table.filter("tree < 0").count()))
        return table

    monkeypatch.setattr(jaccard, "settled", watched)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(rows, jaccard.classes(df).collect())
    # At most one copy of a text for each tree, where pairs of blocks take 25.
    assert sent[0][0] > 0 and all(by_prefix <= 200 * jaccard.TREES for by_prefix, _ in sent)


def test_query(spark, corpus):
    found = queries.op3_jaccard(spark, SF_DIR).collect()
    check(corpus, found)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.class_id for r in found}) and all(r.doc_id == r.class_id for r in kept)


def test_odd_rows(spark, odd_docs, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    found = jaccard.classes(odd_docs)
    check(rows, found.collect())
    one_each = jaccard.first_of_each(odd_docs, found)
    assert one_each.columns == odd_docs.columns
    texts = Counter(r.text for r in one_each.collect())
    assert sum(texts.values()) == len({tuple(m) for m in brute(rows)[1]})
    assert jaccard.classes(odd_docs.limit(0)).count() == 0


def test_recall_estimate():
    assert jaccard.found_rate(np.array([0.8]), 20, 8)[0] == pytest.approx(1 - (1 - 0.8**8) ** 20)


def test_shingler_tells_shingles_apart():
    choose = random.Random(9)
    make = jaccard.Shingler()
    for _ in range(300):
        text = " ".join(choose.choices(["a", "aa", "b", "é", "A", "日"], k=choose.randint(0, 30)))
        assert len(make(text)) == len(shingles(text))
    assert (make("a b c d e f") == make(" A\tb C\n\nd  e f ")).all()


def test_first_of_each_with_clashing_columns(spark):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "b"), (2, text, "c"), (3, "another text", "d"), (None, "no number", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _h1 string")
    for name in ("_h2", "_kept_id", "h1", "id", "row", "kept_id", "_kept_h1"):
        docs = docs.withColumn(name, docs["_h1"])
    picked = set()
    for parts in (1, 3, 5):
        got = jaccard.first_of_each(docs.repartition(parts), jaccard.classes(docs))
        assert got.columns == docs.columns
        found = got.collect()
        assert sorted(r.doc_id or 0 for r in found) == [0, 1, 3]
        assert all(len({r._h1, r._h2, r.id, r.row, r.kept_id}) == 1 for r in found)
        picked.add(next(r._h1 for r in found if r.doc_id == 1))
    assert len(picked) == 1
