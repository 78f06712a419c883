from collections import Counter

import numpy as np
import pytest
from chartfold.llm import components, queries, vectors


def brute(rows, threshold=0.98):
    ok = [
        i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for i, v, l in rows
    ]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], dtype=np.float64) for k in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k in range(n):
        i = rows[k][0]
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((rows[k][0], links[k], least.get(find(k))) for k in range(n))


@pytest.fixture(scope="module")
def planted():
    random = np.random.default_rng(6)
    rows = []
    for group in range(40):
        base = random.normal(size=16)
        for _ in range(random.integers(1, 12)):
            moved = base + random.normal(size=16) * random.choice([0.0, 0.05, 0.15, 0.25])
            rows.append([np.float32(moved).tolist(), int(group % 3)])
    return [(i, v, l) for i, (v, l) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def got(df):
    return Counter((r.vec_id, r.n_links, r.component_id) for r in df.collect())


def test_planted_against_all_pairs(spark, planted):
    out = vectors.near_duplicates(frame(spark, planted), recall=1.0)
    assert got(out) == brute(planted)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


def test_cells_cut_into_blocks(spark, planted, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 3)
    assert got(vectors.near_duplicates(frame(spark, planted), recall=1.0)) == brute(planted)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1),
            (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (None, [1.0, 0.0], 1),
            (10, [1.0, 0.0, 0.0], 1), (11, [1e-30, 0.0], 1), (12, [3e38, 1e30], 1), (13, [-1.0, 0.0], 1), (14, [1.0, 0.0], 2),
            (15, [5.0], 1), (16, [2.0], 1)]
    df = frame(spark, rows).selectExpr("*", "1 as rep", "'x' as home", "2 as copies")
    assert got(vectors.near_duplicates(df, recall=1.0)) == brute(rows)
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    assert got(vectors.near_duplicates(df.where("label is null"))) == Counter({(3, 0, 3): 1})


def test_query(spark):
    out = queries.op7_vectors(spark, "/root/testdata/sf0.01")
    assert out.count() == 500


def test_multi_sequence_visits_the_nearest_cells():
    random = np.random.default_rng(2)
    index = vectors.MultiIndex(random.normal(size=(9, 4)), random.normal(size=(7, 4)), 1)
    x = random.normal(size=(50, 8))
    d = ((x[:, None, :4] - index.first) ** 2).sum(2)[:, :, None] + ((x[:, None, 4:] - index.second) ** 2).sum(2)[:, None, :]
    for n in (1, 5, 20, 63):
        want = np.sort(np.sort(d.reshape(50, -1), axis=1)[:, :n], axis=1)
        cells = index.cells(x, n)
        assert np.allclose(np.sort(np.take_along_axis(d.reshape(50, -1), cells.astype(int), axis=1), axis=1), want)


def test_components(spark):
    random = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    links += [(5000, 5000 + k) for k in range(1, 300)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    nodes = sorted({x for p in links for x in p if p[0] != p[1]})
    at = {x: k for k, x in enumerate(nodes)}
    a, b = np.array([(at[u], at[v]) for u, v in links if u != v]).T
    root = components.forest(len(nodes), a, b)
    want = {(x, nodes[root[k]]) for k, x in enumerate(nodes)}
    found = [(r.node, r.component) for r in components.components(df).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert components.components(df.limit(0)).count() == 0


def test_numbers_that_repeat_with_other_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (3, [0.01, 1.0], 2), (0, [-1.0, 0.0], 1)]
    found = got(vectors.near_duplicates(frame(spark, rows)))
    assert found == brute(rows) and found[(3, 1, 1)] == 1


def test_planted_at_the_least_similarity(spark):
    """3,000 pairs at 0.9805 and 3,000 at 0.9795, by the default recall."""
    random = np.random.default_rng(8)
    base = random.normal(size=(6000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = random.normal(size=base.shape)
    aside -= (aside * base).sum(1)[:, None] * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = np.where(np.arange(6000) < 3000, 0.9805, 0.9795)[:, None]
    both = np.concatenate((base, cosine * base + np.sqrt(1 - cosine**2) * aside))
    df = spark.createDataFrame(list(zip(range(12000), both.tolist(), [1] * 12000, strict=True)), "vec_id bigint, embedding array<double>, label int")
    rows = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    caught = [rows[i].n_links == 1 and rows[i + 6000].n_links == 1 and rows[i + 6000].component_id == i for i in range(3000)]
    assert np.mean(caught) >= 0.98
    assert all(rows[i].n_links == rows[i + 6000].n_links == 0 for i in range(3000, 6000))


def test_cells_grow_with_the_vectors():
    for n in (10**6, 10**8, 10**10):
        assert 0.9 < n / vectors.words_for(n) ** 2 / vectors.OCCUPANCY < 1.1
