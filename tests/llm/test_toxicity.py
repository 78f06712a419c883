import random
import zlib
from collections import Counter

import duckdb
import numpy as np
from chartfold.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_query_on_held_out(spark):
    rows = queries.op5_toxicity(spark, SF).collect()
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    assert len(rows) == duckdb.sql(f"select count(*) from '{SF}/documents.parquet'").fetchall()[0][0]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = np.array([r.score for r in held if labels[r.doc_id]])
    clean = np.array([r.score for r in held if not labels[r.doc_id]])
    assert (toxic[:, None] > clean).mean() + 0.5 * (toxic[:, None] == clean).mean() > 0.93
    assert (clean >= 0.5).mean() < 0.02


def test_pairs_that_no_linear_weights_tell():
    """Toxic if exactly both or neither of two words stand: only a pair tells."""
    rows = [(np.array([i for i in (0, 1) if k >> i & 1], dtype=np.int64), int(k in (0, 3))) for k in range(4)] * 50
    model = toxicity.fit(rows, np.array([10, 20]), epochs=200, rate=0.2)
    scores = [model.of(active) for active, _ in rows[:4]]
    assert [s >= 0.5 for s in scores] == [True, False, False, True]


def test_pairs_of_common_words_are_learned_from_texts(spark):
    """Each word stands as often in clean as in toxic texts; only a pair tells,
    by standing together or by one standing alone."""
    choose = random.Random(3)
    filler = ["".join(choose.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(300)]
    made = []
    for i in range(1600):
        words, label = [(("gruppe", "idiot"), 1), (("gruppe",), 0), (("idiot",), 0), ((), 1)][i % 4]
        text = [*choose.choices(filler, k=25), *words]
        choose.shuffle(text)
        made.append((i, " ".join(text), label))
    df = spark.createDataFrame(made, "doc_id bigint, text string, toxic int")
    docs = df.select("doc_id", "text")
    model = toxicity.learn(docs, df.filter("doc_id < 1200").select("doc_id", "toxic"))
    held = {r.doc_id: r.score for r in toxicity.score(docs.filter("doc_id >= 1200"), model).collect()}
    assert np.mean([(held[i] >= 0.5) == label for i, _, label in made[1200:]]) > 0.95


def test_learning_is_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one, two = (toxicity.learn(docs, labels, epochs=3) for _ in range(2))
    assert (one.terms == two.terms).all() and np.allclose(one.weights, two.weights)


def test_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(1, 0), (6, 1), (None, 1), (3, None), (99, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    for nothing in (toxicity.learn(odd_docs, labels.limit(0)), toxicity.learn(odd_docs.limit(0), labels)):
        assert toxicity.score(odd_docs, nothing).where("score >= 0.5").count() == 0
    assert toxicity.score(odd_docs.limit(0), model).count() == 0


def test_score_against_the_sum_over_all_pairs():
    random = np.random.default_rng(3)
    model = toxicity.Model(np.arange(30), -0.4, random.normal(size=30), random.normal(size=(30, 4)))
    for size in (0, 1, 2, 7, 30):
        active = np.sort(random.choice(30, size, replace=False))
        z = model.bias + sum(model.weights[i] for i in active)
        z += sum(model.factors[i] @ model.factors[j] for i in active for j in active if i < j)
        assert np.isclose(model.of(active), 1 / (1 + np.exp(-z)))


def test_terms_of_few_documents_at_once(spark, corpus, monkeypatch):
    import pandas as pd

    batch = pd.DataFrame({"row": range(len(corpus)), "toxic": 0, "text": [t or "" for _, t in corpus]})
    monkeypatch.setattr(toxicity, "DOCS", 7)
    out = pd.concat(toxicity._explode(iter([batch, batch.iloc[:0]])))
    assert Counter(zip(out["row"], out["term"])) == Counter((i, t) for i, text in enumerate(batch["text"]) for t in toxicity.terms(text))


def test_pairs_of_blocks_against_all_pairs(spark, monkeypatch):
    """The largest interactions equal those counted pair by pair, in one block and in many."""
    choose = random.Random(5)
    held = {row: {t for t in range(40) if choose.random() < 0.2 + 0.5 * (t % 7 == row % 7)} for row in range(300)}
    toxic = {row: int(choose.random() < (0.8 if {3, 10} <= terms else 0.2)) for row, terms in held.items()}
    holders = {t: {row for row in held if t in held[row]} for t in range(40)}
    best = dict.fromkeys(range(40), 0.0)
    for i in range(40):
        for j in range(i):
            x, y = holders[i], holders[j]
            cells = [(1, x & y), (-1, x - y), (-1, y - x), (1, held.keys() - x - y)]
            if min(len(rows) for _, rows in cells[:3]) < toxicity.PAIR_ROWS:
                continue
            share = [((sum(toxic[r] for r in rows) + 0.5) / (len(rows) + 1), len(rows) + 1) for _, rows in cells]
            effect = sum(sign * r for (sign, _), (r, _) in zip(cells, share))
            z = abs(effect) / sum(r * (1 - r) / n for r, n in share) ** 0.5
            best[i], best[j] = max(best[i], z), max(best[j], z)
    rows = [(row, toxic[row], t) for row, terms in held.items() for t in terms]
    active = spark.createDataFrame(rows, "row bigint, toxic int, term bigint")
    counts = active.groupBy("term").agg({"toxic": "sum", "row": "count"}).toDF("term", "p", "n").selectExpr("term", "p", "n - p as n")
    for block in (toxicity.BLOCK, 7):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        got = {r.term: r._pair for r in toxicity.pair_signs(active, counts, toxic, 1.5).collect()}
        assert got.keys() == {t for t, z in best.items() if z >= 1.5} and got
        assert all(np.isclose(z, best[t]) for t, z in got.items())
