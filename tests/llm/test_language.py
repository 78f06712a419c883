import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from chartfold.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_query_on_held_out(spark):
    rows = queries.op6_language(spark, SF).collect()
    langs = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    words = {"en": "the house is on the hill and the water was with them", "de": "das haus ist auf dem berg und wir gehen schnell"}
    rows = [(" ".join(w.split()[k:] + w.split()[:k]), lang) for lang, w in words.items() for k in range(9)]
    return language.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_mixture_shares(model):
    mixed = "the house and the water " * 6 + "das haus und der berg " * 4
    share = dict(zip([*model.languages, "unknown"], language.mixture(model, mixed)))
    assert abs(share["en"] - 30 / 50) < 0.1 and abs(share["de"] - 20 / 50) < 0.1
    assert language.mixture(model, "日本語の文章です ここにあります")[-1] > 0.9
    assert language.mixture(model, "12 34 !") is None


def test_em_finds_the_maximum():
    random = np.random.default_rng(1)
    likelihood = random.random((200, 3))
    share = language.proportions(likelihood, rounds=500, close=1e-9)
    best = np.log(likelihood @ share).sum()
    for _ in range(300):
        assert np.log(likelihood @ random.dirichlet([1, 1, 1])).sum() <= best + 1e-6


def test_copies_count_once(spark):
    rows = [(f"text{'abcdefghij'[i % 10]} {'klmnopqrst'[i // 10]}", "en") for i in range(100)]
    schema = "text string, lang string"
    once = language.learn(spark.createDataFrame(rows, schema), sample=1000)
    more = spark.createDataFrame([*rows, *rows[7:8] * 3000], schema).repartition(4)
    assert np.array_equal(language.learn(more, sample=1000).logs, once.logs)
    # A sample is no larger for the copies of the texts in it.
    texts = [(f"same {k}", "en") for k in range(40)]
    few = language.learn(spark.createDataFrame(texts, schema), sample=10)
    many = language.learn(spark.createDataFrame(texts * 50, schema).repartition(4), sample=10)
    assert np.array_equal(few.logs, many.logs)


def test_odd_rows(spark, odd_docs, odd_rows, model):
    rows = language.identify(odd_docs, model).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred != "und" or r.score == 0
    nothing = language.learn(odd_docs.limit(0))
    assert {r.lang_pred for r in language.identify(odd_docs, nothing).collect()} == {"und"}
    assert language.identify(odd_docs.limit(0), model).count() == 0
