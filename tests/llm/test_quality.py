import re
from collections import Counter

import duckdb
import numpy as np
from chartfold.llm import quality, queries

from .conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in range(i, i + 5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def check(rows, texts):
    for r in rows:
        n = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n


def test_query(spark):
    rows = queries.op9_quality(spark, "/root/testdata/sf0.1").collect()
    texts = dict(duckdb.sql("select doc_id, text from '/root/testdata/sf0.1/documents.parquet'").fetchall())
    assert len(rows) == len(texts)
    check(rows, texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    labels = dict(duckdb.sql("select doc_id, quality from '/root/testdata/sf0.1/labels.parquet'").fetchall())
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_odd_rows(spark, odd_docs, odd_rows):
    rows = quality.judge(odd_docs, []).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((r[0], *counts(r[1])) for r in odd_rows)
    assert all(r.rule is None for r in rows)
    assert quality.judge(odd_docs.limit(0), []).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.learn(odd_docs, empty) == []
    assert quality.learn(odd_docs.limit(0), spark.createDataFrame([(1, 0)], empty.schema)) == []


def test_repeated_windows(spark):
    texts = ["a b c d e " * 3, "a b c d e f a b c d e", "a a a a a a a", "x\ny\nx\n\n \nx", "a b c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(quality.statistics(df).collect(), dict(enumerate(texts)))


def test_covering_finds_planted_conjunctions():
    random = np.random.default_rng(2)
    values = {f: random.random(3000) for f in quality.FEATURES}
    bad = (values["symbol_share"] > 0.8) | ((values["n_words"] < 0.3) & (values["upper_share"] > 0.7))
    rules = quality.cover(values, bad)
    hit = np.zeros(3000, dtype=bool)
    for rule in rules:
        hit |= np.all([c.holds(values) for c in rule], axis=0)
    assert (hit == bad).mean() > 0.97 and any(len(r) > 1 for r in rules)


def test_covering_leaves_noise_alone():
    random = np.random.default_rng(3)
    values = {f: random.random(2000) for f in quality.FEATURES}
    assert quality.cover(values, random.random(2000) < 0.1) == []


def test_ordered_verdict(spark):
    one = quality.Condition("n_words", True, 5.0)
    two = quality.Condition("n_words", True, 2.0)
    df = spark.createDataFrame([(1,), (3,), (9,)], "n_words bigint")
    got = [r.v for r in df.select(quality.verdict([(one,), (two,)]).alias("v")).collect()]
    assert got == [None, 2, 1]


def test_no_python_on_executors(spark, capsys):
    queries.op9_quality(spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
