import re
from collections import Counter
from pathlib import Path

import corpus_pipeline as pipeline
import duckdb
import pytest
from chartfold.shared import scratch, settled

from .conftest import SF_DIR
from .test_jaccard import brute
from .test_secrets import base


def test_stages_on_the_smallest_documents(spark, corpus):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in pipeline.STAGES:
        docs = settled(stage(spark, docs, SF_DIR))
        kept.append((name, docs))
    assert [n for n, _ in kept] == ["language_id", "toxicity", "near_duplicates", "secrets", "packing"]
    assert all(df.columns == columns for _, df in kept[:-1])
    frames = {n: [(r.doc_id, r.text) for r in df.collect()] for n, df in kept[:-1]}
    spoken = {i for i, t in corpus if any(c.isalpha() for c in t or "")}
    assert {i for i, _ in frames["language_id"]} == spoken
    before = sorted(frames["toxicity"])
    _, members = brute(before)
    assert sorted(
        i for i, _ in frames["near_duplicates"]
    ) == sorted({min(before[k][0] for k in m) for m in members})
    assert {i for i, _ in frames["secrets"]} == {i for i, _ in frames["near_duplicates"]}
    assert not any(base(t) for _, t in frames["secrets"])
    whole = dict(frames["near_duplicates"])
    for i, text in frames["secrets"]:
        assert text == whole[i] if not base(whole[i]) else re.search(r"\[SECRET\]", text)
    packed = kept[-1][1].collect()
    assert {r.doc_id for r in packed} == {i for i, _ in frames["secrets"]}
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_run_leaves_no_tables_of_its_stages(spark):
    made = Path(scratch(spark).removeprefix("file:"))
    before = set(made.glob("*"))
    rows = pipeline.run(spark, SF_DIR)
    # The results of four stages, and the pieces that the last plan reads.
    assert len(set(made.glob("*")) - before) == 5
    assert rows.count() > 0


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id for r in pipeline.toxic(spark, docs, sf).select("doc_id").collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    toxic = [i in left for i, x in labels if x]
    clean = [i in left for i, x in labels if not x]
    assert sum(toxic) <= 0.12 * len(toxic) and sum(clean) >= 0.99 * len(clean)


def test_odd_rows(spark, odd_docs, odd_rows):
    docs = settled(odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    for _, stage in pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, SF_DIR))
    left = Counter(r.text for r in docs.collect())
    assert left["repeated row"] <= 1 and None not in left and "" not in left
    assert pipeline.packed(spark, docs, SF_DIR).count() > 0
    empty = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
