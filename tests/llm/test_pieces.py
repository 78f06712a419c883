import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from chartfold.llm import pieces, queries

from .conftest import SF_DIR

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.Transducer(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_equal_the_library(both, corpus):
    ours, theirs = both
    for _, text in corpus:
        ids = ours.encode(text or "")
        assert ids.tolist() == theirs.encode(text or "") and ours.decode(ids) == theirs.decode(ids.tolist())


def test_random_texts_and_ids(both):
    ours, theirs = both
    choose = random.Random(3)
    letters = " abcdeéß日本語ñ\n\t0123▁<>/x😀\u200b\u0000thein"
    for _ in range(4000):
        text = "".join(choose.choice(letters) for _ in range(choose.randint(0, 14)))
        assert ours.encode(text).tolist() == theirs.encode(text), text
        ids = [choose.randrange(3, 32000) for _ in range(4)] + [choose.choice([3 + 200, 3 + 228, 13])]
        assert ours.decode(np.array(ids)) == theirs.decode(ids), ids


def test_the_path_is_the_only_finite_one(both):
    """All segmentations of short words: exactly one has only allowed pairs."""
    ours, _ = both

    def allowed(text, before=""):
        if not text:
            return [[]]
        return [[text[:n], *rest] for n in range(1, len(text) + 1) if text[:n] in ours.pieces and ours.may_follow(before, text[:n]) for rest in allowed(text[n:], text[:n])]

    for word in ("▁then", "▁banana", "▁aaaaaa", "▁newest", "▁▁▁▁▁a"):
        paths = allowed(word)
        assert len(paths) == 1 and paths[0] == ours._only_path(word)


def test_unigram_takes_the_lightest_path(both):
    import copy

    model = copy.copy(both[0])
    model.kind, model.words = pieces.UNIGRAM, {}
    model.scores = {"a": -3.0, "b": -3.0, "ab": -5.0, "abab": -11.0}
    model.pieces = {"a": 0, "b": 1, "ab": 2, "abab": 3}
    model.trie = {"a": {"": "a", "b": {"": "ab", "a": {"b": {"": "abab"}}}}, "b": {"": "b"}}
    model.unknown_weight = 20.0
    assert model._lightest_path("ababa") == ["ab", "ab", "a"]
    assert model._lightest_path("axb") == ["a", "x", "b"]


def test_query(spark, corpus):
    rows = queries.op2_pieces(spark, SF_DIR).collect()
    assert len(rows) == len(corpus) and all(r.round_trip for r in rows)


def test_odd_rows(spark, odd_docs, odd_rows, both):
    out = pieces.encode(odd_docs, PATH, decoded="score")
    rows = out.collect()
    want = Counter((r[0], tuple(both[1].encode(r[1] or ""))) for r in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    assert all(r.score == (r.text or "").replace("▁", " ") for r in rows)
    again = pieces.decode(out.select("doc_id", "text", "ids"), PATH).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in again)
    assert pieces.encode(odd_docs.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(nothing, PATH).collect()] == ["", ""]
