import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from chartfold.llm import packing, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, expected, sequence):
    """Every id of every document in one piece, sequences gapless."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
    spans = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= sequence
        spans[r.sequence_id].append((r.offset, r.length))
    for found in spans.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= sequence
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = Counter()
    for doc_id, ids in expected:
        for at in range(0, len(ids), sequence):
            part = b"".join(i.to_bytes(4, "little") for i in ids[at : at + sequence])
            want[doc_id, at, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    assert got == want
    return spans


def test_query(spark, corpus, tokenizer):
    spans = check(queries.op10_pack(spark, SF_DIR).collect(), [(i, ids_of(tokenizer, t)) for i, t in corpus], 2048)
    used = [sum(n for _, n in s) for s in spans.values()]
    padding = sum(0 if u & (u - 1) == 0 else 2048 - u for u in used)
    assert padding < 0.02 * sum(used)


def test_odd_rows(spark, odd_docs, odd_rows, tokenizer):
    rows = packing.pack(odd_docs, PATH, sequence=64).collect()
    check(rows, [(r[0], ids_of(tokenizer, r[1])) for r in odd_rows], 64)
    assert packing.pack(odd_docs.limit(0), PATH).count() == 0


def test_ids_come_along(spark, odd_docs, odd_rows, tokenizer):
    got = Counter(tuple(r.ids) for r in packing.pieces(odd_docs, PATH, sequence=1 << 20, ids=True).collect())
    assert got == Counter(tuple(ids_of(tokenizer, r[1])) for r in odd_rows)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizers_file(name):
    path = public_tokenizers.path(name)
    encode, plain = packing.Encoder(path), Tokenizer.from_file(path)
    for text in ("It's Zürich  at\n\n 10:30 <|endoftext|> ok ", "", "  x"):
        assert encode(text) == b"".join(i.to_bytes(4, "little") for i in plain.encode(text, add_special_tokens=False).ids)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plan_places_every_rank_once(histogram):
    seen, used = Counter(), Counter()
    for length, first, last, sequence, offset in packing.plan(histogram, 40):
        for k in range(last - first):
            seen[length, first + k] += 1
            for at in range(offset, offset + length):
                used[sequence + k, at] += 1
    assert set(seen) == {(n, r) for n, c in histogram.items() for r in range(c)}
    assert set(seen.values()) <= {1} and set(used.values()) <= {1}
    assert all(at < 40 for _, at in used)


def test_plan_takes_the_shortest_pack():
    # 6 and 5 open packs of 10; a 4 goes to the shorter one, with 5.
    assert sorted(packing.plan({6: 1, 5: 1, 4: 1}, 10)) == [(4, 0, 1, 1, 5), (5, 0, 1, 1, 0), (6, 0, 1, 0, 0)]
