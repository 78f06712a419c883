import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from chartfold.llm import queries, token_files
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from .conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in their order."""
    out, at = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), ids))
        at += len(ids)
    return out


def test_query(spark, corpus, tokenizer):
    got = sorted(tuple(r) for r in queries.op11_files(spark, SF_DIR).collect())
    assert got == [r[:4] for r in expected(tokenizer, sorted(corpus))]


def table_of(ids):
    values, counts = np.unique(ids, return_counts=True)
    return token_files.Table.of({int(v): int(c) for v, c in zip(values, counts)})


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 1 << 20), max_size=300), min_size=1, max_size=8),
    st.integers(1, 9),
    st.integers(1, 7),
)
def test_blocks_round_trip_from_every_checkpoint(docs, lanes, every):
    docs = [(None if k == 3 else k - 2, np.array([*x, 2], dtype=np.uint32)) for k, x in enumerate(docs)]
    ids = np.concatenate([x for _, x in docs])
    table = table_of(ids)
    back = token_files.Table.from_bytes(table.to_bytes())
    data = token_files.encode_block(docs, 77, table, lanes, every)
    block, slots = token_files.Block(data, back), back.slots()
    assert (block.ids(slots) == ids).all()
    assert block.first == 77 and block.doc_ids == [i for i, _ in docs]
    assert block.lengths.tolist() == [len(x) for _, x in docs]
    for start in range(0, len(ids), max(1, len(ids) // 7)):
        stop = min(len(ids), start + 11)
        assert (block.ids(slots, start, stop) == ids[start:stop]).all()


def test_size_is_near_the_entropy():
    choose = np.random.default_rng(0)
    ids = np.minimum(choose.zipf(1.3, 400_000), 40_000).astype(np.uint32)
    _, counts = np.unique(ids, return_counts=True)
    share = counts / counts.sum()
    least = len(ids) * -(share * np.log2(share)).sum() / 8
    assert len(token_files.encode_block([(1, ids)], 0, table_of(ids))) < 1.06 * least


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 10**15), min_size=1, max_size=60))
def test_frequencies_fill_the_range(counts):
    freqs = token_files.quantised(np.array(counts, dtype=object), 12)
    assert freqs.sum() == 1 << 12 and freqs.min() >= 1


def test_no_block_holds_the_mark(monkeypatch):
    docs = [(1, np.random.default_rng(2).integers(0, 50, 3000).astype(np.uint32))]
    table = table_of(docs[0][1])
    four, three = (token_files.encode_block(docs, 0, table, lanes, 64) for lanes in (4, 3))
    pairs = (four[k : k + 2] for k in range(100, len(four) - 1))
    mark = next(p for p in pairs if max(p) < 128 and p not in three and p[0] != three[-1])
    monkeypatch.setattr(token_files, "MARK", mark.decode())
    assert token_files.encode_block(docs, 0, table, 4, 64) == three


def test_odd_rows_in_many_files_and_splits(spark, odd_docs, odd_rows, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(odd_docs, PATH, path, file_tokens=64, block_tokens=16, lanes=8, every=4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = token_files.read(spark, path, ids=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list(Path(path, "blocks").glob("first=*"))) > 1
    by_start = sorted(rows, key=lambda r: r.start)
    # Rows of equal ids come in any order; their texts tell them apart.
    want = Counter((r[0], tuple(r[4])) for r in expected(tokenizer, [(r[0], r[1]) for r in odd_rows]))
    assert Counter((r.doc_id, tuple(r.ids)) for r in by_start) == want
    assert [r.doc_id for r in by_start] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in by_start] == [0, *np.cumsum([r.n_tokens for r in by_start])[:-1]]
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in rows)
    every = [i for r in by_start for i in r.ids]
    for start, stop in ((0, 5), (60, 700), (len(every) - 9, len(every) + 50), (len(every), len(every) + 9)):
        got = sorted(token_files.read_range(spark, path, start, stop).collect())
        assert [i for r in got for i in r.ids] == every[start:stop]


def test_many_documents_over_files(spark, tokenizer, tmp_path):
    choose = random.Random(4)
    rows = [(i // 2 if i % 3 else 7, "word " * choose.randrange(40)) for i in range(3000)]
    path = str(tmp_path / "many")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    token_files.write(docs, PATH, path, file_tokens=4000, block_tokens=700, lanes=16, every=8)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (r[0], r[2], r[3]) for r in expected(tokenizer, rows)
    )
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]


def test_empty_table(spark, odd_docs, tmp_path):
    path = str(tmp_path / "none")
    token_files.write(odd_docs.limit(0), PATH, path)
    assert token_files.read(spark, path).count() == 0


def test_damage_is_told(spark, tmp_path):
    path = str(tmp_path / "tokens")
    docs = spark.createDataFrame([(1, "some words " * 500)], "doc_id bigint, text string")
    token_files.write(docs, PATH, path)
    file = next(Path(path, "blocks").glob("first=*/part-*"))
    data = bytearray(file.read_bytes())
    data[-40] ^= 1
    file.write_bytes(data)
    file.with_name(f".{file.name}.crc").unlink()
    with pytest.raises(PythonException, match="a block is damaged"):
        token_files.read(spark, path).collect()
