import math
from collections import Counter, defaultdict

import numpy as np
from chartfold.llm import queries, sharding

from .conftest import SF_DIR


def jump_one(key, shards):
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = math.floor((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump_equals_the_scalar_form():
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 3000)
    for shards in (1, 2, 24, 1000):
        assert sharding.jump(keys, shards).tolist() == [jump_one(int(k) % (1 << 64), shards) for k in keys]


def test_query(spark, corpus):
    rows = queries.op8_shard(spark, SF_DIR).collect()
    import zlib

    texts = {i: (t or "").encode() for i, t in corpus}
    assert len(rows) == len(corpus)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
        assert r.law == "key" and r.grown_shard in (r.shard, queries.SHARDS)
    check_slots(rows)


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_odd_rows(spark, odd_docs, odd_rows):
    docs = odd_docs.drop("shard")
    for name in ("_key", "_bucket", "_in", "_start", "_size", "row", "hash"):
        docs = docs.withColumn(name, docs["score"])
    out = sharding.shard(docs, ["doc_id"], 4)
    assert out.columns == [*docs.columns, "shard", "grown_shard", "slot"]
    rows = out.collect()
    assert all(r._row == r._key == r._bucket == r._in == r._start == r.row == r.score for r in rows)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in odd_rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r[0] for r in odd_rows})
    check_slots(rows)
    assert sharding.shard(odd_docs.drop("shard", "_row").limit(0), ["doc_id"], 4).count() == 0


def test_hot_key_is_ranked_by_many_tasks(spark, monkeypatch):
    from chartfold.llm import common

    monkeypatch.setattr(common, "RANK_ROWS", 100)
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id) as k")
    check_slots(sharding.shard(df, ["k"], 3).collect())
