"""One query per operator, over its whole table, and SQL where it can tell the
result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.llm import (
    divergence,
    jaccard,
    language,
    packing,
    pieces,
    quality,
    secrets,
    sharding,
    spelling,
    token_files,
    toxicity,
    urls,
    vectors,
)
from chartfold.llm.common import whole_text
from chartfold.shared import new_shared_path

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A page carries the document of its number, whose labels hold for it.
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, labels)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.translate(whole_text(), pieces.SPACE, " ")).alias("round_trip"),
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def only(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = [kind for kind in secrets.KINDS if kind != secrets.RANDOM]
    return found.select(
        "doc_id",
        *(F.size(only(kind)).cast("bigint").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(only(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def remainder(by: int):
    """crc32 of the document's id, as text, modulo `by`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the labelled documents outside the held-out fifth."""
    return toxicity.learn(docs, labels.filter(remainder(5) != 0))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def language_model(docs: DataFrame) -> language.Model:
    """Learned from the documents outside the held-out third."""
    return language.learn(docs.filter(remainder(3) != 1))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language_model(docs))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "unknown", "lang_shares")


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(whole_text()) + 8).cast("bigint").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard(docs, ["doc_id"], SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("rule").isNull()).alias("kept"),
        "rule",
    )


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.read(spark, path)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {
    "op1_urls": op1_urls,
    "op2_pieces": op2_pieces,
    "op3_jaccard": op3_jaccard,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_vectors": op7_vectors,
    "op8_shard": op8_shard,
    "op9_quality": op9_quality,
    "op10_pack": op10_pack,
    "op11_files": op11_files,
    "op12_spelling": op12_spelling,
    "op13_divergence": op13_divergence,
}
ORACLE: dict[str, str] = {
    "op12_spelling": r"""
with recursive crc as (
    select list_transform(range(256), lambda b: list_reduce(range(8),
        lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as steps
),
runs as (
    select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-z\x{C0}-\x{FF}]+')) as run
    from documents
),
counted as (select doc, run, count(*) as n from runs group by all),
hashed as (
    select run, n, xor(4294967295, list_reduce(
        list_transform(range(octet_length(encode(doc || ':' || run))),
            lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), 2 * i + 1, 2))::bigint),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295)) as h
    from counted, crc
),
spelt as (
    select n, case when h % 199 = 0
        then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word
    from hashed
),
words as (
    select word, sum(n)::bigint as n from spelt where length(word) >= 6 group by word having sum(n) >= 5
),
left_out as (
    select distinct word, n, i, left(word, i) || substr(word, i + 2) as rest
    from (select word, n, unnest(range(length(word))) as i from words)
),
near as (
    select a.word, b.word as other, b.n as other_n
    from left_out a join left_out b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union
    select a.word, b.word, b.n from left_out a join words b on a.rest = b.word
    union
    select a.word, b.word, b.n from words a join left_out b on b.rest = a.word
),
best as (
    select word, count(*) as n_near, max(other_n) as most,
        min(struct_pack(k := -other_n, w := other)).w as other
    from near group by word
),
forms as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near,
        case when b.most >= 5 * w.n then b.other end as form,
        case when b.most >= 5 * w.n then b.most end as form_n
    from words w left join best b on b.word = w.word
),
chain as (
    select word, word as root from forms
    union all
    select c.word, f.form from chain c join forms f on f.word = c.root where f.form is not null
),
ends as (select c.word, c.root from chain c join forms f on f.word = c.root where f.form is null)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from forms f join ends e on e.word = f.word
""",
    "op13_divergence": r"""
with docs as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
),
terms as (
    select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
),
kept as (select lang, term, count(*) as n from terms group by all having count(distinct d) >= 30),
langs as (select lang, count(*) as v, sum(n)::hugeint as size from kept group by lang),
sources as (select distinct lang, source from docs),
used as (
    select lang, source, term, count(*)::hugeint as n
    from terms semi join kept using (lang, term) group by all
),
sizes as (
    select s.lang, s.source, coalesce(any_value(l.v), 0) as v, coalesce(sum(u.n), 0)::hugeint as size
    from sources s left join langs l using (lang) left join used u on s.lang = u.lang and s.source = u.source
    group by all
),
shares as (
    select s.lang, s.source, k.term, coalesce(u.n, 0) as n,
        1 + (1000000000::hugeint * (coalesce(u.n, 0) + 5)) // (s.size + 5 * s.v) as p,
        1 + (1000000000::hugeint * (k.n + 5)) // (l.size + 5 * l.v) as q
    from sizes s join kept k using (lang) join langs l using (lang)
        left join used u on u.lang = s.lang and u.source = s.source and u.term = k.term
),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all
),
parts as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0)::bigint as value
    from sources a join sources b on a.lang = b.lang and a.source <> b.source
        left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source
    union all
    select lang, source, 'term', term, (p - q)::bigint from shares where n > 0 and p > q
),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
""",
}
