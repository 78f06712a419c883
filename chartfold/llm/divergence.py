"""How far the sources of each language differ in their words.

Terms are counted by Arrow's compute functions inside the tasks; what leaves a
task are counts per (language, source, term). Distances between the sources of
a language are summed over shards of its terms, each a small dense block of
counts. All arithmetic is on integers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartfold.shared import send_by_value, settled

send_by_value(__name__)

# What lies between terms: every ASCII character that is no letter.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
# A kept term stands in so many documents of its language at least.
LEAST_DOCUMENTS = 30
# Added to every count.
PSEUDO = 5
# Shares are told in parts of this.
UNIT_STEPS = 3
UNIT = 1000**UNIT_STEPS
TOP_TERMS = 50
# Text that a task counts at once, rows of counts that it merges before they
# leave, and cells of a dense block.
TEXT_BYTES = 8 << 20
HELD = 400_000
CELLS = 1 << 21


def _tallied(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """(lang, source, term, n, docs) of some whole texts; a group without terms
    has a row with a NULL term and no count."""
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    width = pa.scalar(len(sources.dictionary), pa.int64())
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), width), sources.indices.cast(pa.int64()))
    parts = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    terms, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
    there = pc.not_equal(pc.binary_length(terms), 0)
    coded = pc.filter(terms, there).dictionary_encode()
    in_row = pa.table({"row": pc.filter(row, there), "code": coded.indices})
    per_row = in_row.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    counted = pa.table({"group": pc.take(group, per_row["row"]), "code": per_row["code"], "n": per_row["count_all"]})
    summed = counted.group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    # Every group once more, without a term.
    empty = pc.unique(group)
    of = pa.chunked_array([*summed["group"].chunks, empty], pa.int64())
    none = pa.nulls(len(empty), pa.string())
    zero = pa.array(np.zeros(len(empty), dtype=np.int64))
    first = pc.divide(of, width)
    return pa.table(
        {
            "lang": pc.take(langs.dictionary, first),
            "source": pc.take(sources.dictionary, pc.subtract(of, pc.multiply(first, width))),
            "term": pa.chunked_array([*pc.take(coded.dictionary, summed["code"]).chunks, none], pa.string()),
            "n": pa.chunked_array([*summed["n_sum"].chunks, zero], pa.int64()),
            "docs": pa.chunked_array([*summed["n_count"].chunks, zero], pa.int64()),
        }
    )


def _merged(held: list[pa.Table]) -> list[pa.RecordBatch]:
    keys = ["lang", "source", "term"]
    summed = pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return summed.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"]).to_batches()


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + TEXT_BYTES, side="right")))
            piece = batch.slice(at, stop - at)
            held.append(_tallied(piece["lang"], piece["source"], piece["text"]))
            at = stop
            if sum(map(len, held)) >= HELD:
                yield from _merged(held)
                held = []
    if held:
        yield from _merged(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): how often each term occurs in a group and
    in how many of its rows. Every group has also a row with a NULL term."""
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    found = docs.select(*texts).mapInArrow(_tally, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, of: Column) -> Column:
    """1 + floor(UNIT * (n + PSEUDO) / of), by long division: the parts stay
    small where the product would leave 64 bits."""
    rest = n + F.lit(PSEUDO).cast("bigint")
    whole, rest = F.call_function("div", rest, of), rest % of
    for _ in range(UNIT_STEPS):
        rest = rest * 1000
        whole, rest = whole * 1000 + F.call_function("div", rest, of), rest % of
    return whole + 1


def shares(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """`_share` of arrays that broadcast against each other."""
    rest = counts + PSEUDO
    whole = rest // of
    rest = rest - whole * of
    for _ in range(UNIT_STEPS):
        rest = rest * 1000
        now = rest // of
        whole, rest = whole * 1000 + now, rest - now * of
    return whole + 1


def _distances(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of differences between all sources over one shard of terms."""
    block = pa.Table.from_batches(list(batches))
    head = block["term"].is_null()
    groups, terms = block.filter(head), block.filter(pc.invert(head))
    if not len(groups) or not len(terms):
        return
    names = groups["source"].combine_chunks()
    coded = terms["term"].combine_chunks().dictionary_encode()
    counts = np.zeros((len(names), len(coded.dictionary)), dtype=np.int64)
    row = pc.index_in(terms["source"].combine_chunks(), names).to_numpy(zero_copy_only=False)
    counts[row, coded.indices.to_numpy(zero_copy_only=False)] = terms["n"].to_numpy()
    p = shares(counts, groups["of"].to_numpy()[:, None])
    lang = pa.array([key[0].as_py()] * len(names), pa.string())
    for k, name in enumerate(names.to_pylist()):
        values = np.abs(p - p[k]).sum(axis=1)
        source = pa.array([name] * len(names), pa.string())
        yield pa.RecordBatch.from_arrays([lang, source, names, pa.array(values)], ["lang", "source", "item", "value"])


def _pairs(groups: DataFrame, kept: DataFrame, cells: int) -> DataFrame:
    """(lang, source, item, value): the distance of each other source."""
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.first("kept_terms").alias("v"))
    cut = F.ceil(F.col("sources") * F.col("v") / F.lit(cells)).cast("int")
    shards = sizes.select("lang", F.greatest(F.lit(1), cut).alias("shards"))
    # The counts of a term lie in one shard, and every shard has all sources.
    dealt = kept.join(shards, "lang").select(
        "lang", "source", "term", "n", F.lit(None).cast("bigint").alias("of"), F.pmod(F.xxhash64("term"), "shards").alias("shard")
    )
    heads = groups.join(shards, "lang").select(
        "lang",
        "source",
        F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("bigint").alias("n"),
        "of",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards").cast("bigint") - 1)).alias("shard"),
    )
    summed = (
        dealt.unionByName(heads)
        .groupBy("lang", "shard")
        .applyInArrow(_distances, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    # A language without kept terms has distances too, of 0.
    blank = groups.where("kept_terms = 0").select("lang", "source")
    others = blank.join(blank.select("lang", F.col("source").alias("item")), "lang")
    none = others.select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    return summed.unionByName(none).where("source <> item")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (text, lang, source).

    A language keeps the terms in at least `least` of its rows. Each source and
    each language gives every kept term the share 1 + floor(10^9 * (n + 5) /
    (N + 5 V)), where N counts all kept terms there and V is their number. Part
    `pair` ranks all other sources of the language by the sum of the absolute
    differences of shares; part `term` the `top` terms that the source uses
    more than its language does, by difference. Ties go by the item's bytes.

    NULL text, lang and source are empty strings; repeated rows count each;
    sources without a term, and languages without a kept one (distances 0), are
    groups too. Other columns are ignored; an empty table gives an empty result.
    Each task counts at most `TEXT_BYTES` of text at once, or one longer text.
    A block of distances has about `cells` counts, whatever the input, or one
    term of all sources.
    """
    counts = settled(term_counts(docs))
    known = counts.where(F.col("term").isNotNull())
    by_term = known.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("in_docs"))
    terms = settled(by_term.where(F.col("in_docs") >= least).select("lang", "term", "in_lang"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept_terms"), F.sum("in_lang").alias("size"))
    kept = settled(known.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    v = F.coalesce("kept_terms", F.lit(0).cast("bigint"))
    groups = settled(
        counts.where(F.col("term").isNull())
        .select("lang", "source")
        .join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            v.alias("kept_terms"),
            (F.coalesce("own", F.lit(0)) + PSEUDO * v).alias("of"),
            (F.coalesce("size", F.lit(0)) + PSEUDO * v).alias("of_lang"),
        )
    )
    pairs = _pairs(groups, kept.select("lang", "source", "term", "n"), cells)
    more = (_share(F.col("n"), F.col("of")) - _share(F.col("in_lang"), F.col("of_lang"))).alias("value")
    above = kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), more).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]

    def as_part(df: DataFrame, part: str) -> DataFrame:
        return df.withColumn("part", F.lit(part)).select(columns)

    ranked = above.withColumn("rank", F.row_number().over(order))
    return as_part(pairs.withColumn("rank", F.row_number().over(order)), "pair").unionByName(
        as_part(ranked.where(F.col("rank") <= top), "term")
    )
