"""Token ids in binary files, by a static range asymmetric numeral system.

One table of frequencies, counted over all ids, serves all files. A file is a
run of blocks that stand alone; each holds whole documents:

| Part | Fields (little-endian) |
| --- | --- |
| head | `RANS`, crc32 of the rest of the block, crc32 of the table, lanes, steps between checkpoints, documents, checkpoints (32 bits each); ids before the block, ids in it, words (64 bits each) |
| documents | whether the id is there (a byte each), id, ids in the document (64 bits each) |
| checkpoints | the first word to read, crc32 of the ids up to the next one, and the state of each lane (64 bits each) |
| words | 32 bits each |
| mark | `MARK`, which no other part holds |

Id number i of a block belongs to lane i modulo the number of lanes. The lanes
share one run of words, so a step decodes an id of every lane at once. Decoding
can begin at any block, found by the mark, and within it at any checkpoint.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartfold.llm.common import RANK_ROWS, numbered, whole_text
from chartfold.llm.packing import Encoder
from chartfold.shared import send_by_value, settled

send_by_value(__name__)

END_ID = 2
# About as many ids go into a file and into a block; both hold whole documents.
FILE_TOKENS = 1 << 25
BLOCK_TOKENS = 1 << 20
LANES = 1024
# Steps of all lanes from one checkpoint to the next.
CHECKPOINT_STEPS = 256
# A lane of a small block has this many ids at least.
_LANE_TOKENS = 64
MARK = "\n--end-of-block\n"
_MAGIC, _TABLE_MAGIC = b"RANS", b"FREQ"
_HEAD = "<4sIIIIIIQQQ"
_HEAD_BYTES = struct.calcsize(_HEAD)
_TABLE_HEAD = "<4sIII"
_TABLE_HEAD_BYTES = struct.calcsize(_TABLE_HEAD)
# States lie between this and its square times two.
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def quantised(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies from 1 that sum up to 2^bits, in proportion to positive counts."""
    total, span = int(counts.sum()), 1 << bits
    freqs = np.array([max(1, int(c) * span // total) for c in counts], dtype=np.int64)
    rest = span - int(freqs.sum())
    for at in np.argsort(-freqs, kind="stable"):
        if rest >= 0:
            freqs[at] += rest
            break
        less = min(-rest, int(freqs[at]) - 1)
        freqs[at] -= less
        rest += less
    return freqs


@dataclass
class Table:
    """The ids that occur, ascending, and their frequencies out of 2^bits."""

    symbols: np.ndarray
    freqs: np.ndarray
    crc: int = field(init=False)

    def __post_init__(self):
        self.bits = int(self.freqs.sum()).bit_length() - 1 if len(self.freqs) else 0
        self.freq = self.freqs.astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(self.freqs)[:-1]]).astype(np.uint64)
        self.crc = zlib.crc32(self._body())

    def _body(self) -> bytes:
        return self.symbols.astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes()

    @classmethod
    def of(cls, counts: dict[int, int]) -> Table:
        symbols = np.array(sorted(counts), dtype=np.uint32)
        if not len(symbols):
            return cls(symbols, np.zeros(0, dtype=np.int64))
        bits = max(12, len(symbols).bit_length() + 4)
        if bits > 30:
            raise ValueError("too many different ids for a table")
        return cls(symbols, quantised(np.array([counts[int(s)] for s in symbols], dtype=object), bits))

    def to_bytes(self) -> bytes:
        return struct.pack(_TABLE_HEAD, _TABLE_MAGIC, self.crc, len(self.symbols), self.bits) + self._body()

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        magic, crc, n, _ = struct.unpack_from(_TABLE_HEAD, data)
        body = np.frombuffer(data, "<u4", 2 * n, _TABLE_HEAD_BYTES)
        table = cls(body[:n].copy(), body[n:].astype(np.int64))
        if magic != _TABLE_MAGIC or crc != table.crc:
            raise ValueError("the table of frequencies is damaged")
        return table

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The place in the table of each id."""
        size = int(self.symbols[-1]) + 1 if len(self.symbols) else 0
        at = np.full(size, -1, dtype=np.int32)
        at[self.symbols] = np.arange(len(self.symbols))
        found = at[ids] if len(ids) == 0 or ids.max() < size else np.full(1, -1)
        if (found < 0).any():
            raise ValueError("an id is not in the table of frequencies")
        return found

    def slots(self) -> np.ndarray:
        """The place in the table of each slot."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freqs)


def _encoded(ids: np.ndarray, table: Table, lanes: int, every: int):
    """(checkpoints as (step, word, states), words) of ids, from the last step
    to the first."""
    place = table.places(ids)
    bits, limit = np.uint64(table.bits), np.uint64(63 - table.bits)
    freq, before = table.freq[place], table.before[place]
    states = np.full(lanes, _LOW, dtype=np.uint64)
    steps = -(-len(ids) // lanes)
    chunks, marks, words = [], [], 0
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes : (step + 1) * lanes], before[step * lanes : (step + 1) * lanes]
        x = states[: len(f)]
        full = x >= (f << limit)
        out = x[full]
        if len(out):
            chunks.append(out.astype("<u4"))
            words += len(out)
            x[full] = out >> _WORD
        whole = x // f
        x[:] = (whole << bits) + (x - whole * f) + c
        if step % every == 0:
            marks.append((step, words, states.copy()))
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, dtype="<u4")
    return [(step, words - left, at) for step, left, at in marks[::-1]], stream


def encode_block(
    docs: list[tuple[int | None, np.ndarray]], first: int, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS
) -> bytes:
    """The block of whole documents (doc_id, ids); `first` ids come before it."""
    ids = np.concatenate([np.asarray(x, dtype=np.uint32) for _, x in docs])
    lanes = max(1, min(lanes, len(ids) // _LANE_TOKENS))
    # A block that holds the mark, also across its end, is told with another number of lanes.
    for lanes in chain(range(lanes, 0, -1), count(lanes + 1)):
        checkpoints, words = _encoded(ids, table, lanes, every)
        parts = [
            bytes(i is not None for i, _ in docs),
            np.array([i or 0 for i, _ in docs], dtype="<i8").tobytes(),
            np.array([len(x) for _, x in docs], dtype="<u8").tobytes(),
        ]
        for step, word, states in checkpoints:
            piece = ids[step * lanes : (step + every) * lanes]
            parts += [struct.pack("<QQ", word, zlib.crc32(piece.astype("<u4").tobytes())), states.astype("<u8").tobytes()]
        rest = b"".join([*parts, words.tobytes()])
        counts = (table.crc, lanes, every, len(docs), len(checkpoints), first, len(ids), len(words))
        crc = zlib.crc32(rest, zlib.crc32(struct.pack(_HEAD, _MAGIC, 0, *counts)))
        block = struct.pack(_HEAD, _MAGIC, crc, *counts) + rest
        if (block + MARK.encode()).find(MARK.encode()) == len(block):
            return block


class Block:
    """A block read back; its ids are decoded on demand."""

    def __init__(self, data: bytes, table: Table):
        fields = struct.unpack_from(_HEAD, data)
        magic, crc, of_table, self.lanes, self.every, docs, marks, self.first, self.size, words = fields
        if magic != _MAGIC or crc != zlib.crc32(data[_HEAD_BYTES :], zlib.crc32(struct.pack(_HEAD, magic, 0, *fields[2:]))):
            raise ValueError("a block is damaged")
        if of_table != table.crc:
            raise ValueError("a block belongs to another table of frequencies")
        self.table, at = table, _HEAD_BYTES
        there = np.frombuffer(data, np.uint8, docs, at)
        numbers = np.frombuffer(data, "<i8", docs, at + docs)
        self.lengths = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.doc_ids = [int(n) if t else None for t, n in zip(there, numbers)]
        at += 17 * docs
        marked = np.frombuffer(data, "<u8", marks * (2 + self.lanes), at).reshape(marks, 2 + self.lanes)
        self.word, self.crcs, self.states = marked[:, 0], marked[:, 1], marked[:, 2:]
        self.words = np.frombuffer(data, "<u4", words, at + marked.nbytes)

    def _segment(self, k: int, slots: np.ndarray) -> np.ndarray:
        """The ids from checkpoint `k` to the next one."""
        table, lanes = self.table, self.lanes
        begin = k * self.every * lanes
        n = min(self.size - begin, self.every * lanes)
        places = np.empty(n, dtype=np.uint32)
        states = self.states[k].astype(np.uint64)
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        word = int(self.word[k])
        for at in range(0, n, lanes):
            x = states[: min(lanes, n - at)]
            slot = x & mask
            place = slots[slot]
            places[at : at + len(x)] = place
            x[:] = table.freq[place] * (x >> bits) + slot - table.before[place]
            low = np.flatnonzero(x < _LOW)
            if len(low):
                x[low] = (x[low] << _WORD) | self.words[word : word + len(low)]
                word += len(low)
        ids = table.symbols[places].astype("<u4")
        if zlib.crc32(ids.tobytes()) != int(self.crcs[k]):
            raise ValueError("ids differ from their checksum")
        return ids

    def ids(self, slots: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids `start` to `stop` (exclusive) of the block, from the last
        checkpoint before them on."""
        stop = self.size if stop is None else min(stop, self.size)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        span = self.every * self.lanes
        segments = [self._segment(k, slots) for k in range(start // span, -(-stop // span))]
        return np.concatenate(segments)[start - start // span * span :][: stop - start]


def _squeezed(data: bytes) -> bytes:
    """Little-endian 32-bit ids in few bytes, for their way through a shuffle."""
    ids = np.frombuffer(data, "<u4")
    narrow = not len(ids) or ids.max() < 1 << 16
    plain = ids.astype("<u2").tobytes() if narrow else data
    return struct.pack("<BQ", 2 if narrow else 4, len(plain)) + pa.Codec("zstd", 1).compress(plain, asbytes=True)


def _unsqueezed(data: bytes) -> np.ndarray:
    width, size = struct.unpack_from("<BQ", data)
    return np.frombuffer(pa.Codec("zstd").decompress(data[9:], size, asbytes=True), f"<u{width}")


def _tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            found = [encoder(text) + end for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n": [len(x) // 4 for x in found], "ids": [_squeezed(x) for x in found]})

    # A NULL id must not turn the others into floats on the way.
    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    made = sent.mapInPandas(encode, "doc_id string, n bigint, ids binary")
    return numbered(made.withColumn("doc_id", F.col("doc_id").cast("bigint")))


def _table(tokens: DataFrame) -> Table:
    """Counts of all ids; one number for each different id reaches the driver."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            new = np.bincount(np.concatenate([_unsqueezed(data) for data in batch["ids"]]))
            if len(new) > len(counts):
                counts, new = new.astype(np.int64), counts
            counts[: len(new)] += new
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"id": at, "n": counts[at]})

    found = tokens.select("ids").mapInPandas(tally, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return Table.of({r["id"]: r["n"] for r in found.collect()})


def _file_starts(tokens: DataFrame, file_tokens: int) -> list[tuple[tuple, int]]:
    """The first document of each file, as (whether there is an id, id, row),
    with the ids of all documents before it, ascending."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    parts = max(8, -(-tokens.count() // RANK_ROWS))
    dealt = settled(tokens.select("doc_id", "_row", "n").repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("part").agg(F.sum("n").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    running = F.sum("n").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("end", running).join(starts, "part")
    start = (F.col("base") + F.col("end") - F.col("n")).alias("start")
    first = (
        placed.select("doc_id", "_row", start)
        .groupBy(F.floor(F.col("start") / F.lit(file_tokens)).alias("file"))
        .agg(F.min(F.struct("doc_id", "_row", "start")).alias("f"))
        .select("f.*")
    )
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["_row"]), r["start"]) for r in first.collect())


def write(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
    lanes: int = LANES,
    every: int = CHECKPOINT_STEPS,
) -> None:
    """Writes the ids of all documents (doc_id, text), each with `end_id` behind
    it, to files under `path`, in ascending order of doc_id.

    NULL texts count as empty: the end id alone. NULL ids come first; rows with
    equal ids are kept, next to each other. Other columns are ignored. An empty
    table gives no block. A text of any length is one document of one block.

    Texts are encoded once, and their ids cross one shuffle, by file. Only the
    counts of different ids and the first document of each file reach the
    driver. Spark's own writer and committer bring the bytes to the store, so a
    task that runs again leaves no half file.
    """
    spark = docs.sparkSession
    tokens = _tokens(docs, tokenizer, end_id)
    table = _table(tokens)
    starts = _file_starts(tokens, file_tokens)
    keys, firsts = [k for k, _ in starts], [s for _, s in starts]

    @F.pandas_udf("bigint")
    def file_of(ids: pd.Series, rows: pd.Series) -> pd.Series:
        from bisect import bisect_right

        found = [(i is not None, int(i or 0), int(r)) for i, r in zip(ids, rows)]
        return pd.Series([firsts[bisect_right(keys, key) - 1] for key in found])

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int | None, np.ndarray]] = []
        file, size, before = None, 0, 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"first": [file], "value": [encode_block(held, before, table, lanes, every)]})

        for batch in batches:
            for first, doc_id, data in zip(batch["first"], batch["doc_id"], batch["ids"]):
                if held and (first != file or size >= block_tokens):
                    yield block()
                    before, held, size = before + size, [], 0
                if first != file:
                    file, before = first, first
                ids = _unsqueezed(data)
                held.append((None if doc_id is None else int(doc_id), ids))
                size += len(ids)
        if held:
            yield block()

    order = ["first", F.col("doc_id").asc_nulls_first(), "_row"]
    filed = (
        tokens.withColumn("first", file_of(F.col("doc_id").cast("string"), F.col("_row")))
        .repartition(max(1, len(starts)), "first")
        .sortWithinPartitions(*order)
        .select("first", F.col("doc_id").cast("string").alias("doc_id"), "ids")
    )
    made = filed.mapInPandas(blocks, "first bigint, value binary")
    text = made.select("first", F.col("value").cast("string").alias("value"))
    text.write.partitionBy("first").option("lineSep", MARK).option("compression", "none").text(os.path.join(path, "blocks"))
    whole = spark.createDataFrame([(bytearray(table.to_bytes()),)], "value binary").coalesce(1)
    whole.select(F.col("value").cast("string")).write.option("compression", "none").text(os.path.join(path, "table"))


def _read_table(spark: SparkSession, path: str) -> Table:
    files = spark.read.format("binaryFile").load(os.path.join(path, "table")).select("content").collect()
    return Table.from_bytes(b"".join(bytes(r["content"]) for r in files))


def _blocks(spark: SparkSession, path: str, start: int, stop: int | None) -> DataFrame:
    """The stored blocks of the files that can hold ids `start` to `stop`."""
    reader = spark.read.schema("value string").option("lineSep", MARK).option("recursiveFileLookup", "true")
    found = reader.text(os.path.join(path, "blocks"))
    if start or stop is not None:
        first = {f: int(f.rsplit("first=", 1)[1].split("/")[0]) for f in found.inputFiles()}
        last = max((s for s in first.values() if s <= start), default=0)
        wanted = [f for f, s in first.items() if s >= last and (stop is None or s < stop)]
        found = reader.text(wanted) if wanted else found.limit(0)
    return found.select(F.col("value").cast("binary").alias("value"))


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents in the files that
    `write` made, with `ids` also the ids; `start` counts the ids of all
    documents before. Blocks are decoded apart, wherever a file is split.

    A damaged block or table, and a block of another table, raise an error.
    """
    table = _read_table(spark, path)
    schema = "doc_id string, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = table.slots()
        for batch in batches:
            for data in batch["value"]:
                block = Block(bytes(data), table)
                found = block.ids(slots)
                ends = np.cumsum(block.lengths)
                begins = ends - block.lengths
                own = [found[a:b] for a, b in zip(begins, ends)]
                rows = {
                    "doc_id": [None if i is None else str(i) for i in block.doc_ids],
                    "start": block.first + begins,
                    "n_tokens": block.lengths,
                    "ids_crc32": [zlib.crc32(x.tobytes()) for x in own],
                }
                yield pd.DataFrame(rows | ({"ids": [x.tolist() for x in own]} if ids else {}))

    found = _blocks(spark, path, 0, None).mapInPandas(decode, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(position, ids) for the ids `start` to `stop` (exclusive) of all, in
    pieces, a row for each block they touch; only files that can hold them are
    read, and blocks are decoded from the checkpoint before."""
    table = _read_table(spark, path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = table.slots()
        for batch in batches:
            rows = []
            for data in batch["value"]:
                block = Block(bytes(data), table)
                begin = max(start - block.first, 0)
                piece = block.ids(slots, begin, max(0, stop - block.first))
                if len(piece):
                    rows.append((block.first + begin, piece.tolist()))
            yield pd.DataFrame(rows, columns=["position", "ids"])

    return _blocks(spark, path, start, stop).mapInPandas(decode, "position bigint, ids array<bigint>")
