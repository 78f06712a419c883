"""Packing documents into token sequences, shortest pack first over the length
histogram."""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import numbered, ranked, release, whole_text
from chartfold.shared import send_by_value

send_by_value(__name__)

SEQUENCE = 2048
END_ID = 1
_ID_BYTES = 4
# Documents whose pieces are held at once.
_DOCUMENTS = 1_000
# The published pattern of byte-level pre-tokens, in the form that
# never backtracks.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def _visible_bytes() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes, from a
    `tokenizers` file.

    A plain byte-level BPE file, whose ids follow the order of its merges, is
    run by tiktoken, several times as fast and with the same ids; any other
    file by `tokenizers` itself. Special tokens' strings in a text become their
    ids, as `tokenizers` has it by default; none are added.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self._byte_level(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        if not self.fast:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)

    @staticmethod
    def _byte_level(spec: dict):
        model, before, added = spec["model"], spec["pre_tokenizer"] or {}, spec.get("added_tokens", ())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if model["type"] != "BPE" or spec["normalizer"] or {k: before.get(k) for k in plain} != plain:
            return None
        if any(model.get(k) for k in odd) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            return None
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merged)):
            return None
        import tiktoken

        special = {t["content"]: t["id"] for t in added}
        to_byte = _visible_bytes()
        ranks = {bytes(to_byte[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        if not self.fast:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif any(s in text for s in self.special):
            ids = self.fast.encode(text, allowed_special="all")
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Token pieces (doc_id, start, length, ids_crc32, doc_tokens) of documents.

    A document is its ids and `end_id`, cut after every `sequence` ids. NULL
    texts count as empty: one piece that is the end id. With `ids`, the column
    `ids` holds the ids themselves.
    """
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        encode = Encoder(tokenizer)
        release()
        end = end_id.to_bytes(_ID_BYTES, "little")
        step = sequence * _ID_BYTES
        for batch in (b[i : i + _DOCUMENTS] for b in batches for i in range(0, len(b), _DOCUMENTS)):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = encode(text) + end
                total = len(data) // _ID_BYTES
                for at in range(0, len(data), step):
                    part = data[at : at + step]
                    row = (doc_id, at // _ID_BYTES, len(part) // _ID_BYTES, zlib.crc32(part), total)
                    rows.append((*row, np.frombuffer(part, "<u4").tolist()) if ids else row)
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in (schema + ", ids array<bigint>" * ids).split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    # A NULL id must not turn the others into floats on the way.
    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    return sent.mapInPandas(cut, schema + ", ids array<bigint>" * ids)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Packs all lengths of a histogram; rows (length, rank_from, rank_to,
    sequence_from, offset).

    Longest first, each length goes into the shortest pack that it fits into,
    or opens a new one. Equal packs are kept as one pattern with a count, so
    the work depends on the number of lengths alone. The pieces of a length
    that have ranks from `rank_from` to `rank_to` (exclusive) go, in order, to
    the sequences from `sequence_from` on.
    """
    packs: list[tuple[int, int, int, list[tuple[int, int, int]]]] = []  # -room, first sequence, count, entries
    sequences, done = 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and -packs[0][0] >= length:
                room, first, count, entries = heapq.heappop(packs)
                room = -room
                used = min(count, left)
                if used < count:
                    rest = [(n, r + used, o) for n, r, o in entries]
                    heapq.heappush(packs, (-room, first + used, count - used, rest))
            else:
                room, first, used, entries = sequence, sequences, left, []
                sequences += used
            entries = [*entries, (length, rank, sequence - room)]
            if room - length:
                heapq.heappush(packs, (length - room, first, used, entries))
            else:
                done.append((0, first, used, entries))
            rank, left = rank + used, left - used
    return [(n, r, r + count, first, o) for _, first, count, entries in [*done, *packs] for n, r, o in entries]


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Every piece of `docs` (doc_id, text) with its `sequence_id` and `offset`.

    The histogram has at most `sequence` lengths, whatever the input; the plan
    over it is small and broadcast. Pieces find their place by their rank
    among pieces of equal length. Ids may be NULL or repeat; every row is
    packed. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = numbered(pieces(docs, tokenizer, sequence, end_id))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        plan(histogram, sequence),
        "_length bigint, rank_from bigint, rank_to bigint, sequence_from bigint, offset bigint",
    )
    fits = (
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("rank_from"))
        & (F.col("_rank") < F.col("rank_to"))
    )
    return (
        ranked(cut, ["length"])
        .join(F.broadcast(places), fits)
        .withColumn("sequence_id", F.col("sequence_from") + F.col("_rank") - F.col("rank_from"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )
