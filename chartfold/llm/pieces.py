"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The normaliser and the pieces of a model are compiled into arcs over
characters. A text is composed with them and encoded by the shortest path in
the tropical semiring: weights add up along a path, the least sum wins.

For a unigram model an arc weighs what its piece scores, negated. A BPE model
has no such weights: its result is what merging neighbours in order of score
ends with. That result is the only sequence of pieces in which merging the
text of any two neighbours alone gives back the same two, because the merges
inside a part of a text are the same with and without the rest. So an arc
weighs nothing after a piece that it may follow and infinity after any other,
and the shortest path is the only finite one.
"""

from __future__ import annotations

import codecs
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from chartfold.shared import send_by_value

send_by_value(__name__)

# The mark of a space, the kinds of pieces and models in the file
# format, what an unknown piece weighs beyond the worst piece, and its text.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "

# Words and pairs of pieces that a task remembers.
KNOWN_WORDS = 400_000
KNOWN_PAIRS = 600_000
# Rows of results that a task holds.
SLICE = 512
_END: dict = {}


class Transducer:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        codecs.register_error("a mark for each byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.kind = model.trainer_spec.model_type
        self.rules = model.normalizer_spec
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("the model must be of unigram or BPE kind")
        if self.rules.precompiled_charsmap or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("a normaliser with a character map is not supported")
        if not self.rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("spaces must be escaped and begin words")
        if any(p.type == USER for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.fallback = model.trainer_spec.byte_fallback
        self.pieces: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes = [-1] * 256
        self.unknown = 0
        # What each id is written as; bytes stand for themselves.
        self.written: list[bytes] = []
        self.opens_word = {i for i, p in enumerate(model.pieces) if p.type == NORMAL and p.piece[0] == SPACE}
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        for i, p in enumerate(model.pieces):
            written = b""
            if p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                self.bytes[value], written = i, bytes([value])
            elif p.type == UNKNOWN:
                self.unknown, written = i, (model.trainer_spec.unk_surface or UNKNOWN_TEXT).encode()
            elif p.type != CONTROL:
                written = p.piece.replace(SPACE, " ").encode()
            self.written.append(written)
            if p.type == NORMAL:
                self.pieces[p.piece] = i
                self.scores[p.piece] = p.score
        self.unknown_weight = UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)
        # The input side of the arcs: a trie of characters, '' marks an end.
        self.trie: dict = {}
        for piece in self.pieces:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
        # No piece goes on over a space, so words are composed one by one.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.words: dict[str, bytes] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0

    def normalise(self, text: str) -> str:
        if self.rules.remove_extra_whitespaces:
            text = " ".join(x for x in text.replace(SPACE, " ").split(" ") if x)
        if not text:
            return ""
        return (SPACE if self.rules.add_dummy_prefix else "") + text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging the characters of a short text ends with."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, before: str, piece: str) -> bool:
        parts = self.merged(before + piece)
        return parts == ([before, piece] if before else [piece])

    def _only_path(self, text: str) -> list[str]:
        """The path of finite weight, by its last piece at each place. Every
        place ends the path of the text before it, and has one such piece."""
        length, trie, pairs = len(text), self.trie, self.pairs
        last: list[str | None] = [None] * (length + 1)
        last[0] = ""
        for at in range(length):
            before = last[at]
            follows = pairs.get(before)
            if follows is None:
                follows = pairs[before] = {}
            node, end = trie, at
            while end < length:
                node = node.get(text[end])
                end += 1
                if node is None:
                    if end > at + 1:
                        break
                    # A character that no piece begins with is an arc by itself.
                    node, piece = _END, text[at]
                else:
                    piece = node.get("") or (text[at] if end == at + 1 else None)
                if piece is None or last[end] is not None:
                    continue
                allowed = follows.get(piece)
                if allowed is None:
                    allowed = follows[piece] = self.may_follow(before, piece)
                    self.n_pairs += 1
                if allowed:
                    last[end] = piece
        if self.n_pairs > KNOWN_PAIRS:
            pairs.clear()
            self.n_pairs = 0
        return self._back(text, last)

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, str]]:
        """(end, piece) of all pieces that begin at `at`; a character that is no
        piece is an arc too, for its bytes or the unknown piece."""
        node, end = self.trie, at
        if text[at] not in self.pieces:
            yield at + 1, text[at]
        while end < len(text) and (node := node.get(text[end])) is not None:
            end += 1
            if "" in node:
                yield end, node[""]

    def _lightest_path(self, text: str) -> list[str]:
        weight = [0.0] + [math.inf] * len(text)
        last: list[str | None] = [None] * (len(text) + 1)
        for at in range(len(text)):
            for end, piece in self.arcs(text, at):
                w = weight[at] + (-self.scores[piece] if piece in self.scores else self.unknown_weight)
                if w < weight[end]:
                    weight[end], last[end] = w, piece
        return self._back(text, last)

    @staticmethod
    def _back(text: str, last: list[str | None]) -> list[str]:
        path, at = [], len(text)
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _word(self, word: str) -> bytes:
        ids: list[int] = []
        unknown = False
        for piece in self._only_path(word) if self.kind == BPE else self._lightest_path(word):
            i = self.pieces.get(piece)
            if i is not None:
                ids.append(i)
            elif self.fallback:
                ids.extend(self.bytes[b] for b in piece.encode("utf-8", "replace"))
            elif not unknown:
                # Neighbouring unknown characters are one piece.
                ids.append(self.unknown)
            unknown = i is None
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        text = self.normalise(text)
        words = _words(text) if self.by_word else [text]
        known, out = self.words, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = self._word(word)
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                known[word] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype="<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement marks,
        one each."""
        written, ids = self.written, ids.tolist()
        data = b"".join([written[i] for i in ids])
        first = next((i for i in ids if i not in self.silent), None)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = data.decode("utf-8", "a mark for each byte")
        opened = self.rules.add_dummy_prefix or self.rules.remove_extra_whitespaces
        return text[1:] if opened and first in self.opens_word else text


def _words(text: str) -> list[str]:
    """A text cut before every space mark that follows another character."""
    parts = text.split(SPACE)
    # A space mark opens each part but the first; empty parts are further marks.
    out, marks = ([parts[0]] if parts[0] else []), ""
    for part in parts[1:]:
        marks += SPACE
        if part:
            out.append(marks + part)
            marks = ""
    if marks:
        out.append(marks)
    return out


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """`batch` with these columns last, in place of any of their names."""
    kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def _schema(df: DataFrame, **types: str) -> str:
    kept = StructType([f for f in df.schema.fields if f.name not in types])
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {t}" for n, t in types.items()])


def encode(df: DataFrame, path: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """`df` with `ids`, the ids of the texts by the model file at `path`, which
    must be readable on every executor.

    NULL and empty texts have no ids (an empty array). With `decoded`, a column
    of that name holds what the ids are decoded to, made in the same pass.
    Columns of these names are replaced, all others kept; rows may repeat.
    Results leave a task in slices of `SLICE` rows, whatever comes in.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                ids = [transducer.encode(t or "") for t in part.column(text).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                new = {"ids": pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.zeros(0, np.int32))}
                if decoded:
                    new[decoded] = pa.array([transducer.decode(i) for i in ids], pa.string())
                yield _with(part, **new)

    types = {"ids": "array<int>"} | ({decoded: "string"} if decoded else {})
    return df.mapInArrow(of, _schema(df, **types))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`df` with `into`, the texts of arrays of ids; NULL and empty ones give ''.

    Decoding gives back an encoded text, with space marks as spaces; a model
    without byte fallback loses unknown characters.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(path)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = [transducer.decode(np.array(a or [], dtype=np.int64)) for a in part.column(ids).to_pylist()]
                yield _with(part, **{into: pa.array(texts, pa.string())})

    return df.mapInArrow(of, _schema(df, **{into: "string"}))
