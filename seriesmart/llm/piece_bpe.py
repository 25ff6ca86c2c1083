"""SentencePiece BPE encoding through a prefix table, and decoding.

A text's encoding is found from left to right: for every prefix the table holds
the one token that ends it. A token t that ends at position i is that token if
the tokens (last of the prefix before t, t) would stay apart when their joined
string is merged on its own. Ids are then read off backwards.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from .staging import fresh_name

SPACE = "▁"
CACHED_CHUNKS = 100_000
CACHED_PAIRS = 300_000

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Decoder:
    """Texts of ids, from the pieces of a SentencePiece file."""

    def __init__(self, file: sentencepiece.SentencePieceProcessor):
        size = file.vocab_size()
        self.unknown = file.unk_id()
        self.is_byte = [file.is_byte(i) for i in range(size)]
        self.control = {i for i in range(size) if file.is_control(i)}
        self.raw: list[bytes] = []
        for i in range(size):
            piece = file.id_to_piece(i)
            if self.is_byte[i]:
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif i in self.control:
                self.raw.append(b"")
            elif file.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(piece.replace(SPACE, " ").encode())

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids vanish, one leading space goes, bad bytes become U+FFFD each."""
        joined = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if i not in self.control), None)
        if first is not None and not self.is_byte[first] and first != self.unknown and joined[:1] == b" ":
            joined = joined[1:]
        return joined.decode("utf-8", "each_byte")


class PieceBpe(Decoder):
    """Encoder and decoder over the pieces and scores of a SentencePiece BPE file."""

    def __init__(self, model_path: str):
        file = sentencepiece.SentencePieceProcessor(model_file=model_path)
        super().__init__(file)
        self.eos = file.eos_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_to_id: dict[int, int] = {}
        for i in range(file.vocab_size()):
            piece = file.id_to_piece(i)
            if self.is_byte[i]:
                self.bytes_to_id[self.raw[i][0]] = i
            elif i not in self.control and i != self.unknown:
                self.ids[piece] = i
                self.score[piece] = file.get_score(i)
        counted: dict[float, int] = {}
        for piece, value in self.score.items():
            if len(piece) > 1:
                counted[value] = counted.get(value, 0) + 1
        # Pieces of equal score have no order of their own; only runs of spaces may share one.
        tied = [p for p, v in self.score.items() if len(p) > 1 and counted[v] > 1]
        if any(p.strip(SPACE) for p in tied):
            raise ValueError("The model has pieces of equal score that are not runs of spaces.")
        if any(SPACE in p[1:] and p.strip(SPACE) for p in self.score):
            raise ValueError("The model has pieces that join words.")
        self.matcher = ahocorasick.Automaton()
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.spines: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        for piece in self.ids:
            if len(piece) == 1 or self._halves(piece):
                self.matcher.add_word(piece, (piece, len(piece)))
        self.matcher.make_automaton()
        self.chunks = _Chunks(self)

    def merged(self, text: str, log: list | None = None) -> list[str]:
        """Best score first, leftmost among equals, with a heap: the definition of BPE."""
        parts, left, right = list(text), list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                joint = parts[i] + parts[j]
                if joint in self.score:
                    heapq.heappush(heap, (-self.score[joint], i, j, joint))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joint = heapq.heappop(heap)
            if not parts[i] or not parts[j] or right[i] != j or parts[i] + parts[j] != joint:
                continue
            if log is not None:
                log.append((parts[i], parts[j], joint))
            parts[i], parts[j] = joint, ""
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes a piece; None for one that merging never yields."""
        if piece not in self.halves:
            log: list[tuple[str, str, str]] = []
            whole = self.merged(piece, log) == [piece]
            self.halves[piece] = log[-1][:2] if whole and log else None
        return self.halves[piece]

    def _spine(self, piece: str, at_end: bool) -> list[tuple[str, float]]:
        """The symbols that stand at a piece's edge while it is merged, from the single
        character on, each with the score of the merge that takes it up."""
        key = (piece, at_end)
        if key not in self.spines:
            steps, symbol = [(piece, float("-inf"))], piece
            while len(symbol) > 1:
                inner = self._halves(symbol)[1 if at_end else 0]
                steps.append((inner, self.score[symbol]))
                symbol = inner
            self.spines[key] = steps[::-1]
        return self.spines[key]

    def apart(self, first: str, second: str) -> bool:
        """Whether merging first + second leaves exactly these two pieces."""
        known = self.pairs.get((first, second))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[first, second] = self._apart(first, second)
        return known

    def _apart(self, first: str, second: str) -> bool:
        ends, starts = self._spine(first, True), self._spine(second, False)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = ends[i], starts[j]
            joint = self.score.get(x + y)
            # Of equal scores the leftmost goes first: inside first, then across, then inside second.
            if joint is not None and joint > x_taken and joint >= y_taken:
                return False
            if i == len(ends) - 1 and j == len(starts) - 1:
                return True
            if x_taken >= y_taken and i < len(ends) - 1:
                i += 1
            else:
                j += 1

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of one chunk: a run of spaces, if any, and what follows up to the next."""
        if chunk.startswith(SPACE * 2):
            return self.merged(chunk)  # runs of spaces share one score: only the heap orders them
        last, pairs, settled = ["", *chunk], self.pairs, -1
        # A character without a piece stands for itself: nothing merges with it, it falls back to bytes.
        for end, (piece, length) in self.matcher.iter(chunk):
            if end == settled:
                continue
            start = end + 1 - length
            if start:
                fits = pairs.get((last[start], piece))
                if fits is None:
                    fits = self.apart(last[start], piece)
                if not fits:
                    continue
            last[end + 1], settled = piece, end
        out, end = [], len(chunk)
        while end:
            piece = last[end]
            out.append(piece)
            end -= len(piece)
        out.reverse()
        return out

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.pieces(chunk):
            number = self.ids.get(piece)
            if number is not None:
                out.append(number)
            else:
                out.extend(self.bytes_to_id.get(x, self.unknown) for x in piece.encode())
        return tuple(out)

    def encode(self, text: str | None, eos: bool = True) -> list[int]:
        """Ids of a whole text; null counts as empty."""
        out: list[int] = []
        if text:
            words = text.replace(SPACE, " ").split(" ")
            if "" in words:
                words = _runs(words)
            out = list(chain.from_iterable(map(self.chunks.__getitem__, words)))
        if eos:
            out.append(self.eos)
        return out


class _Chunks(dict):
    """Ids by word: the latest words, and those that were the latest before."""

    def __init__(self, coder: PieceBpe):
        super().__init__()
        self.coder = coder
        self.before: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        self.clear()
        self.before = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_CHUNKS:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(word) or self.coder.chunk_ids(SPACE + word)
        if len(word) <= 40:
            self[word] = ids
        return ids


def _runs(words: list[str]) -> list[str]:
    """Words of which empty ones are drawn into the next as spaces in front."""
    out, spaces = [], 0
    for word in words[:-1]:
        if word:
            out.append(SPACE * spaces + word)
            spaces = 0
        else:
            spaces += 1
    out.append(SPACE * spaces + words[-1])
    return out


@lru_cache(maxsize=2)
def coder(model_path: str) -> PieceBpe:
    """One coder a Python worker; its caches are bounded."""
    return PieceBpe(model_path)


@lru_cache(maxsize=2)
def decoder(model_path: str) -> Decoder:
    """One decoder a Python worker."""
    return Decoder(sentencepiece.SentencePieceProcessor(model_file=model_path))


def encode(
    docs: DataFrame, model_path: str, text: str = "text", tokens: str = "tokens", eos: bool = True,
    decoded: str | None = None,
) -> DataFrame:
    """Adds ``tokens`` (array of int), the ids of each whole ``text``; with ``decoded`` also
    a column of that name, what ``decode`` makes of the ids.

    Null and empty texts give the end id alone (or no id). All columns stay; if a
    name is taken, underscores are put in front of the new one. Rows stay
    where they are: no shuffle, and memory is one Arrow batch and bounded caches.
    Decoding in the same pass takes one Python worker a task instead of two.
    """
    name = fresh_name(tokens, docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType(), False))])
    if decoded:
        schema = schema.add(fresh_name(decoded, schema.names), T.StringType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = coder(model_path)
        kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
        for whole in batches:
            for batch in parts(whole, text):
                ids = pa.array((model.encode(x, eos) for x in batch[text].to_pylist()), kind)
                more = [ids, pa.array((model.decode(x) for x in _lists(ids)), pa.string())] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)
        model.chunks.forget()  # the worker lives on and may do other work

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, tokens: str = "tokens", text: str = "decoded") -> DataFrame:
    """Adds ``text``, decoded from ``tokens``; null tokens give an empty text."""
    name = fresh_name(text, df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = decoder(model_path)
        for whole in batches:
            for batch in parts(whole, tokens):
                out = pa.array((model.decode(x) for x in _lists(batch[tokens])), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column, one by one; a null gives an empty list."""
    flat, ends = column.flatten(), np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
    values, start = flat.to_numpy(zero_copy_only=False), 0
    for end in ends.tolist():
        yield values[start:end].tolist()
        start = end


def parts(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds about ``most`` bytes, one row at least."""
    rows, size = batch.num_rows, max(batch[column].nbytes, 1)
    step = max(1, rows * most // size)
    for start in range(0, rows, step):
        yield batch.slice(start, step)
