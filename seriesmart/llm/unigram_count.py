"""Token counts of a unigram vocabulary without making tokens.

Each word is a chunk: a space mark and what follows up to the next space. An
Aho-Corasick automaton lists the vocabulary's matches in a chunk; a Viterbi pass
carries, for each prefix, the best score and the number of pieces on its path.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from .piece_bpe import SPACE, parts
from .staging import fresh_name

CACHED_CHUNKS = 250_000
# Fixed value: what an unknown character costs below the lowest score.
UNKNOWN_PENALTY = 10.0


def vocabulary_of(model_path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores of a SentencePiece file, and the id of the unknown piece."""
    file = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(file.id_to_piece(i), file.get_score(i)) for i in range(file.vocab_size())], file.unk_id()


class UnigramCounter:
    """Counts as the ``tokenizers`` library's Unigram model with byte fallback does,
    behind a Metaspace splitter that marks the first word too.

    Ties: a path replaces another with the same end only by a higher score, and
    paths are met in the order of their last piece's start; so of equal scores the
    longest last piece stays. A character without a piece of its own is unknown: it
    counts one token a byte, or, where the vocabulary lacks a byte's piece, one
    token for a whole run of unknown characters.
    """

    def __init__(self, vocab: list[tuple[str, float]]):
        self.pieces = {p for p, _ in vocab}
        self.unknown_score = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.matcher = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.all_bytes = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.words = _Counts(self)

    def path(self, chunk: str) -> tuple[float, int]:
        """Best score and number of tokens of one chunk."""
        size = len(chunk)
        score: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        unknown = [0] * (size + 1)  # where the run of unknown characters that ends here began, plus 1
        missing = self.unknown_score
        at, single = 0, False

        def settle() -> None:
            """The unknown path into ``at``, met last of all: its start is the latest."""
            if single:
                return
            value = score[at - 1] + missing
            if score[at] is None or value > score[at]:
                start = unknown[at - 1] or at
                before = count[at - 1] if not unknown[at - 1] else count[start - 1]
                score[at], unknown[at] = value, start
                count[at] = before + self._fallback(chunk[start - 1 : at])

        for end, (length, gain) in self.matcher.iter(chunk):
            end += 1
            while at < end:
                if at:
                    settle()
                at, single = at + 1, False
            value = score[end - length] + gain
            if score[end] is None or value > score[end]:
                score[end], count[end] = value, count[end - length] + 1
            single = single or length == 1
        while at < size:
            if at:
                settle()
            at, single = at + 1, False
        if at:
            settle()
        return score[size], count[size]

    def _fallback(self, run: str) -> int:
        raw = run.encode()
        if self.all_bytes or all(f"<0x{b:02X}>" in self.pieces for b in raw):
            return len(raw)
        return 1

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty have none."""
        if not text:
            return 0
        marked = text.replace(SPACE, " ")
        return sum(map(self.words.__getitem__, (marked[1:] if marked[0] == " " else marked).split(" ")))


class _Counts(dict):
    """Counts by word, kept up to a fixed number of words."""

    def __init__(self, counter: UnigramCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        n = self.counter.path(SPACE + word)[1]
        if len(word) <= 40:
            self[word] = n
        return n


@lru_cache(maxsize=2)
def counter(model_path: str) -> UnigramCounter:
    """One counter a Python worker; its cache is bounded."""
    return UnigramCounter(vocabulary_of(model_path)[0])


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Adds ``into`` (long), the unigram token count of each whole ``text``.

    Null and empty texts count 0. All columns stay; a clash gets underscores in
    front of the new name. No shuffle; memory is one Arrow batch and the caches.
    """
    name = fresh_name(into, docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        for whole in batches:
            for batch in parts(whole, text):
                n = pa.array(map(model.count, batch[text].to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, n], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)
