"""Periodic runs of words, found from string synchronising sets.

A run is a stretch of consecutive words whose words q apart are identical, q being
its smallest such distance; it is at least ``max(6, 4 * q)`` words long and cannot
grow on either side.

For a scale t a position is chosen by hashes of t-word windows: it is synchronising if
the smallest hash among the windows that start in ``[i, i + t]`` stands at either end.
Whether i is chosen depends on the 2t words after it only, so repeats choose alike.
Windows inside a run of period up to t / 4 take no part; a stretch of t positions
without a chosen one is then such a run, which a smaller scale has found before. A run
with a period in ``[t, 2t)`` therefore holds a chosen i whose next chosen position with
the same 2t words is i + q: the pair proposes q, and the run is as long as comparing
words q apart allows. Scales are 8, 16, 32 and so on; periods below 8 are compared
directly.

Texts are worked on whole, one batch at a time, by array operations over all words of
the batch: words in different texts are kept apart by marks that occur once. Nothing
is shuffled, and a batch is bounded by bytes unless one text alone is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from .staging import fresh_name, ship

#: Periods below this are compared directly, those from it on come from pairs.
DIRECT = 8
LEAST_LENGTH = 6
LEAST_POWER = 4
#: Text bytes worked on at once; one text may be larger.
BATCH_BYTES = 4_000_000

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def annotate(docs: DataFrame, text: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period by start, then period) and ``collapsed``.

    Words are what stands between the six ASCII spaces. ``collapsed`` holds the words,
    one space between them, without those that some run holds after its first period.
    A null or empty text has no words, no runs and an empty ``collapsed``. Every row is
    judged by itself, so repeated rows and null ids get a row each; columns that have
    one of the three names keep it, and the added ones get underscores in front.
    """
    ship(docs.sparkSession)
    added = [fresh_name(n, docs.columns) for n in ("n_words", "runs", "collapsed")]
    kinds = (T.LongType(), T.ArrayType(RUN, False), T.StringType())
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k, False) for n, k in zip(added, kinds, strict=True)]])
    place = docs.columns.index(text)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            for first, count in _slices(column, batch_bytes):
                part = batch.slice(first, count)
                values = part.column(place).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([*part.columns, *_columns(values)], names=[f.name for f in schema.fields])

    return docs.mapInArrow(tasks, schema)


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first, count) of stretches of rows of at most ``most`` bytes, or of one row."""
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > most:
            yield first, i - first
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes) - first


def _columns(values: list[bytes | None]) -> list[pa.Array]:
    lists = [(v or b"").split() for v in values]
    found = runs_of(lists)
    counts = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    kept = []
    for words, runs in zip(lists, found, strict=True):
        if runs:
            inner = np.zeros(len(words) + 1, np.int32)
            for start, length, period in runs:
                inner[start + period] += 1
                inner[start + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(inner[:-1]) == 0).tolist()]
        kept.append(b" ".join(words))
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    structs = pa.StructArray.from_arrays(
        [pa.array(flat[:, k]) for k in range(3)], fields=[pa.field(n, pa.int64(), False) for n in RUN.names]
    )
    return [
        pa.array(list(map(len, lists)), pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), structs),
        pa.array(kept, pa.binary()).cast(pa.string()),
    ]


def runs_of(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each word list, by start, then period."""
    order = sorted(range(len(lists)), key=lambda i: -len(lists[i]))
    sizes = np.array([len(lists[i]) for i in order], np.int64)
    # Longest text first, one mark after each: a scale takes a front part of the array.
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    known: dict[bytes, int] = {}
    words = np.empty(starts[-1], np.int64)
    for k, i in enumerate(order):
        at, n = starts[k], len(lists[i])
        words[at : at + n] = [known.setdefault(w, len(known)) for w in lists[i]]
        words[at + n] = -1 - k
    runs = _direct(words)
    scale = DIRECT
    while len(sizes) and LEAST_POWER * scale <= sizes[0]:
        texts = int(np.searchsorted(-sizes, -LEAST_POWER * scale, side="right"))
        runs += _at_scale(words[: starts[texts]], scale, runs)
        scale *= 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    for start, end, period in sorted(runs, key=lambda r: (r[0], r[2])):
        text = int(np.searchsorted(starts, start, side="right")) - 1
        out[order[text]].append((start - int(starts[text]), end - start, period))
    return out


def _least(period: int) -> int:
    return max(LEAST_LENGTH, LEAST_POWER * period)


def _direct(words: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) with a period below ``DIRECT``."""
    found: dict[tuple[int, int], int] = {}
    for period in range(1, min(DIRECT, len(words))):
        edges = np.diff(np.concatenate(([0], (words[period:] == words[:-period]).view(np.int8), [0])))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - begins + period >= _least(period)
        for begin, end in zip(begins[long].tolist(), (ends[long] + period).tolist(), strict=True):
            # A stretch with a smaller period too is the run of that period.
            found.setdefault((begin, end), period)
    return [(begin, end, period) for (begin, end), period in found.items()]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_hashes(words: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``scale`` and every ``2 * scale`` words; ``scale`` is a power of two."""
    hashed, width = _mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while True:
        wider = _mixed(hashed[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashed[width:])
        if width == scale:
            return hashed, wider
        hashed, width = wider, 2 * width


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def synchronising(words: np.ndarray, scale: int, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The chosen positions, ascending, and the hashes of the ``2 * scale`` words after them.

    ``runs`` holds all runs with periods up to ``scale / 4``, and may hold others, also
    of texts behind those in ``words``.
    """
    hashed, contexts = _window_hashes(words, scale)
    covered = np.zeros(len(words) + 1, np.int32)
    for start, end, period in runs:
        if LEAST_POWER * period <= scale <= end - start and end <= len(words):
            covered[start] += 1
            covered[end - scale + 1] -= 1
    none = np.iinfo(np.uint64).max
    hashed = np.where(np.cumsum(covered)[: len(hashed)] > 0, none, hashed)
    least = _sliding_least(hashed, scale + 1)
    chosen = (least != none) & ((least == hashed[: len(least)]) | (least == hashed[scale : scale + len(least)]))
    at = np.flatnonzero(chosen[: len(contexts)])
    return at, contexts[at]


def _at_scale(words: np.ndarray, scale: int, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs with a period in ``[scale, 2 * scale)``, given those of all smaller periods."""
    at, contexts = synchronising(words, scale, runs)
    order = np.argsort(contexts, kind="stable")
    at, contexts = at[order], contexts[order]
    gap = at[1:] - at[:-1]
    proposed = (contexts[1:] == contexts[:-1]) & (gap >= scale) & (gap < 2 * scale)
    pairs = sorted(zip(gap[proposed].tolist(), at[:-1][proposed].tolist(), strict=True))
    found, reached, last = [], -1, 0
    for period, position in pairs:
        if period == last and position < reached:
            continue
        begin, end = _extent(words, position, period)
        last, reached = period, end - period
        if end - begin >= _least(period):
            found.append((begin, end, period))
    return found


def _extent(words: np.ndarray, position: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``position`` whose words ``period`` apart are identical."""
    step, end = 4 * period, position
    while end + period < len(words):
        upto = min(end + step, len(words) - period)
        differs = words[end:upto] != words[end + period : upto + period]
        if differs.any():
            end += int(differs.argmax())
            break
        end, step = upto, 2 * step
    step, begin = 4 * period, position
    while begin > 0:
        down = max(0, begin - step)
        differs = words[down:begin] != words[down + period : begin + period]
        if differs.any():
            begin -= int(differs[::-1].argmax())
            break
        begin, step = down, 2 * step
    return begin, end + period
