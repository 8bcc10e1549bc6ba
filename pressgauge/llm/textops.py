"""Vectorised text work on Arrow batches: words, shingles and substring hashes of many documents at once.

A word is a longest run of ASCII letters, ASCII digits and non-ASCII characters of the lower-cased text. A null text
is an empty one. Batches are cut into pieces of about a megabyte before anything is made of them, so besides the batch
itself the memory of a task follows the piece. Nothing is kept between pieces: functions travel to the executors by
value, and what each copy of them held would stay in a worker for long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
U64 = np.uint64

_MIX = (U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers, in a new array."""
    x = x ^ (x >> U64(30))
    x *= _MIX[0]
    x ^= x >> U64(27)
    x *= _MIX[1]
    x ^= x >> U64(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd multipliers for multiply-shift hashing."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BASE = 0x5851F42D4C957F2D
_BYTE = odd_numbers(256, 77)
_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
for _range in (b"09", b"az", b"AZ"):
    _WORD[_range[0]:_range[1] + 1] = True


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=U64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Piece:
    """Some documents of a batch: their bytes one after another, and hashes of any part of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.n_docs = data, offsets, first, len(offsets) - 1
        self._sums = self._inverse = None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte ranges [start, end)."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=U64)
            np.cumsum(_BYTE[self.data] * _powers(_BASE, len(self.data)), out=self._sums[1:])
            self._inverse = _powers(pow(_BASE, -1, 1 << 64), len(self.data) + 1)
        h = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(h ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end bytes of all words, and where each document's words begin (one more entry at the end)."""
        inside = _WORD[self.data]
        edge = np.zeros(len(self.data) + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        starts = np.flatnonzero(after & (~before | edge))
        ends = np.flatnonzero(before & (~after | edge))
        return starts, ends, np.searchsorted(starts, self.offsets)


def pieces(texts: pa.Array, lower: bool = True) -> Iterator[Piece]:
    """The documents of a string array in pieces of about PIECE_BYTES; a longer document is a piece of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(sizes, sizes[row] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        part = texts.slice(row, end - row)
        if lower:
            part = pc.utf8_lower(part)
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", dtype=np.uint8)
        yield Piece(data[offsets[0]:offsets[-1]], offsets - offsets[0], row)
        row = end


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """Hashes of all runs of k words, per document; a document of fewer words has one shingle of all of them."""
    full = np.zeros(0, dtype=U64)
    if len(words) >= k:
        full = words[:len(words) - k + 1].copy()
        for j in range(1, k):
            full *= U64(0x2545F4914F6CDD1D)
            full += words[j:len(words) - k + 1 + j]
        full = mix(full)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(full[a:b - k + 1])
        elif b > a:
            h = np.zeros(1, dtype=U64)
            for w in words[a:b]:
                h = h * U64(0x2545F4914F6CDD1D) + w
            out.append(mix(h + U64(b - a)))
        else:
            out.append(full[:0])
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each document, in order."""
    for piece in pieces(texts):
        starts, ends, bounds = piece.words()
        for s in shingles(piece.hashes(starts, ends), bounds, k):
            yield distinct(s)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold each run of equal keys as a whole, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            v = batch.column(key).to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
            if held:
                changed[0] |= held[-1].column(key)[-1].as_py() != v[0]
        at = np.flatnonzero(changed)
        if len(at):
            if at[-1] or held:
                yield pa.Table.from_batches([*held, batch.slice(0, int(at[-1]))])
            held = [batch.slice(int(at[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n items' connected component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
