"""Benchmark decontamination by the q-gram lemma.

Two strings within edit distance k share at least ``length - q + 1 - k q`` character q-grams, all of them near one
diagonal. Benchmark items are cut into overlapping windows; a document's q-grams that occur in a window are counted
in diagonal bands that overlap by k, bands that reach the bound are regions, and banded alignment verifies them.

Windows of SMALL bytes every STEP are looked for besides the large ones, so a passage of PASSAGE bytes is found
wherever in its item it begins, if no more than a tenth of a window in it is edited. `LARGE` leaves these out.

Windows of equal bytes are searched as one. A q-gram that has more than FREQUENT places is left out of the count
wherever each of its windows keeps ``length - q + 1 - bound + SHARED`` others: the bound falls by what was left out,
so at least SHARED of them must be shared. The regions found are counted again with all their q-grams, each once,
before they are aligned. Texts are searched in runs that make at most PAIRS pairs of places, each repeating the end of the one
before by the reach of a window, so memory follows neither the text nor the benchmark times the text.

Text is compared as lower-cased UTF-8 bytes with every run of other characters than letters and digits as one blank.

Items of fewer than ``min_chars`` bytes are left out; by default none is. Items of fewer than
MIN_CHARS bytes are searched whole, with as many edits up to a tenth as the lemma can find (one from 16 bytes on, two
from 24, three from 32, four from 40); those of fewer than 16 bytes are found where they stand exactly, as whole words.

Defined cases: a null or empty text has no passage; a null item, or one without letters and digits, is not searched; repeated items are reported each under its own id; items of equal ids
count as one; repeated document rows are reported each. Every row is judged by itself, so other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.textops import _WORD, U64, Piece, odd_numbers, pieces

Q = 8
#: A passage of PASSAGE bytes holds a whole small window, wherever in its item it begins.
SMALL, STEP = 48, 8
PASSAGE = SMALL + STEP - 1
#: Size and stride of the windows that are looked for.
WINDOWS = ((100, 50), (SMALL, STEP))
EDITS = 0.1
MIN_CHARS = 48
BAND = 16
#: Benchmark bytes that are sent to the tasks at a time; a larger benchmark is searched in several passes.
PART_BYTES = 4 << 20
#: Places in the benchmark from which on a q-gram counts as frequent.
FREQUENT = 16
#: Shared q-grams that a window still needs when its most frequent ones are left out of the count.
SHARED = 5
#: Pairs of a text's and the benchmark's places that are made at a time, and regions that are counted or aligned.
PAIRS, REGIONS = 1 << 17, 2000

#: Options that find longer passages only.
LARGE = {"windows": WINDOWS[:1], "min_chars": MIN_CHARS}

HIT = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()),
    ("windows", pa.int32()),
]))
HIT_DDL = "array<struct<item_id bigint, start int, end int, edits int, windows int>>"

_GRAM = odd_numbers(1, 5)[0]
_BITS = 22


def plain(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with runs of separators as one blank, the documents' offsets in them, and each byte's old place."""
    inside = _WORD[piece.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    first = piece.offsets[:-1][np.diff(piece.offsets) > 0]
    keep[first] = inside[first]
    at = np.flatnonzero(keep)
    data = np.where(inside[at], piece.data[at], np.uint8(32))
    return data, np.searchsorted(at, piece.offsets), at


def grams(data: np.ndarray) -> np.ndarray:
    """The hash of the Q bytes from each place on, as they are packed in a number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    packed = np.zeros(n, dtype=U64)
    for j in range(Q):
        packed <<= U64(8)
        packed |= data[j:j + n]
    return packed * _GRAM


class Index:
    """A benchmark's items one after another, the windows to look for in them, and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], edits: float = EDITS, min_chars: int = 1, windows=WINDOWS):
        self.item, texts = [], []
        # By length: items that are looked for as words, exactly.
        words: dict[int, dict[bytes, list[int]]] = {}
        for piece in pieces(pa.array([t for _, t in items], type=pa.string())):
            data, offsets, _ = plain(piece)
            for k in range(piece.n_docs):
                text = data[offsets[k]:offsets[k + 1]]
                if len(text) and text[-1] == 32:
                    text = text[:-1]
                if not len(text) or len(text) < min_chars:
                    continue
                if len(text) < 2 * Q:
                    same = words.setdefault(len(text), {}).setdefault(text.tobytes(), [])
                    if items[piece.first + k][0] not in same:
                        same.append(items[piece.first + k][0])
                    continue
                self.item.append(items[piece.first + k][0])
                texts.append(text)
        self.words = [(n, np.array(sorted(of), dtype=f"S{n}"), [of[t] for t in sorted(of)]) for n, of in sorted(words.items())]
        n = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(n)))
        self.data = np.concatenate([*texts, np.zeros(0, dtype=np.uint8)])
        # By window size: the number of its first window, and where its windows begin, in order. Windows of the same
        # bytes are one window here, with all their items.
        self.groups: list[tuple[int, int, np.ndarray]] = []
        self.items: list[list[int]] = []
        known: dict[bytes, int] = {}
        begins, lengths, owners = [], [], []
        for number, (size, stride) in enumerate(sorted(windows, reverse=True)):
            start, own = [], []
            for k, m in enumerate(n.tolist()):
                if number and m <= size:
                    continue  # whole among the larger windows
                last = max(m - size, 0)
                for s in (*range(0, last, stride), last):
                    place = int(self.first[k]) + s
                    text = self.data[place:place + min(size, m)].tobytes()
                    same = known.setdefault(text, len(self.items))
                    if same == len(self.items):
                        start.append(place)
                        own.append(k)
                        self.items.append([self.item[k]])
                    elif self.item[k] not in self.items[same]:
                        self.items[same].append(self.item[k])
            start, own = np.array(start, dtype=np.int64), np.array(own, dtype=np.int64)
            self.groups.append((sum(map(len, begins)), size, start))
            begins.append(start)
            owners.append(own)
            lengths.append(np.minimum(n[own], size))
        self.begin, self.length, self.owner = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (begins, lengths, owners))
        self.budget = np.floor(self.length * edits).astype(np.int64)
        short = self.length < MIN_CHARS
        self.budget[short] = np.minimum(self.budget[short], self.length[short] // Q - 1)
        self.least = np.maximum(self.length - Q + 1 - self.budget * Q, 1)
        self.most = int(self.budget.max(initial=0))
        self.longest = int(self.length.max(initial=0))
        #: Bytes of text that the q-grams of one window and band lie in.
        self.reach = self.longest + BAND + self.most
        #: Above every place in an item, in whole bands.
        self.lead = BAND * (int(n.max(initial=0)) // BAND + 1)
        self.grams = grams(self.data)
        # Places of windows; each q-gram lies within one item.
        cover = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.add.at(cover, self.begin, 1)
        np.add.at(cover, self.begin + self.length - Q + 1, -1)
        place = np.flatnonzero(np.cumsum(cover)[:len(self.grams)] > 0)
        _, back, count = np.unique(self.grams[place], return_inverse=True, return_counts=True)
        often = np.zeros(len(self.grams), dtype=np.int64)
        often[place] = count[back]
        place, self.needed = self._chosen(place, often)
        # Of all windows of an item.
        self.item_needed = np.full(len(n), np.iinfo(np.int64).max)
        np.minimum.at(self.item_needed, self.owner, self.needed)
        order = np.argsort(self.grams[place], kind="stable")
        self.place = place[order].astype(np.int32)
        self.gram, start, count = np.unique(self.grams[self.place], return_index=True, return_counts=True)
        self.start, self.count = start.astype(np.int32), count.astype(np.int32)
        self._seen = None

    def _chosen(self, place: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places whose q-grams are counted, and how many of them each window needs."""
        if not (often > FREQUENT).any():
            return place, self.least
        take = np.zeros(len(often) + 1, dtype=bool)
        take[:-1] = (often > 0) & (often <= FREQUENT)
        for m in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == m)
            for s in range(0, len(own), 4096):
                w = own[s:s + 4096]
                at = self.begin[w][:, None] + np.arange(m - Q + 1)
                rank = np.argsort(np.argsort(often[at], axis=1, kind="stable"), axis=1)
                take[at[rank < (m - Q + 1 - self.least[w] + np.minimum(self.least[w], SHARED))[:, None]]] = True
        taken = np.concatenate(([0], np.cumsum(take)))
        left = self.length - Q + 1 - (taken[self.begin + self.length - Q + 1] - taken[self.begin])
        return np.flatnonzero(take[:-1]), self.least - left

    def seen(self, grams: np.ndarray) -> np.ndarray:
        """Which of the q-grams may be in an item, by the head of their hash; the table is made where it's used."""
        if self._seen is None:
            self._seen = np.zeros(1 << _BITS, dtype=bool)
            self._seen[self.gram >> U64(64 - _BITS)] = True
        return self._seen[grams >> U64(64 - _BITS)]

    def text(self, window: int) -> np.ndarray:
        return self.data[self.begin[window]:self.begin[window] + self.length[window]]


def _unfolded(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For n numbers from each first one on: the row they are of, and all these numbers."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def _bands(first: np.ndarray, owner: np.ndarray, diagonal: np.ndarray, overlap) -> tuple[np.ndarray, np.ndarray]:
    """Keys of document, owner and band of diagonals, each band longer by the overlap: one key a row, and
    then a second one of the rows that lie in two bands; and these rows."""
    inner = np.flatnonzero(diagonal % BAND < overlap)
    key = np.stack((first, owner, diagonal // BAND), axis=1)
    again = key[inner]
    again[:, 2] -= 1
    return np.concatenate((key, again)), inner


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, the number of each row's key, and the rows of each key."""
    order = np.lexsort(key.T[::-1])
    rows = key[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))[:len(rows)]
    number = np.empty(len(key), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return rows[new], number, np.bincount(number, minlength=int(new.sum()))


def _runs(n: np.ndarray, at: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Runs of text places of about PAIRS pairs; whatever lies within the reach is whole in one of them."""
    total = np.concatenate(([0], np.cumsum(n)))
    s = 0
    while s < len(n):
        e = int(np.searchsorted(total, total[s] + PAIRS, side="right")) - 1
        e = max(e, int(np.searchsorted(at, at[s] + 2 * reach)))
        yield s, min(e, len(n))
        if e >= len(n):
            return
        s = max(int(np.searchsorted(at, at[e - 1] + 1 - reach)), s + 1)


def regions(index: Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, window and first diagonal of every band with enough shared q-grams. Bands of whole items come first:
    a window's q-grams are in them, so only the items that have enough for a window are taken apart."""
    g = grams(data)
    at = np.flatnonzero(index.seen(g))
    found = np.searchsorted(index.gram, g[at])
    found = np.minimum(found, len(index.gram) - 1)
    good = index.gram[found] == g[at]
    doc = np.searchsorted(offsets, at, side="right") - 1
    good &= at + Q <= offsets[doc + 1]
    at, found, doc = at[good], found[good], doc[good]
    keys = [np.zeros((0, 3), dtype=np.int64)]
    for s, e in _runs(index.count[found], at, index.reach):
        for start, count in _shares(index, found[s:e]):
            keys.append(_counted(index, at[s:e], start, count, doc[s:e], offsets))
    key, _, _ = _numbered(np.concatenate(keys))
    # Windows of equal length are handled together.
    key = key[np.argsort(index.length[key[:, 1]], kind="stable")]
    doc, window, first = key[:, 0], key[:, 1], key[:, 2] * BAND - index.lead
    keep = np.zeros(len(key), dtype=bool)
    for s in range(0, len(key), REGIONS):
        k = slice(s, s + REGIONS)
        keep[k] = _shared(index, g, offsets, doc[k], window[k], first[k]) >= index.least[window[k]]
    return doc[keep], window[keep], first[keep]


def _shares(index: Index, found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First entries and numbers of the q-grams' places in the benchmark, whole items at a time, if there are many."""
    start, count = index.start[found].astype(np.int64), index.count[found].astype(np.int64)
    parts = -(-int(count.sum()) // PAIRS)
    if parts <= 2:
        yield start, count
        return
    limits = np.unique(np.searchsorted(index.first, np.linspace(0, index.first[-1], parts + 1)))
    limits = index.first[np.minimum(limits, len(index.first) - 1)]
    own, back = np.unique(found, return_inverse=True)
    lists = [index.place[index.start[k]:index.start[k] + index.count[k]] for k in own]
    cuts = np.array([np.searchsorted(places, limits) for places in lists])
    for k in range(len(limits) - 1):
        yield start + cuts[back, k], cuts[back, k + 1] - cuts[back, k]


def _counted(
    index: Index, at: np.ndarray, start: np.ndarray, n: np.ndarray, doc: np.ndarray, offsets: np.ndarray,
) -> np.ndarray:
    """Document, window and band of those with enough counted q-grams, from some places of the texts."""
    row, entry = _unfolded(start, n)
    place, at, doc = index.place[entry].astype(np.int64), (at - offsets[doc])[row], doc[row]
    item = np.searchsorted(index.first, place, side="right") - 1
    # Diagonals from the document's start on, all above zero.
    key, inner = _bands(doc, item, at - (place - index.first[item]) + index.lead, index.most)
    _, number, count = _numbered(key)
    enough = count[number] >= index.item_needed[np.concatenate((item, item[inner]))]
    use = enough[:len(item)].copy()
    use[inner] |= enough[len(item):]
    place, at, doc, item = place[use], at[use], doc[use], item[use]
    out = [np.zeros((0, 3), dtype=np.int64)]
    for number, size, begin in index.groups:
        # A place lies in several windows; an item may have none of this size.
        low = np.searchsorted(begin, np.maximum(index.first[item], place + Q - size))
        row, window = _unfolded(low, np.searchsorted(begin, place, side="right") - low)
        own = index.owner[number:][window] == item[row]
        row, window = row[own], window[own] + number
        diagonal = at[row] - (place[row] - index.begin[window]) + index.lead
        key, _, count = _numbered(_bands(doc[row], window, diagonal, index.budget[window])[0])
        out.append(key[count >= index.needed[key[:, 1]]])
    return np.concatenate(out)


def _shared(
    index: Index, g: np.ndarray, offsets: np.ndarray, doc: np.ndarray, window: np.ndarray, first: np.ndarray,
) -> np.ndarray:
    """The q-grams of each window that its text has in the band from the first diagonal on, each counted once."""
    width = BAND + index.budget[window]
    n = index.length[window] - Q + 1
    step = np.arange(int(n.max()))
    inside = step < n[:, None]
    found = np.zeros(inside.shape, dtype=bool)
    own = index.grams[np.minimum(index.begin[window][:, None] + step, len(index.grams) - 1)]
    size = offsets[doc + 1] - offsets[doc] - Q + 1
    for k in range(int(width.max())):
        place = (first + k)[:, None] + step
        ok = inside & (place >= 0) & (place < size[:, None]) & (k < width)[:, None]
        there = g[np.clip(place + offsets[doc][:, None], 0, len(g) - 1)]
        found |= ok & (own == there)
    return found.sum(axis=1)


def align(index: Index, window: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each window in its row of text, which begins ``most`` bytes before its band, and the end of
    the match there. Column b of the table stands for text place ``row + b``."""
    size = int(index.length[window].max())
    width = BAND + 3 * index.most + 1
    pattern = np.zeros((len(window), size), dtype=np.uint8)
    for k, w in enumerate(window):
        pattern[k, :index.length[w]] = index.text(w)
    step = np.arange(width, dtype=np.int32)
    table = np.zeros((len(window), width), dtype=np.int32)
    best, end = np.zeros(len(window), dtype=np.int32), np.zeros(len(window), dtype=np.int64)
    for row in range(size):
        new = table + (text[:, row:row + width] != pattern[:, row:row + 1])
        np.minimum(new[:, :-1], table[:, 1:] + 1, out=new[:, :-1])
        table = np.minimum.accumulate(new - step, axis=1) + step
        done = np.flatnonzero(index.length[window] == row + 1)
        if len(done):
            best[done], where = table[done].min(axis=1), table[done].argmin(axis=1)
            end[done] = where + row + 1
    return best, end


def word_runs(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
    """Document, start, end and items of every place where an item of a few bytes stands as whole words."""
    inside = np.append(data != 32, False)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge | ~np.append(True, inside[:-1])))
    doc = np.searchsorted(offsets, starts, side="right") - 1
    for n, texts, items in index.words:
        end = np.minimum(starts + n, len(data))
        use = np.flatnonzero((starts + n <= offsets[doc + 1]) & (edge[end] | ~inside[end]))
        for s in range(0, len(use), 100_000):
            at = starts[use[s:s + 100_000]]
            own = np.ascontiguousarray(data[at[:, None] + np.arange(n)]).view(f"S{n}").ravel()
            found = np.minimum(np.searchsorted(texts, own), len(texts) - 1)
            for k in np.flatnonzero(texts[found] == own):
                yield int(doc[use[s + k]]), int(at[k]), int(at[k]) + n, items[found[k]]


def _found(index: Index, piece: Piece) -> Iterator[tuple[int, dict]]:
    """Document of the piece and match, for windows and places."""
    data, offsets, old = plain(piece)
    for d, a, b, items in word_runs(index, data, offsets) if index.words else ():
        for item in items:
            yield d, {"item_id": item, "window": -1, "start": int(old[a]), "end": int(old[b - 1]) + 1, "edits": 0}
    if not len(index.gram):
        return
    doc, window, first = regions(index, data, offsets)
    # Of each document and window the best place counts.
    best_of: dict[tuple[int, int], tuple[int, int, int]] = {}
    for s in range(0, len(doc), REGIONS):
        d, w, f = doc[s:s + REGIONS], window[s:s + REGIONS], first[s:s + REGIONS]
        # Bytes outside of the document are 0, which no pattern holds.
        place = (f - index.most)[:, None] + np.arange(index.longest + BAND + 3 * index.most + 1)
        inside = (place >= 0) & (place < (offsets[d + 1] - offsets[d])[:, None])
        text = np.where(inside, data[np.clip(place + offsets[d][:, None], 0, len(data) - 1)], np.uint8(0))
        best, end = align(index, w, text)
        ok = best <= index.budget[w]
        stop = np.minimum(end + f - index.most, offsets[d + 1] - offsets[d])
        begin = np.maximum(stop - index.length[w], 0)
        for k in np.flatnonzero(ok):
            a, b = old[offsets[d[k]] + begin[k]], old[offsets[d[k]] + stop[k] - 1] + 1
            own, hit = (int(d[k]), int(w[k])), (int(best[k]), int(a), int(b))
            best_of[own] = min(best_of.get(own, hit), hit)
    for (d, w), (edits, start, end) in best_of.items():
        for item in index.items[w]:
            yield d, {"item_id": item, "window": w, "start": start, "end": end, "edits": edits}


def joined(hits: list[dict]) -> tuple[int, int, int, int]:
    """Start and end of the best window and what overlaps it, one after another, that window's edits, and the number
    of windows found."""
    best: dict[int, dict] = {}
    for h in sorted(hits, key=lambda h: (h["edits"], h["start"])):
        best.setdefault(h["window"], h)
    top = next(iter(best.values()))
    start, end = top["start"], top["end"]
    for h in sorted(best.values(), key=lambda h: h["start"]):
        if start <= h["start"] < end:
            end = max(end, h["end"])
    for h in sorted(best.values(), key=lambda h: -h["end"]):
        if start < h["end"] <= end:
            start = min(start, h["start"])
    return start, end, top["edits"], len(best)


def finder(index: Index):
    """An Arrow function from texts to the items that they hold, each with the place of its best window and those
    that overlap it (code points), that window's edits and the number of its windows found."""
    def run(texts: pa.Array) -> pa.Array:
        rows: list[list] = [[]] * len(texts)
        for piece in pieces(texts) if len(index.gram) or index.words else ():
            by_doc: dict[int, dict[int, list[dict]]] = {}
            for d, hit in _found(index, piece):
                by_doc.setdefault(d, {}).setdefault(hit["item_id"], []).append(hit)
            for d, by_item in by_doc.items():
                lead = np.cumsum((piece.data[piece.offsets[d]:piece.offsets[d + 1]] & 0xC0) != 0x80)
                at = piece.offsets[d]
                rows[piece.first + d] = [
                    {
                        "item_id": item, "edits": edits, "windows": windows,
                        "start": int(lead[start - at]) - 1, "end": int(lead[end - 1 - at]),
                    }
                    for item, hits in sorted(by_item.items())
                    for start, end, edits, windows in [joined(hits)]
                ]
        return pa.array(rows, type=HIT)

    return F.arrow_udf(run, HIT_DDL)


def passages(
    benchmark: DataFrame, text: str = "text", edits: float = EDITS, min_chars: int = 1, windows=WINDOWS,
) -> list[Column]:
    """Columns of benchmark items found in a text column, one for each part of the benchmark.

    The size of the benchmark is measured first; each part that goes to the tasks is a hash share of at most about
    PART_BYTES, so any benchmark can be searched.
    """
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // PART_BYTES
    columns = []
    for part in range(parts):
        share = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        rows = sorted((r["item_id"], r["text"]) for r in share.collect())
        columns.append(finder(Index(rows, edits, min_chars, windows))(F.col(text)))
    return columns


def find(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, start, end, edits, windows``: one row for each document and item that it holds a passage
    of (a whole window of the item, or all of a shorter item)."""
    hits = passages(benchmark, **options)
    out = documents.select("doc_id", F.explode(F.concat(*hits)).alias("hit"))
    return out.select("doc_id", "hit.*")


def remove(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a passage; columns as they were."""
    kept = documents
    for hits in passages(benchmark, **options):
        kept = kept.filter(F.size(hits) == 0)
    return kept


def query(spark: SparkSession, d: str) -> DataFrame:
    return find(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))


def stage(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    return remove(docs, spark.read.parquet(f"{d}/benchmark.parquet"))
