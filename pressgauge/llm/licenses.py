"""License texts and notices in documents: MinHash bands over overlapping text windows, then exact shingle containment.

A template of n shingles (runs of K words; of SHORT_K where it has fewer than SHORT_WORDS) is looked for in windows of
``2 s`` shingles that begin every ``s`` shingles, where s is the smallest power of two of at least n: any run of n
shingles lies whole in one of them. A window that holds m of the template's shingles is similar to it by
``m / (2 s + n - m)`` or more; with one MinHash row per band, b bands miss it with probability ``(1 - similarity)^b``.
Each window size takes as many bands as bring this to MISS at ``m = contain n``; minima of a size are those of pairs of
blocks of half the size. Every retrieved pair is verified on the exact shingles of the window.

Templates are data: whole bodies and usual notices, several per license, in ``license_texts``. Words in braces tell a
license from its like (``{version 3}``) and must be in a find, one after another: all shingles of a run of k words or
more, else one that holds the run.

Defined cases: a null or empty text has no notice; templates without words are not searched; a text that is shorter
than the window is one window; of overlapping finds the one of most words counts (then the fullest, the first, by
name), each occurrence once; repeated rows are reported each. Every row is judged by itself, so other columns don't
matter.
"""

from __future__ import annotations

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.textops import U64, Piece, distinct, odd_numbers, pieces, shingles

K = 5
SHORT_K = 3
SHORT_WORDS = 15
MISS = 1e-9
CONTAIN = 0.8


def _templates() -> dict[str, list[str]]:
    """Texts by license: a file is a whole body, a line of the notices is a license and a text."""
    folder, out = Path(__file__).parent / "license_texts", {}
    for line in (folder / "notices.tsv").read_text().splitlines():
        name, text = line.split("\t")
        out.setdefault(name, []).append(text)
    for body in sorted(folder.glob("*.txt")):
        out.setdefault(body.stem, []).append(body.read_text())
    return out


TEMPLATES = _templates()

FOUND = pa.list_(pa.struct([
    ("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64()),
]))
FOUND_DDL = "array<struct<license string, start int, end int, containment double>>"


class Templates:
    """Templates of one shingle length: their shingle sets, the shingles that they need, and MinHash values by window size."""

    def __init__(self, k: int, contain: float, miss: float, texts: list[tuple[str, str]]):
        self.k, self.contain, self.names, self.sets, self.needs, steps = k, contain, [], [], [], []
        for name, text in texts:
            for piece in pieces(pa.array([text], type=pa.string())):
                starts, ends, bounds = piece.words()
                run = shingles(piece.hashes(starts, ends), bounds, k)[0]
                if len(run):
                    self.names.append(name)
                    self.sets.append(distinct(run))
                    self.needs.append(_needs(piece, starts, run, k))
                    steps.append(1 << (len(self.sets[-1]) - 1).bit_length())
        self.bands = {step: 1 for step in sorted(set(steps))}
        for own, step in zip(self.sets, steps):
            m = math.ceil(contain * len(own) - 1e-9)
            similarity = min(m / (2 * step + len(own) - m), 1 - 1e-12)
            self.bands[step] = max(self.bands[step], math.ceil(math.log(miss) / math.log1p(-similarity)))
        self.factors = odd_numbers(max(self.bands.values(), default=0), 31)
        # By step and band: the templates of each MinHash value.
        self.values = {step: [{} for _ in range(bands)] for step, bands in self.bands.items()}
        for t, (own, step) in enumerate(zip(self.sets, steps)):
            for factor, values in zip(self.factors, self.values[step]):
                values.setdefault((own * factor).min(), []).append(t)

    def retrieved(self, hashes: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int, int, int]]:
        """Template, document, first shingle and size of the windows that agree with a template in a band; hashes
        are the shingles of several documents, one after another."""
        out, levels = set(), []
        blocks, first = np.diff(bounds), bounds[:-1]
        low, high = min(self.bands), max(self.bands)
        step = low
        while step <= high:
            # Blocks of a step within each document, as runs of the level below; a window is a block and its successor.
            count = -(-blocks // (step if step == low else 2))
            doc = np.repeat(np.arange(len(count)), count)
            begin = np.cumsum(count) - count
            inner = np.arange(len(doc)) - begin[doc]
            start = None if step == 1 else first[doc] + inner * (step if step == low else 2)
            # Above the lowest level a block is a pair of the level below, or its last one.
            second = None if step == low else np.minimum(start + 1, first[doc] + blocks[doc] - 1)
            levels.append((step, start, second, doc, inner, inner[:-1] == count[doc[:-1]] - 1))
            blocks, first = count, begin
            step *= 2
        for band, factor in enumerate(self.factors):
            least = hashes * factor
            top = max(step for step, bands in self.bands.items() if band < bands)
            for step, start, second, doc, inner, last in levels:
                if step > top:
                    break
                if second is not None:
                    least = np.minimum(least[start], least[second])
                elif start is not None:
                    least = np.minimum.reduceat(least, start)
                if band >= self.bands.get(step, 0):
                    continue
                window = least.copy()
                np.minimum(least[:-1], np.where(last, least[:-1], least[1:]), out=window[:-1])
                for value, templates in self.values[step][band].items():
                    for w in np.flatnonzero(window == value):
                        out.update((t, int(doc[w]), int(inner[w]) * step, 2 * step) for t in templates)
        return out

    def occurrences(self, k: int, part: np.ndarray) -> list[tuple[int, int, int]]:
        """First and last shingle of template k's places in a window, and how many of its shingles are there."""
        own = self.sets[k]
        code = np.minimum(np.searchsorted(own, part), len(own) - 1)
        hit = np.flatnonzero(own[code] == part)
        reach = math.ceil(len(own) / self.contain)
        out = []
        while len(hit):
            # A shingle counts for the places before it from which it is in reach and the first of its kind.
            order = np.lexsort((hit, code[hit]))
            before = np.full(len(hit), -1)
            same = code[hit[order[1:]]] == code[hit[order[:-1]]]
            before[order[1:][same]] = hit[order[:-1][same]]
            counts = _spread(np.maximum(before, hit - reach) + 1, hit, len(part))[hit]
            if counts.max() < self.contain * len(own) - 1e-9:
                break
            for need in self.needs[k]:
                there = np.concatenate([_places(part, hit, run) for run in need])
                counts[_spread(there + len(need[0]) - reach, there, len(part))[hit] == 0] = 0
            best = int(np.argmax(counts))
            if counts[best] < self.contain * len(own) - 1e-9:
                break
            run = hit[(hit >= hit[best]) & (hit < hit[best] + reach)]
            out.append((int(run[0]), int(run[-1]), int(counts[best])))
            hit = hit[(hit < run[0] - reach) | (hit > run[-1])]
        return out


def _spread(start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """How many of the ranges [start, end] hold each place."""
    ends = np.bincount(end + 1, minlength=size + 1)
    return np.cumsum(np.bincount(np.maximum(start, 0), minlength=size + 1) - ends)


def _places(part: np.ndarray, hit: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The hits at which a run of shingles begins."""
    at = hit[hit + len(run) <= len(part)]
    for j, value in enumerate(run):
        at = at[part[at + j] == value]
    return at


def _needs(piece: Piece, starts: np.ndarray, run: np.ndarray, k: int) -> list[list[np.ndarray]]:
    """Runs of shingles, all equally long, of which a find must have one; for each run of words in braces."""
    out = []
    opened, closed = (np.searchsorted(starts, np.flatnonzero(piece.data == ord(c))) for c in "{}")
    for a, b in zip(opened.tolist(), closed.tolist()):
        if b - a >= k:
            out.append([run[a:b - k + 1]])
        else:
            out.append([run[at:at + 1] for at in range(max(b - k, 0), min(a + 1, len(run)))])
    return out


def families(texts: dict[str, str | list[str]], contain: float = CONTAIN, miss: float = MISS) -> list[Templates]:
    """The templates by shingle length."""
    by_k: dict[int, list[tuple[str, str]]] = {}
    for name, several in sorted(texts.items()):
        for text in [several] if isinstance(several, str) else several:
            words = sum(len(piece.words()[0]) for piece in pieces(pa.array([text], type=pa.string())))
            by_k.setdefault(SHORT_K if words < SHORT_WORDS else K, []).append((name, text))
    made = (Templates(k, contain, miss, several) for k, several in sorted(by_k.items()))
    return [t for t in made if t.names]


def scanner(templates: list[Templates]):
    """An Arrow function from texts to the notices they hold: license, place in code points, containment."""
    def run(texts: pa.Array) -> pa.Array:
        rows: list[list] = [[]] * len(texts)
        for piece in pieces(texts):
            starts, ends, bounds = piece.words()
            words = piece.hashes(starts, ends)
            found: dict[int, set] = {}
            for family in templates:
                lists = shingles(words, bounds, family.k)
                sizes = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
                hashes = np.concatenate([*lists, np.zeros(0, dtype=U64)])
                for k, doc, first, size in family.retrieved(hashes, sizes) if len(hashes) else ():
                    for a, b, count in family.occurrences(k, lists[doc][first:first + size]):
                        word = bounds[doc] + first
                        begin, end = starts[word + a], ends[min(word + b + family.k, bounds[doc + 1]) - 1]
                        share = count / len(family.sets[k])
                        found.setdefault(doc, set()).add((-count - family.k, -share, int(begin), int(end), family.names[k]))
            for doc, hits in found.items():
                at, kept = int(piece.offsets[doc]), []
                for _, share, begin, end, name in sorted(hits):
                    if all(end <= a or begin >= b for a, b, _, _ in kept):
                        kept.append((begin, end, name, -share))
                lead = np.cumsum((piece.data[at:piece.offsets[doc + 1]] & 0xC0) != 0x80)
                rows[piece.first + doc] = [
                    {"license": name, "start": int(lead[a - at]) - 1, "end": int(lead[b - 1 - at]), "containment": share}
                    for a, b, name, share in sorted(kept)
                ]
        return pa.array(rows, type=FOUND)

    return F.arrow_udf(run, FOUND_DDL)


def scan(
    documents: DataFrame, templates: dict[str, str | list[str]] | None = None, contain: float = CONTAIN, miss: float = MISS,
) -> DataFrame:
    """``doc_id, license, start, end, containment``: one row for each license text or notice in a document."""
    find = scanner(families(TEMPLATES if templates is None else templates, contain, miss))
    out = documents.select("doc_id", F.explode(find("text")).alias("hit"))
    return out.select("doc_id", "hit.*")


def query(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark.read.parquet(f"{d}/documents.parquet"))
