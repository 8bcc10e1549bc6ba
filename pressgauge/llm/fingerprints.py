"""Document fingerprints by content-defined chunking.

The UTF-8 text is cut where a gear hash of the last 32 bytes has zeros in its upper bits: eight of them before a chunk
has NORMAL bytes, five after that (normalised cutting), never before LEAST, always at MOST bytes. Cuts depend only on
the bytes around them, so they come back after an insertion or a removal. A fingerprint is the set of a text's
distinct chunk digests with the chunks' lengths. The likeness of two fingerprints is the length of their shared chunks by that of the smaller
one: 1 when one contains the other.

Defined cases: a null text is an empty one; an empty text has the empty fingerprint, like another empty one by 1 and
others by 0; documents of equal ids follow each other by a hash of their texts, rows that repeat come one after the
other; a null id comes last; the only document is its own next one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.textops import odd_numbers, pieces
from pressgauge.session import shuffle_tasks

LEAST, NORMAL, MOST = 32, 96, 384
_HARD, _EASY = np.uint32(0xFF000000), np.uint32(0xF8000000)
_GEAR = (odd_numbers(256, 19) >> np.uint64(32)).astype(np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[int]]:
    """The ends of the chunks of each document."""
    h = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        more = h.copy()
        more[s:] += h[:-s] << np.uint32(s)
        h = more
    easy = np.flatnonzero((h & _EASY) == 0)
    hard = (easy[(h[easy] & _HARD) == 0] + 1).tolist()
    easy = (easy + 1).tolist()
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        out = []
        while end - start > LEAST:
            normal, most = min(start + NORMAL, end), min(start + MOST, end)
            at = bisect_left(hard, start + LEAST)
            cut = hard[at] if at < len(hard) else end
            if cut >= normal:
                at = bisect_left(easy, normal)
                cut = easy[at] if at < len(easy) else end
            start = min(cut, most)
            out.append(start)
        if end > start:
            out.append(end)
        yield out


def chunk_sets(texts: list[str]) -> list[dict[str, int]]:
    """Digest and length of the distinct chunks of each text."""
    out = []
    for piece in pieces(pa.array(texts, type=pa.string()), lower=False):
        raw = piece.data.tobytes()
        for start, ends in zip(piece.offsets.tolist(), cuts(piece.data, piece.offsets)):
            own = {}
            for end in ends:
                own[hashlib.blake2b(raw[start:end], digest_size=8).hexdigest()] = end - start
                start = end
            out.append(own)
    return out


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Length of the shared chunks by that of the smaller set."""
    small, large = sorted((a, b), key=lambda x: sum(x.values()))
    if not small:
        return float(not large)
    return sum(n for d, n in small.items() if d in large) / sum(small.values())


def written_out(own: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in sorted(own.items()))


FINGERPRINT_DDL = "string"


def fingerprint(text) -> DataFrame:
    """A column with the fingerprint of a text column: digest:length of the distinct chunks."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([written_out(s) for s in chunk_sets([t.as_py() or "" for t in texts])], type=pa.string())

    return F.arrow_udf(run, FINGERPRINT_DDL)(text)


_ROWS_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_STEP = 256


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the first as many code points of the following text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each range followed by the first row of the next one (a guest), which is not reported."""
    held: list[tuple] = []
    for batch in batches:
        for s in range(0, batch.num_rows, _STEP):
            part = batch.slice(s, _STEP)
            held += zip(*(part.column(c).to_pylist() for c in ("_range", "_guest", "doc_id", "text")))
            if len(held) > 1:
                yield _pairs(held)
                held = held[-1:]


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    texts = [r[3] or "" for r in rows]
    use = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
    changed = [edited(texts[k], texts[k + 1]) for k in use]
    own, other = chunk_sets(texts), chunk_sets(changed)
    return pa.RecordBatch.from_pylist([
        {
            "doc_id": rows[k][2], "n_chars": len(texts[k]), "edited_sha256": hashlib.sha256(c.encode()).hexdigest(),
            "fingerprint": written_out(own[k]), "edited_fingerprint": written_out(e),
            "near_edited": likeness(own[k], e), "near_next": likeness(own[k], own[k + 1]),
        }
        for k, c, e in zip(use, changed, other)
    ], schema=_ROWS)


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document, in descending doc_id.

    Documents are dealt to ranges of ids, each range with a copy of the first document of the next one. Texts are
    shuffled once; the driver sees the limits of the ranges, of which there are four to a shuffle partition."""
    spark = documents.sparkSession
    parts = shuffle_tasks(spark)
    ids = documents.select("doc_id")
    # Several ranges to a task, as hashing deals them out unevenly.
    n = 4 * parts
    limits = ids.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n)
    bounds = np.array(sorted({int(x) for x in limits}), dtype=np.int64)

    def range_of(doc_ids: pa.Array) -> pa.Array:
        """0 for the largest ids; null ids are in the last range."""
        own = np.array(doc_ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), dtype=np.int64)
        return pa.array((len(bounds) - np.searchsorted(bounds, own, side="right")).astype(np.int32))

    place = F.arrow_udf(range_of, "int")
    firsts = sorted(
        (r["_range"], r["doc_id"]) for r in
        ids.withColumn("_range", place("doc_id")).groupBy("_range").agg(F.max("doc_id").alias("doc_id")).collect()
    )
    # The first document of each range is a guest of the range before it, that of the first range of the last one.
    guests = [(firsts[k][1], firsts[k - 1][0]) for k in range(len(firsts))]
    visits = spark.createDataFrame(guests, "_first bigint, _range int")
    own = documents.select("doc_id", "text", place("doc_id").alias("_range"), F.lit(False).alias("_guest"))
    visiting = documents.select("doc_id", "text").join(F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("_first"))).select(
        "doc_id", "text", "_range", F.lit(True).alias("_guest"),
    )
    rows = own.union(visiting).repartition(parts, "_range")
    ordered = rows.sortWithinPartitions("_range", "_guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return ordered.mapInArrow(_compared, _ROWS_DDL)


def query(spark: SparkSession, d: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{d}/documents.parquet"))
