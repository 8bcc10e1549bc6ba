"""Fill-in-the-middle texts by displacement scatter.

A text is cut in prefix, middle and suffix and put together anew, the middle last, with a mark before each part. A
batch is one run of bytes: a scan of the bytes that begin a code point turns the cuts into byte places, difference
arrays hold by how much the output place of a byte departs from its place in the batch, their running sum gives every
byte its output place, and one scatter writes all outputs. `restored` finds the marks, makes the differences of the
opposite move and gathers. Sums run over slices of SLICE bytes, so besides the text itself and its output a long text
needs no more memory than a short one.

Forms: ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``, ``plain`` is the text.

Defined cases: a null text is an empty one; an empty text and one that holds a mark are plain; a null id is hashed as
an empty string; repeated rows are changed alike; an output without the three marks of its form, each once and in order, is
restored as null. Every row is judged by itself, and other columns come along unchanged (`transform` names its own by
arguments and refuses names that are taken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.textops import Piece, pieces

MARKS = ("<P>", "<S>", "<M>")
#: Shares of a hundred: texts that stay plain, and of the others those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SLICE = 1 << 20

_WIDTH = 3
_PREFIX, _SUFFIX, _MIDDLE = (np.frombuffer(m.encode(), dtype=np.uint8) for m in MARKS)


def _places(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slices [i, j) of all places below size, with the place that each is displaced to.

    Runs begin at starts (ascending; of equal ones the last counts) and are displaced by shifts."""
    change = np.diff(shifts, prepend=0)
    carry = 0
    for i in range(0, size, SLICE):
        j = min(i + SLICE, size)
        a, b = np.searchsorted(starts, (i, j))
        moved = np.zeros(j - i, dtype=np.int64)
        np.add.at(moved, starts[a:b] - i, change[a:b])
        moved[0] += carry
        np.cumsum(moved, out=moved)
        carry = int(moved[-1])
        moved += np.arange(i, j)
        yield i, j, moved


def _byte_places(piece: Piece, chars: np.ndarray) -> np.ndarray:
    """Of each document, the byte where its code point number chars begins (its end, if that is their number)."""
    heads = (piece.data & 0xC0) != 0x80
    steps = np.arange(0, len(heads) + SLICE, SLICE)
    before = np.concatenate(([0], np.cumsum([np.count_nonzero(heads[s:s + SLICE]) for s in steps])))

    def count_before(places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), dtype=np.int64)
        for k in np.unique(places // SLICE):
            here = places // SLICE == k
            run = np.concatenate(([0], np.cumsum(heads[k * SLICE:(k + 1) * SLICE])))
            out[here] = before[k] + run[places[here] - k * SLICE]
        return out

    wanted = count_before(piece.offsets[:-1]) + chars
    out = np.full(len(wanted), len(heads), dtype=np.int64)
    block = np.searchsorted(before, wanted, side="right") - 1
    for k in np.unique(block[wanted < before[-1]]):
        here = (block == k) & (wanted < before[-1])
        out[here] = k * SLICE + np.flatnonzero(heads[k * SLICE:(k + 1) * SLICE])[wanted[here] - before[k]]
    return out


def _interleaved(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).reshape(-1)


def scattered(piece: Piece, form: np.ndarray, prefix: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the outputs of a piece. form: 0 plain, 1 psm, 2 spm; lengths in code points."""
    begin, end = piece.offsets[:-1], piece.offsets[1:]
    framed = form > 0
    prefix, middle = np.where(framed, prefix, 0), np.where(framed, middle, 0)
    a = _byte_places(piece, prefix)
    b = _byte_places(piece, prefix + middle)
    offsets = np.concatenate(([0], np.cumsum(end - begin + 3 * _WIDTH * framed)))
    o, n_pre, n_suf = offsets[:-1], a - begin, end - b
    spm = form == 2
    at_pre = np.where(framed, o + _WIDTH + spm * (n_suf + _WIDTH), o)
    at_suf = np.where(framed, o + _WIDTH + ~spm * (n_pre + _WIDTH), o)
    at_mid = np.where(framed, o + 3 * _WIDTH + n_pre + n_suf, o)
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    for mark, at in ((_PREFIX, at_pre), (_SUFFIX, at_suf), (_MIDDLE, at_mid)):
        out[(at[framed] - _WIDTH)[:, None] + np.arange(_WIDTH)] = mark
    starts, targets = _interleaved(begin, a, b), _interleaved(at_pre, at_mid, at_suf)
    for i, j, place in _places(starts, targets - starts, len(piece.data)):
        out[place] = piece.data[i:j]
    return out, offsets


def _marks(piece: Piece, letter: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of a mark's places in each document, and the first of them."""
    d = piece.data
    found = np.flatnonzero((d[:-2] == ord("<")) & (d[1:-1] == letter[0]) & (d[2:] == ord(">"))) if len(d) > 2 else np.zeros(0, int)
    own = np.searchsorted(piece.offsets, found, side="right") - 1
    found, own = (x[found + _WIDTH <= piece.offsets[own + 1]] for x in (found, own))
    first = np.full(piece.n_docs, -1, dtype=np.int64)
    first[own[::-1]] = found[::-1]
    return np.bincount(own, minlength=piece.n_docs), first


def gathered(piece: Piece, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the restored texts of a piece, and which of them could be restored."""
    begin, end = piece.offsets[:-1], piece.offsets[1:]
    (c_p, p), (c_s, s), (c_m, m) = (_marks(piece, x) for x in (b"P", b"S", b"M"))
    one = (c_p == 1) & (c_s == 1) & (c_m == 1)
    psm = (form == 1) & one & (p == begin) & (p < s) & (s < m)
    spm = (form == 2) & one & (s == begin) & (s < p) & (p < m)
    framed = psm | spm
    n_pre = np.where(framed, np.where(psm, s, m) - p - _WIDTH, 0)
    n_suf = np.where(framed, np.where(psm, m, p) - s - _WIDTH, 0)
    size = end - begin - 3 * _WIDTH * framed
    offsets = np.concatenate(([0], np.cumsum(size)))
    o = offsets[:-1]
    starts = _interleaved(o, o + n_pre, o + size - n_suf)
    sources = _interleaved(*(np.where(framed, at + _WIDTH, begin) for at in (p, m, s)))
    out = np.empty(int(offsets[-1]), dtype=np.uint8)
    for i, j, place in _places(starts, sources - starts, len(out)):
        np.take(piece.data, place, out=out[i:j])
    return out, offsets, framed | (form == 0)


_FORMS = ("plain", "psm", "spm")


def _form_numbers(forms: pa.Array) -> np.ndarray:
    return np.array([_FORMS.index(f) if f in _FORMS else -1 for f in forms.to_pylist()], dtype=np.int64)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)],
    )


def _one(chunks: list[pa.Array]) -> pa.Array:
    return pa.concat_arrays(chunks) if chunks else pa.array([], type=pa.string())


def _transformed(texts: pa.Array, forms: pa.Array, prefix: pa.Array, middle: pa.Array) -> pa.Array:
    form = _form_numbers(forms)
    pre, mid = (np.asarray(x.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) for x in (prefix, middle))
    out = []
    for piece in pieces(texts, lower=False):
        own = slice(piece.first, piece.first + piece.n_docs)
        out.append(_strings(*scattered(piece, form[own], pre[own], mid[own])))
    return _one(out)


def _restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    form = _form_numbers(forms)
    out = []
    for piece in pieces(outputs, lower=False):
        data, offsets, sound = gathered(piece, form[piece.first:piece.first + piece.n_docs])
        texts = _strings(data, offsets)
        out.append(texts if sound.all() else pa.compute.if_else(pa.array(sound), texts, pa.scalar(None, pa.string())))
    return _one(out)


def output(text: Column | str, form: Column | str, prefix_chars: Column | str, middle_chars: Column | str) -> Column:
    """The text in the given form; lengths are code points and don't count for plain."""
    return F.arrow_udf(_transformed, "string")(text, form, prefix_chars, middle_chars)


def restored(output_text: Column | str, form: Column | str) -> Column:
    """The text that an output was made from."""
    return F.arrow_udf(_restored, "string")(output_text, form)


def transform(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", form_col: str = "form",
    prefix_col: str = "prefix_chars", middle_col: str = "middle_chars", output_col: str = "output",
) -> DataFrame:
    """The documents with form, lengths of prefix and middle (null where plain) and output.

    Cuts and form come from the SHA-256 of ``1:`` and the id, so they are the same in each run."""
    new = (form_col, prefix_col, middle_col, output_col)
    taken = {c.lower() for c in documents.columns} & {c.lower() for c in new}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(documents[id_col].cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    text = F.coalesce(documents[text_col], F.lit(""))
    units = F.length(text) + 1
    low, high = F.least(h1 % units, h2 % units), F.greatest(h1 % units, h2 % units)
    marked = F.contains(text, F.lit(MARKS[0])) | F.contains(text, F.lit(MARKS[1])) | F.contains(text, F.lit(MARKS[2]))
    form = (
        F.when((F.length(text) == 0) | marked | (h3 % 100 >= 100 - PLAIN), "plain")
        .when(h4 % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    )
    framed = documents.withColumns({
        form_col: form,
        prefix_col: F.when(form != "plain", low),
        middle_col: F.when(form != "plain", high - low),
    })
    return framed.withColumn(output_col, output(F.col(text_col), form_col, prefix_col, middle_col))


def query(spark: SparkSession, d: str) -> DataFrame:
    documents = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows = transform(documents).withColumn("restored", restored("output", "form"))
    return rows.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"), "form", "prefix_chars",
        "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = """
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM own
), formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix
  FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
