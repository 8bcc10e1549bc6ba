"""TextRank: PageRank over the word-neighbourhood graph of each document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pressgauge.session import shuffle_tasks


def neighbourhoods(docs: DataFrame, window: int, doc: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``doc, pos, word, neighbours``: the words up to ``window`` positions to either side."""
    t = F.col(tokens)
    items = docs.select(doc, F.posexplode_outer(t).alias("pos", "word"), tokens).where(F.col("pos").isNotNull())
    before = F.slice(t, F.greatest(F.col("pos") - window + 1, F.lit(1)), F.least(F.col("pos"), F.lit(window)))
    after = F.slice(t, F.col("pos") + 2, F.lit(window))
    return items.select(doc, "pos", "word", F.concat(before, after).alias("neighbours"))


def word_graph(
    docs: DataFrame, window: int, doc: str = "doc_id", tokens: Column | str = "tokens",
) -> DataFrame:
    """Distinct ``doc, word, neighbour``; a word that repeats within the window neighbours itself. Rows of equal ``doc``
    are texts of one document."""
    def edges(at: np.ndarray, to: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, None]:
        return at, to, None

    return _of_documents(docs, doc, tokens, "neighbour", None, _per_document(window, ["word", "neighbour"], edges))


def degrees(docs: DataFrame, window: int, doc: str = "doc_id", tokens: Column | str = "tokens") -> DataFrame:
    """``doc, word, degree``: how many neighbours a word has in the :func:`word_graph`, counted where that is made."""
    def counted(at: np.ndarray, to: np.ndarray, n: int) -> tuple[np.ndarray, None, np.ndarray]:
        degree = np.bincount(at, minlength=n)
        there = np.flatnonzero(degree)
        return there, None, degree[there]

    return _of_documents(docs, doc, tokens, "degree", T.LongType(), _per_document(window, ["word", "degree"], counted))


def _of_documents(docs: DataFrame, doc: str, tokens: Column | str, name: str, kind: T.DataType | None, run) -> DataFrame:
    """``doc, word`` and a column of ``kind`` (None: of a word's) that ``run`` makes of each document's list of token
    lists. Documents move once; ``tokens`` is as in :func:`textrank`."""
    placed = _by_document(docs.select(doc, tokens) if isinstance(tokens, str) else docs, doc)
    given = placed.select(doc, (F.col(tokens) if isinstance(tokens, str) else tokens).alias("word"))
    key, words = given.schema.fields
    word = words.dataType.elementType
    result = T.StructType([key, T.StructField("word", word), T.StructField(name, kind or word)])
    return given.groupBy(doc).agg(F.collect_list("word").alias("word")).mapInArrow(run, result)


def _by_document(docs: DataFrame, doc: str) -> DataFrame:
    """One row per document moves once; later groupings by document and word keep the partitioning."""
    return docs.repartition(shuffle_tasks(docs.sparkSession), doc)


def textrank(
    docs: DataFrame, window: int, steps: int, damping: float = 0.85, doc: str = "doc_id",
    tokens: Column | str = "tokens",
) -> DataFrame:
    """``doc, word, score`` for the words of every document, one row per document; a word without any neighbour is left out.

    ``tokens`` is a token-array column, or an expression that makes one; an expression is computed after
    the shuffle, so that the text moves and not its tokens.

    The graph of a document is symmetric and at most ``window`` edges a token, so documents are shuffled once, by
    ``doc``, and ranked where they lie, many short ones or one long one at a time: distinct edges as sorted numbers,
    each step a weighted count over them. Memory and time are linear in the tokens of a document.
    """
    if steps < 1:
        raise ValueError("steps must be positive")
    placed = _by_document(docs.select(doc, tokens) if isinstance(tokens, str) else docs, doc)
    given = placed.select(doc, (F.col(tokens) if isinstance(tokens, str) else tokens).alias("word"))
    key, words = given.schema.fields
    result = T.StructType([key, T.StructField("word", words.dataType.elementType), T.StructField("score", T.DoubleType())])
    return given.mapInArrow(_ranker(window, steps, damping), result)


def _ranker(window: int, steps: int, damping: float):
    """A function over Arrow batches of documents and their token lists."""
    def ranked(at: np.ndarray, to: np.ndarray, n: int) -> tuple[np.ndarray, None, np.ndarray]:
        degree = np.bincount(at, minlength=n)
        rank = np.ones(n)
        for _ in range(steps):
            share = rank / np.maximum(degree, 1)
            rank = np.bincount(at, weights=share[to], minlength=n) * damping + (1.0 - damping)
        there = np.flatnonzero(degree)
        return there, None, rank[there]

    return _per_document(window, ["word", "score"], ranked)


def _per_document(window: int, names: list[str], finish):
    """A function over Arrow batches of documents and their token lists (or lists of such lists). Of the edges of some
    documents' graphs, both directions of each, and the number of vertices ``finish`` makes the vertices of the result
    and beside them others or values. It holds all it needs, so that executors need not have this package."""
    # Of many short documents; what a piece needs in memory is some 200 bytes a token. Also the rows of a result batch.
    piece_tokens = 1 << 17

    def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # A sort of 64-bit numbers takes a tenth of np.unique's time.
        both = np.sort(np.concatenate((a, b)))
        return both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both

    def edges(vertex: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Both directions of the distinct pairs of vertices at most ``window`` places apart in a row."""
        pairs = np.zeros(0, dtype=np.int64)
        for away in range(1, min(window, len(vertex) - 1) + 1):
            same = row[:-away] == row[away:]
            a, b = vertex[:-away][same], vertex[away:][same]
            pairs = merged(pairs, np.minimum(a, b) * n + np.maximum(a, b))
        low, high = np.divmod(pairs, n) if len(pairs) else (pairs, pairs)
        loops = low == high
        both = np.sort(np.concatenate((pairs, high[~loops] * n + low[~loops])))
        return np.divmod(both, n) if len(both) else (both, both)

    def lengths(lists: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def made(name: str, keys: pa.Array, lists: pa.Array) -> Iterator[pa.RecordBatch]:
        of = np.arange(len(lists))
        if pa.types.is_list(lists.type.value_type):
            of, lists = np.repeat(of, lengths(lists)), lists.flatten()
        row = np.repeat(np.arange(len(lists)), lengths(lists))
        coded = lists.flatten().dictionary_encode(null_encoding="encode")
        width = max(len(coded.dictionary), 1)
        places = of[row] * width + coded.indices.to_numpy(zero_copy_only=False)
        distinct, vertex = np.unique(places, return_inverse=True)
        found, others, values = finish(*edges(vertex, row, len(distinct)), len(distinct))
        for first in range(0, len(found), piece_tokens):
            part = slice(first, first + piece_tokens)
            doc, word = np.divmod(distinct[found[part]], width)
            beside = pa.array(values[part]) if others is None else coded.dictionary.take(pa.array(distinct[others[part]] % width))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(doc)), coded.dictionary.take(pa.array(word)), beside], names=[name, *names],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, (keys, lists) = batch.schema.names[0], batch.columns
            ends = np.cumsum(lengths(lists))
            if pa.types.is_list(lists.type.value_type):
                ends = np.concatenate(([0], np.cumsum(lengths(lists.flatten()))))[ends]
            first, done = 0, 0
            while first < len(lists):
                last = max(int(np.searchsorted(ends, done + piece_tokens, side="right")), first + 1)
                yield from made(name, keys.slice(first, last - first), lists.slice(first, last - first))
                first, done = last, int(ends[last - 1])

    return run


def by_score(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Each document's words in descending score, ties by word."""
    return scores.orderBy(doc, F.desc("score"), "word")


def top_words(scores: DataFrame, n: int, doc: str = "doc_id") -> DataFrame:
    """The ``n`` best words per document, ties by word."""
    w = W.partitionBy(doc).orderBy(F.desc("score"), "word")
    return scores.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
