"""Toxicity grades by cumulative-link ordinal regression.

``P(grade > k) = 1 / (1 + exp(cut_k - w x))`` for ordered cuts: one weight per text feature is shared by all
thresholds. Features are words and the first four and five bytes of words, hashed; a document's value of a feature is
``log(1 + count)``. The labels say toxic or not; among the toxic ones the grade (1 mild, 2 medium, 3 severe) comes
from the thirds of the number of their words with a toxic-only feature. The result is the expected grade, and a
document is toxic when grade 1 or more is likelier than ``reject``.

The model is fitted on a bounded sample: the MAX_LABELLED labelled documents with the smallest hashes of their ids.

Defined cases: a null or empty text has no features and gets the grade of the cuts alone; labels with a null id or
class are not used, several labels of an id count as the largest; without labels of both classes nothing is toxic;
repeated rows are scored each. Every row is scored by itself, so other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.textops import U64, Piece, pieces

MAX_LABELLED = 8000
REJECT = 0.5
GRADES = 3
_BITS = 30
_PARTS = (4, 5)


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all words of a piece, the document of each, and the words of each document."""
    starts, ends, bounds = piece.words()
    doc = np.repeat(np.arange(piece.n_docs), np.diff(bounds))
    numbers, docs = [piece.hashes(starts, ends) >> U64(64 - _BITS)], [doc]
    for size in _PARTS:
        long = ends - starts >= size
        h = piece.hashes(starts[long], starts[long] + size)
        numbers.append((h * U64(2 * size + 1)) >> U64(64 - _BITS))
        docs.append(doc[long])
    return np.concatenate(numbers).astype(np.int64), np.concatenate(docs), np.diff(bounds)


def _counted(texts: pa.Array) -> pa.Array:
    rows = []
    for piece in pieces(texts):
        number, doc, _ = features(piece)
        key, count = np.unique(doc << _BITS | number, return_counts=True)
        at = np.searchsorted(key >> _BITS, np.arange(piece.n_docs + 1))
        rows += [
            {"number": (key[a:b] & ((1 << _BITS) - 1)).astype(np.int32), "count": count[a:b].astype(np.int32)}
            for a, b in zip(at[:-1], at[1:])
        ]
    return pa.array(rows, type=pa.struct([("number", pa.list_(pa.int32())), ("count", pa.list_(pa.int32()))]))


class Model:
    """Weights of chosen features and ordered cuts."""

    def __init__(self, number: np.ndarray, weight: np.ndarray, cuts: np.ndarray):
        order = np.argsort(number)
        self.number, self.weight, self.cuts = number[order], weight[order], cuts

    def chances(self, value: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.cuts[None, :] - value[:, None]))

    def values(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for piece in pieces(texts):
            number, doc, _ = features(piece)
            at = np.minimum(np.searchsorted(self.number, number), len(self.number) - 1)
            hit = self.number[at] == number if len(self.number) else np.zeros(len(number), dtype=bool)
            key, count = np.unique(doc[hit] << _BITS | at[hit], return_counts=True)
            part = self.weight[key & ((1 << _BITS) - 1)] * np.log1p(count) if len(key) else np.zeros(0)
            out.append(np.bincount(key >> _BITS, weights=part, minlength=piece.n_docs))
        return np.concatenate(out)


def grades(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """0 for the documents that aren't toxic, else 1 to 3 by the third of the toxic documents' hits."""
    if not toxic.any():
        return np.zeros(len(toxic), dtype=np.int64)
    thirds = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + (hits[:, None] > thirds).sum(axis=1), 0)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 800, keep: float = 4.0) -> Model:
    """From feature numbers, counts and toxic (0 or 1) of some documents."""
    toxic = np.array([bool(t) for _, _, t in rows], dtype=bool)
    none = Model(np.zeros(0, dtype=np.int64), np.zeros(0), np.full(GRADES, 50.0))
    if not toxic.any() or toxic.all():
        return none
    known, number = np.unique(np.concatenate([n for n, _, _ in rows]), return_inverse=True)
    count = np.concatenate([c for _, c, _ in rows])
    doc = np.repeat(np.arange(len(rows)), [len(n) for n, _, _ in rows])
    with_it = np.bincount(number, minlength=len(known)).astype(float)
    in_toxic = np.bincount(number[toxic[doc]], minlength=len(known))
    # Features whose share of toxic documents is far from the base rate, in standard errors.
    rate = toxic.mean()
    z = (in_toxic - with_it * rate) / np.sqrt(with_it * rate * (1 - rate))
    chosen = np.flatnonzero((np.abs(z) > keep) & (with_it >= 3))
    if not len(chosen):
        return none
    only = (z > keep) & (with_it >= 3) & (in_toxic >= 0.9 * with_it)
    grade = grades(toxic, np.bincount(doc, weights=count * only[number], minlength=len(rows)))
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[number] >= 0
    doc, col, x = doc[use], place[number[use]], np.log1p(count[use])
    above = (grade[:, None] > np.arange(GRADES)).astype(float)
    # Ordered cuts: the first one and the logarithms of the gaps. Adam on the penalised likelihood.
    par = np.concatenate([np.zeros(len(chosen)), [1.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for t in range(1, rounds + 1):
        w, cuts = par[:len(chosen)], _cuts(par[len(chosen):])
        value = np.bincount(doc, weights=x * w[col], minlength=len(rows))
        p = Model(chosen, w, cuts).chances(value)
        # Chance of each grade as a difference of neighbours, and its slope.
        full = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], axis=1)
        slope = full * (1 - full)
        at = np.arange(len(rows))
        own = np.maximum(full[at, grade] - full[at, grade + 1], 1e-9)
        dvalue = (slope[at, grade] - slope[at, grade + 1]) / own
        dcut = np.zeros(GRADES)
        np.add.at(dcut, grade[grade > 0] - 1, -(slope[at, grade] / own)[grade > 0])
        np.add.at(dcut, grade[grade < GRADES], (slope[at, grade + 1] / own)[grade < GRADES])
        gaps = np.exp(par[len(chosen) + 1:])
        dpar = np.concatenate([[dcut.sum()], [dcut[k + 1:].sum() * g for k, g in enumerate(gaps)]])
        g = np.concatenate([np.bincount(col, weights=x * dvalue[doc], minlength=len(chosen)) - 0.01 * w, dpar]) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Model(known[chosen].astype(np.int64), par[:len(chosen)], _cuts(par[len(chosen):]))


def _cuts(par: np.ndarray) -> np.ndarray:
    return par[0] + np.concatenate([[0.0], np.cumsum(np.exp(par[1:]))])


def trained(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    """A model from at most ``most`` labelled documents."""
    own = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    counted = F.arrow_udf(_counted, "struct<number array<int>, count array<int>>")
    # The sample has at most ``most`` pairs of numbers, so it can go to every task. A repeated document counts once;
    # of several texts of an id the one with the smallest hash is taken.
    found = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"),
    )
    table = found.select("doc_id", "toxic", counted("text").alias("x")).orderBy("doc_id").toArrow()
    x = table.column("x").combine_chunks()
    parts = [
        (x.field(name).flatten().to_numpy(), np.cumsum([0, *[len(r) for r in x.field(name)]]))
        for name in ("number", "count")
    ]
    (number, at), (count, _) = parts
    return fit([
        (number[a:b], count[a:b], t) for a, b, t in zip(at[:-1], at[1:], table.column("toxic").to_pylist())
    ])


def severity(model: Model, text: str = "text") -> Column:
    """A column ``struct<severity, toxic_chance>``: the expected grade and the chance of grade 1 or more."""
    def run(texts: pa.Array) -> pa.Array:
        p = model.chances(model.values(texts))
        return pa.StructArray.from_arrays([pa.array(p.sum(axis=1)), pa.array(p[:, 0])], names=["severity", "toxic_chance"])

    return F.arrow_udf(run, "struct<severity double, toxic_chance double>")(F.col(text))


def score(documents: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``doc_id, severity, toxic_chance, toxic`` of every document."""
    out = documents.select("doc_id", severity(trained(documents, labels)).alias("s"))
    return out.select("doc_id", "s.*", (F.col("s.toxic_chance") >= reject).alias("toxic"))


def clean(documents: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The documents that aren't toxic; columns as they were."""
    return documents.filter(severity(trained(documents, labels))["toxic_chance"] < reject)


def query(spark: SparkSession, d: str) -> DataFrame:
    return score(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def stage(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    return clean(docs, spark.read.parquet(f"{d}/labels.parquet"))
