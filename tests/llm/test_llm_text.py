"""Text helpers, connected components and global ranks against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressgauge.llm import textops
from pressgauge.llm.graph import connected
from pressgauge.llm.ranks import ranked

TEXTS = ["", None, "One two, three FOUR five six", "ñandú über", "x", "a b c d e", "--", "one two three four five six", "é" * 40]


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def test_words_and_shingles(monkeypatch):
    for size in (10, 1 << 20):
        monkeypatch.setattr(textops, "PIECE_BYTES", size)
        found, sets = [], []
        for piece in textops.pieces(pa.array(TEXTS)):
            starts, ends, bounds = piece.words()
            raw = piece.data.tobytes()
            for a, b in zip(bounds[:-1], bounds[1:]):
                found.append([raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])])
            sets += textops.shingles(piece.hashes(starts, ends), bounds, 5)
        assert found == [words(t) for t in TEXTS]
        assert [len(s) for s in sets] == [max(len(w) - 4, min(len(w), 1)) for w in found]
        assert (sets[2] == sets[7]).all()


def test_hash_equals_for_equal_substrings_only():
    piece = next(textops.pieces(pa.array(["abcabcabd"])))
    h = piece.hashes(np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert h[0] == h[1] != h[2]


def test_whole_groups():
    keys = [1, 1, 2, 3, 3, 3, 4]
    for step in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_pydict({"k": keys[s:s + step]}) for s in range(0, 7, step)]
        tables = [t.column("k").to_pylist() for t in textops.whole_groups(iter(batches), ["k"])]
        assert sum(tables, []) == keys
        assert all(not set(a) & set(b) for a, b in zip(tables, tables[1:]))


def brute_components(edges):
    label = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_connected(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    edges += [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 260)]
    df = spark.createDataFrame(edges + [(5, 5), (None, 3), (4, None)] + edges[:3], "a int, b int")
    got = {r["id"]: r["root"] for r in connected(df, "a", "b").collect()}
    assert got == brute_components([e for e in edges if e[0] != e[1]])
    assert connected(df.limit(0), "a", "b").count() == 0


def test_ranked(spark):
    rows = [(k % 7 if k % 11 else None, f"r{k}") for k in range(100)]
    got = ranked(spark.createDataFrame(rows, "k int, v string"), [F.col("k").asc_nulls_last(), F.col("v").desc()]).collect()
    got = [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["rank"])]
    by_name = sorted(rows, key=lambda r: r[1], reverse=True)
    assert got == sorted(by_name, key=lambda r: (r[0] is None, r[0] or 0))
    assert ranked(spark.createDataFrame([], "k int"), [F.col("k")]).count() == 0
