import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import pytest

from pressgauge.operators import similarity


def brute(baskets, support):
    n = Counter(t for b in baskets.values() for t in b)
    both = Counter(p for b in baskets.values() for p in combinations(sorted(b), 2))
    return {
        (a, b): (c, round(c / math.sqrt(n[a] * n[b]), 9))
        for (a, b), c in both.items() if n[a] >= support and n[b] >= support
    }


@pytest.mark.parametrize("size", [1000, 3])
@pytest.mark.parametrize("support", [1, 3])
def test_cosine_equals_brute_force(spark, monkeypatch, size, support):
    monkeypatch.setattr(similarity, "SLICE", size)
    rng = random.Random(3)
    vocab = [f"t{k}" for k in range(25)]
    baskets = {f"u{u}": set(rng.sample(vocab, rng.randint(1, 8))) for u in range(30)}
    baskets["heavy"] = set(vocab)
    df = spark.createDataFrame([(u, t) for u, b in baskets.items() for t in b], "user_id string, term string")
    got = {
        (r["term_a"], r["term_b"]): (r["together"], round(r["cosine"], 9))
        for r in similarity.term_cosine(df, support).collect()
    }
    assert got == brute(baskets, support)


def test_cap_counts_stop_words_and_drops_whole_users(spark, rows):
    queries = spark.createDataFrame(
        [("u1", "a b stop"), ("u2", "a b c stop"), ("u1", "b")], "user_id string, query string"
    )
    terms = similarity.search_terms(queries, ["stop"])
    assert rows(similarity.cap_baskets(terms, 3), "user_id", "term") == {("u1", "a"), ("u1", "b")}
    assert rows(similarity.cap_baskets(terms), "user_id", "term") == {
        ("u1", "a"), ("u1", "b"), ("u2", "a"), ("u2", "b"), ("u2", "c")
    }


def test_least_cosine_and_best_pairs(spark):
    rng = random.Random(4)
    baskets = {f"u{u}": set(rng.sample([f"t{k}" for k in range(12)], rng.randint(2, 6))) for u in range(40)}
    df = spark.createDataFrame([(u, t) for u, b in baskets.items() for t in b], "user_id string, term string")
    all_pairs = {p: c for p, (_, c) in brute(baskets, 1).items()}
    got = {(r["term_a"], r["term_b"]) for r in similarity.term_cosine(df, 1, min_cosine=0.4).collect()}
    assert got == {p for p, c in all_pairs.items() if c >= 0.4} and got
    best = set()
    for t in {t for p in all_pairs for t in p}:
        own = sorted((-c, (set(p) - {t}).pop(), p) for p, c in all_pairs.items() if t in p)
        best |= {p for _, _, p in own[:2]}
    rows = similarity.term_cosine(df, 1, top=2).collect()
    assert {(r["term_a"], r["term_b"]) for r in rows} == best and len(rows) == len(best)


def test_pairs_are_counted_before_the_shuffle(spark):
    df = spark.createDataFrame([("u", "a"), ("u", "b")], "user_id string, term string")
    plan = similarity.term_cosine(df, 1)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan


@pytest.mark.parametrize("least", [0.1, 0.3, 0.5, 0.8, 1.0])
def test_close_pairs_with_large_baskets(spark, least):
    """Some users have most terms; pairs are found although their baskets are looked at last."""
    rng = random.Random(6)
    vocab = [f"t{k}" for k in range(40)]
    baskets = {f"u{u}": set(rng.sample(vocab[:30], rng.randint(1, 4))) for u in range(60)}
    for u in range(8):
        baskets[f"large{u}"] = set(rng.sample(vocab, 30))
    baskets["twins"] = baskets["twins again"] = {"t38", "t39", "x", "y"}
    df = spark.createDataFrame([(u, t) for u, b in baskets.items() for t in b], "user_id string, term string")
    got = {
        (r["term_a"], r["term_b"]): (r["together"], round(r["cosine"], 9))
        for r in similarity.term_cosine(df, 2, min_cosine=least).collect()
    }
    assert got == {p: x for p, x in brute(baskets, 2).items() if x[1] >= least - 1e-12} and got


def test_close_pairs_make_fewer(spark, monkeypatch):
    """Pairs that are made before they are counted, with and without a least cosine."""
    rng = random.Random(7)
    vocab = [f"t{k}" for k in range(60)]
    baskets = {f"u{u}": set(rng.sample(vocab, 4)) for u in range(400)}
    baskets |= {f"large{u}": set(vocab) for u in range(5)}
    df = spark.createDataFrame([(u, t) for u, b in baskets.items() for t in b], "user_id string, term string")
    made = []
    plain = similarity._together

    def counted(pairs, *more):
        made.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(similarity, "_together", counted)
    similarity.term_cosine(df, 2)
    similarity.term_cosine(df, 2, min_cosine=0.5)
    assert made[1] < made[0] / 4


@pytest.mark.parametrize("least", [0.0, 0.2])
def test_pairs_are_not_shuffled(spark, monkeypatch, least):
    """A tile's pairs are counted where they are made, and no names are joined to them."""
    monkeypatch.setattr(similarity, "TILE", 20)
    monkeypatch.setattr(similarity, "SLICE", 5)
    rng = random.Random(8)
    vocab = [f"t{k}" for k in range(30)]
    baskets = {f"u{u}": set(rng.sample(vocab, rng.randint(1, 20))) for u in range(40)}
    df = spark.createDataFrame([(u, t) for u, b in baskets.items() for t in b], "user_id string, term string")
    plans, plain = [], similarity._together

    def seen(pairs, *more):
        out = plain(pairs, *more)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(similarity, "_together", seen)
    pairs = similarity.term_cosine(df, 2, min_cosine=least)
    got = {(r["term_a"], r["term_b"]): (r["together"], round(r["cosine"], 9)) for r in pairs.collect()}
    assert got == {p: x for p, x in brute(baskets, 2).items() if x[1] >= least}
    assert len(plans) == 1 and not re.search(r"Exchange hashpartitioning\([^)]*\bb#", plans[0])
    if not least:
        assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [tile")[0]


def packed_sizes(blocks, least):
    """In place of a tile's pairs one row with the bytes of what was sent to it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, tile = 0, None
        for batch in batches:
            tile = batch.column("tile").slice(0, 1)
            size += sum(len(x.as_py()) for c in ("terms", "users") for x in batch.column(c))
        name, one = pa.array(["x"]), pa.array([1])
        yield pa.RecordBatch.from_arrays([tile, name, name, one, one, pa.array([size])], names=["tile", "a", "b", "n_a", "n_b", "together"])

    return count


def test_little_is_sent_to_tiles(spark, monkeypatch):
    """Blocks are packed: a few bytes for each user of a term and tile, where a row of parts of baskets took a hundred."""
    rng = random.Random(9)
    rows = [(f"user{u}", f"t{t}", 200) for u in range(1500) for t in rng.sample(range(300), 40)]
    coded = spark.createDataFrame(rows, "user_id string, no string, n bigint")
    monkeypatch.setattr(similarity, "_counter", packed_sizes)
    sizes = [r["together"] for r in similarity._pairs(coded).collect()]
    # 4 blocks, each sent to 4 tiles.
    assert len(sizes) == 10 and sum(sizes) < 4 * 4 * len(rows)


def test_blocks_whose_counts_allow_no_close_pair_do_not_meet(spark, monkeypatch):
    coded = spark.createDataFrame(
        [(f"u{u}", f"t{n}-{t}", n) for n in (3, 300) for t in range(1200 // n) for u in range(n)], "user_id string, no string, n bigint",
    )
    monkeypatch.setattr(similarity, "_counter", packed_sizes)
    assert similarity._pairs(coded, 0.5).count() < similarity._pairs(coded).count()


def test_cosine_of_packs_of_all_sizes(spark, monkeypatch):
    """Repeated rows and users without a name as before; blocks of several packs, of one term and of none."""
    rng = random.Random(10)
    baskets = {f"u{u}": rng.sample(range(90), rng.randint(1, 30)) for u in range(60)}
    rows = [(u, f"t{t}") for u, b in baskets.items() for t in b] + [(f"u{u}", "everywhere") for u in range(60)]
    rows += [("u1", "t1"), ("u1", "t1"), ("u1", "t2"), (None, "t3"), (None, "t4"), ("u2", None)]
    df = spark.createDataFrame(rows, "user_id string, term string")
    n = Counter(t for _, t in rows)
    times = Counter(rows)
    both = Counter()
    for (u, a), x in times.items():
        for (v, b), y in times.items():
            if u is not None and u == v and a is not None and b is not None and a < b:
                both[a, b] += x * y
    for size in (7, 1 << 20):
        monkeypatch.setattr(similarity, "SLICE", size)
        for least in (0.0, 0.3):
            got = {(r["term_a"], r["term_b"]): r["together"] for r in similarity.term_cosine(df, 2, min_cosine=least).collect()}
            assert got == {p: c for p, c in both.items() if n[p[0]] >= 2 and n[p[1]] >= 2 and c / math.sqrt(n[p[0]] * n[p[1]]) >= least}
