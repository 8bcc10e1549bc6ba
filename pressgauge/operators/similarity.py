"""Cosine similarity of search terms over user baskets."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge.functions.text import Tokeniser, normalise_delimiters, segment_gate, words
from pressgauge.session import run_path, shuffle_tasks

#: Rows of user and term in one pack of a block.
SLICE = 1 << 20
#: Rows of user and term in one block; a tile's task holds two blocks.
BLOCK = 1 << 22
#: Pairs of terms, each as often as a user has it, in one tile.
TILE = 1 << 27


def search_terms(
    queries: DataFrame, stop_words: Sequence[str] = (), tokeniser: Tokeniser = words
) -> DataFrame:
    """``user_id, term`` of a parsed search log, one row per occurrence, user baskets in long form."""
    stop = list(stop_words)
    raw = F.split(normalise_delimiters(F.col("query")), ",")
    gated = F.flatten(F.transform(raw, lambda w: segment_gate(w, tokeniser)))
    # The outer form: for the plain one Spark adds a test for empty lists that computes the terms again.
    terms = queries.select("user_id", F.explode_outer(gated).alias("term")).where(F.col("term") != "")
    # Stop words count towards a basket cap and are removed after it.
    return terms.withColumn("stop", F.col("term").isin(stop) if stop else F.lit(False))


def cap_baskets(terms: DataFrame, max_distinct: int | None = None) -> DataFrame:
    """Distinct ``user_id, term``, stop words removed; with ``max_distinct`` only of users with at most so many terms."""
    pairs = terms.groupBy("user_id", "term").agg(F.first("stop").alias("stop"))
    if max_distinct is not None:
        over = pairs.groupBy("user_id").count().where(F.col("count") > max_distinct).select("user_id")
        pairs = pairs.join(over, "user_id", "left_anti")
    return pairs.where(~F.col("stop")).select("user_id", "term")


def user_baskets(baskets: DataFrame) -> DataFrame:
    """``user_id, terms``: the distinct terms of a user, sorted."""
    return baskets.groupBy("user_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))


def term_cosine(
    baskets: DataFrame, support: int, min_cosine: float = 0.0, top: int | None = None,
) -> DataFrame:
    """``term_a, term_b, together, cosine`` of term pairs (a < b) that share a user.

    cosine = n(a, b) / sqrt(n(a) n(b)) over distinct users; terms with fewer than ``support`` users take no part, nor
    pairs below ``min_cosine``; with ``top`` only the best pairs of each term stay, ties by the other term.

    Pairs are neither shuffled nor joined. Terms fall into blocks and the pairs of two blocks into a tile; what moves
    are the blocks, packed to some two bytes a term and user, once for each block they meet. A tile's pairs are counted
    where it lies, some terms at a time, and leave it counted, so nothing is spilled whatever the number of pairs.

    With ``min_cosine`` blocks meet only where the counts of their terms allow it, see `close_pairs`.
    """
    counts = baskets.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    # A table, so that its size is known and nothing is computed twice.
    coded = _table(baskets.join(counts, "term").select("user_id", F.col("term").alias("no"), "n"), "term-users")
    counted = close_pairs(coded, min_cosine) if min_cosine > 0 else _together(_pairs(coded))
    cosine = F.col("together") / F.sqrt((F.col("n_a") * F.col("n_b")).cast("double"))
    pairs = counted.select(
        F.least("a", "b").alias("term_a"), F.greatest("a", "b").alias("term_b"), "together", cosine.alias("cosine"),
    ).where(F.col("cosine") >= min_cosine)
    return pairs if top is None else _best(pairs, top)


def _table(df: DataFrame, name: str) -> DataFrame:
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def close_pairs(coded: DataFrame, min_cosine: float) -> DataFrame:
    """``a, b, n_a, n_b, together`` of the pairs of ``user_id, no, n`` whose cosine may reach ``min_cosine`` > 0; those
    that reach it are among them, with their exact numbers of common users.

    Of a pair with n(a) <= n(b) at most n(a) users are common, so n(a) is at least ``t^2 n(b)``. Blocks are ranges of
    counts: those too far apart never meet. Of the others only pairs that have enough common users leave their tile.
    """
    return _together(_pairs(coded, min_cosine))


def _pairs(coded: DataFrame, least: float = 0.0) -> DataFrame:
    """``tile, a, b, n_a, n_b, together``: each pair of terms of ``user_id, no, n`` that share a user, once, counted;
    with ``least`` only those whose cosine may reach it."""
    coded = coded.where("user_id IS NOT NULL")
    # Users travel as numbers; a table, as these must not change.
    users = coded.groupBy("user_id").agg(F.count(F.lit(1)).alias("size")).withColumn("user", F.monotonically_increasing_id())
    users = _table(users, "term-user-numbers")
    rows, pairs = users.agg(F.sum("size"), F.sum(F.col("size").cast("double") * F.col("size"))).first()
    tasks = shuffle_tasks(coded.sparkSession)
    blocks = math.ceil(max(math.sqrt(max((pairs or 0) / TILE, 2 * tasks)), (rows or 0) / BLOCK))
    size = F.lit((rows or 1) / blocks)
    # The blocks of terms of a count, by the places of their rows in the order of counts: one row for each count.
    upto = F.sum("rows").over(W.orderBy("n"))
    counts = coded.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).withColumn("upto", upto)
    place = [F.least(F.floor(c / size), F.lit(blocks - 1)).cast("int") for c in (F.col("upto") - F.col("rows"), F.col("upto") - 1)]
    counts = counts.select("n", place[0].alias("low"), place[1].alias("high"))
    reach, back = _meetings(counts, blocks, least) if least > 0 else ([blocks - 1] * blocks, [0] * blocks)

    slices = math.ceil((rows or 1) / blocks / SLICE)
    placed = coded.join(counts, "n").join(users.select("user_id", "user"), "user_id").select(
        (F.col("low") + F.pmod(F.xxhash64("no"), F.col("high") - F.col("low") + 1)).cast("int").alias("block"),
        # Other bits than the block's.
        F.pmod(F.xxhash64(F.lit(SLICE), "no"), F.lit(slices)).cast("int").alias("slice"), "no", "n", "user",
    )
    of_terms = _table(placed, "term-places").repartition(tasks, "block", "slice").groupBy("block", "slice", "no", "n").agg(
        F.count(F.lit(1)).alias("users"), F.collect_list("user").alias("of"),
    )
    packs = of_terms.groupBy("block", "slice").applyInArrow(_packer(), "block int, terms binary, users binary")

    def tiles(first: Column, last: Column, tile) -> Column:
        return F.transform(F.sequence(first, last), tile)

    block = F.col("block")
    meets = F.concat(
        tiles(block, F.get(F.array(*map(F.lit, reach)), block), lambda j: F.struct((block * blocks + j).alias("tile"), F.lit(False).alias("second"))),
        tiles(F.get(F.array(*map(F.lit, back)), block), block, lambda i: F.struct((i * blocks + block).alias("tile"), F.lit(True).alias("second"))),
    )
    # A block that meets itself is sent once.
    sent = packs.select("terms", "users", F.inline(meets)).where(~F.col("second") | (F.col("tile") % (blocks + 1) != 0))
    sent = sent.repartition(sum(j - i + 1 for i, j in enumerate(reach)), "tile")
    term = coded.schema["no"].dataType
    found = T.StructType([
        T.StructField("tile", T.IntegerType()), T.StructField("a", term), T.StructField("b", term),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "together")],
    ])
    return sent.groupBy("tile").applyInArrow(_counter(blocks, least), found)


def _meetings(counts: DataFrame, blocks: int, least: float) -> tuple[list[int], list[int]]:
    """Of each block the last one, and the first one, whose terms' counts allow the cosine."""
    lowest, highest = [math.inf] * blocks, [0] * blocks
    for n, low, high in counts.collect():
        for k in range(low, high + 1):
            lowest[k], highest[k] = min(lowest[k], n), max(highest[k], n)
    # A block without terms counts as the one before it.
    for k in range(1, blocks):
        highest[k] = max(highest[k], highest[k - 1])
    reach = [max([j for j in range(i, blocks) if highest[i] >= least * least * lowest[j] - 1e-9], default=i) for i in range(blocks)]
    reach = [max(reach[: i + 1]) for i in range(blocks)]
    return reach, [min(i for i in range(j + 1) if reach[i] >= j) for j in range(blocks)]


def _together(pairs: DataFrame) -> DataFrame:
    return pairs.drop("tile")


def _packer():
    """A function over Arrow batches of ``block, slice, no, n, users, of``, the terms of a slice of a block: one row with
    its terms and, term by term, the differences of their users' numbers, both compressed. It holds all it needs, as
    `_counter` does, so that executors need not have this package."""
    def packed(columns: list[pa.Array]) -> bytes:
        batch = pa.RecordBatch.from_arrays(columns, names=[str(k) for k in range(len(columns))])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        return out.getvalue().to_pybytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        no, n, users, of = (pa.concat_arrays(rows.column(c).chunks) for c in ("no", "n", "users", "of"))
        term, user = np.repeat(np.arange(len(no)), users.to_numpy()), of.flatten().to_numpy()
        user = user[np.lexsort((user, term))]
        yield pa.RecordBatch.from_arrays([
            rows.column("block").chunk(0).slice(0, 1), pa.array([packed([no, n, users])], pa.binary()),
            pa.array([packed([pa.array(np.diff(user, prepend=0))])], pa.binary()),
        ], names=["block", "terms", "users"])

    return pack


def _counter(blocks: int, least: float):
    """A function over Arrow batches of ``terms, users, tile, second``, the packs of both blocks of a tile: its pairs,
    counted. Pairs of users are made for some terms of the first block at a time."""
    # Pairs made at once, some 40 bytes each; rows of a result batch.
    piece, batch_rows = 1 << 21, 1 << 16

    def opened(packs: list[tuple[pa.Buffer, pa.Buffer]]):
        terms = [pa.ipc.open_stream(t).read_all() for t, _ in packs]
        no, n, sizes = (pa.concat_arrays([x for t in terms for x in t.column(k).chunks]) for k in range(3))
        user = np.concatenate([np.cumsum(pa.ipc.open_stream(u).read_all().column(0).to_numpy()) for _, u in packs])
        return no, n.to_numpy(), sizes.to_numpy(), user

    def counted(keys: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        if span <= 4 * len(keys):
            together = np.bincount(keys)
            there = np.flatnonzero(together)
            return there, together[there]
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(first, append=len(keys))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, list] = ([], [])
        for batch in batches:
            for terms, users, tile, second in zip(*(batch.column(c) for c in ("terms", "users", "tile", "second")), strict=True):
                sides[second.as_py()].append((terms.as_buffer(), users.as_buffer()))
        number = tile.as_py()
        own = number % (blocks + 1) == 0
        if not sides[0] or not (own or sides[1]):
            return
        no_a, n_a, sizes, users = opened(sides[0])
        no_b, n_b, sizes_b, users_b = (no_a, n_a, sizes, users) if own else opened(sides[1])
        # The terms of the second block by user.
        there, at = np.unique(users_b, return_inverse=True)
        of_user = np.repeat(np.arange(len(no_b), dtype=np.int32), sizes_b)[np.argsort(at, kind="stable")]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(at))))
        place = np.minimum(np.searchsorted(there, users), len(there) - 1)
        begin, pairs = bounds[place], np.where(there[place] == users, bounds[place + 1] - bounds[place], 0)
        made = np.concatenate(([0], np.cumsum(pairs)))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        upto, width, term = made[ends], len(no_b), 0
        while term < len(no_a):
            after = max(int(np.searchsorted(upto, upto[term] + piece, side="right")) - 1, term + 1)
            rows, total, span = slice(ends[term], ends[after]), int(upto[after] - upto[term]), (after - term) * width
            if total:
                kind = np.int32 if max(span, total) < 1 << 31 else np.int64
                # Of each user of a term the places of the other terms, and the key of the pair.
                places = np.repeat(begin[rows] - (made[rows] - upto[term]), pairs[rows]) + np.arange(total)
                base = np.repeat(np.arange(after - term, dtype=kind) * kind(width), sizes[term:after])
                found, together = counted(np.repeat(base, pairs[rows]) + of_user[places], span)
                a, b = np.divmod(found, width)
                a = a + term
                wanted = a < b if own else np.ones(len(a), dtype=bool)
                if least:
                    wanted &= together >= least * np.sqrt(n_a[a].astype(float) * n_b[b]) - 1e-9
                a, b, together = a[wanted], b[wanted], together[wanted].astype(np.int64)
                for first in range(0, len(a), batch_rows):
                    part = slice(first, first + batch_rows)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(a[part]), number, dtype=np.int32)), no_a.take(pa.array(a[part])), no_b.take(pa.array(b[part])),
                        pa.array(n_a[a[part]]), pa.array(n_b[b[part]]), pa.array(together[part]),
                    ], names=["tile", "a", "b", "n_a", "n_b", "together"])
            term = after

    return count


def _best(pairs: DataFrame, top: int) -> DataFrame:
    """Pairs that are among the best ``top`` of either of their terms."""
    w = W.partitionBy("term").orderBy(F.desc("cosine"), "other")
    both = pairs.select("*", F.inline(F.array(
        F.struct(F.col("term_a").alias("term"), F.col("term_b").alias("other")),
        F.struct(F.col("term_b").alias("term"), F.col("term_a").alias("other")),
    )))
    return both.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(pairs.columns).distinct()
