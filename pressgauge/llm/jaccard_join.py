"""Set-similarity join on word shingles by chosen paths.

Documents are sets of five-word shingles; two are linked when their Jaccard similarity is at least 0.8. Equal sets are
one record from the start, so copies cost nothing. Each record is embedded as SKETCH MinHash values, its tokens
``(place, value)``; two records share a token with a probability equal to their similarity.

A run splits the records recursively: every node samples BRANCH of the token places, and a record goes to the child
of each of its sampled tokens. A node with at most LEAF records is compared by brute force on the embeddings; a node
that keeps most of its parent's records (they are alike) or lies at DEPTH is taken as one candidate group as it is.
A pair at the threshold survives a run of depth d with probability ``s(d) = 1 - (1 - threshold s(d-1))^BRANCH``,
``s(0) = 1``; runs are repeated until ``1 - (1 - s(DEPTH))^runs`` reaches the target recall.

Leaves and groups give candidate components; only their members' texts are read again, and within each component all
pairs are verified on the exact shingle sets, in tiles of bounded shingles and records. So the links and their counts
are exact for what the paths retrieve, no list of pairs leaves a task, and neither a large group of copies nor one of near copies
meets in one task.

Defined cases: documents without words (null or empty texts) have no shingles and are linked to none; a document of
one to four words has one shingle; repeated rows are copies of each other; a null id is an id, smaller than others as
a class id; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.graph import connected, written
from pressgauge.llm.textops import U64, components, mix, odd_numbers, pieces, shingles, distinct, whole_groups

K = 5
THRESHOLD = 0.8
TARGET = 0.99999
SKETCH = 64
BRANCH = 2
DEPTH = 10
LEAF = 200
#: Share of its parent's records from which on a node's records count as alike.
ALIKE = 0.7
#: Shingles and records of a block of documents; a tile is a pair of blocks.
BLOCK = 250_000
RECORDS = 2_000
#: Records on each side that are compared at a time within a tile.
SIDE = 1_000
#: Texts that are taken apart at a time.
_STEP = 256


def runs_for(threshold: float, target: float) -> int:
    """Repetitions that reach the target recall for pairs at the threshold."""
    s = 1.0
    for _ in range(DEPTH):
        s = 1 - (1 - threshold * s) ** BRANCH
    return math.ceil(math.log(1 - target) / math.log(1 - s))


def least_agreeing(threshold: float) -> int:
    """Equal places of two embeddings that a pair at the threshold reaches but for one time in a million."""
    tail = 0.0
    for agree in range(SKETCH + 1):
        tail += math.comb(SKETCH, agree) * threshold**agree * (1 - threshold) ** (SKETCH - agree)
        if tail > 1e-6:
            return agree
    return SKETCH


SET_DDL = "struct<c1 bigint, c2 bigint, n int, sketch binary>"
_SET = pa.struct([("c1", pa.int64()), ("c2", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary())])


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    for piece in pieces(texts):
        starts, ends, bounds = piece.words()
        for s in shingles(piece.hashes(starts, ends), bounds, k):
            yield distinct(s)


def embedded(k: int):
    """An Arrow function from texts to a digest of the shingle set, its size and its MinHash values; a set without
    shingles is null."""
    factors = odd_numbers(SKETCH, 11)[:, None]

    def run(texts: pa.Array) -> pa.Array:
        sums = np.zeros((len(texts), 2), dtype=np.int64)
        sizes = np.zeros(len(texts), dtype=np.int32)
        sketches = np.zeros((len(texts), SKETCH), dtype="<u4")
        for row, own in enumerate(_sets(texts, k)):
            if not len(own):
                continue
            low = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=U64)
            for s in range(0, len(own), 4096):
                np.minimum(low, (own[s:s + 4096] * factors).min(axis=1), out=low)
            sums[row] = own.sum().astype(np.int64), mix(own ^ U64(0xA5A5A5A55A5A5A5A)).sum().astype(np.int64)
            sizes[row] = len(own)
            sketches[row] = low >> U64(32)
        return pa.StructArray.from_arrays([
            pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(sizes),
            pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SKETCH), len(texts), [None, pa.py_buffer(sketches)]).cast(pa.binary()),
        ], fields=list(_SET), mask=pa.array(sizes == 0))

    return F.arrow_udf(run, SET_DDL)


def _token(sketch, place):
    """The value at a place of a binary embedding."""
    return F.substring(sketch, place * 4 + 1, F.lit(4))


def _children(node, sketch):
    """Child nodes of a record: BRANCH different token places, drawn from the node's hash."""
    first = F.pmod(F.xxhash64(node, F.lit(0)), F.lit(SKETCH)).cast("int")
    places = [first]
    for j in range(1, BRANCH):
        step = SKETCH // BRANCH
        places.append(F.pmod(first + F.lit(j * step) + F.pmod(F.xxhash64(node, F.lit(j)), F.lit(step)).cast("int"), F.lit(SKETCH)))
    return F.array(*[F.xxhash64(node, p, _token(sketch, p)) for p in places])


def _members(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold several records, with the number of their records."""
    counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(counts, "node")


def candidates(records: DataFrame, threshold: float, target: float) -> DataFrame:
    """``u, v``: star edges between records that may be linked, from all runs of chosen paths."""
    roots = F.array(*[F.lit(-1 - r).cast("bigint") for r in range(runs_for(threshold, target))])
    level = records.select("u", "sketch", F.explode(roots).alias("parent")).select(
        "u", F.lit(None).cast("bigint").alias("parent_size"), F.explode(_children(F.col("parent"), F.col("sketch"))).alias("node"),
    )
    leaves, edges = [], []
    for depth in range(1, DEPTH + 1):
        now = written(_members(level), "nodes")
        leaves.append(now.filter(F.col("size") <= LEAF).select("node", "u"))
        large = now.filter(F.col("size") > LEAF)
        alike = (F.col("size") >= ALIKE * F.coalesce("parent_size", F.lit(1 << 62))) | F.lit(depth == DEPTH)
        least = large.filter(alike).groupBy("node").agg(F.min("u").alias("v"))
        edges.append(large.filter(alike).join(least, "node").select("u", "v"))
        large = large.filter(~alike)
        if large.isEmpty():
            break
        level = large.select("u", "node", "size").join(records.select("u", "sketch"), "u").select(
            "u", F.col("size").alias("parent_size"), F.explode(_children(F.col("node"), F.col("sketch"))).alias("node"),
        )
    small = leaves[0]
    for more in leaves[1:]:
        small = small.union(more)
    # Nodes of different runs often hold the same records; these are compared once. A leaf has at most LEAF of them.
    buckets = small.groupBy("node").agg(F.array_sort(F.collect_list("u")).alias("us"))
    buckets = buckets.groupBy("us").agg(F.min("node").alias("node"))
    rows = buckets.select("node", F.explode("us").alias("u")).join(records.select("u", "sketch"), "u")
    agree = least_agreeing(threshold)
    found = rows.repartition("node").sortWithinPartitions("node").mapInArrow(lambda b: _compared(b, agree), "u bigint, v bigint")
    for more in edges:
        found = found.union(more)
    return found


def _compared(batches: Iterator[pa.RecordBatch], agree: int) -> Iterator[pa.RecordBatch]:
    """Brute force within each leaf, many leaves at a time: star edges of what agrees in enough places."""
    for table in whole_groups(batches, ["node"]):
        u = table.column("u").to_numpy()
        node = table.column("node").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype="<u4").reshape(-1, SKETCH)
        start = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        size = np.diff(np.append(start, len(node)))
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for n in np.unique(size):
            i, j = np.triu_indices(n, 1)
            heads = start[size == n]
            step = max(1, 100_000 // max(len(i), 1))
            for s in range(0, len(heads), step):
                x = (heads[s:s + step, None] + i).ravel()
                y = (heads[s:s + step, None] + j).ravel()
                ok = (sketch[x] == sketch[y]).sum(axis=1) >= agree
                a.append(x[ok])
                b.append(y[ok])
        label = components(len(u), np.concatenate(a), np.concatenate(b))
        own = np.flatnonzero(label != np.arange(len(u)))
        yield pa.RecordBatch.from_arrays([pa.array(u[own]), pa.array(u[label[own]])], names=["u", "v"])


_PLACED_DDL = "u bigint, w bigint, root bigint, blocks int, shingles binary"


def _shingled(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The shingles in place of the texts. Equal rows follow each other as the join leaves them; one of them stays."""
    last = None
    for batch in batches:
        u = batch.column("u").to_numpy()
        new = np.flatnonzero(np.concatenate(([len(u) > 0 and u[0] != last], u[1:] != u[:-1]))[:len(u)])
        last = u[-1] if len(u) else last
        for s in range(0, len(new), _STEP):
            part = batch.take(pa.array(new[s:s + _STEP]))
            own = pa.array([x.tobytes() for x in _sets(part.column("text"), k)], type=pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("u", "w", "root", "blocks")), own], names=["u", "w", "root", "blocks", "shingles"],
            )


def verified(rows: DataFrame, threshold: float, k: int, count: bool = True) -> DataFrame:
    """``u, v, linked``: for every record and tile in which it has links, the documents that it is linked to there
    and a record of the same component. Without ``count`` pairs that are connected already are not looked at, and
    ``linked`` is only above zero.

    ``rows``: u, w (documents of this set), root, blocks (of the root's records), text; equal rows one after another."""
    placed = rows.mapInArrow(lambda b: _shingled(b, k), _PLACED_DDL).withColumn(
        "block", F.pmod(F.xxhash64("u"), "blocks").cast("int"),
    )
    tiles = placed.select(
        "u", "w", "root", "block", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select("u", "w", "root", "block", "shingles", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    keys = ["root", "x", "y"]
    return tiles.repartition(*keys).sortWithinPartitions(*keys, "u").mapInArrow(
        lambda b: _linked(b, threshold, count), "u bigint, v bigint, linked bigint",
    )


def _linked(batches: Iterator[pa.RecordBatch], threshold: float, count: bool = True) -> Iterator[pa.RecordBatch]:
    keys = ["root", "x", "y"]
    for table in whole_groups(batches, keys):
        key = np.stack([table.column(c).to_numpy() for c in keys])
        u, w, block = (table.column(c).to_numpy() for c in ("u", "w", "block"))
        sets = [np.frombuffer(s, dtype=U64) for s in table.column("shingles").to_pylist()]
        start = np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0))))
        out: list[list[np.ndarray]] = [[], [], []]
        for a, b in zip(start, np.append(start[1:], len(u))):
            # A text may come several times, as repeated rows.
            own = a + np.flatnonzero(np.concatenate(([True], u[a + 1:b] != u[a:b - 1])))
            side = block[own] == key[1, a]
            one = np.flatnonzero(side)
            two = one if key[1, a] == key[2, a] else np.flatnonzero(~side)
            if not len(one) or not len(two):
                continue
            label, counts = np.arange(len(own)), np.zeros(len(own), dtype=np.int64)
            for s in range(0, len(one), SIDE):
                # A block with itself: each pair of parts once.
                for t in range(s if two is one else 0, len(two), SIDE):
                    x, y = one[s:s + SIDE], two[t:t + SIDE]
                    if not count and (label[x] == label[x[0]]).all() and (label[y] == label[x[0]]).all():
                        continue
                    link = _similar([sets[i] for i in own[x]], [sets[i] for i in own[y]], threshold)
                    same = two is one and s == t
                    if same:
                        np.fill_diagonal(link, False)
                    counts[x] += link @ w[own[y]]
                    if not same:
                        counts[y] += w[own[x]] @ link
                    i, j = np.nonzero(link)
                    i, j = label[x[i]], label[y[j]]
                    new = i != j
                    label = components(len(own), i[new], j[new])[label]
            hit = np.flatnonzero(counts)
            for part, values in zip(out, (u[own[hit]], u[own[label[hit]]], counts[hit])):
                part.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["u", "v", "linked"])


def _similar(one: list[np.ndarray], two: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether each pair's Jaccard similarity reaches the threshold."""
    sizes = [np.array([len(s) for s in side]) for side in (one, two)]
    both = [np.concatenate(side) for side in (one, two)]
    shared = np.intersect1d(*[distinct(x) for x in both], assume_unique=True)
    inter = np.zeros((len(one), len(two)), dtype=np.float32)
    owner = [np.repeat(np.arange(len(s)), s) for s in sizes]
    place = [np.minimum(np.searchsorted(shared, x), max(len(shared) - 1, 0)) for x in both]
    use = [shared[p] == x if len(shared) else np.zeros(len(x), dtype=bool) for p, x in zip(place, both)]
    step = max(256, (1 << 22) // (len(one) + len(two)))
    for s in range(0, len(shared), step):
        parts = []
        for n, o, p, ok in zip((len(one), len(two)), owner, place, use):
            here = ok & (p >= s) & (p < s + step)
            m = np.zeros((n, step), dtype=np.float32)
            m[o[here], p[here] - s] = 1
            parts.append(m)
        inter += parts[0] @ parts[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - inter
    return inter >= (threshold - 1e-9) * union


def similar_groups(
    documents: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, k: int = K, count: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The rows' sets (``doc_id, key, c1, c2, n``; key is a hash of the text) and, for each set, its class:
    ``c1, c2, class_id, class_key, n_links``.

    A class is a connected component of links; its id is its smallest doc_id. n_links counts the other documents that
    a document is linked to, copies included; without ``count`` it is not to be used.
    """
    key = F.xxhash64("text")
    rows = written(
        documents.select("doc_id", key.alias("key"), embedded(k)("text").alias("s")).select("doc_id", "key", "s.*"), "sets",
    )
    records = written(
        rows.filter("c1 is not null").groupBy("c1", "c2").agg(
            F.count(F.lit(1)).alias("w"), F.min(F.struct("doc_id", "key")).alias("first"), F.first("sketch").alias("sketch"),
            F.first("n").alias("n"),
        ).withColumn("u", F.monotonically_increasing_id()), "records",
    )
    groups = connected(candidates(records, threshold, target), "u", "v").withColumnRenamed("id", "u")
    groups = written(groups.join(records.select("u", "n", "w", "first"), "u"), "groups")
    blocks = groups.groupBy("root").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK, F.count(F.lit(1)) / RECORDS)).cast("int").alias("blocks"),
    )
    wanted = groups.join(blocks, "root").select(
        "u", "w", "root", "blocks", F.col("first.doc_id").alias("id"), F.col("first.key").alias("own"),
    )
    # The members grow with the documents, so they are never broadcast, however few they are here.
    texts = documents.select("doc_id", "text", key.alias("key")).join(
        wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("own")),
    ).select("u", "w", "root", "blocks", "text")
    links = written(verified(texts, threshold, k, count), "links")
    counts = links.groupBy("u").agg(F.sum("linked").alias("linked"))
    classes = connected(links, "u", "v").withColumnRenamed("id", "u")
    named = records.join(counts, "u", "left").join(classes, "u", "left").select(
        "c1", "c2", "first", F.coalesce("root", "u").alias("root"),
        (F.coalesce("linked", F.lit(0)) + F.col("w") - 1).alias("n_links"),
    )
    least = named.groupBy("root").agg(F.min("first").alias("head"))
    classes = named.join(least, "root").select(
        "c1", "c2", F.col("head.doc_id").alias("class_id"), F.col("head.key").alias("class_key"), "n_links",
    )
    return rows.drop("sketch"), written(classes, "classes")


def join(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, n_links`` of every document."""
    rows, classes = similar_groups(documents, **options)
    joined = rows.filter("c1 is not null").join(classes, ["c1", "c2"]).select("doc_id", "class_id", "n_links")
    alone = rows.filter("c1 is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return joined.union(alone)


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the smallest id; columns as they were."""
    rows, classes = similar_groups(documents, count=False, **options)
    own = rows.filter("c1 is not null").join(classes, ["c1", "c2"])
    keep = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
    # What goes, and rows that are there several times; the rest needs no mark.
    marks = own.groupBy("doc_id", "key").agg(F.min(keep).alias("keep"), F.count(F.lit(1)).alias("times")).filter(
        "not keep or times > 1"
    ).select(F.struct("doc_id", "key").alias("__own"), F.struct("keep", "times").alias("__mark"))
    # Like the members above, the marks grow with the documents.
    marked = documents.withColumn("__key", F.xxhash64("text")).join(
        marks.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__own")["doc_id"]) & (F.col("__key") == F.col("__own")["key"]), "left",
    )
    single = marked.filter("__mark is null")
    several = marked.filter("__mark.keep").dropDuplicates(["doc_id", "__key"])
    return single.union(several).select(documents.columns)


def query(spark: SparkSession, d: str) -> DataFrame:
    return join(spark.read.parquet(f"{d}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    return one_of_each(docs)
