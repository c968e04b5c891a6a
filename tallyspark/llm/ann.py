"""Nearest neighbours by a forest of random-projection trees.

The trees are cut on the driver from a sample of about ``SAMPLE`` vectors: a node's hyperplane is the difference of two of
its vectors, its threshold the median of their projections.  Every vector is then sent down every tree in the tasks.  A
query searches all trees through one priority queue of nodes, ordered by how far the query lies on the other
side of the cuts above them, until the leaves it has taken hold ``share`` of all vectors.  Leaves meet their queries by a
shuffle on (tree, leaf, part); a leaf is dealt into parts of about ``PART`` vectors, so equal vectors, which no
hyperplane parts, do not gather in one task.  Each part measures exact distances in double precision and keeps the k
nearest for each query; the k nearest of these are the answer.

A vector that a query meets in several trees is measured in the first of them: the query brings the leaves that it takes, the
vector its leaf in every tree.  Queries are dealt into blocks of about ``BLOCK`` where there are more.

``share`` is what the data need: for vectors without any cluster structure (isotropic, 64 dimensions) most of the recall
comes late, for clustered ones a small share suffices.  A search takes ``LEAST`` vectors at any rate, so small inputs, whose few
leaves part neighbours coarsely, are searched whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SAMPLE, TREES, LEAF, SHARE, PART, K = 16_384, 6, 128, 1.5, 4096, 10
LEAST, BLOCK = 20_000, 16_384


def usable(vector: Column) -> Column:
    """Neither null, empty or zero nor holding null or non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Tree:
    """Nodes by number, 0 the root: normal, threshold, left and right child (negative: leaf -1 - child)."""

    def __init__(self, x: np.ndarray, random: np.random.Generator):
        self.normal, self.cut, self.kids, self.leaves = [], [], [], 0
        self.top = self.grow(x, random)
        width = x.shape[1] if x.ndim == 2 else 0
        self.normal = np.array(self.normal, np.float64).reshape(len(self.kids), width)
        self.cut, self.kids = np.array(self.cut, np.float64), np.array(self.kids, np.int64).reshape(len(self.kids), 2)

    def grow(self, x: np.ndarray, random: np.random.Generator) -> int:
        if len(x) > LEAF:
            for _ in range(3):
                a, b = x[random.choice(len(x), 2, replace=False)]
                normal = (a - b) / (np.linalg.norm(a - b) or 1.0)
                at = x @ normal
                cut = float(np.median(at))
                left = at < cut
                if 0 < left.sum() < len(x):
                    me = len(self.kids)
                    self.normal.append(normal)
                    self.cut.append(cut)
                    self.kids.append((0, 0))
                    self.kids[me] = (self.grow(x[left], random), self.grow(x[~left], random))
                    return me
        self.leaves += 1
        return -self.leaves

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector."""
        at = np.full(len(x), self.top)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            right = np.einsum("ij,ij->i", x[inner], self.normal[node]) >= self.cut[node]
            at[inner] = self.kids[node, right.astype(int)]
        return -1 - at


def search(trees: list[Tree], held: list[np.ndarray], q: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of the shared queue until the leaves hold ``enough`` vectors; ``held``: vectors by leaf."""
    sides = [t.normal @ q - t.cut for t in trees]
    queue = [(0.0, i, t.top) for i, t in enumerate(trees)]
    heapq.heapify(queue)
    out, got = [], 0.0
    while queue and got < enough:
        far, i, at = heapq.heappop(queue)
        while at >= 0:
            side = sides[i][at]
            near = int(side >= 0)
            heapq.heappush(queue, (max(far, abs(float(side))), i, int(trees[i].kids[at, 1 - near])))
            at = int(trees[i].kids[at, near])
        if held[i][-1 - at]:
            out.append((i, -1 - at))
            got += held[i][-1 - at]
    return out


def nearest(rows: DataFrame, queries: Column, k: int = K, share: float = SHARE, trees: int = TREES, seed: int = 11, least: int = LEAST) -> DataFrame:
    """The k nearest rows found for each row of ``rows`` (vec_id, embedding; others are left out) that ``queries`` selects.

    Columns: query_id, rank (from 1), vec_id, score (Euclidean distance of the original vectors, in double precision); nearest
    first, ties to the smaller vec_id; every row but those of the query's own vec_id is a candidate; all
    candidates if there are fewer than k.  Vectors that are not ``usable``, null vec_ids and vectors of another length than
    most take no part.  A vec_id of several rows is met once, by its nearest; as a query it is its least vector.  ``share``
    counts vectors over all trees, a vector as often as it is met; ``least`` is the least number so counted.
    """
    good = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    lengths = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    n, length = (lengths[0]["count"], lengths[0]["n"]) if lengths else (0, 0)
    good = good.where(F.size("embedding") == length)
    part = min(1.0, SAMPLE / max(1, n))
    # about SAMPLE vectors, equal rows once, which bounds the trees that go with the tasks
    sample = good.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))).distinct().toArrow()
    x = np.array(sample.column("embedding").to_pylist(), np.float64).reshape(sample.num_rows, length)
    x = x[np.lexsort([*x.T[::-1], sample.column("vec_id").to_numpy()])] if len(x) else x
    grown = [Tree(x, np.random.default_rng(seed + i)) for i in range(trees)]

    def vectors(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), length)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors(batch.column(1))
            leaves = np.column_stack([t.leaf(v) for t in grown]).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * trees, pa.int32()), pa.array(leaves))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "embedding", "leaves"])

    kind = "vec_id long, embedding array<double>"
    # a number of its own for each row, fixed by writing it: rows that repeat are dealt over a leaf's parts as others are
    indexed = written(good.mapInArrow(index, f"{kind}, leaves array<long>").withColumn("row", F.xxhash64(F.monotonically_increasing_id())), "forest")
    in_leaf = indexed.select("*", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = in_leaf.groupBy("tree", "leaf").count()
    held = [np.zeros(max(1, t.leaves)) for t in grown]
    for tree, leaf, count in sizes.collect():  # as many rows as the forest has leaves
        held[tree][leaf] = count
    enough = max(share * n, least)
    first = np.concatenate([[0], np.cumsum([len(h) for h in held])])  # number of each tree's first leaf

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                some = batch.slice(s, 256)
                taken = [search(grown, held, q, enough) for q in vectors(some.column(1))]
                marks = np.zeros((len(taken), first[-1]), bool)  # the leaves that each query takes
                for i, found in enumerate(taken):
                    marks[i, [first[t] + f for t, f in found]] = True
                marks = [m.tobytes() for m in np.packbits(marks, axis=1)]
                found = [[(t, f, p) for t, f in found for p in range(max(1, -(-int(held[t][f]) // PART)))] for found in taken]
                which = np.repeat(np.arange(len(found)), [len(f) for f in found])
                t, f, p = np.array([x for y in found for x in y], np.int64).reshape(-1, 3).T
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays([some.column(0).take(at), some.column(1).take(at), pa.array(marks, pa.binary()).take(at), *map(pa.array, (t.copy(), f.copy(), p.copy()))],
                                                 ["vec_id", "embedding", "taken", "tree", "leaf", "part"])

    asked = written(good.where(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    asked = asked.mapInArrow(look, f"{kind}, taken binary, tree long, leaf long, part long").withColumn("block", block("vec_id"))
    of = F.create_map(*[y for t, row in enumerate(held) for y in (F.lit(t), F.array(*[F.lit(int(max(1, -(-c // PART)))) for c in row]))])
    dealt = (in_leaf.withColumn("tree", F.col("tree").cast("long")).withColumn("part", F.pmod("row", of[F.col("tree").cast("int")][F.col("leaf").cast("int")]).cast("long"))
             .drop("row").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k nearest vectors of one part of a leaf for each of its queries, but for those met in a tree before."""
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        ids, v = left.column("vec_id").to_numpy(), vectors(left.column("embedding").combine_chunks())
        own, q = right.column("vec_id").to_numpy(), vectors(right.column("embedding").combine_chunks())
        tree = left.column("tree")[0].as_py()
        leaves = left.column("leaves").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :tree] + first[:tree]
        taken = right.column("taken").to_pylist()
        out, repeated, met = [], len(np.unique(ids)) < len(ids), np.zeros((0, len(ids)), bool)
        for i in range(len(own)):
            if i % 256 == 0:  # which vectors the next queries met in an earlier tree
                marks = np.unpackbits(np.frombuffer(b"".join(taken[i:i + 256]), np.uint8).reshape(-1, len(taken[0])), axis=1).view(bool)
                met = own[i:i + 256, None] == ids
                for t in range(tree):
                    met |= marks[:, leaves[:, t]]
            new = np.flatnonzero(~met[i % 256])
            if not len(new):
                continue
            some, near_v = (ids, v) if len(new) == len(ids) else (ids[new], v[new])
            d = np.sqrt(((near_v - q[i]) ** 2).sum(axis=1))
            if repeated:  # an id counts once, by its nearest row
                order = np.lexsort([d, some])
                d[order[1:][some[order[1:]] == some[order[:-1]]]] = np.inf
            near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
            near = near[np.lexsort([some[near], d[near]])][:k]
            near = near[np.isfinite(d[near])]
            out.append((np.full(len(near), own[i]), some[near], d[near]))
        return pa.table({c: np.concatenate([o[j] for o in out]) for j, c in enumerate(("query_id", "vec_id", "score"))}) if out else empty

    keys = ["tree", "leaf", "part", "block"]
    met = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(measure, "query_id long, vec_id long, score double")
    met = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
