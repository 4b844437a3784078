"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is filed under a leaf. A query
walks the tree best bin first: a priority queue holds the nodes seen so far by their
centre's inner product with the query. How many leaves are visited is widened until the
answers to some of the queries, checked against all rows, reach the wanted recall.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from barhouse.llm.common import settled

# The tree is fitted on about so many rows, and cut until a leaf holds few of them.
SAMPLE_ROWS = 20_000
LEAF_SAMPLE = 400
BRANCH = 8
# Recall is measured on about so many queries.
TRIAL_QUERIES = 128
RECALL = 0.94
# Rows and queries that meet in one group.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


@dataclass
class Tree:
    """Node 0 is the root; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: np.ndarray  # number of each leaf, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return int(self.leaf_of.max()) + 1

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by nearest centre from the root down."""
        node = np.zeros(len(vectors), np.int64)
        open_ = {0}
        while open_:
            n = open_.pop()
            if self.children[n]:
                rows = np.flatnonzero(node == n)
                if len(rows):
                    c = self.centres[self.children[n]]
                    node[rows] = np.array(self.children[n])[(((c * c).sum(1) / 2) - vectors[rows] @ c.T).argmin(axis=1)]
                    open_.update(self.children[n])
        return self.leaf_of[node]

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves from the most promising on."""
        near = self.centres @ query
        queue = [(0.0, 0)]
        while queue:
            _, n = heapq.heappop(queue)
            if self.children[n]:
                for c in self.children[n]:
                    heapq.heappush(queue, (-near[c], c))
            else:
                yield int(self.leaf_of[n])


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Which of ``k`` clusters each point belongs to."""
    centres = points[rng.choice(len(points), k, replace=False)]
    part = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        part = ((centres * centres).sum(1) / 2 - points @ centres.T).argmin(axis=1)
        sizes = np.bincount(part, minlength=k)
        sums = np.stack([np.bincount(part, points[:, d], k) for d in range(points.shape[1])], axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return part


def grow(points: np.ndarray, leaf: int = LEAF_SAMPLE, branch: int = BRANCH, seed: int = 3) -> Tree:
    """Hierarchical k-means; points that don't part, such as copies, share a leaf."""
    rng = np.random.default_rng(seed)
    centres, children, leaf_of = [points.mean(axis=0)], [[]], [-1]
    todo, leaves = [(0, points)], 0
    while todo:
        node, own = todo.pop()
        parts = _kmeans(own, min(branch, len(own)), rng) if len(own) > leaf else np.zeros(len(own), np.int64)
        kinds = np.unique(parts)
        if len(kinds) < 2:
            leaf_of[node], leaves = leaves, leaves + 1
            continue
        for kind in kinds:
            inside = own[parts == kind]
            children[node].append(len(centres))
            centres.append(inside.mean(axis=0))
            children.append([])
            leaf_of.append(-1)
            todo.append((len(centres) - 1, inside))
    return Tree(np.array(centres), children, np.array(leaf_of))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of rows that take part.

    Left out are null ids and vectors, vectors with a null or non-finite component, and zero vectors.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("bigint"), v.alias("vector")).where(fine & F.col("vec_id").isNotNull())


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, added up from the first component to the last, so that equal vectors score equally."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def _nth(*columns: np.ndarray) -> np.ndarray:
    """Each row's number in its run of equal rows."""
    n = len(columns[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query place, row place, score) of each query's ``k`` best rows; ties go to smaller ids; rows with the query's own id are passed over.

    A fast product finds what can be among the best, with room for its rounding; the exact one decides.
    """
    order = np.argsort(row_ids, kind="stable")
    _, copy = np.unique(rows[order], axis=0, return_inverse=True)
    copy, ids = copy.ravel(), row_ids[order]
    # Of equal vectors with one id, k can be among the best; of equal ones, then, the first 2 k, as k at most have the query's id.
    kept = np.lexsort((ids, copy))
    kept = kept[_nth(copy[kept], ids[kept]) < k]
    kept = kept[_nth(copy[kept]) < 2 * k]
    order = order[np.sort(kept)]
    rows, ids = rows[order], row_ids[order]
    rough = queries @ rows.T
    room = 1e-12 * (np.abs(queries) @ np.abs(rows).T).max(initial=0.0)
    out = []
    for i in range(len(queries)):
        other = np.flatnonzero(ids != query_ids[i])
        if len(other) > k:
            least = np.partition(rough[i, other], len(other) - k)[len(other) - k] - room
            other = other[rough[i, other] >= least]
        score = _products(queries[i], rows[other])
        top = np.lexsort((ids[other], -score))[:k]
        out.append((np.full(len(top), i), order[other[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


FOUND = "query_id bigint, vec_id bigint, score double"


def _found(query_ids: np.ndarray, row_ids: np.ndarray, got: tuple[np.ndarray, ...]) -> pa.Table:
    i, j, score = got
    return pa.table({"query_id": query_ids[i], "vec_id": row_ids[j], "score": score})


def exact(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The ``k`` best rows of a few given queries, each task keeping its own best."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for a in range(0, len(ids), BLOCK_ROWS):
                part = slice(a, a + BLOCK_ROWS)
                yield from _found(query_ids, ids[part], best(queries, query_ids, vectors[part], ids[part], k)).to_batches()

    return _top(rows.mapInArrow(scan, FOUND), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows by inner product of each row of (vec_id, embedding) that ``is_query`` picks.

    Returns query_id, rank (from 1), vec_id, score. Rows repeating an id are candidates of their
    own, but never of a query with their id; queries repeating an id are one, the smallest of the
    shortest vectors. Vectors meet those of their own length only, and each length has a tree
    of its own. An empty table, or one without usable vectors, gives no rows.
    """
    rows = usable(vectors)
    length = F.size("vector")
    counts = rows.groupBy(length.alias("n")).count().orderBy("n").collect()
    found = [_search(rows.where(length == r["n"]) if len(counts) > 1 else rows, r["count"], is_query, k, recall) for r in counts]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if len(found) == 1:
        return found[0]
    # An id with queries of several lengths is answered by the first.
    parts = [part.withColumn("n", F.lit(r["n"])) for part, r in zip(found, counts, strict=True)]
    every = reduce(DataFrame.unionByName, parts)
    least = F.min("n").over(Window.partitionBy("query_id"))
    return every.withColumn("least", least).where("n = least").drop("n", "least")


def _search(rows: DataFrame, total: int, is_query: Column, k: int, recall: float) -> DataFrame:
    """The same for vectors of one length, of which there are ``total``."""
    draw = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(draw < SAMPLE_ROWS / total).orderBy("vec_id", "vector").toPandas()["vector"]
    if not len(sample):
        sample = rows.limit(1).toPandas()["vector"]
    tree = grow(np.stack(sample.to_numpy()))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.file(_matrix(batch.column(1))), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], ["vec_id", "vector", "leaf"])

    filed = rows.mapInArrow(file, "vec_id bigint, vector array<double>, leaf bigint")
    # Rows are dealt into blocks by a number of their own, not by an id that many may share.
    index = settled(filed.withColumn("place", F.monotonically_increasing_id()), "leaves")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    asked = index.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.count("*").alias("own"))
    queries = settled(asked, "queries")
    visits = _calibrate(tree, sizes, index, queries, k, recall)
    return _visit(tree, sizes, index, queries, visits, k)


def _visited(tree: Tree, sizes: np.ndarray, query: np.ndarray, own: int, visits: int, k: int) -> list[int]:
    """The first ``visits`` leaves of a walk, and more while they may hold too few rows, without the query's ``own``, for ``k`` answers."""
    out, held = [], 0
    for leaf in tree.walk(query):
        if len(out) >= visits and held >= k + own:
            break
        out.append(leaf)
        held += int(sizes[leaf])
    return out


def _calibrate(tree: Tree, sizes: np.ndarray, index: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """Leaves to visit, widened until the trial queries find enough of their true neighbours."""
    total = queries.count()
    draw = F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(1 << 30)) / (1 << 30)
    trial = queries.where(draw < TRIAL_QUERIES / max(total, 1)).toPandas()
    if not len(trial):
        return tree.leaves
    ids, vectors = trial["vec_id"].to_numpy(), np.stack(trial["vector"].to_numpy())
    truth = exact(index.select("vec_id", "vector"), ids, vectors, k)
    where = truth.join(index.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    found = {q: set(g["leaf"]) for q, g in where.groupby("query_id")}
    hits = {q: g["leaf"].value_counts() for q, g in where.groupby("query_id")}
    walks = {q: list(tree.walk(v)) for q, v in zip(ids, vectors, strict=True) if q in found}
    visits = 1
    while visits < tree.leaves:
        reached = [hits[q].reindex(walk[:visits]).sum() / hits[q].sum() for q, walk in walks.items()]
        if not reached or np.mean(reached) >= recall:
            break
        visits = visits + max(1, visits // 8)
    return min(visits, tree.leaves)


def _visit(tree: Tree, sizes: np.ndarray, index: DataFrame, queries: DataFrame, visits: int, k: int) -> DataFrame:
    """Let queries meet the rows of the leaves they visit, in blocks of bounded size."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asking = zip(_matrix(batch.column(1)), batch.column(2).to_pylist(), strict=True)
            found = [_visited(tree, sizes, q, own, visits, k) for q, own in asking]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            leaf = pa.array(np.concatenate([np.array(x, np.int64) for x in found]) if found else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), leaf], ["query_id", "leaf"])

    visited = settled(queries.mapInArrow(walk, "query_id bigint, leaf bigint"), "visits")
    askers = np.zeros(tree.leaves, np.int64)
    for r in visited.groupBy("leaf").count().collect():
        askers[r["leaf"]] = r["count"]
    cut = [[int(x) for x in -(-n // most)] for n, most in ((np.maximum(sizes, 1), BLOCK_ROWS), (np.maximum(askers, 1), BLOCK_QUERIES))]
    blocks, slices = (F.element_at(F.lit(np.array(x)), (F.col("leaf") + 1).cast("int")).cast("bigint") for x in cut)
    counted = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    left = index.withColumn("block", F.pmod(F.xxhash64("place"), blocks)).withColumn("slice", counted(slices))
    right = visited.withColumn("slice", F.pmod(F.xxhash64("query_id"), slices)).withColumn("block", counted(blocks))
    right = right.join(queries.select(F.col("vec_id").alias("query_id"), "vector"), "query_id")

    def meet(rows: pa.Table, asking: pa.Table) -> pa.Table:
        ids, query_ids = rows["vec_id"].to_numpy(), asking["query_id"].to_numpy()
        if not len(ids) or not len(query_ids):
            return _found(query_ids[:0], ids[:0], (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        return _found(query_ids, ids, best(_matrix(asking["vector"]), query_ids, _matrix(rows["vector"]), ids, k))

    keys = ["leaf", "block", "slice"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND)
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
