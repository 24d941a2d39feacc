"""Approximate nearest neighbours in a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector goes down it to a leaf. A query walks
the tree best bin first: a priority queue holds the branches not yet taken, nearest centre
first, and leaves are visited in the order they come off it. How many are visited is
calibrated: widened until the neighbours of some queries, found by comparing them with all
vectors, are reached with the recall asked for.

The largest inner product becomes the smallest distance by one more component, which gives
all vectors the length of the longest one.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.llm.vectors import lengths, usable
from roadlark.session import materialise

NEAREST = 20
FIT_VECTORS = 20_000  # vectors the tree is fitted on, about, at most
CALIBRATION = 128  # queries the number of visits is calibrated on, about, at most
RECALL = 0.94  # of the calibration's queries; others lie a little below
BRANCHES = 8
LEAF = 48  # fitted vectors of a leaf, at most
BUNDLE = 128  # leaves next to each other in the tree that are searched together
BLOCK = 16384  # vectors of a bundle that meet in one task
QUERY_BLOCK = 4096  # queries of a bundle that meet in one task
BUCKETS = 1 << 20


@dataclass
class Tree:
    """Nodes in order of a walk; a leaf has its number, others their children's centres."""

    length: float
    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.length**2 - np.square(vectors).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) / self.length

    def grow(self, points: np.ndarray, rng: np.random.Generator) -> int:
        """Adds the tree of ``points`` and returns its top node."""
        tops, work = [], [(points, -1)]
        while work:
            some, parent = work.pop()
            number = len(self.leaf)
            self.centres.append(None)
            self.children.append([])
            self.leaf.append(-1)
            if parent >= 0:
                self.children[parent].append(number)
            tops.append(number)
            centres, group = kmeans(some, BRANCHES, rng) if len(some) > LEAF else (None, None)
            if centres is None or len(centres) < 2:
                self.leaf[number] = self.leaves
                self.leaves += 1
                continue
            self.centres[number] = centres
            # Taken from the end, so that the children are numbered in the centres' order.
            work += [(some[group == i], number) for i in reversed(range(len(centres)))]
        return tops[0]

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        points = self.lifted(vectors)
        found = np.zeros(len(points), np.int64)
        work = [(0, np.arange(len(points)))]
        while work:
            node, rows = work.pop()
            if self.centres[node] is None:
                found[rows] = self.leaf[node]
                continue
            nearest = distances(points[rows], self.centres[node]).argmin(axis=1)
            work += [(child, rows[nearest == i]) for i, child in enumerate(self.children[node]) if (nearest == i).any()]
        return found

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        size = np.sqrt(np.square(query).sum())
        point = np.append(query / size, 0.0)[None]
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.centres[node] is None:
                found.append(self.leaf[node])
                continue
            far = distances(point, self.centres[node])[0]
            for child, distance in zip(self.children[node], far):
                heapq.heappush(queue, (float(distance), child))
        return found


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.square(centres).sum(axis=1) - 2 * points @ centres.T


def kmeans(points: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres that have points, and each point's centre."""
    centres = points[rng.choice(len(points), count, replace=False)]
    for _ in range(rounds):
        group = distances(points, centres).argmin(axis=1)
        used = np.unique(group)
        centres = np.stack([points[group == i].mean(axis=0) for i in used])
    return centres, distances(points, centres).argmin(axis=1)


def fit(rows: DataFrame, fit_vectors: int) -> Tree | None:
    """The tree of about ``fit_vectors`` rows at most, taken by a hash of vector and id."""
    count, length = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not count:
        return None
    share = min(1.0, fit_vectors / count)
    drawn = rows.where(F.pmod(F.xxhash64("id", "vector"), BUCKETS) < share * BUCKETS).select("vector").distinct()
    sample = drawn.toPandas()["vector"].to_list()
    points = np.stack(sample) if sample else np.zeros((1, rows.select(F.size("vector")).first()[0]))
    points = points[np.lexsort(points.T[::-1])]  # rows come in any order
    tree = Tree(max(length, 1e-300))
    tree.grow(tree.lifted(points), np.random.default_rng(17))
    return tree


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order whatever else is in the block."""
    return (vectors * query).sum(axis=1)


def _best(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, nearest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, places of its nearest vectors, their scores)."""
    for begin in range(0, len(queries), 256):
        rough = queries[begin : begin + 256] @ vectors.T
        rough[query_ids[begin : begin + 256, None] == ids[None]] = -np.inf
        if allowed is not None:
            rough[~allowed[begin : begin + 256]] = -np.inf
        for i, row in enumerate(rough):
            there = np.isfinite(row)
            if not there.any():
                continue
            if there.sum() > nearest:
                edge = np.partition(row, -nearest)[-nearest]
                there &= row >= edge - 1e-9 * max(1.0, abs(edge))
            places = np.flatnonzero(there)
            scores = _products(vectors[places], queries[begin + i])
            order = np.lexsort((ids[places], -scores))[:nearest]
            yield begin + i, places[order], scores[order]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(float)


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)


def _calibrated(rows: DataFrame, queries: DataFrame, tree: Tree, nearest: int, recall: float, count: int) -> int:
    """The least number of leaf visits with which the neighbours of ``count`` queries are
    reached with the recall asked for."""
    asked = queries.agg(F.count("*")).first()[0]
    drawn = queries.where(F.pmod(F.xxhash64("id"), BUCKETS) < min(1.0, count / max(1, asked)) * BUCKETS)
    some = drawn.toPandas()
    if not len(some):
        return tree.leaves
    asked_ids, asked_vectors = some["id"].to_numpy(), _matrix(some["vector"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, leaves = batch["id"].to_numpy(), batch["leaf"].to_numpy()
            for i, places, scores in _best(asked_vectors, asked_ids, _matrix(batch["vector"]), ids, None, nearest):
                yield pd.DataFrame({"query_id": asked_ids[i], "vec_id": ids[places], "leaf": leaves[places], "score": scores})

    found = rows.mapInPandas(search, "query_id long, vec_id long, leaf int, score double")
    true = _ranked(found, nearest).select("query_id", "leaf").toPandas()
    needed = []
    for query, vector in zip(asked_ids, asked_vectors):
        order = {leaf: i + 1 for i, leaf in enumerate(tree.visits(vector, tree.leaves))}
        needed += [order[leaf] for leaf in true.loc[true["query_id"] == query, "leaf"]]
    return int(np.quantile(needed, recall, method="higher")) if needed else tree.leaves


def search(
    vectors: DataFrame,
    is_query: Column,
    nearest: int = NEAREST,
    fit_vectors: int = FIT_VECTORS,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows where ``is_query`` (a condition on the
    columns of ``vectors``), their ``nearest`` rows of largest inner product, ties to the
    smaller id; all other rows if there are fewer. Vectors of each length have a tree of
    their own, as there is no product with others.

    Vectors that are null, zero or have null or non-finite components, and rows without id,
    take no part. Of rows with one id the smallest vector
    counts. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).where(F.col("id").isNotNull() & usable("vector"))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("query").alias("query"))
    rows = materialise(rows, "vectors")
    found = [_search(rows.where(F.size("vector") == n), nearest, fit_vectors, recall) for n in lengths(rows, "vector")]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, nearest: int, fit_vectors: int, recall: float) -> DataFrame:
    """The neighbours among some (id, vector, query) with vectors of one length."""
    tree = fit(rows, fit_vectors)

    @F.pandas_udf("int")
    def leaf_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(tree.assign(_matrix(batch)) if len(batch) else [], dtype="int32")

    placed = materialise(rows.withColumn("leaf", leaf_of("vector")), "leaves")
    queries = rows.where("query").select("id", "vector")
    most = _calibrated(placed, queries, tree, nearest, recall, CALIBRATION)

    @F.pandas_udf("array<struct<bundle: int, leaves: array<int>>>")
    def bundles(batch: pd.Series) -> pd.Series:
        walks = []
        for query in batch:
            by_bundle: dict[int, list[int]] = {}
            for leaf in tree.visits(np.asarray(query, float), most):
                by_bundle.setdefault(leaf // BUNDLE, []).append(leaf)
            walks.append([{"bundle": b, "leaves": leaves} for b, leaves in by_bundle.items()])
        return pd.Series(walks)

    walks = materialise(queries.select("id", F.explode(bundles("vector")).alias("_b")).select("id", "_b.*"), "walks")

    # Both tables have a row a bundle at most; bundles are as many as the tree has.
    bundle = F.floor(F.col("leaf") / BUNDLE).cast("int").alias("bundle")
    members = placed.groupBy(bundle).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_m"))
    askers = walks.groupBy("bundle").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("_q"))
    blocks = F.broadcast(materialise(members.join(askers, "bundle"), "blocks"))

    def dealt(column: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(column)).cast("int")

    def every(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    held = placed.select("id", "vector", "leaf", bundle).join(blocks, "bundle")
    held = held.select("bundle", dealt("_m").alias("m"), every("_q").alias("q"), "id", "vector", "leaf")
    asked = walks.join(queries, "id").join(blocks, "bundle")
    asked = asked.select("bundle", every("_m").alias("m"), dealt("_q").alias("q"), "id", "vector", "leaves")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(left) and len(right):
            wanted = np.zeros((len(right), BUNDLE), bool)
            for i, leaves in enumerate(right["leaves"]):
                wanted[i, np.asarray(leaves) % BUNDLE] = True
            allowed = wanted[:, left["leaf"].to_numpy() % BUNDLE]
            ids, query_ids = left["id"].to_numpy(), right["id"].to_numpy()
            found = _best(_matrix(right["vector"]), query_ids, _matrix(left["vector"]), ids, allowed, nearest)
            for i, places, scores in found:
                parts.append(pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[places], "score": scores}))
        if parts:
            return pd.concat(parts, ignore_index=True)
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": int, "vec_id": int})

    keys = ["bundle", "m", "q"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(look, "query_id long, vec_id long, score double")
    return _ranked(found, nearest).select("query_id", "rank", "vec_id", "score")
