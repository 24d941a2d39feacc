"""Near-duplicate vectors by lattice hashing.

In each of several tables a vector is projected at random to two times eight dimensions,
and each half is decoded to its nearest point of the E8 lattice; the two points are the
vector's cell. It also probes cells in which one of the points is a neighbouring one.
Vectors of one label that meet in a cell are compared by cosine.

Every cell is a number of blocks of bounded size, and a block's result is a count for each
vector and a spanning forest of the links in it, not the links. A pair is counted where it
meets first, in the order of the tables.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadlark.llm.common import components
from roadlark.llm.vectors import lengths, usable
from roadlark.session import materialise

COSINE = 0.98
TABLES = 6
SCALE = 1.5  # lattice steps for a distance of 1 between unit vectors
NEIGHBOURS = 2  # further points probed for each half
CODES = 1 + 2 * NEIGHBOURS  # cells a vector looks at in each table, its own one first
BLOCK = 1024  # vectors of a cell that are compared with as many others at a time
CHUNK = 1 << 17  # pairs in memory at a time

_WEIGHTS = np.random.default_rng(21).integers(1, 1 << 62, 32, np.int64)


def _d8(points: np.ndarray) -> list[np.ndarray]:
    """The nearest points of D8 (whole coordinates with an even sum), three for each."""
    near = np.rint(points)
    off = points - near
    odd = (near.sum(axis=1).astype(np.int64) & 1).astype(bool)[:, None]
    doubtful = np.argsort(-np.abs(off), axis=1, kind="stable")[:, :3]
    step = np.where(off >= 0, 1.0, -1.0)
    rows = np.arange(len(points))

    def moved(by: list[int]) -> np.ndarray:
        other = near.copy()
        for i in by:
            other[rows, doubtful[:, i]] += step[rows, doubtful[:, i]]
        return other

    return [
        np.where(odd, moved([0]), near),
        np.where(odd, moved([1]), moved([0, 1])),
        np.where(odd, moved([2]), moved([0, 2])),
    ]


def e8(points: np.ndarray, count: int) -> np.ndarray:
    """(rows, count, 8): the nearest points of E8, which is D8 and D8 moved by one half,
    nearest first; times two, as whole numbers."""
    found = np.stack(_d8(points) + [p + 0.5 for p in _d8(points - 0.5)], axis=1)
    distance = np.square(found - points[:, None]).sum(axis=2)
    order = np.argsort(distance, axis=1, kind="stable")[:, :count]
    return (2 * np.take_along_axis(found, order[..., None], axis=1)).astype(np.int64)


def cells(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """(rows, TABLES * CODES): hashes of the cells that each vector looks at."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    size = unit.shape[1]
    codes = []
    for table in range(TABLES):
        directions = np.random.default_rng(100 + table).normal(size=(size, 16)) / np.sqrt(8)
        if size >= 16:
            directions = np.linalg.qr(directions)[0] * np.sqrt(size / 8)
        projected = unit @ directions * SCALE
        halves = [
            (e8(projected[:, 8 * i : 8 * i + 8], 1 + NEIGHBOURS) * _WEIGHTS[8 * i : 8 * i + 8]).sum(axis=2)
            for i in range(2)
        ]
        base = labels * _WEIGHTS[16] + table * _WEIGHTS[17]
        looks = [(0, 0)] + [(i, 0) for i in range(1, 1 + NEIGHBOURS)] + [(0, i) for i in range(1, 1 + NEIGHBOURS)]
        codes += [base + halves[0][:, i] * _WEIGHTS[18] + halves[1][:, j] for i, j in looks]
    return np.stack(codes, axis=1)


def _cells_column() -> Column:
    @F.pandas_udf("array<long>")
    def found(vectors: pd.Series, labels: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        with np.errstate(over="ignore"):
            codes = cells(np.stack(vectors.to_list()).astype(float), labels.to_numpy(np.int64))
        return pd.Series(list(codes))

    return found("vector", "label")


def _roots(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """The smallest number that each of ``count`` numbers is linked to."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root


def _compare(rows: pd.DataFrame, cosine: float) -> Iterator[pd.DataFrame]:
    """Counts (a, null, times) and forest edges (a, b, 0) of whole groups of rows."""
    group = rows["group"].to_numpy()
    node = rows["node"].to_numpy()
    table = rows["table"].to_numpy()
    copies = rows["copies"].to_numpy()
    vectors = np.stack(rows["vector"].to_list()).astype(float)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    codes = np.stack(rows["codes"].to_list()).reshape(len(rows), TABLES, CODES)
    home = rows["home"].to_numpy()
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    end = np.append(begin[1:], len(group))
    pairs_a, pairs_b = [], []
    counts: dict[str, np.ndarray] = {"times": np.zeros(len(rows), np.int64)}
    buffer: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def check() -> None:
        a = np.concatenate([x for x, _ in buffer])
        b = np.concatenate([y for _, y in buffer])
        near = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= cosine
        a, b = a[near], b[near]
        sees = (codes[a] == codes[b][:, :, :1]).any(axis=2)
        seen = (codes[b] == codes[a][:, :, :1]).any(axis=2)
        first = (sees | seen).argmax(axis=1)
        here = first == table[a]
        twice = seen[np.arange(len(a)), table[a]]
        here &= ~twice | (node[a] > node[b])
        a, b = a[here], b[here]
        np.add.at(counts["times"], a, copies[b])
        np.add.at(counts["times"], b, copies[a])
        pairs_a.append(a)
        pairs_b.append(b)

    for start, stop in zip(begin, end):
        homes = start + np.flatnonzero(home[start:stop])
        visitors = start + np.flatnonzero(~home[start:stop])
        step = max(1, CHUNK // max(1, len(homes)))
        for i in range(0, len(visitors), step):
            some = visitors[i : i + step]
            a, b = np.repeat(some, len(homes)), np.tile(homes, len(some))
            other = node[a] != node[b]
            buffer.append((a[other], b[other]))
            held += int(other.sum())
            if held >= CHUNK:
                check()
                buffer.clear()
                held = 0
    if held:
        check()
    counted = np.flatnonzero(counts["times"])
    yield pd.DataFrame({"a": node[counted], "b": -1, "times": counts["times"][counted]})
    if pairs_a:
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        names, place = np.unique(node, return_inverse=True)
        root = _roots(place[a], place[b], len(names))
        linked = np.flatnonzero(root != np.arange(len(names)))
        yield pd.DataFrame({"a": names[linked], "b": names[root[linked]], "times": 0})


def _meetings(nodes: DataFrame) -> DataFrame:
    """Rows (group, node, table, home, copies, vector, codes): the vectors whose home is a
    cell and those that look at it, in blocks of bounded size; for cells where different
    vectors meet only."""
    looks = nodes.select("node", F.posexplode("codes").alias("place", "cell")).select(
        "cell", "node", F.floor(F.col("place") / CODES).cast("int").alias("table"), (F.col("place") % CODES == 0).alias("home")
    )
    sizes = looks.groupBy("cell").agg(F.count("*").alias("looks"), F.count(F.when(F.col("home"), 1)).alias("homes"))
    busy = materialise(sizes.where((F.col("homes") > 0) & (F.col("looks") > 1)), "cells")
    met = looks.join(busy, "cell")

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / BLOCK).cast("int")

    def dealt(count: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), blocks(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(count) - 1))

    homes = met.where("home").select(
        "cell", dealt("homes", 1).alias("_h"), every("looks").alias("_v"), "node", "table", F.lit(True).alias("home")
    )
    visitors = met.select(
        "cell", every("homes").alias("_h"), dealt("looks", 2).alias("_v"), "node", "table", F.lit(False).alias("home")
    )
    both = homes.union(visitors).withColumn("group", F.xxhash64("cell", "_h", "_v"))
    held = nodes.select("node", "copies", "vector", "codes")
    return both.join(held, "node").select("group", "node", "table", "home", "copies", "vector", "codes")


def _linked(rows: DataFrame, cosine: float) -> DataFrame:
    """(class, component, links) of the classes of vectors of one length."""
    classes = (
        rows.groupBy("class")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialise(materialise(classes, "classes").withColumn("codes", _cells_column()), "codes")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            held = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            group = held["group"].to_numpy()
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if last:
                yield from _compare(held.iloc[:last], cosine)
            rest = held.iloc[last:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from _compare(rest, cosine)

    groups = _meetings(nodes).repartition("group").sortWithinPartitions("group")
    found = materialise(groups.mapInPandas(compare, "a long, b long, times long"), "found")
    counts = found.where(F.col("times") > 0).groupBy(F.col("a").alias("node")).agg(F.sum("times").alias("others"))
    roots = components(found.where(F.col("times") == 0).select("a", "b"))
    joined = nodes.select("node", "class", "least", "copies").join(roots, "node", "left")
    joined = materialise(joined.withColumn("root", F.coalesce("root", "node")), "rooted")
    named = joined.groupBy("root").agg(F.min("least").alias("component"))
    return (
        joined.join(named, "root")
        .join(counts, "node", "left")
        .select("class", "component", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    )


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Equal vectors of one label are one class and linked with each other; classes are
    compared in double precision, those of each length among themselves. A vector that is
    null, zero or has null or non-finite components, or one without label, has no link and
    is its own component. Repeated rows are linked; an id that is null is no component's smallest
    unless no other is there, and such a row is not kept. Other columns are not looked at.
    """
    rows = vectors.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{vector_column}`").alias("vector"),
        F.col("label").cast("long").alias("label"),
    )
    good = usable("vector") & F.col("label").isNotNull()
    digest = F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")).cast("binary"))
    rows = rows.withColumn("class", F.when(good, F.concat_ws("|", "label", digest)))
    sized = rows.where(F.col("class").isNotNull())
    linked = [_linked(sized.where(F.size("vector") == n), cosine) for n in lengths(sized, "vector")]
    result = functools.reduce(DataFrame.unionByName, linked) if linked else None
    if result is None:
        result = rows.sparkSession.createDataFrame([], "class string, component long, links long")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
    return (
        rows.select("id", "class")
        .join(result, "class", "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.cast("long").alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        )
    )
