"""Hard negatives: integer inner products of anchors and candidates, tile by tile.

Anchors are dealt into blocks and all rows into stripes; a block and a stripe meet in one
task. There they are multiplied in tiles by Strassen's recursion, whose additions and
products are exact integers. Each tile is merged into heaps of fixed size: first the
nearest rows of an anchor's own label, then, in a second pass, for each of these the
nearest rows of other labels within a window of its score. What leaves a task are heaps,
and heaps of one anchor from all stripes are merged again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.session import materialise

SCALE = 256  # a component x becomes floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score that a negative's may have
BLOCK = 1024  # anchors of a block
STRIPE = 16384  # rows of a stripe
BLOCK_BYTES = 16 << 20  # components of a block or a stripe, about, at most
TILE = 2048  # rows of a stripe multiplied at once
SMALL = 32  # the recursion ends where a side is no longer than this
MOST = (1 << 63) - 1
ABSENT = -MOST - 1  # no score: scores stop at -MOST and MOST
LARGEST = 1 << 62  # components stop there


def _multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The plain product; in doubles where each sum is below 2 ** 53 and so exact."""
    bound = a.shape[1] * _largest(a) * _largest(b)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0


def strassen(a: np.ndarray, b: np.ndarray, small: int = SMALL) -> np.ndarray:
    """a @ b for int64: seven products of halves where there would be eight. Sides of odd
    length get a row or column of zeros. Sums may pass 2 ** 63 on the way: they are right
    modulo 2 ** 64, and so is the result where it fits."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= small:
        return _multiplied(a, b)
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    r, i, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    m1 = strassen(a11 + a22, b11 + b22, small)
    m2 = strassen(a21 + a22, b11, small)
    m3 = strassen(a11, b12 - b22, small)
    m4 = strassen(a22, b21 - b11, small)
    m5 = strassen(a11 + a12, b22, small)
    m6 = strassen(a21 - a11, b11 + b12, small)
    m7 = strassen(a12 - a22, b21 + b22, small)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c] = m1 + m4 - m5 + m7
    out[:r, c:] = m3 + m5
    out[r:, :c] = m2 + m4
    out[r:, c:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of rows of ``a`` and ``b``; those beyond a long stop at its ends."""
    if a.shape[1] * _largest(a) * _largest(b) <= MOST:
        return strassen(a, b.T)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


class Heaps:
    """For each of some lines its ``size`` best entries so far: the highest score first,
    of equal ones the one that came first. An entry's place tells which row it is."""

    def __init__(self, lines: int, size: int) -> None:
        self.scores = np.full((lines, size), ABSENT)
        self.places = np.zeros((lines, size), np.int64)

    def add(self, scores: np.ndarray, first: int) -> None:
        """Merges a tile whose columns are the places from ``first`` on; entries that do
        not count are ABSENT. ``scores`` is used up."""
        lines, size = np.arange(len(scores)), self.scores.shape[1]
        best, places = [], []
        for _ in range(min(size, scores.shape[1])):
            at = scores.argmax(axis=1)  # the first of equal ones
            best.append(scores[lines, at])
            places.append(at + first)
            scores[lines, at] = ABSENT
        if best:
            self.merge(np.column_stack(best), np.column_stack(places))

    def merge(self, scores: np.ndarray, places: np.ndarray) -> None:
        scores = np.column_stack([self.scores, scores])
        places = np.column_stack([self.places, places])
        # ABSENT is the lowest long: its order needs no negation, which would overflow.
        order = np.argsort(~scores, axis=1, kind="stable")[:, : self.scores.shape[1]]
        self.scores = np.take_along_axis(scores, order, axis=1)
        self.places = np.take_along_axis(places, order, axis=1)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` components; shorter ones end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, vector in enumerate(column):
        out[i, : len(vector)] = vector
    return out


class Meeting:
    """A block of anchors and a stripe of rows, the rows in the order of their ids."""

    def __init__(self, rows: pd.DataFrame, anchors: pd.DataFrame) -> None:
        self.rows = rows.sort_values(["no_id", "id", "row"], kind="stable")
        self.anchors = anchors
        width = max(map(len, [*rows["vector"], *anchors["vector"]]))
        self.left, self.right = _matrix(anchors["vector"], width), _matrix(self.rows["vector"], width)
        labels = pd.factorize(pd.concat([anchors["label"], self.rows["label"]]))[0]
        self.own, self.other = labels[: len(anchors)], labels[len(anchors) :]

    def tiles(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place of the first row, scores, whether the labels are equal)."""
        for first in range(0, len(self.right), TILE):
            part = slice(first, first + TILE)
            yield first, products(self.left, self.right[part]), self.own[:, None] == self.other[None, part]

    def entries(self, heaps: Heaps, **more: np.ndarray) -> pd.DataFrame:
        """The heaps' rows; ``more`` are columns with a value for each line."""
        line, slot = np.nonzero(heaps.scores > ABSENT)
        taken = self.rows.iloc[heaps.places[line, slot]]
        found = {name: values[line] for name, values in more.items()}
        return pd.DataFrame(
            found
            | {name: taken[name].to_numpy() for name in ("row", "id", "no_id")}
            | {"score": heaps.scores[line, slot]}
        )


ENTRY = "row long, id long, no_id boolean, score long"


def _positives(size: int):
    def look(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(anchors):
            return _nothing(["anchor"])
        met, anchor = Meeting(rows, anchors), anchors["row"].to_numpy()
        heaps, row = Heaps(len(anchors), size), met.rows["row"].to_numpy()
        for first, scores, same in met.tiles():
            same &= anchor[:, None] != row[None, first : first + scores.shape[1]]
            scores[~same] = ABSENT
            heaps.add(scores, first)
        return met.entries(heaps, anchor=anchor)

    return look


def _negatives(size: int, low: int, high: int):
    def look(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(anchors):
            return _nothing(["anchor", "place"])
        met, anchor = Meeting(rows, anchors), anchors["row"].to_numpy()
        most = max(map(len, anchors["bounds"]))
        heaps = [Heaps(len(anchors), size) for _ in range(most)]
        # Of an anchor with fewer positives the other windows are empty.
        floors, ceilings = np.full((most, len(anchors)), MOST), np.full((most, len(anchors)), ABSENT)
        for i, scores in enumerate(anchors["bounds"]):
            for j, score in enumerate(int(s) for s in scores):
                floors[j, i], ceilings[j, i] = -(-low * score // 100), high * score // 100
        for first, scores, same in met.tiles():
            scores[same] = ABSENT
            for window, least, last in zip(heaps, floors, ceilings):
                inside = (scores >= least[:, None]) & (scores <= last[:, None])
                some = inside.any(axis=1)
                if some.any():
                    tile = np.full_like(scores, ABSENT)
                    tile[some] = np.where(inside[some], scores[some], ABSENT)
                    window.add(tile, first)
        places = [met.entries(h, anchor=anchor, place=np.full(len(anchors), j + 1, np.int32)) for j, h in enumerate(heaps)]
        return pd.concat(places, ignore_index=True)

    return look


def _nothing(columns: list[str]) -> pd.DataFrame:
    names = [*columns, "row", "id", "no_id", "score"]
    return pd.DataFrame({n: pd.Series(dtype=bool if n == "no_id" else "int64") for n in names})


def _first(entries: DataFrame, line: list[str], count: int) -> DataFrame:
    """The heaps of one line merged: its ``count`` first entries, numbered from 1."""
    order = Window.partitionBy(*line).orderBy(F.desc("score"), "no_id", "id", "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def finite(column: str) -> Column:
    """A vector whose components are all there and finite."""
    return F.coalesce(
        F.forall(F.col(f"`{column}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` are columns over ``vectors``. Rows with a null label, a null
    vector or any null or non-finite component take no part. A row's score is its inner
    product with the anchor, in integers: a component x counts as floor(256 * x). An
    anchor's positives are its ``positives`` highest other rows of the same label; for each,
    the ``negatives`` highest rows of other labels whose score is from ``low`` to ``high``
    percent of the positive's. Equal scores come by smaller id.

    Each row counts for itself, also where several have one id; a null id is no anchor
    unless ``is_anchor`` says so and comes last among equals. Of vectors of different
    lengths the shorter one counts as ending in zeros. Components stop at 2 ** 62 and scores
    at the ends of a long. An empty table gives no rows; other columns are not looked at.
    """
    whole = F.transform(
        F.col(f"`{vector_column}`").cast("array<double>"),
        lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * SCALE).cast("long"))),
    )
    rows = vectors.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(0)).alias("id"),
        F.col(f"`{id_column}`").isNull().alias("no_id"),
        label.cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.when(finite(vector_column), whole).alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull())
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    count, asked, width = rows.agg(
        F.count("*"), F.count(F.when(F.col("anchor"), 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))
    ).first()
    fit = max(1, BLOCK_BYTES // (8 * max(1, width)))
    blocks, stripes = -(-asked // min(BLOCK, fit)), -(-count // min(STRIPE, fit))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(max(1, parts))).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, parts) - 1)))

    held = rows.select(every(blocks).alias("b"), dealt(stripes).alias("s"), "row", "id", "no_id", "label", "vector")
    anchors = rows.where("anchor").select("row", "label", "vector")

    def meet(some: DataFrame, look, schema: str) -> DataFrame:
        renamed = [F.col(c).alias(c) for c in some.columns]  # columns of their own beside those of the rows
        there = some.select(dealt(blocks).alias("b"), every(stripes).alias("s"), *renamed)
        return held.groupBy("b", "s").cogroup(there.groupBy("b", "s")).applyInPandas(look, schema)

    near = meet(anchors, _positives(positives), f"anchor long, {ENTRY}")
    near = materialise(_first(near, ["anchor"], positives).select("anchor", "rank", "id", "no_id", "score"), "positives")
    listed = near.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_p"))
    windows = anchors.join(listed.select("row", F.col("_p.score").alias("bounds")), "row")
    far = meet(windows, _negatives(negatives, low, high), f"anchor long, place int, {ENTRY}")
    far = _first(far, ["anchor", "place"], negatives)

    def named(column: str, prefix: str = "") -> Column:
        return F.when(~F.col(f"{prefix}no_id"), F.col(f"{prefix}{column}"))

    of_anchor = rows.where("anchor").select(F.col("row").alias("anchor"), named("id").alias("anchor_id"))
    of_positive = near.select(
        "anchor", F.col("rank").alias("place"), named("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    of_negative = far.select("anchor", "place", "rank", named("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        of_negative.join(of_positive, ["anchor", "place"])
        .join(of_anchor, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
