"""Similarity join of documents on word n-grams: rare-first prefix filtering.

A document is the set of its distinct shingles, a shingle is a 64-bit hash of its words.
Documents with equal sets are one node. The shingles of a node are put in order, rare ones
first; two nodes can only be linked if they share a shingle of their prefixes, so prefixes
are joined by shingle. Pairs pass a length, a positional and a suffix filter and are then
verified once on their whole sets, read again from the texts.

A shingle with many nodes, as in a large group of near copies, does not pair them all. One
of its nodes is its centre. The others are verified against the centre, and what they
differ by from it is prefix-filtered in its turn (see ``_crowded``).

How frequent a shingle is comes from a table of counters over all documents, as large for
any input. It only orders the shingles; links are the same for every order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.llm.common import Shelf, components, lean, small_batches, text_of
from roadlark.operators.joins import lookup_join
from roadlark.session import materialise

WORDS = 4
PERCENT = 85  # of the union that the intersection must be at least
SKETCH_BITS = 22  # counters for the frequency of shingles
CHUNKS = 64  # pieces the counters travel in
PIVOTS = 64  # parts of a set that the suffix filter compares by size
CHUNK_BYTES = 1 << 14
CROWD = 32  # nodes under a shingle that are paired with each other, at most

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)) + 1
_FACTORS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64, and of its inverse."""
    base = int(_FACTORS[-1])
    made = []
    for number in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, number, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    return made[0], made[1]


_POWERS = _powers(CHUNK_BYTES)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def _chunks(data: bytes) -> Iterator[bytes]:
    """Pieces of about CHUNK_BYTES, cut where no word is."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        cut = start + CHUNK_BYTES
        while cut < len(data) and not _SPACE[data[cut]]:
            cut += 1
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as lower case."""
    found = []
    for data in _chunks(text.encode("utf-8", "surrogatepass")):
        codes = np.frombuffer(data, np.uint8)
        space = np.concatenate([[True], _SPACE[codes], [True]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edge[::2], edge[1::2]
        powers, inverses = _POWERS if len(codes) <= CHUNK_BYTES else _powers(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_LOWER[codes].astype(np.uint64) * powers[: len(codes)], out=sums[1:])
        if len(starts):
            found.append(_mixed((sums[ends] - sums[starts]) * inverses[starts]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of a shorter text, of all its words."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    length = min(words, len(hashes))
    total = np.full(len(hashes) - length + 1, length, np.uint64) * _FACTORS[-2]
    for i in range(length):
        total += hashes[i : len(hashes) - length + 1 + i] * _FACTORS[i]
    return np.unique(_mixed(total))


def _summed(blobs: DataFrame, keys: list[str]) -> DataFrame:
    """Sums the counters of each (chunk, part), reading them as a stream."""

    @lean
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for chunk, part, blob in zip(batch["chunk"], batch["part"], batch["counters"]):
                counters = np.frombuffer(zlib.decompress(blob), np.int64)
                key = (chunk, part)
                totals[key] = totals[key] + counters if key in totals else counters
        for (chunk, part), counters in totals.items():
            row = {"chunk": [chunk], "part": [part], "counters": [zlib.compress(counters.tobytes(), 1)]}
            yield pd.DataFrame(row)

    return blobs.repartition(*keys).mapInPandas(add, blobs.schema)


def frequency_table(docs: DataFrame, words: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Logarithmic class of the number of documents with a shingle, by the first ``bits``
    bits of its hash; counted over all documents."""

    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(1 << bits, np.int32)  # of the documents of one task
        number = 0
        for batch in batches:
            for text in batch["text"]:
                number += 1
                counters[(shingles(text, words) >> np.uint64(64 - bits)).astype(np.int64)] += 1
        if number:
            blobs = [zlib.compress(piece.astype(np.int64).tobytes(), 1) for piece in np.split(counters, CHUNKS)]
            yield pd.DataFrame({"chunk": range(CHUNKS), "part": int(counters.sum()) % CHUNKS, "counters": blobs})

    partial = docs.select(text_of().alias("text")).mapInPandas(count, "chunk int, part int, counters binary")
    by_part = _summed(partial, ["chunk", "part"])
    whole = _summed(by_part.withColumn("part", F.lit(0)), ["chunk"])

    @lean
    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logs = [np.log2(np.frombuffer(zlib.decompress(b), np.int64) + 1.0) for b in batch["counters"]]
            packed = [zlib.compress(np.minimum(4 * x, 255).astype(np.uint8).tobytes(), 1) for x in logs]
            yield pd.DataFrame({"chunk": batch["chunk"], "classes": packed})

    table = np.zeros((CHUNKS, (1 << bits) // CHUNKS), np.uint8)
    for chunk, packed in whole.mapInPandas(classes, "chunk int, classes binary").collect():
        table[chunk] = np.frombuffer(zlib.decompress(bytes(packed)), np.uint8)
    return table.ravel()


def prefixes(table: np.ndarray, words: int, percent: int) -> Column:
    """Of the column ``text``: size and digest of its set, its prefix in order (rare
    shingles first), and the sizes of the set's parts."""
    bits = len(table).bit_length() - 1

    @F.pandas_udf("n long, digest binary, prefix array<long>, parts binary")
    @lean
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text, words)
                rarity = table[(found >> np.uint64(64 - bits)).astype(np.int64)]
                order = np.lexsort((found, rarity))
                length = len(found) - -(-percent * len(found) // 100) + 1 if len(found) else 0
                parts = np.bincount((found >> np.uint64(58)).astype(np.int64), minlength=PIVOTS)
                digest = xxhash.xxh3_128(found.tobytes()).digest()
                prefix = found[order[:length]].astype(np.int64)
                rows.append((len(found), digest, prefix, parts.astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=["n", "digest", "prefix", "parts"])

    return described(text_of())


def _close(a: Column, b: Column, percent: int) -> Column:
    """Length filter: the smaller set can be ``percent`` of the union."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _suffix_filter(percent: int) -> Column:
    """Whether the sizes of the parts let the sets of ``_a`` and ``_b`` share enough: what
    the parts differ by is not shared."""

    @F.pandas_udf("boolean")
    def may_share(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        left = np.frombuffer(b"".join(a), np.int32).reshape(-1, PIVOTS).astype(np.int64)
        right = np.frombuffer(b"".join(b), np.int32).reshape(-1, PIVOTS).astype(np.int64)
        shared = np.minimum(left, right).sum(axis=1)
        union = left.sum(axis=1) + right.sum(axis=1) - shared
        return pd.Series(100 * shared >= percent * union)

    return may_share("_parts_a", "_parts_b")


def _verified(percent: int) -> Column:
    @F.pandas_udf("boolean")
    @lean
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            answers = []
            for left, right in zip(a, b):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                answers.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pd.Series(answers, dtype=bool)

    return linked("_set_a", "_set_b")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the length and suffix filters."""
    for end in ("a", "b"):
        side = nodes.select(F.col("node").alias(end), F.col("n").alias(f"_n_{end}"), F.col("parts").alias(f"_parts_{end}"))
        pairs = pairs.join(side, end)
    return pairs.where(_close(F.col("_n_a"), F.col("_n_b"), percent)).where(_suffix_filter(percent)).select("a", "b")


def _sets(
    shelf: Shelf, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int
) -> tuple[DataFrame, DataFrame]:
    """(node, set) of the nodes in ``pairs``, from the text of one document of each, and the
    written table that it reads.

    The sets are dealt by node and not written: joins by node take them as they are dealt,
    and both ends of a pair the same ones.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = shelf.write(nodes.join(ends, "node").select("node", "digest", F.col("any_id").alias("_doc")), "wanted")

    @F.pandas_udf("set binary, digest binary")
    @lean
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles(text, words).tobytes() for text in texts]
            yield pd.DataFrame({"set": sets, "digest": [xxhash.xxh3_128(x).digest() for x in sets]})

    texts = docs.select(_doc_key().alias("_doc"), text_of().alias("text"))
    chosen = lookup_join(texts, wanted.select("_doc").distinct(), "_doc", "inner")
    found = chosen.select(whole("text").alias("_s")).select("_s.*")
    # Rows with one id may have several texts, and several rows one text.
    one = found.join(wanted.select("node", "digest"), "digest").select("node", "set")
    return one.dropDuplicates(["node"]), wanted


def _doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("set").alias(f"_set_{end}")), end)
    return pairs


def _crossed(
    left: DataFrame, right: DataFrame, on: list[str], percent: int, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Pairs of different nodes under one key that pass the length filter, with the n, the
    place and the columns ``carry`` of each."""
    rest = ("node", "n", "place", *carry)
    one = left.select(*on, *[F.col(c).alias(f"{c}_a") for c in rest])
    other = right.select(*on, *[F.col(c).alias(f"{c}_b") for c in rest])
    return one.join(other, on).where(
        (F.col("node_a") != F.col("node_b")) & _close(F.col("n_a"), F.col("n_b"), percent)
    )


def _few(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) under shingles with few nodes that pass the length and positional
    filters."""
    rows = entries.where(F.col("nodes") <= CROWD)
    met = _crossed(rows, rows, ["hash"], percent).where(F.col("node_a") < F.col("node_b"))
    # Shingles with many nodes may be shared too: as many as stand before this one.
    before = F.least("place_a", "place_b")
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) - 1
    most = before + 1 + rest
    near = met.where(100 * most >= percent * (F.col("n_a") + F.col("n_b") - most))
    return near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _crowded(
    shelf: Shelf, docs: DataFrame, nodes: DataFrame, entries: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Written (edges, pairs) for the shingles with many nodes: links to their centres, and the
    pairs beside them that may be linked and connect what the centres do not.

    The centre is the node with the fewest shingles of its own, which the texts of a group
    are likely to come from. Let D(x) be what x and the centre c differ by. Sets of s
    shingles together are linked if they differ by no more than (100 - percent) * s /
    (100 + percent) of them; let M(x) be that for x and the largest set it can be linked
    to. What a and b differ by is what D(a) and D(b) do not share. Where both are linked
    to c they are connected. Otherwise, let a be not linked to c. To be linked, a and b
    must then share at least |D(a)| - M(a) of D(a), and half of |D(b)| less the slack,
    which is M(a) - |D(a)| where that is above 0. So prefixes of D, rare ones first, must
    share an element, where an element of one D only cannot be shared; or they share none,
    and |D(b)| is within the slack.
    """
    crowds = entries.where(F.col("nodes") > CROWD)
    best = F.struct(-F.col("own"), "n", "node")
    centres = crowds.groupBy("hash").agg(F.max(best).alias("_c"))
    stars = crowds.join(centres.select("hash", F.col("_c.node").alias("b")), "hash")
    stars = stars.select(F.col("node").alias("a"), "b").where(F.col("a") != F.col("b")).distinct()
    stars = shelf.write(stars, "stars")
    # Written, so that a centre's partition can be split: all of its group meets it there.
    dealt, wanted = _sets(shelf, docs, nodes, stars, words)
    sets = shelf.write(dealt, "sets")
    shelf.give_up(wanted)

    @F.pandas_udf("n long, most long, linked boolean, difference array<long>")
    @lean
    def compared(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for a, b in batches:
            rows = []
            for left, right in zip(a, b):
                x, y = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
                difference = np.setxor1d(x, y, assume_unique=True)
                limit, size = 100 - percent, 100 + percent
                linked = len(difference) * size <= limit * (len(x) + len(y))
                most = limit * (len(x) + 100 * len(x) // percent) // size
                rows.append((len(x), most, linked, difference))
            yield pd.DataFrame(rows, columns=["n", "most", "linked", "difference"])

    found = _with_sets(stars, sets).select("a", "b", compared("_set_a", "_set_b").alias("_d"))
    found = found.select(F.col("a").alias("node"), F.col("b").alias("centre"), "_d.*")
    found = shelf.write(found.withColumn("size", F.size("difference")), "differences")
    shelf.give_up(stars, sets)
    edges = found.where("linked").select(F.col("node").alias("a"), F.col("centre").alias("b"))

    apart = found.where(~F.col("linked")).withColumn("room", F.col("most") - F.col("size"))
    slack = apart.groupBy("centre").agg(F.greatest(F.max("room"), F.lit(0)).alias("slack"))
    parts = found.select("node", "centre", "n", "most", "linked", "size", F.explode("difference").alias("part"))
    often = parts.groupBy("centre", "part").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    order = Window.partitionBy("centre", "node").orderBy("often", "part")
    everywhere = Window.partitionBy("centre", "node")
    size = F.col("size")
    # Places in the difference: its elements that no other one has stand in front.
    place = size - F.count("*").over(everywhere) + F.row_number().over(order) - 1
    shared = parts.join(often, ["centre", "part"]).withColumn("place", place).join(slack, "centre")
    long = size - F.greatest(size - F.col("most"), F.lit(1)) + 1
    short = size - F.greatest(F.ceil((size - F.col("slack")) / 2), F.lit(1)) + 1
    inside = F.col("place") < F.when(F.col("linked"), short).otherwise(F.greatest(long, short))
    placed = shelf.write(shared.where(inside), "parts")
    left = placed.where(~F.col("linked") & (F.col("place") < long))
    # At the first element that a and b share, what stands behind it in either must make up
    # for what their whole sets may not differ by.
    behind = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    may_differ = F.floor((100 - percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    enough = 2 * behind >= F.col("size_a") + F.col("size_b") - may_differ
    met = _crossed(left, placed.where(F.col("place") < short), ["centre", "part"], percent, ("size",)).where(enough)
    # Without a shared element only what is next to the centre can make up for the rest.
    one = apart.where(F.col("room") >= 0).select("centre", "room", F.col("node").alias("node_a"))
    other = found.join(slack, "centre").where(size <= F.col("slack"))
    other = other.select("centre", "size", F.col("node").alias("node_b"))
    beside = one.join(other, "centre").where((F.col("size") <= F.col("room")) & (F.col("node_a") != F.col("node_b")))
    pairs = met.select("node_a", "node_b").union(beside.select("node_a", "node_b"))
    ends = [F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")]
    edges, pairs = shelf.write(edges, "edges"), shelf.write(pairs.select(*ends).distinct(), "pairs")
    shelf.give_up(found, placed)
    return edges, pairs


def join(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, keys: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(members, edges). members: doc_id, n and node of every row, node null without
    shingles, and the columns ``keys`` of ``docs``. edges: linked pairs (a, b) of nodes that
    connect all that are linked in any number of steps.
    """
    small_batches(docs)
    table = frequency_table(docs, words)
    carried = ["doc_id", *(keys or {})]
    own = [column.alias(name) for name, column in (keys or {}).items()]
    described = docs.select("doc_id", *own, prefixes(table, words, percent).alias("_d")).select(*carried, "_d.*")
    shelf = Shelf()
    described = shelf.write(described, "prefixes")
    classes = (
        described.where(F.col("n") > 0)
        .groupBy("digest")
        .agg(
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("parts").alias("parts"),
            F.min(_doc_key()).alias("any_id"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = shelf.write(classes, "nodes")
    members = described.select(*carried, "n", "digest").join(nodes.select("digest", "node"), "digest", "left")
    members = materialise(members.drop("digest"), "members")
    shelf.give_up(described)
    # Dealt by shingle once: the window counts the nodes of a shingle where its rows are.
    exploded = nodes.select("node", F.posexplode("prefix").alias("place", "hash"))
    counted = exploded.withColumn("nodes", F.count("*").over(Window.partitionBy("hash")))
    several = shelf.write(counted.where(F.col("nodes") > 1), "several")
    # How many shingles of a node's prefix no other prefix has.
    shared = several.groupBy("node").agg(F.count("*").alias("_shared"))
    own = nodes.select("node", "n", F.size("prefix").alias("_size")).join(shared, "node")
    own = own.select("node", "n", (F.col("_size") - F.col("_shared")).alias("own"))
    entries = shelf.write(several.join(own, "node"), "entries")
    shelf.give_up(several)

    central, more = _crowded(shelf, docs, nodes, entries, words, percent)
    pairs = _few(entries, percent).union(more).distinct()
    pairs = shelf.write(_plausible(pairs, nodes, percent), "pairs")
    shelf.give_up(entries, more)
    sets, wanted = _sets(shelf, docs, nodes, pairs, words)
    verified = _with_sets(pairs, sets).where(_verified(percent))
    edges = materialise(central.union(verified.select("a", "b")), "edges")
    shelf.give_up(central, nodes, pairs, wanted)
    return members, edges


def _rooted(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, _id, root) of every node: its smallest id and its component."""
    roots = components(edges)
    # Minima by node before the join, so that the copies of a text cost a row a task.
    smallest = members.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("_id"))
    return materialise(
        smallest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, node.

    Texts that are null, empty or have no word have no shingles and are linked with
    nothing; their component is their own id. Equal sets and repeated rows are linked. A
    row without an id is linked like others, but is no component's smallest id unless no
    row of it has one. Columns beside doc_id and text are not looked at.
    """
    members, edges = join(docs, words, percent)
    rooted = _rooted(members, edges)
    named = rooted.groupBy("root").agg(F.min("_id").alias("component_id"))
    components_of = rooted.join(named, "root").select("node", "component_id")
    return members.join(components_of, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
    )


def _row_key(docs: DataFrame) -> Column:
    """128 bits of a row's values, the same wherever it is read again. Maps and variants
    cannot be hashed and do not count."""
    values = [F.col(f"`{c}`") for c, kind in docs.dtypes if not re.search(r"\b(map<|variant\b)", kind)]
    # A null leaves a hash as it is, so where the nulls are is hashed too.
    nulls = F.concat(*[v.isNull().cast("string") for v in values])
    return F.concat_ws(" ", F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), nulls, *values))


def kept(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, with their columns, that stay of their groups: exactly one row of
    each, the one with the smallest id (rows without an id come last) and of several such
    the one with the smallest key of its values. Of equal rows one stays. Rows without a
    word are linked with nothing and are kept.
    """
    members, edges = join(docs, words, percent, {"row": _row_key(docs)})
    roots = _rooted(members, edges).select("node", "root")
    # Equal rows are in one node: from here on a row for each different one.
    rows = members.where(F.col("node").isNotNull()).groupBy("node", "doc_id", "row").agg(F.count("*").alias("copies"))
    rows = materialise(rows.join(roots, "node"), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("_first")
    stays = rows.groupBy("root").agg(first).select("root", F.col("_first.row").alias("first"))
    fates = rows.join(stays, "root").select("row", (F.col("row") == F.col("first")).alias("stays"), "copies")
    fates = materialise(fates.where(~F.col("stays") | (F.col("copies") > 1)), "fates")

    whole = docs.select(_row_key(docs).alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    left = lookup_join(whole, fates, "row", keys_from=members).where(F.col("stays").isNull()).select("doc.*")
    copied = fates.where("stays").select("row")
    if copied.isEmpty():
        return left
    several = lookup_join(whole, copied, "row", "inner", keys_from=members)
    return left.union(several.groupBy("row").agg(F.first("doc").alias("doc")).select("doc.*"))
