"""Alignment of two tokenizers over a corpus, by inverted bitmaps of token pairs.

Where a token of A and one of B end at the same byte, the text is cut; inside a group all
A tokens are linked with all B tokens. Documents are dealt into containers of at most
65,536, and for each pair of ids a container has a compressed bitmap of the documents that
hold it linked, merged with OR as documents come, and planes of the bits of how often each
of them does. Containers share no document, so a pair's documents are the sum of its
bitmaps' bits. Each posting then gives its documents what its pair counts for.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadlark.llm.common import small_batches
from roadlark.operators.joins import lookup_join
from roadlark.session import materialise

SPACE = "▁"  # the pieces' sign for a space
CONTAINER_DOCS = 1 << 16
CONTAINER_POSTINGS = 1_000_000  # a container ends with the batch that passes this
KEPT_UNITS = 250_000  # units whose tokens a task keeps
KEPT_LETTERS = 16 << 20

# Cuts of a text across which neither side has a token: before a space behind anything but
# white space; and, where B has no piece across, between a letter and a sign and around a
# line end between other signs. The first group only says where to look.
LETTER, SIGN = "[A-Za-zÀ-ÖØ-öø-ɏ]", "[.,;:!?%$#&*]"
SPACES = r"(?<=\S)(?= )"
ALL_CUTS = (
    rf"(?=[ \n.,;:!?%$#&*])(?:{SPACES}|(?<={LETTER})(?={SIGN})|(?<=\S)(?=\n\S))"
    r"|(?<=\n)(?<=\S\n)(?=\S)"
)
LARGE = 4096  # links of a group that are counted before they are kept

STATS = ("n_a", "n_b", "n_groups", "n_links")
DIGEST = "n_a long, n_b long, n_groups long, n_links long"


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 signs
    stand for themselves, the others for the letters from 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def joined(sizes: np.ndarray) -> np.ndarray:
    """Where lists of these sizes begin when they lie one behind the other, and the end."""
    return np.concatenate([[0], np.cumsum(sizes)])


def counted_up(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for each of these sizes, one behind the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Units:
    """Tokens of a text's units, the pieces between its cuts. A unit is encoded once while
    it is kept. One that does not begin with a space is given to B, which adds a space to
    what it gets, behind a line end; the tokens of both are taken off again."""

    def __init__(self, definition: str, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # every core has its own task
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = SentencePieceProcessor(model_proto=model)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.width, self.ids = len(pieces), max(len(self.a_bytes), len(pieces))
        self.names = [f"{i}{sign}" for sign in ",|;" for i in range(self.ids)]
        self.name_sizes = np.array(list(map(len, self.names)), np.int64)
        self.space, self.line = [self.b.piece_to_id(SPACE)], self.b.encode("\n")
        # No piece goes on with a space behind other letters, or else a text is one unit.
        whole = any(SPACE in p.lstrip(SPACE) for p in pieces)
        across = re.compile(rf"{LETTER}{SIGN}|\n")
        fine = len(self.line) == 2 and self.line[0] == self.space[0] and self.b.is_byte(self.line[1])
        fine = fine and not any(across.search(p) for p in pieces)
        self.cut = re.compile(r"(?!)" if whole else ALL_CUTS if fine else SPACES)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.letters = 0
        self.groups: list[str] = []
        self.stats = np.zeros((0, len(STATS)), np.int64)
        self.good = np.zeros(0, bool)
        self.starts = np.zeros(1, np.int64)  # where a unit's pairs begin in the two below
        self.pairs = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int64)

    def split(self, text: str) -> list[str]:
        return self.cut.split(" " + text)

    def add(self, units: list[str]) -> None:
        """Encodes new units."""
        from_a = [x.ids for x in self.a.encode_batch_fast(units, add_special_tokens=False)]
        spaced = [u[0] == " " for u in units]
        from_b = self.b.encode([u[1:] if s else "\n" + u for u, s in zip(units, spaced)], num_threads=1)
        skip = len(self.line)
        from_b = [self.space if u == " " else b if s else b[skip:] for u, s, b in zip(units, spaced, from_b)]
        sizes = np.array([len(u) if u.isascii() else len(u.encode()) for u in units], np.int64)
        good = self._good(units, from_a, from_b)
        stats = np.array([(len(a), len(b), 0, 0) for a, b in zip(from_a, from_b)], np.int64)
        some = np.flatnonzero(good).tolist()
        texts, inner, pairs, times, of = self._groups([from_a[i] for i in some], [from_b[i] for i in some], sizes[good])
        stats[good, 2:] = inner
        named = iter(texts)
        self.groups += [next(named) if g else "" for g in good.tolist()]
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units))))
        self.letters += sum(map(len, units))
        counts = np.zeros(len(units), np.int64)
        counts[good] = np.bincount(of, minlength=len(some))
        self.stats = np.concatenate([self.stats, stats])
        self.good = np.concatenate([self.good, good])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.times = np.concatenate([self.times, times])

    def _good(self, units: list[str], from_a: list[list[int]], from_b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of both sides give the unit's bytes."""
        fine = np.ones(len(units), bool)
        for tokens, known in ((from_a, self.a_bytes), (from_b, self.b_bytes)):
            get = known.__getitem__
            fine &= np.array([b"".join(map(get, ids)) == u.encode() for ids, u in zip(tokens, units)], bool)
        return fine

    def _groups(
        self, from_a: list[list[int]], from_b: list[list[int]], sizes: np.ndarray
    ) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of units laid one behind the other: each one's groups as text, its groups and
        links, and all pairs with their times and units, in the units' order."""
        a_n, b_n = (np.array(list(map(len, x)), np.int64) for x in (from_a, from_b))
        a, b = (np.fromiter((i for ids in x for i in ids), np.int64, int(n.sum())) for x, n in ((from_a, a_n), (from_b, b_n)))
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
        first_a, first_b = np.concatenate([[0], last_a])[:-1], np.concatenate([[0], last_b])[:-1]
        wide, high = last_a - first_a, last_b - first_b
        unit = np.searchsorted(np.cumsum(sizes), cuts)
        links = wide * high
        numbers = np.zeros((len(sizes), 2), np.int64)
        np.add.at(numbers, unit, np.column_stack([np.ones_like(links), links]))

        # Each group's A tokens, then its B tokens, with the sign that follows each.
        in_a, in_b = np.repeat(np.arange(len(cuts)), wide), np.repeat(np.arange(len(cuts)), high)
        names = np.zeros(len(a) + len(b), np.int64)
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[last_a - 1], sign_b[last_b - 1] = 1, 2
        names[np.arange(len(a)) + first_b[in_a]] = a + sign_a * self.ids
        names[np.arange(len(b)) + last_a[in_b]] = b + sign_b * self.ids
        text = "".join(map(self.names.__getitem__, names.tolist()))
        at = joined(self.name_sizes[names])[joined(a_n + b_n)].tolist()
        texts = [text[i : j - 1] for i, j in zip(at, at[1:])]

        few = np.flatnonzero(links <= LARGE)
        group, place = np.repeat(few, links[few]), counted_up(links[few])
        pairs = a[first_a[group] + place // high[group]] * self.width + b[first_b[group] + place % high[group]]
        times, of = np.ones(len(pairs), np.int64), unit[group]
        for g in np.flatnonzero(links > LARGE).tolist():
            x, n = np.unique(a[first_a[g] : last_a[g]], return_counts=True)
            y, m = np.unique(b[first_b[g] : last_b[g]], return_counts=True)
            pairs = np.concatenate([pairs, np.add.outer(x * self.width, y).ravel()])
            times = np.concatenate([times, np.multiply.outer(n, m).ravel()])
            of = np.concatenate([of, np.full(len(x) * len(y), unit[g])])
        order = np.argsort(of, kind="stable")
        return texts, numbers, pairs[order], times[order], of[order]

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Of each text: its numbers, whether it has tokens, its units."""
        if len(self.index) > KEPT_UNITS or self.letters > KEPT_LETTERS:
            self.clear()
        split = [self.split(t) if t else [] for t in texts]
        fresh = set().union(*split).difference(self.index) if split else set()
        if fresh:
            self.add(sorted(fresh))
        found = [list(map(self.index.__getitem__, parts)) for parts in split]
        ends = np.cumsum(np.array([len(x) for x in found], np.int64))
        flat = np.fromiter((u for x in found for u in x), np.int64, int(ends[-1]) if len(ends) else 0)
        before = np.concatenate([[0], ends])
        sums = np.concatenate([np.zeros((1, len(STATS)), np.int64), np.cumsum(self.stats[flat], axis=0)])[before]
        bad = np.concatenate([[0], np.cumsum(~self.good[flat])])[before]
        fine = (np.diff(bad) == 0) & (np.diff(before) > 0)
        numbers = np.where(fine[:, None], np.diff(sums, axis=0), 0)
        return numbers, fine, found

    def links(self, found: list[list[int]], places: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (pair, place) of some texts' links and how often each occurs."""
        flat = np.fromiter((u for x in found for u in x), np.int64)
        place = np.repeat(np.array(places, np.int64), [len(x) for x in found])
        both, often = np.unique(place * len(self.groups) + flat, return_counts=True)
        place, unit = np.divmod(both, max(1, len(self.groups)))
        sizes = self.starts[unit + 1] - self.starts[unit]
        at = np.arange(sizes.sum()) + np.repeat(self.starts[unit] - np.cumsum(sizes) + sizes, sizes)
        keys = self.pairs[at] * CONTAINER_DOCS + np.repeat(place, sizes)
        return merged(keys, self.times[at] * np.repeat(often, sizes))


def merged(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys made one, their times added: OR of the bitmaps they stand for."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times


def bitmaps(keys: np.ndarray, times: np.ndarray, docs: int) -> dict[str, list]:
    """The postings of a container of ``docs`` documents, one for each pair.

    A bitmap is the documents' places as 16-bit numbers, or one bit for each document of
    the container where that is shorter (``dense``). Plane k has a bit for each document
    in the bitmap: bit k of its times less one; pairs that occur once have no plane.
    """
    pair, place = keys >> 16, (keys & (CONTAINER_DOCS - 1)).astype("<u2")
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(pair))
    more = times - 1
    most = np.maximum.reduceat(more, first) if len(first) else first
    links = np.add.reduceat(times, first) if len(first) else first
    raw, dense = place.tobytes(), (last - first) * 16 > docs
    maps, planes = [], []
    for a, b, wide, top in zip(first.tolist(), last.tolist(), dense.tolist(), most.tolist()):
        if wide:
            bits = np.zeros(docs, bool)
            bits[place[a:b]] = True
            maps.append(np.packbits(bits).tobytes())
        else:
            maps.append(raw[2 * a : 2 * b])
        part = more[a:b]
        planes.append(b"".join(np.packbits((part >> k) & 1 == 1).tobytes() for k in range(int(top).bit_length())))
    return {
        "pair": pair[first].tolist(), "n": (last - first).tolist(), "links": links.tolist(), "dense": dense.tolist(),
        "docs": maps, "planes": planes,
    }


def postings(maps: list[bytes], planes: list[bytes], dense: list[bool], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents of bitmaps, one behind the other, and the times of each."""
    parts = [
        np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8))).astype("<u2").tobytes() if wide else m
        for m, wide in zip(maps, dense)
    ]
    place = np.frombuffer(b"".join(parts), "<u2").astype(np.int64)
    times = np.ones(len(place), np.int64)
    begins = np.cumsum(sizes) - sizes
    for a, n, blob in zip(begins.tolist(), sizes.tolist(), planes):
        if blob:
            width = (n + 7) // 8
            for k in range(len(blob) // width):
                bits = np.unpackbits(np.frombuffer(blob, np.uint8, width, k * width), count=n)
                times[a : a + n] += bits.astype(np.int64) << k
    return place, times


POSTING = "pair long, n int, links long, dense boolean, docs binary, planes binary"


def index(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """Documents (with ``place`` in their ``container``) and postings, in one written table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"is_doc boolean, container long, place int, doc_id {kind}, {DIGEST}, groups_sha256 string, {POSTING}"
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.col("text").cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(definition, model)
        container, size, keys, times = None, 0, [], []

        def flushed() -> pa.RecordBatch:
            found = bitmaps(*merged(np.concatenate(keys), np.concatenate(times)), size)
            return _batch(out, len(found["pair"]), {"is_doc": False, "container": container, **found})

        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or _arrow_schema(batch.schema.field("doc_id").type)
            if container is not None and (size + batch.num_rows > CONTAINER_DOCS or sum(map(len, keys)) > CONTAINER_POSTINGS):
                yield flushed()
                container, size, keys, times = None, 0, [], []
            if container is None:
                container = batch.column("_row")[0].as_py()
            for begin in range(0, batch.num_rows, CONTAINER_DOCS):
                part = batch.slice(begin, CONTAINER_DOCS)
                if begin:
                    yield flushed()
                    container, size, keys, times = part.column("_row")[0].as_py(), 0, [], []
                n = part.num_rows
                numbers, fine, found = units.of(part.column("text").to_pylist())
                some = np.flatnonzero(fine).tolist()
                pairs, often = units.links([found[i] for i in some], [size + i for i in some])
                keys.append(pairs)
                times.append(often)
                get = units.groups.__getitem__
                digests = [hashlib.sha256(";".join(map(get, x)).encode()).hexdigest() if f else "" for x, f in zip(found, fine)]
                columns = {"is_doc": True, "container": container, "place": range(size, size + n), "groups_sha256": digests}
                columns |= {"doc_id": part.column("doc_id")} | {c: numbers[:, i] for i, c in enumerate(STATS)}
                yield _batch(out, n, columns)
                size += n
        if container is not None:
            yield flushed()

    return materialise(rows.mapInArrow(encode, schema), "alignment")


def _batch(schema: pa.Schema, rows: int, columns: dict) -> pa.RecordBatch:
    """Rows of some columns, of which one value may stand for all; the others are null."""
    arrays = []
    for f in schema:
        values = columns.get(f.name)
        if values is None:
            arrays.append(pa.nulls(rows, f.type))
        elif isinstance(values, (bool, int)):
            arrays.append(pa.array([values] * rows, f.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow_schema(doc_id: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("is_doc", pa.bool_()), ("container", pa.int64()), ("place", pa.int32()), ("doc_id", doc_id)]
        + [(c, pa.int64()) for c in STATS]
        + [("groups_sha256", pa.string()), ("pair", pa.int64()), ("n", pa.int32()), ("links", pa.int64())]
        + [("dense", pa.bool_()), ("docs", pa.binary()), ("planes", pa.binary())]
    )


def _pieces(model: bytes) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model).get_piece_size()


def pair_counts(table: DataFrame, width: int) -> DataFrame:
    """(pair, a_id, b_id, n_docs, n_links, best) of each pair of ids that is linked anywhere;
    ``best`` is whether no pair of its A id is in more documents. There are no more A ids
    than the vocabulary has, so their highest counts are broadcast."""
    counts = (
        table.where(~F.col("is_doc")).groupBy("pair").agg(F.sum("n").alias("n_docs"), F.sum("links").alias("n_links"))
        .withColumns({"a_id": F.floor(F.col("pair") / width).cast("int"), "b_id": (F.col("pair") % width).cast("int")})
    )
    counts = materialise(counts, "pairs")
    highest = counts.groupBy("a_id").agg(F.max("n_docs").alias("_most"))
    return counts.join(F.broadcast(highest), "a_id").select(
        "pair", "a_id", "b_id", "n_docs", "n_links", (F.col("n_docs") == F.col("_most")).alias("best")
    )


def read_models(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def linked_pairs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a_id, b_id, n_docs, n_links, best): the corpus-wide table of linked id pairs."""
    small_batches(docs)
    definition, model = read_models(a_path, b_path)
    return pair_counts(index(docs, definition, model), _pieces(model)).drop("pair")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``a_path`` is the file of a byte-level BPE tokenizer, ``b_path`` of a piece model that
    puts a space before a text; both are read on the driver. A encodes a space and the
    text, without special tokens. ``n_best`` are links whose pair is in as many documents
    as any of its A id, ``count_sum`` adds the documents of the pair over all links.

    Rows whose text is null or empty, or whose tokens' bytes are not a space and the text on
    both sides, have no tokens: zeros and an empty digest. Each row is a document, also
    where rows repeat; doc_id is only carried. An empty table gives no rows; other columns
    are not looked at.
    """
    small_batches(docs)
    definition, model = read_models(a_path, b_path)
    table = index(docs, definition, model)
    weights = pair_counts(table, _pieces(model)).select("pair", "n_docs", "best")
    posted = lookup_join(
        table.where(~F.col("is_doc")).select("pair", "container", "n", "dense", "docs", "planes"),
        materialise(weights, "weights"), "pair", "inner",
    )
    carried = ["container", "place", "doc_id", *STATS, "groups_sha256"]
    there = table.where("is_doc").select([F.col(c).alias(c) for c in carried])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(rows: pa.Table, found: pa.Table) -> pa.Table:
        total, best = np.zeros(CONTAINER_DOCS, np.int64), np.zeros(CONTAINER_DOCS, np.int64)
        if found.num_rows:
            sizes = found["n"].to_numpy().astype(np.int64)
            place, times = postings(found["docs"].to_pylist(), found["planes"].to_pylist(), found["dense"].to_pylist(), sizes)
            np.add.at(total, place, times * np.repeat(found["n_docs"].to_numpy(), sizes))
            np.add.at(best, place, times * np.repeat(found["best"].to_numpy(zero_copy_only=False), sizes))
        at = rows["place"].to_numpy()
        names = ["doc_id", *STATS, "n_best", "count_sum", "groups_sha256"]
        columns = {"n_best": pa.array(best[at]), "count_sum": pa.array(total[at])}
        return pa.table({n: columns[n] if n in columns else rows[n] for n in names})

    schema = f"doc_id {kind}, {DIGEST}, n_best long, count_sum long, groups_sha256 string"
    return there.groupBy("container").cogroup(posted.groupBy("container")).applyInArrow(scored, schema)
