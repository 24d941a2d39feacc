"""Packing documents into sequences along a space-filling curve.

A document's vector is the mean of random directions of its token ids; a few dimensions of
it, cut into a grid, give its key on a Hilbert curve. Documents are sorted by range of the
key, and each token's place in that order gives its sequence: documents that are near each
other share sequences, and only the last sequence needs padding.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from roadlark.llm.common import give_back, lean, small_batches, text_of
from roadlark.session import materialise

SEQUENCE = 4096
END = 2  # id behind each document
DIMENSIONS = 4
GRID_BITS = 10  # of each dimension
CACHED_WORDS = 200_000  # of a task
CACHED_LETTERS = 8 << 20
UNSTABLE = "Σİ"  # letters whose lower case depends on others or is more than one
TAIL = ".,;:!?%$#&*"  # signs that the tokenizer always parts from a letter before them
LINE_WORDS = 500  # words encoded as one text
# Letters and signs of which every Unicode version says the same, and whose lower case is in
# normal form; what else a text may hold is left to the tokenizer.
FOREIGN = "[^\\t-\\r -~¡-±´-¸»¿-\u012f\u0131-\u024f\u2010-\u2027\u20ac]"
PART = b".,;:!?"  # cut from the letter or digit before them, so that they make no words of their own
# Where the tokenizer cuts a word of these in lower case. Digits have an id each.
PIECES = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|[0-9]{1,3}|(?:[^\w\s]|_)+")


def _tokenizer(definition: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Key of each row of grid places (0 to 2 ** bits - 1) on a Hilbert curve."""
    axes = [column.astype(np.int64).copy() for column in grid.T]
    side = 1 << (bits - 1)
    while side > 1:
        low = side - 1
        for i in range(len(axes)):
            high = (axes[i] & side) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] if i == 0 else axes[i] ^ swap
        side >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros(len(grid), np.int64)
    side = 1 << (bits - 1)
    while side > 1:
        flip = np.where((axes[-1] & side) != 0, flip ^ (side - 1), flip)
        side >>= 1
    key = np.zeros(len(grid), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> bit) & 1)
    return key


def _words(text: str) -> list[str]:
    """The text at its plain spaces and line ends. The tokenizer drops white space and
    joins nothing across it, so the words' ids are the text's ids."""
    return text.replace("\n", " ").split(" ")


def _parted(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words in lower case, without foreign signs, cut before a sign of PART at their ends that
    stands behind a letter or digit, and how many parts each has."""
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    kinds = np.zeros(256, np.uint8)
    kinds[list(PART)] = 1
    kinds[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = 2
    kinds[0xC3:0xCA] = 3  # the first byte of two, nearly always of a letter
    ends, sizes = offsets[1:], np.diff(offsets)
    at = np.flatnonzero(sizes > 1)
    at = at[kinds[data[ends[at] - 1]] == 1]
    sign = ends[at] - 1
    last, two = data[sign - 1], kinds[data[np.maximum(sign - 2, 0)]] == 3
    times = (data[np.maximum(sign - 2, 0)] == 0xC3) & ((last == 0x97) | (last == 0xB7))
    cut = (kinds[last] == 2) | (last >= 0x80) & two & ~times & (sizes[at] > 2)
    parts = np.ones(len(words), np.int64)
    parts[at[cut]] = 2
    borders = np.insert(offsets, at[cut] + 1, sign[cut])
    return pa.StringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders), words.buffers()[2]), parts


class Words:
    """Ids of words, each word encoded once while it is kept."""

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = _tokenizer(definition)
        self.size = max(self.tokenizer.get_vocab_size(), END + 1)
        self.code = "H" if self.size <= 1 << 16 else "I"
        # Texts with one of these go to the tokenizer whole: it has ids for them.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # For words of letters that are in lower case and in normal form, one piece each.
        # Bytes of ASCII letters stand for themselves.
        split = pre_tokenizers.WhitespaceSplit()
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain = []
        for cut in (split, pre_tokenizers.Sequence([split, bytewise])):
            self.plain.append(Tokenizer(self.tokenizer.model))  # one model for all
            self.plain[-1].normalizer = normalizers.Sequence([])
            self.plain[-1].pre_tokenizer = cut
        # Which ids end a word. Without a suffix words are encoded one by one.
        self.last = np.zeros(self.size, bool)
        if suffix := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self._forget()
        give_back()  # what reading the definition took

    def _forget(self) -> None:
        # Words, and words of several pieces, with their number; their ids lie in that order.
        self.known: dict[str, int] = {"": 0}
        self.several: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, self.code), np.zeros(1, np.int64)
        self.met = np.zeros(1, np.int64)  # in how many batches of texts
        self.letters = 0

    def _make_room(self) -> None:
        """Words of a single batch go, or all if the others are too many as well."""
        if len(self.sizes) <= CACHED_WORDS and self.letters <= CACHED_LETTERS:
            return
        stay = self.met > 1
        stay[0] = True
        letters = sum(len(w) for kept in (self.known, self.several) for w, i in kept.items() if stay[i])
        if 2 * stay.sum() > CACHED_WORDS or 2 * letters > CACHED_LETTERS:
            self._forget()
            return
        number = np.cumsum(stay) - 1
        self.known = {w: int(number[i]) for w, i in self.known.items() if stay[i]}
        self.several = {w: int(number[i]) for w, i in self.several.items() if stay[i]}
        self.flat, self.sizes = self._joined(np.flatnonzero(stay))
        self.met, self.letters = np.ones(len(self.sizes), np.int64), letters

    def _keep(self, kept: dict[str, int], words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        kept.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.letters += sum(map(len, words))
        self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])

    def _joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of kept words, one behind the other, and how many each has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(self.sizes) - self.sizes)[numbers] - (ends - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes

    def _dealt(self, numbers: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
        """The ids of each text; ``before`` tells how many of the words stand before each text
        and behind the last."""
        ids, sizes = self._joined(numbers)
        cuts = np.append(0, np.cumsum(sizes))[before].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers, -1 for those not kept."""
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        rest = np.flatnonzero(numbers < 0).tolist()
        numbers[rest] = list(map(self.several.get, map(words.__getitem__, rest), repeat(-1)))
        return numbers

    def _encode(self, words: list[str], lower: bool = False) -> None:
        """Words of letters are encoded many at a time. ``lower`` tells that all are in lower
        case and in normal form."""
        plain, other = ([], []), []
        for word in words:
            if word.isalpha() and (lower or word == word.lower() and unicodedata.is_normalized("NFC", word)):
                plain[not word.isascii()].append(word)
            else:
                other.append(word)
        done, ids, sizes = [], [], []
        for tokenizer, kind in zip(self.plain, plain):
            lines = [kind[i : i + LINE_WORDS] for i in range(0, len(kind), LINE_WORDS)]
            texts = list(map(" ".join, lines))
            for line, found in zip(lines, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                blob = np.array(found.ids, self.code)
                ends = np.flatnonzero(self.last[blob])
                if len(ends) != len(line) or ends[-1] != len(blob) - 1:
                    other += line
                    continue
                done += line
                ids.append(blob)
                sizes.append(np.diff(ends, prepend=-1))
        for word, found in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            done.append(word)
            ids.append(np.array(found.ids, self.code))
            sizes.append([len(found.ids)])
        if done:
            self._keep(self.known, done, np.concatenate(ids), np.concatenate(sizes))

    def _join(self, cut: dict[str, list[str]]) -> None:
        """Keeps words whose pieces are kept."""
        if cut:
            pieces = self._numbers(list(chain.from_iterable(cut.values())))
            ids, sizes = self._joined(pieces)
            self.met[pieces] += 1
            ends = np.cumsum(sizes)[np.cumsum([len(p) for p in cut.values()]) - 1]
            self._keep(self.several, list(cut), ids, np.diff(ends, prepend=0))

    def add(self, words: set[str]) -> None:
        """A word is encoded in lower case, as the tokenizer takes it, and apart from the
        signs behind it. Words with UNSTABLE letters are left as they are."""
        cut, bodies = {}, set()
        for word in words.difference(self.known, self.several):
            body, tail = word, ""
            if not any(letter in word for letter in UNSTABLE):
                lower = word.lower()
                if word.isalpha():
                    body = lower
                elif (bare := lower.rstrip(TAIL)) and bare[-1].isalnum():
                    body, tail = bare, lower[len(bare) :]
            bodies.update((body, tail))
            if body != word:
                cut[word] = [body, tail]
        self._encode(list(bodies.difference(self.known)))
        self._join(cut)

    def _gathered(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of texts in lower case without foreign signs. Each different word of
        them is looked up once, and what is made of it kept."""
        split = pc.ascii_split_whitespace(texts)
        parted, parts = _parted(split.flatten())
        words = parted.dictionary_encode()
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = self._numbers(different)
        missing = np.flatnonzero(numbers < 0)
        fresh = [different[i] for i in missing.tolist()]
        cut = {word: PIECES.findall(word) for word in fresh if not word.isalpha()}
        new = dict.fromkeys(filter(str.isalpha, fresh))
        new.update(dict.fromkeys(set(chain.from_iterable(cut.values())).difference(self.known)))
        self._encode(list(new), lower=True)
        self._join({word: pieces for word, pieces in cut.items() if word not in self.known})
        numbers[missing] = self._numbers(fresh)
        self.met[numbers] += 1
        return self._dealt(numbers[words.indices.to_numpy()], np.append(0, np.cumsum(parts))[split.offsets.to_numpy()])

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, the last one included."""
        self._make_room()
        found: list[np.ndarray] = [np.zeros(0, self.code)] * len(texts)
        foreign = pc.match_substring_regex(pa.array(texts, pa.string()), FOREIGN).to_pylist()
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        rest = sorted(set(range(len(texts))).difference(whole))
        if latin := [i for i in rest if not foreign[i]]:
            lower = pa.array([texts[i].lower() for i in latin], pa.string())
            for i, ids in zip(latin, self._gathered(lower)):
                found[i] = ids
        if other := [i for i in rest if foreign[i]]:
            split = [_words(texts[i]) for i in other]
            different = set().union(*split)
            self.add(different)
            self.met[self._numbers(list(different))] += 1
            before = np.append(0, np.cumsum([len(words) for words in split]))
            for i, ids in zip(other, self._dealt(self._numbers(list(chain.from_iterable(split))), before)):
                found[i] = ids
        for i in whole:
            found[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, self.code)
        last = array(self.code, [END]).tobytes()
        return [ids.tobytes() + last for ids in found]


def tokenised(docs: DataFrame, definition: str) -> DataFrame:
    """_row, doc_id, n (tokens with the last one), key, ids (as bytes) of each document."""

    @F.pandas_udf("n long, key long, ids binary")
    @lean
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Spark gives every core its task: the tokenizer needs no threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = Words(definition)
        kind = np.dtype(f"<u{array(words.code).itemsize}")
        table = np.random.default_rng(5).normal(size=(words.size, DIMENSIONS)).astype(np.float32)
        for texts in batches:
            blobs = words.ids(texts.to_list())
            sizes = np.array([len(b) // kind.itemsize for b in blobs], np.int64)
            means = np.zeros((len(blobs), DIMENSIONS))
            for i, blob in enumerate(blobs):
                means[i] = table.take(np.frombuffer(blob, kind), axis=0).mean(axis=0)
            # A place between 0 and 1, spread by what means of so many directions vary.
            even = 1 / (1 + np.exp(-8 * means))
            grid = np.minimum((even * (1 << GRID_BITS)).astype(np.int64), (1 << GRID_BITS) - 1)
            yield pd.DataFrame({"n": sizes, "key": hilbert(grid, GRID_BITS), "ids": blobs})

    rows = docs.select("doc_id", encode(text_of()).alias("_t"))
    return rows.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "_t.*")


def starts(tokens: DataFrame) -> DataFrame:
    """(_row, _start): how many tokens stand before each document, along the curve.

    The keys are cut into sorted ranges; one sum for each range tells what stands before.
    """
    order = ["key", "_row"]
    ranges = tokens.select("key", "_row", "n").repartitionByRange(*order)
    ranges = materialise(ranges.withColumn("_range", F.spark_partition_id()), "curve")
    sums = ranges.groupBy("_range").agg(F.sum("n").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.sum("n").over(Window.partitionBy("_range").orderBy(*order)) - F.col("n")
    return ranges.join(F.broadcast(offsets), "_range").select("_row", (F.col("_before") + inside).alias("_start"))


def pack(docs: DataFrame, path: str, length: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` names the file of a tokenizer that takes texts in lower case and bytes as its
    alphabet; it is read on the driver. A null or empty text is one id,
    the last one. Every document is cut where a sequence is full, so all sequences but the
    last are full. Repeated rows are packed each for itself. An empty table gives no piece.
    Columns beside doc_id and text are not looked at.
    """
    small_batches(docs)
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    tokens = materialise(tokenised(docs, definition), "tokens")
    code = Words(definition).code

    @F.pandas_udf("array<struct<start: long, length: long, ids_crc32: long>>")
    def pieces(ids: pd.Series, first: pd.Series) -> pd.Series:
        found = []
        for blob, place in zip(ids, first):
            whole = np.frombuffer(blob, f"<u{array(code).itemsize}").astype("<u4")
            cuts = [0, *range(length - place % length, len(whole), length), len(whole)]
            found.append(
                [
                    {"start": a, "length": b - a, "ids_crc32": zlib.crc32(whole[a:b].tobytes())}
                    for a, b in zip(cuts, cuts[1:])
                ]
            )
        return pd.Series(found)

    placed = tokens.drop("key").join(starts(tokens), "_row")
    cut = placed.select("doc_id", "n", "_start", F.explode(pieces("ids", "_start")).alias("_p"))
    at = F.col("_start") + F.col("_p.start")
    return cut.select(
        "doc_id",
        "_p.start",
        "_p.length",
        "_p.ids_crc32",
        F.col("n").alias("doc_tokens"),
        F.floor(at / length).cast("long").alias("sequence_id"),
        (at % length).alias("offset"),
    )
