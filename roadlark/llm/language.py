"""Language identification by unigram models of word pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for
each piece, estimated by expectation maximisation on a sample of documents. The forward
algorithm sums the probability of all ways to cut a word into pieces; a text's likelihood
is the product over its words, since no piece goes beyond a word. A long word is cut where
none of its pieces reaches over, which changes no sum; what is still long is summed in logarithms.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadlark.llm.common import SAMPLE_BUCKETS, remainder, small_batches, text_of
from roadlark.session import materialise

FIT_DOCS = 20_000  # documents the models are fitted on, about, at most
FOLDS = 4
HELD_OUT = 2
ROUNDS = 2  # of expectation maximisation
PLAIN = 32  # letters: products over so many are within the range of doubles
UNKNOWN = 1e-8  # probability of a letter that is no piece, in every language
SMOOTHING = 0.1  # added to the expected count of each piece
CACHED_WORDS = 200_000
LETTERS = 200_000  # of words scored at a time, or one longer word
UNDETERMINED = "und"

_START = "▁"
_FILTER_BITS = 22


@functools.cache
def _places(letters: int) -> np.ndarray:
    """An odd factor for each place in a piece."""
    return np.random.default_rng(3).integers(1 << 62, 1 << 63, letters, np.uint64) * np.uint64(2) + np.uint64(1)


def _hash(piece: str) -> int:
    codes = np.array([ord(c) for c in piece], np.uint64)
    return int((codes * _places(1024)[: len(codes)]).sum(dtype=np.uint64))


@dataclass
class Vocabulary:
    """Sorted hashes of the pieces, and the length of the longest one."""

    hashes: np.ndarray
    longest: int

    @staticmethod
    def read(path: str) -> Vocabulary:
        """Of a sentence-piece model file; control, unknown and byte pieces are left out, and
        pieces with a word start inside."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        plain = [p for p in pieces if p and _START not in p[1:]]
        return Vocabulary(np.unique(np.array([_hash(p) for p in plain], np.uint64)), max(map(len, plain)))

    def quick(self) -> np.ndarray:
        """Which values of a hash's first bits any piece has."""
        some = np.zeros(1 << _FILTER_BITS, bool)
        some[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return some


class Lattice:
    """Every way to cut a list of words, as arcs between the places of their letters.

    A word is one part; one of more than PLAIN letters is several, cut where no piece reaches
    over, so that its probability is the product of theirs. A part of n letters has n + 1
    nodes; an arc is a piece (its index, or the number of pieces for a letter that is none)
    from the node before it to the node behind it.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary, quick: np.ndarray) -> None:
        lengths = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        word = np.repeat(np.arange(len(words)), lengths)
        begin = np.cumsum(lengths) - lengths
        room = (begin + lengths)[word] - np.arange(len(codes))
        places = _places(1024)
        value = np.zeros(len(codes) + 1, np.uint64)
        starts, pieces, sizes = [], [], []
        for length in range(1, vocabulary.longest + 1):
            if len(codes) < length:
                break
            value = value[:-1] + codes[length - 1 :] * places[length - 1]
            fits = room[: len(value)] >= length
            maybe = np.flatnonzero(fits & quick[(value >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            piece = np.minimum(np.searchsorted(vocabulary.hashes, value[maybe]), len(vocabulary.hashes) - 1)
            known = vocabulary.hashes[piece] == value[maybe]
            if length == 1:
                own = np.full(len(codes), len(vocabulary.hashes))
                own[maybe[known]] = piece[known]
                maybe, piece = np.arange(len(codes)), own
            else:
                maybe, piece = maybe[known], piece[known]
            starts.append(maybe)
            pieces.append(piece)
            sizes.append(np.full(len(maybe), length))
        letter, size = np.concatenate(starts), np.concatenate(sizes)
        self.piece = np.concatenate(pieces)
        # Arcs over the gap in front of each letter: where there are none, a long word is cut.
        over = np.bincount(letter + 1, minlength=len(codes) + 2) - np.bincount(letter + size, minlength=len(codes) + 2)
        new = (np.cumsum(over)[: len(codes)] == 0) & (lengths > PLAIN)[word]
        new[begin] = True
        part = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(codes)))
        self.parts = np.bincount(word[begin], minlength=len(words))  # of each word
        self.first = begin + np.arange(len(begin))  # node in front of each part
        self.last = self.first + count
        self.nodes = len(codes) + len(begin)
        self.start = letter + part[letter]
        self.end = self.start + size
        self.step = letter - begin[part[letter]] + size
        self.long = (count > PLAIN)[part[letter]]

    def _waves(self, order: np.ndarray, steps: np.ndarray) -> Iterator[np.ndarray]:
        bounds = np.flatnonzero(np.diff(steps[order])) + 1
        yield from np.split(order, bounds) if len(order) else ()

    def _sums(self, probability: np.ndarray, at: np.ndarray, origin: np.ndarray, goal: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Logarithms of the sums that arcs carry from ``origin`` to ``goal``, in order of ``steps``."""
        order = np.lexsort((goal, steps))
        total = np.zeros((self.nodes, probability.shape[1]))
        total[at] = 1.0
        for arcs in self._waves(order[~self.long[order]], steps):
            goals = goal[arcs]
            cut = np.flatnonzero(np.append(True, goals[1:] != goals[:-1]))
            total[goals[cut]] = np.add.reduceat(total[origin[arcs]] * probability[self.piece[arcs]], cut, axis=0)
        with np.errstate(divide="ignore"):
            total = np.log(total)
        if self.long.any():
            logs = np.log(probability)
            for arcs in self._waves(order[self.long[order]], steps):
                goals = goal[arcs]
                cut = np.flatnonzero(np.append(True, goals[1:] != goals[:-1]))
                total[goals[cut]] = np.logaddexp.reduceat(total[origin[arcs]] + logs[self.piece[arcs]], cut, axis=0)
        return total

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """(nodes, languages): log probability of all ways from a part's start to the node."""
        return self._sums(probability, self.first, self.start, self.end, self.step)

    def backward(self, probability: np.ndarray) -> np.ndarray:
        """(nodes, languages): log probability of all ways from the node to its part's end."""
        return self._sums(probability, self.last, self.end, self.start, self.end - self.start - self.step)

    def by_word(self, of_parts: np.ndarray) -> np.ndarray:
        """Sums of the parts' values for each word."""
        return np.add.reduceat(of_parts, np.cumsum(self.parts) - self.parts, axis=0)


def words_of(text: str) -> list[str]:
    """Lower-case words, each with the sign of a word start."""
    return [_START + w for w in text.lower().split()]


def by_letters(words: list[str], most: int = LETTERS) -> Iterator[list[str]]:
    """The words in order, in lists of ``most`` letters or of one longer word."""
    taken: list[str] = []
    letters = 0
    for word in words:
        if taken and letters + len(word) > most:
            yield taken
            taken, letters = [], 0
        taken.append(word)
        letters += len(word)
    if taken:
        yield taken


@dataclass
class Model:
    """Learned languages in order, and for each piece its probability in each language."""

    vocabulary: Vocabulary
    languages: list[str]
    probability: np.ndarray  # (pieces + 1, languages), the last row for unknown letters

    def log_likelihoods(self, words: list[str], quick: np.ndarray) -> np.ndarray:
        """(words, languages)"""
        found = []
        for some in by_letters(words):
            lattice = Lattice(some, self.vocabulary, quick)
            found.append(lattice.by_word(lattice.forward(self.probability)[lattice.last]))
        return np.concatenate(found)


def expected_counts(
    sample: DataFrame, vocabulary: Vocabulary, languages: list[str], probability: np.ndarray
) -> np.ndarray:
    """(pieces, languages): how often each piece is expected in the (lang, word, n) table."""

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        quick = vocabulary.quick()
        index = {name: i for i, name in enumerate(languages)}
        total = np.zeros((len(vocabulary.hashes) + 1, len(languages)))
        for batch in batches:
            for name, rows in batch.groupby("lang"):
                column = probability[:, [index[name]]]
                often = dict(zip(rows["word"], rows["n"]))
                for words in by_letters(list(often)):
                    lattice = Lattice(words, vocabulary, quick)
                    ahead, behind = lattice.forward(column)[:, 0], lattice.backward(column)[:, 0]
                    part = np.repeat(np.arange(len(lattice.first)), lattice.last - lattice.first + 1)[lattice.start]
                    share = np.exp(
                        ahead[lattice.start]
                        + np.log(column[lattice.piece, 0])
                        + behind[lattice.end]
                        - ahead[lattice.last][part]
                    )
                    times = np.repeat(np.array([often[w] for w in words], float), lattice.parts)
                    total[:, index[name]] += np.bincount(lattice.piece, share * times[part], minlength=len(total))
        for i in range(len(languages)):
            seen = np.flatnonzero(total[:, i])
            yield pd.DataFrame({"language": i, "piece": seen, "n": total[seen, i]})

    partial = sample.mapInPandas(expect, "language int, piece int, n double")
    counts = np.zeros((len(vocabulary.hashes) + 1, len(languages)))
    for language, piece, n in partial.groupBy("language", "piece").agg(F.sum("n")).toPandas().to_numpy():
        counts[int(piece), int(language)] = n
    return counts[:-1]


def counted_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each word occurs in the texts of a batch, cut as they are for a prediction."""
    for batch in batches:
        seen = Counter((lang, word) for lang, text in zip(batch["lang"], batch["text"]) for word in words_of(text))
        rows = [(lang, word, n) for (lang, word), n in seen.items()]
        yield pd.DataFrame(rows, columns=["lang", "word", "n"])


def train(docs: DataFrame, path: str, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """Learns text and language of documents outside the held-out fold, of about
    ``fit_docs`` at most; a hash of the text decides which."""
    vocabulary = Vocabulary.read(path)
    learn = docs.where((remainder("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    share = min(1.0, fit_docs / max(1, learn.count()))
    drawn = F.pmod(F.xxhash64("doc_id", text_of()), SAMPLE_BUCKETS) < share * SAMPLE_BUCKETS
    words = learn.where(drawn).select("lang", text_of().alias("text")).mapInPandas(
        counted_words, "lang string, word string, n long"
    )
    counted = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    sample = materialise(counted, "words")
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    size = len(vocabulary.hashes)
    probability = np.full((size + 1, len(languages)), 1 / size)
    probability[size] = UNKNOWN
    for _ in range(rounds if languages else 0):
        counts = expected_counts(sample, vocabulary, languages, probability) + SMOOTHING
        probability[:size] = counts / counts.sum(axis=0)
    return Model(vocabulary, languages, probability)


def predicted(model: Model) -> Column:
    """(lang_pred, score) of the column ``text``."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        quick = model.vocabulary.quick()
        index: dict[str, int] = {}
        known = np.zeros((0, len(model.languages)))
        for texts in batches:
            if len(index) > CACHED_WORDS:
                index, known = {}, known[:0]
            texts = [t if any(map(str.isalpha, t)) else "" for t in texts]
            places, counts = [], []
            for text in texts:
                words = words_of(text) if model.languages else []
                places += [index.setdefault(w, len(index)) for w in words]
                counts.append(len(words))
            fresh = list(index)[len(known) :]
            if fresh:
                known = np.concatenate([known, model.log_likelihoods(fresh, quick)])
            sums = np.zeros((len(texts), len(model.languages)))
            if places:
                full = np.flatnonzero(counts)
                cut = (np.cumsum(counts) - counts)[full]
                sums[full] = np.add.reduceat(known[places], cut, axis=0)
            rows = []
            for total, count in zip(sums, counts):
                if not count:
                    rows.append((UNDETERMINED, 0.0))
                    continue
                best = int(total.argmax())
                rows.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return predict(text_of())


def identify(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``path`` names the vocabulary, read on the driver. The score is the probability of the
    language among those learnt, each as likely beforehand; ties go to the first in order.
    Texts that are null or have no letter are ``und`` with score 0, and so are all where
    no language could be learnt. Repeated rows get equal results. Columns beside doc_id,
    lang and text are not looked at.
    """
    small_batches(docs)
    model = train(docs, path)
    held_out = remainder("doc_id", FOLDS) == HELD_OUT
    rows = docs.select("doc_id", held_out.alias("held_out"), predicted(model).alias("_p"))
    return rows.select("doc_id", "held_out", "_p.lang_pred", "_p.score")
