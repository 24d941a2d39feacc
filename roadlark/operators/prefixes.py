"""Search in a block of sorted texts, inside a task: a tree of prefixes, in numpy.

A level of the tree are the runs of texts that share their first letters. They follow
from how many letters each text shares with the one before, so no nodes are kept. A search
takes one level after the other for many texts at once; what texts have in common is
looked at once, however many they are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

LETTER_BITS = 21  # of a code point
KEPT_LEVELS = 64
ROUNDING = 1e-9
STARTS = 1 << 20  # of searches that go on together
PAIRS = 1 << 16  # of a text and a run of prefixes that go on together
TEXTS = 1 << 13  # that set out together, with no more than
ROOM = 1 << 22  # letters


@dataclass
class Level:
    """The runs of texts alike in their first letters: where each begins and ends, and of
    each text (and of the end) the number of runs up to there."""

    begin: np.ndarray
    end: np.ndarray
    upto: np.ndarray


def letters(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts of an Arrow array, where each text begins, and how long it is."""
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = data.to_pybytes()[places[0] : places[-1]].decode() if data else ""
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    long = _lengths(texts)
    return codes, np.cumsum(long) - long, long


def _lengths(texts) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


class Tree:
    """Distinct texts in order, an Arrow array that is not empty; or in order of length
    first, as a tree for each."""

    def __init__(self, texts, by_length: bool = False):
        self.codes, self.begin, long = letters(texts)
        self.size, self.long = len(texts), long.astype(np.int32)
        self.shared = np.zeros(self.size, np.int32)
        self.shared[0] = -1
        alike, depth = np.arange(1, self.size), 0
        while alike.size:
            alike = alike[np.minimum(self.long[alike - 1], self.long[alike]) > depth]
            alike = alike[self.codes[self.begin[alike - 1] + depth] == self.codes[self.begin[alike] + depth]]
            depth += 1
            self.shared[alike] = depth
        if by_length:
            self.shared[1:][np.diff(self.long) > 0] = -1
        self._levels: dict[int, Level] = {}
        self._keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(self, depth: int) -> Level:
        if (kept := self._levels.get(depth)) is not None:
            return kept
        first = self.shared < depth
        begin = np.flatnonzero(first).astype(np.int32)
        upto = np.empty(self.size + 1, np.int32)
        np.cumsum(first, out=upto[:-1])
        upto[-1] = begin.size + 1
        made = Level(begin, np.append(begin[1:], np.int32(self.size)), upto)
        if depth < KEPT_LEVELS:
            self._levels[depth] = made
        return made

    def steps(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(run, letter) as one number, in order, and the run of the next level it leads to."""
        if (kept := self._keys.get(depth)) is not None:
            return kept
        here, there = self.level(depth), self.level(depth + 1)
        to = np.flatnonzero(self.long[there.begin] > depth)
        texts = there.begin[to]
        run = here.upto[texts].astype(np.int64) - 1
        made = run << LETTER_BITS | self.codes[self.begin[texts] + depth], to
        if depth < KEPT_LEVELS:
            self._keys[depth] = made
        return made

    def inside(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (of ``texts``, of the tree) where the one of the tree lies in the other, as two
        arrays of places; one may come more than once."""
        codes, begin, long = letters(texts)
        if self.long[0] == 0:
            yield np.arange(len(texts)), np.zeros(len(texts), np.int64)
        ends = np.cumsum(long)
        for first, last in _chunks(ends, STARTS):
            who = np.repeat(np.arange(first, last), long[first:last])
            at = begin[first] + np.arange(who.size)
            run, depth = np.zeros(who.size, np.int64), 0
            while who.size:
                keys, to = self.steps(depth)
                if not keys.size:
                    break
                asked = run << LETTER_BITS | codes[at]
                found = np.minimum(np.searchsorted(keys, asked), keys.size - 1)
                on = keys[found] == asked
                who, at, run = who[on], at[on] + 1, to[found[on]]
                depth += 1
                texts_here = self.level(depth).begin[run]
                done = self.long[texts_here] == depth
                yield who[done], texts_here[done]
                on = at < ends[who]
                who, at, run = who[on], at[on], run[on]

    def within(
        self, texts, best: np.ndarray, most: int, met: int, backwards: bool
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in ``texts``, place in the tree, edits) of pairs of so few edits that they
        are as good as the text's ``best``, and no more than ``most``. Lengths that are as
        good with ``met`` edits at most are left out.

        The tree is one by length. No more than half of the edits are in the first half of
        what it has; less than half, if it has the texts ``backwards``.
        """
        codes, begin, long = letters(texts)
        least = np.maximum(best, 1e-9)
        order = np.lexsort((long, np.minimum((1 - least) / least * long, most).astype(np.int64)))
        while order.size:
            widest = long[order[:TEXTS]].max()
            some, order = np.split(order, [min(TEXTS, max(1, ROOM // (widest + 1)))])
            search = _Search(self, codes, begin[some], long[some], best[some], most, met, backwards)
            yield from search.pairs(some)


def _chunks(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of texts with about ``most`` letters, one text at least."""
    first = 0
    while first < ends.size:
        start = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + most, "right")))
        yield first, last
        first = last


class _Search:
    """Edits between each text and the prefixes of the tree.

    A pair is a text and a length of the tree. With the edits it may have a prefix of the
    other is to be compared with some prefixes of the text only, which are ``width`` at
    most and begin ``low`` letters beyond it; at the ends of both the ``last`` of these is
    the whole text. Each pair goes down several runs.
    """

    def __init__(self, tree, codes, begin, long, best, most, met, backwards):
        self.tree = tree
        other = tree.long[tree.level(0).begin]
        edits = np.floor((1 - best)[:, None] * np.maximum(long[:, None], other) + ROUNDING)
        edits = np.minimum(edits, most).astype(np.int64)
        apart = long[:, None] - other
        self.who, self.root = np.nonzero((edits > met) & (np.abs(apart) <= edits))
        self.edits, apart = edits[self.who, self.root], apart[self.who, self.root]
        beside = (self.edits - np.abs(apart)) // 2
        self.low = np.minimum(apart, 0) - beside
        self.last = apart - self.low
        self.width = int((np.abs(apart) + 2 * beside).max(initial=0)) + 1
        self.far = int(self.edits.max(initial=0)) + 1
        half = other[self.root]
        self.half = (half + 1) // 2 if backwards else half // 2
        self.spare = self.edits - ((self.edits - 1) // 2 if backwards else self.edits // 2)
        # Letters that none is equal to before and behind each text.
        stride = int(long.max()) + 4 * self.far
        padded = np.full((long.size, stride), 0xFFFFFFFF, np.uint32)
        at = np.arange(stride) - self.far
        inside = (at >= 0) & (at < long[:, None])
        padded[inside] = codes[(begin[:, None] + at)[inside]]
        self.padded, self.at = padded.ravel(), self.who * stride + self.low + self.far

    def pairs(self, names: np.ndarray):
        if not self.who.size:
            return
        start = np.arange(self.width)[:, None] + self.low
        rows = np.where(start < 0, self.far, np.minimum(start, self.far)).astype(np.min_scalar_type(self.far + 1))
        waiting = [(0, np.arange(self.who.size), self.root, rows)]
        while waiting:
            depth, pair, run, rows = waiting.pop()
            if pair.size > PAIRS:
                for cut in range(0, pair.size, PAIRS):
                    part = slice(cut, cut + PAIRS)
                    waiting.append((depth, pair[part], run[part], np.ascontiguousarray(rows[:, part])))
                continue
            texts = self.tree.level(depth).begin[run]
            done = np.flatnonzero(self.tree.long[texts] == depth)
            if done.size:
                found = rows[self.last[pair[done]], done].astype(np.int64)
                close = found <= self.edits[pair[done]]
                yield names[self.who[pair[done[close]]]], texts[done[close]], found[close]
            pair, run, rows = self.step(depth, pair, run, rows)
            if pair.size:
                waiting.append((depth + 1, pair, run, rows))

    def step(self, depth, pair, run, rows):
        """The runs that can still come within the edits, one letter further."""
        tree = self.tree
        here, there = tree.level(depth), tree.level(depth + 1)
        first = there.upto[here.begin[run]].astype(np.int64) - 1
        count = there.upto[here.end[run]] - 1 - first
        parent = np.repeat(np.arange(pair.size), count)
        run = np.arange(parent.size) + np.repeat(first - (np.cumsum(count) - count), count)
        texts = there.begin[run]
        on = tree.long[texts] > depth
        if not on.all():
            parent, run, texts = parent[on], run[on], texts[on]
        pair = pair[parent]
        letter = tree.codes[tree.begin[texts] + depth]
        at, edits = self.at[pair] + depth, self.edits[pair].astype(np.int16)
        last = self.last[pair].astype(np.int16)
        # In the first half there is room for fewer edits.
        spare = np.where(depth < self.half[pair], self.spare[pair], 0).astype(np.int16)
        old = rows.take(parent, axis=1)
        new = np.empty_like(old)
        one, far = old.dtype.type(1), old.dtype.type(self.far)
        reach = np.full(pair.size, 1 << 14, np.int16)
        for cell in range(self.width):
            value = old[cell] + (self.padded[at + cell] != letter)
            if cell + 1 < self.width:
                np.minimum(value, old[cell + 1] + one, out=value)
            if cell:
                np.minimum(value, new[cell - 1] + one, out=value)
            np.minimum(value, far, out=new[cell])
            # What is left of both differs in length by so much.
            rest = np.abs(last - np.int16(cell))
            np.maximum(rest, spare, out=rest)
            rest += new[cell]
            np.minimum(reach, rest, out=reach)
        on = np.flatnonzero(reach <= edits)
        return pair[on], run[on], new.take(on, axis=1)


class Best:
    """Of each of some names the best text met: 1 - edits / longer length, then the lowest rank."""

    def __init__(self, size: np.ndarray, long: np.ndarray, rank: np.ndarray):
        self.size, self.long, self.rank = size, long, rank
        self.like = np.full(size.size, -1.0)
        self.text = np.zeros(size.size, np.int64)

    def meet(self, name: np.ndarray, text: np.ndarray, edits: np.ndarray) -> None:
        like = 1.0 - edits / np.maximum(np.maximum(self.size[name], self.long[text]), 1)
        order = np.lexsort((self.rank[text], -like, name))
        name, text, like = name[order], text[order], like[order]
        first = np.flatnonzero(np.diff(name, prepend=-1))
        name, text, like = name[first], text[first], like[first]
        was = self.like[name]
        better = (like > was) | ((like == was) & (self.rank[text] < self.rank[self.text[name]]))
        self.like[name[better]], self.text[name[better]] = like[better], text[better]

    def met(self) -> np.ndarray:
        return np.flatnonzero(self.like >= 0)


def _texts(table, column: str):
    import pyarrow as pa

    texts = table[column].cast(pa.large_string()).combine_chunks()
    return texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)


def _tree(texts, by_length: bool = False) -> tuple[Tree, np.ndarray]:
    """The tree of ``texts`` and their places in order of it."""
    import pyarrow as pa
    import pyarrow.compute as pc

    keys = pa.table({"long": pc.utf8_length(texts), "text": texts})
    by = [(k, "ascending") for k in (("long", "text") if by_length else ("text",))]
    order = pc.sort_indices(keys, sort_keys=by)
    return Tree(texts.take(order), by_length), order.to_numpy().astype(np.int64)


def _found(names, texts, best: Best):
    import pyarrow as pa

    met = best.met()
    found = best.text[met]
    taken = {"name": names.take(pa.array(met)), "candidate": texts.take(pa.array(found))}
    return pa.table({k: v.cast(pa.string()) for k, v in taken.items()} | {"rank": pa.array(best.rank[found], pa.int64())})


def best_nested(asked, block):
    """(name, candidate, rank) as an Arrow table: of each ``name`` of ``asked`` the best candidate
    of ``block`` (candidate, rank) that contains it or is contained in it."""
    names, texts = _texts(asked, "name"), _texts(block, "candidate")
    size, long = _lengths(names), _lengths(texts)
    best = Best(size, long, block["rank"].to_numpy())
    if len(names) and len(texts):
        tree, order = _tree(texts)
        for name, text in tree.inside(names):
            best.meet(name, order[text], size[name] - long[order[text]])
        tree, order = _tree(names)
        for text, name in tree.inside(texts):
            best.meet(order[name], text, long[text] - size[order[name]])
    return _found(names, texts, best)


def best_within(asked, block, most: int, met: int, backwards: bool):
    """(name, candidate, rank) as an Arrow table: of each ``name`` of ``asked`` the best candidate
    of ``block`` (candidate, rank) that is as good as the name's ``best`` and has no more than
    ``most`` edits. One that is as good with ``met`` edits at most may be left out.

    One half of a candidate has half of the edits at most. So a search forwards and one
    ``backwards`` each take one half first, with half of the edits, where most prefixes are
    left behind. Both together find all.
    """
    import pyarrow.compute as pc

    names, texts = _texts(asked, "name"), _texts(block, "candidate")
    best = Best(_lengths(names), _lengths(texts), block["rank"].to_numpy())
    if len(names) and len(texts):
        turned = pc.utf8_reverse if backwards else lambda column: column
        tree, order = _tree(turned(texts), by_length=True)
        for name, text, edits in tree.within(turned(names), asked["best"].to_numpy(), most, met, backwards):
            best.meet(name, order[text], edits)
    return _found(names, texts, best)
