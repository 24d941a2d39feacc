"""Operators on whole tables against brute force."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadlark.llm import common, jaccard, lattice, mixing, neighbours, packing
from roadlark.llm.queries import QUERIES
from roadlark.llm.sql import ORACLES

from .conftest import FOLDER

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))


def rounded(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in cursor.description)
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = sorted(tuple(rounded(row[i]) for i in order) for row in cursor.fetchall())
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert sorted(tuple(rounded(row[c]) for c in columns) for row in df.collect()) == expected


def test_mix_of_odd_rows(odd_documents, no_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    total = sum(r.size for r in rows)
    targets = {r.source: r.target for r in rows}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in rows)
    assert len({r.copies for r in rows if r.doc_id == 1}) == 1
    assert mixing.mix(no_documents).count() == 0
    again = mixing.repeated(odd_documents)
    assert again.columns == odd_documents.columns and again.count() == sum(r.copies for r in rows)


def test_mix_is_nested_and_near_its_targets(table):
    small = {r.doc_id: r.copies for r in mixing.mix(table("documents"), share=0.7).collect()}
    rows = mixing.mix(table("documents")).collect()
    assert all(small[r.doc_id] <= r.copies for r in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[r.source] - r.target) <= largest[r.source] for r in rows)


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert dict(found.collect()) == {n: r for n, r in root.items() if n in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_components(docs, percent):
    sets = {i: frozenset(jaccard.shingles(t or "").tolist()) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * (len(sets[a] | sets[b])):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: find(i) for i in names}


@pytest.mark.parametrize("crowd", [2, 32])
def test_near_copies_of_a_crowd(spark, monkeypatch, crowd):
    """Many near copies of a few texts, some linked to the largest one, some to others."""
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    rng = np.random.default_rng(crowd)
    docs = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(120)]
        for copy in range(40):
            changed = list(words)
            for at in rng.choice(120, rng.integers(0, 9), replace=False):
                changed[at] = f"c{rng.integers(40)}"
            docs.append((len(docs), " ".join(changed[: 120 - int(rng.integers(0, 12))])))
    docs += [(len(docs) + i, f"one two three {i % 2}") for i in range(4)]
    found = jaccard.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_components(docs, jaccard.PERCENT)


def test_pairs_of_a_crowd_are_few(spark, monkeypatch):
    """Of near copies that are not linked to their centre, few pairs that cannot be linked meet."""
    rng, made = np.random.default_rng(3), []
    base = [f"w{i}" for i in range(100)]
    docs = []
    for copy in range(300):
        changed = list(base)
        for at in rng.choice(100, rng.integers(1, 5), replace=False):
            changed[at] = f"c{rng.integers(4)}"
        docs.append((copy, " ".join(changed)))
    plausible = jaccard._plausible

    def counted(pairs, nodes, percent):
        made.append(pairs.count())
        return plausible(pairs, nodes, percent)

    monkeypatch.setattr(jaccard, "_plausible", counted)
    found = jaccard.deduplicate(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80).collect()
    sets = [frozenset(jaccard.shingles(text, 5).tolist()) for _, text in docs]
    linked = sum(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert made[0] <= 2 * linked
    assert 1 < len({r.component_id for r in found}) < len(docs)


def test_shingles_are_dealt_once(spark, monkeypatch):
    """The counts of the shingles need no shuffle beside that of the prefixes."""
    plans, write = [], jaccard.Shelf.write

    def seen(shelf, rows, name):
        if name == "several":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(shelf, rows, name)

    monkeypatch.setattr(jaccard.Shelf, "write", seen)
    docs = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(9)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.component_id for r in jaccard.deduplicate(docs).collect()} == set(range(9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange hashpartitioning") == 1


def test_sets_of_pairs_are_not_written(spark, monkeypatch):
    """Only those of the centres and what is compared with them are."""
    written, write = [], common.Shelf.write
    monkeypatch.setattr(common.Shelf, "write", lambda shelf, rows, name: written.append(name) or write(shelf, rows, name))
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:59], f"x{i}"]) for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, edges = jaccard.join(docs)
    assert edges.count() == 10
    assert written.count("sets") == 1 and written.index("sets") < written.index("differences")


def test_jaccard_of_odd_rows(odd_documents, no_documents):
    rows = jaccard.deduplicate(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert [r.component_id for r in rows if r.doc_id == 1] == [1, 1]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id in (2, 3, 4, 6)} == {
        2: (0, 2), 3: (0, 3), 4: (0, 4), 6: (1, 6),
    }
    assert jaccard.kept(odd_documents).columns == odd_documents.columns
    assert jaccard.kept(no_documents).count() == 0


def test_shingles_cut_words_as_asked():
    same = ["a b\tc\x0bd E", "A B C  D\r\ne "]
    assert jaccard.shingles(same[0]).tolist() == jaccard.shingles(same[1]).tolist()
    assert len(jaccard.shingles("a b c d e")) == 2 and len(jaccard.shingles("a b")) == 1
    assert len(jaccard.shingles("a\xa0b c d e")) == 1  # a no-break space parts no words
    text = " ".join(f"word{i}" for i in range(9000))
    assert len(jaccard.shingles(text)) == 8997  # over many chunks


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(200, 8)) * 2
    near = lattice.e8(points, 3) / 2
    whole = np.isclose(near % 1, 0).all(axis=2) | np.isclose(near % 1, 0.5).all(axis=2)
    assert whole.all() and np.isclose(near.sum(axis=2) % 2, 0).all()
    distance = np.square(near - points[:, None]).sum(axis=2)
    assert (distance[:, 0] <= 1 + 1e-9).all() and (np.diff(distance, axis=1) >= 0).all()


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int, rank string")


def odd_vectors(spark):
    unit, nan, inf = [1.0] + [0.0] * 7, float("nan"), float("inf")
    close = [1.0, 0.1] + [0.0] * 6
    rows = [
        (20, unit, 1), (20, unit, 1), (1, [2 * x for x in unit], 1), (2, unit, 2), (3, close, 1), (4, None, 1),
        (5, [0.0] * 8, 1), (6, [nan] + unit[1:], 1), (7, [inf] + unit[1:], 1), (8, unit, None), (9, [None] + unit[1:], 1),
        (10, [1.0], 1), (None, unit, 1), (40, close, 2), (11, [], 1),
    ]
    return vectors_of(spark, [(*r, 1, "x") for r in rows])


def test_lattice_of_odd_vectors(spark):
    rows = lattice.near_duplicates(odd_vectors(spark)).collect()
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert len(rows) == 15
    assert found[20] == (4, 1, False) and found[1] == (4, 1, True) and found[3] == (4, 1, False)
    assert found[None] == (4, 1, False) and found[2] == (1, 2, True) and found[40] == (1, 2, False)
    assert all(found[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert lattice.near_duplicates(odd_vectors(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block", [7, 1024])
def test_lattice_of_a_crowd(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = rng.normal(size=(1, 64))
    vectors = base + rng.normal(size=(150, 64)) * rng.uniform(0.02, 0.16, (150, 1))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= lattice.COSINE) & ~np.eye(150, dtype=bool)
    rows = vectors_of(spark, [(i, v.tolist(), 1, 1, "x") for i, v in enumerate(vectors)])
    found = {r.vec_id: r for r in lattice.near_duplicates(rows).collect()}
    counted = np.array([found[i].n_links for i in range(150)])
    assert (counted <= near.sum(axis=1)).all() and counted.sum() >= 0.99 * near.sum()


def nearest(vectors, ids, query, count):
    scores = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]]
    return {int(ids[i]) for i in order[:count]}


def test_neighbours_reach_their_recall(spark, table):
    rows = table("embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in neighbours.search(table("embeddings"), F.col("vec_id") % 20 == 0).collect():
        found[r.query_id].append(r)
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    recalls = []
    for query, hits in found.items():
        hits.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in hits] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in hits] == sorted((-r.score, r.vec_id) for r in hits)
        place = int(np.flatnonzero(ids == query)[0])
        recalls.append(len({r.vec_id for r in hits} & nearest(vectors, ids, place, 20)) / 20)
    assert np.mean(recalls) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    rows = neighbours.search(odd_vectors(spark), F.col("vec_id") % 20 == 0).collect()
    first = sorted((r["rank"], r.vec_id, round(r.score, 6)) for r in rows if r.query_id == 20)
    assert first == [(1, 1, 2.0), (2, 2, 1.0), (3, 3, 1.0), (4, 8, 1.0), (5, 40, 1.0)]
    assert {r.query_id for r in rows} == {20, 40}
    assert neighbours.search(odd_vectors(spark).limit(0), F.lit(True)).count() == 0


def test_vectors_of_two_lengths_are_all_searched_and_compared(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i % 3 else 16)], i % 2) for i in range(300)]
    rows += [(1000 + i, [x * 1.001 for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(df).collect()}
    assert all(links[i][0] >= 1 and links[1000 + i][1] == links[i][1] for i in range(300))
    found = defaultdict(set)
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    vectors = {i: np.array(v) for i, v, _ in rows}
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, near in found.items():
        same = [i for i in vectors if i != query and len(vectors[i]) == len(vectors[query])]
        true = sorted(same, key=lambda i: (-vectors[i] @ vectors[query], i))[:20]
        assert near <= set(same) and len(near) == 20
        hits += len(near & set(true))
    assert hits >= 0.9 * 20 * len(found)


def test_repeated_rows_keep_columns_of_any_name(spark):
    schema = "doc_id long, text string, source string, target int, source_size int, _size int, _hash int, _copies int"
    docs = spark.createDataFrame([(i, "some words " * i, "ab"[i % 2], 1, 2, 5, 6, 7) for i in range(30)], schema)
    rows = mixing.repeated(docs).collect()
    assert rows and {tuple(r)[3:] for r in rows} == {(1, 2, 5, 6, 7)}


def test_hilbert_curve_visits_neighbours():
    side = np.arange(16)
    grid = np.stack([x.ravel() for x in np.meshgrid(side, side, side)], axis=1)
    key = packing.hilbert(grid, 4)
    assert sorted(key) == list(range(16**3))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_packing_looks_up_each_piece_once():
    """Case, white space and the signs around a word make no words of their own, and the ids
    are those of the whole text."""
    with open(TOKENIZER, encoding="utf-8") as file:
        words = packing.Words(file.read())
    words.ids(["Word word, (WORD) word;\tword. Word's WORD! 12word 34", "wOrD\nword: \"word\""])
    assert len(words.known) <= 14
    rng = np.random.default_rng(5)
    signs = [chr(c) for c in range(9, 0x300)] + ["'", "s", "'re", "LL", " ", ", ", ".. ", "e\u0301", "İ", "Σ", "”", "½", "\x1c", "字"] * 20
    texts = ["".join(rng.choice(signs, 12)) for _ in range(3000)] + ["", " ", "a,, b", "it's 'tis x_y 3.14, e."]
    found = words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    whole = [packing.array(words.code, [*f.ids, packing.END]).tobytes() for f in found]
    assert words.ids(texts) == whole


def test_packing_keeps_what_it_has_cut(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        words = packing.Words(file.read())
    cut = []

    class Pieces:
        @staticmethod
        def findall(word, find=packing.PIECES.findall):
            cut.append(word)
            return find(word)

    monkeypatch.setattr(packing, "PIECES", Pieces)
    text = "on 12:30 he paid 1999$ for x-rays, é and don't."
    whole = words.tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]
    for _ in range(2):
        assert np.frombuffer(words.ids([text])[0], words.code).tolist() == whole
    assert len(cut) == len(set(cut)) > 2


def test_packing_keeps_words_met_again(monkeypatch):
    """When there is no room, words of one batch go and those of several stay; the ids are
    those of the whole texts all along."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 400)
    with open(TOKENIZER, encoding="utf-8") as file:
        words = packing.Words(file.read())
    asked = []
    monkeypatch.setattr(words, "_encode", lambda new, *a, f=words._encode, **k: (asked.extend(new), f(new, *a, **k)))
    again = "Often met words, \u00e9t\u00e9s \u0438 x-rays: 12."
    texts = [[f"{again} w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}{'uvwxyz'[j % 6]}{'abcdefghij'[j // 6]}" for j in range(60)] for i in range(50)]
    for batch in texts:
        found = words.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
        assert words.ids(batch) == [packing.array(words.code, [*f.ids, packing.END]).tobytes() for f in found]
    assert asked.count("often") == 1 and len(words.sizes) <= 400 + 200


def test_packing_cuts_signs_behind_words_wherever_they_stand():
    """A sign behind a word makes no word of its own, also at the end of a text or beside two signs."""
    with open(TOKENIZER, encoding="utf-8") as file:
        words = packing.Words(file.read())
    texts = ["a word.", "\u00e9t\u00e9,", "5:", "x.. word; a, y", "", " ", ".", "\u201d.", "\u00d7. \u00f7, \u023a!", "it's. '."]
    found = words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert words.ids(texts) == [packing.array(words.code, [*f.ids, packing.END]).tobytes() for f in found]
    assert not {"word.", "word;", "a,", "\u00e9t\u00e9,", "5:"} & set(words.several)


def test_packing_round_trip(spark, table, odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = ["a<|endoftext|>b ΑΣ.Β", "x <|startoftext|> y", "İΣ. ΟΔΟΣ, İstanbul! ΣΑΣİ;", "<|ENDOFTEXT|> ΑΣΣ?İ"]
    special = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs in (table("documents"), odd_documents, special):
        rows = packing.pack(docs, TOKENIZER).collect()
        sequences, pieces = defaultdict(list), defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
            pieces[r.doc_id].append(r)
        for number, parts in sequences.items():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            assert sum(n for _, n in parts) == 4096 or number == max(sequences)
        for r in docs.dropDuplicates(["doc_id"]).collect():
            ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
            copies = docs.where(F.col("doc_id").eqNullSafe(F.lit(r.doc_id))).count() if docs is odd_documents else 1
            assert sum(p.length for p in pieces[r.doc_id]) == copies * len(ids)
            for p in pieces[r.doc_id]:
                assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
                assert p.doc_tokens == len(ids)
    assert packing.pack(no_documents, TOKENIZER).count() == 0
