"""Alignment, hard negatives and shards against brute force and on odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from roadlark.llm import alignment, negatives, sharding

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

ODD_TEXTS = [
    "a  b\n c  d ", "<|endoftext|> x <s> hi", "中文 text é ☃☃", "a▁b c", "  lead", "trail  ", " ", "x\x00y z",
    "don't we'll 12345 678", "\t\ttab\n\n\nnl  \r\n x", "\x1c a \x85 b  c", "😀😀😀 👩‍👩‍👧 ok", None, "", "ﬁ½ Å é ́x",
    "a" * 5000, "word " * 20_000, "12345678901234567890" * 300, ";\r\n;\r\n x;\r",
]


class Plain:
    """Both tokenizers on whole texts, one document at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=B)
        self.letters = alignment._byte_letters()
        self.words = {i: t for t, i in self.a.get_vocab().items()}

    def groups(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        from_a = [bytes(self.letters[c] for c in self.words[i]) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        from_b = [bytes.fromhex(p[3:5]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + text).encode()
        if not b"".join(from_a) == whole == b"".join(from_b):
            return None
        ends = [np.cumsum([len(x) for x in side]) for side in (from_a, from_b)]
        found, left = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            right = [int(np.searchsorted(e, end)) + 1 for e in ends]
            found.append((a[left[0] : right[0]], b[left[1] : right[1]]))
            left = right
        return found


def plain_alignment(rows):
    plain, links, groups = Plain(), [], []
    for _, text in rows:
        found = plain.groups(text)
        groups.append(found)
        links.append(Counter((x, y) for g, h in found or [] for x in g for y in h))
    count = Counter(pair for found in links for pair in found)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), found, own in zip(rows, groups, links):
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in found)
        best = sum(n for p, n in own.items() if count[p] == top[p[0]])
        total = sum(n * count[p] for p, n in own.items())
        sizes = sum(len(g) for g, _ in found), sum(len(h) for _, h in found)
        out.append((doc_id, *sizes, len(found), sum(own.values()), best, total, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_alignment_equals_brute_force(spark, table):
    docs = table("documents").select("doc_id", "text").where("length(text) < 4000")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    docs = docs.unionByName(odd)
    found = sorted((tuple(r) for r in alignment.align(docs, A, B).collect()), key=str)
    assert found == plain_alignment([tuple(r) for r in docs.collect()])


def test_alignment_of_odd_rows(spark, odd_documents, no_documents):
    rows = alignment.align(odd_documents, A, B).collect()
    assert len(rows) == odd_documents.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[1][0] == by_id[1][1] and by_id[None][0].n_links > 0
    assert [(by_id[i][0].n_a, by_id[i][0].groups_sha256) for i in (2, 3)] == [(0, ""), (0, "")]
    assert alignment.align(no_documents, A, B).count() == 0
    pairs = alignment.linked_pairs(odd_documents, A, B)
    assert pairs.agg(F.sum("n_links")).first()[0] == sum(r.n_links for r in rows)
    assert pairs.agg(F.sum(F.col("n_docs") * F.col("n_links"))).first()[0] >= max(r.count_sum for r in rows)


def test_containers_end_when_they_are_full(spark, table, monkeypatch):
    docs = table("documents").select("doc_id", "text").where("length(text) < 2000").limit(150).coalesce(1)
    whole = sorted(map(str, alignment.align(docs, A, B).collect()))
    monkeypatch.setattr(alignment, "CONTAINER_POSTINGS", 500)
    monkeypatch.setattr(alignment, "KEPT_UNITS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert sorted(map(str, alignment.align(docs, A, B).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 200), st.integers(1, 9)), max_size=300))
def test_bitmaps_and_planes_round_trip(entries):
    pairs, places, times = (np.array([e[i] for e in entries], np.int64) for i in range(3))
    keys, times = alignment.merged(pairs * alignment.CONTAINER_DOCS + places, times)
    expected = Counter()
    for pair, place, n in entries:
        expected[pair, place] += n
    found = alignment.bitmaps(keys, times, 201)
    sizes = np.array(found["n"], np.int64)
    place, often = alignment.postings(found["docs"], found["planes"], found["dense"], sizes)
    again = dict(zip(zip(np.repeat(np.array(found["pair"], np.int64), sizes).tolist(), place.tolist()), often.tolist()))
    assert again == dict(expected)
    assert sum(found["links"]) == sum(expected.values())


# ---- hard negatives --------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 2**32 - 1))
def test_strassen_is_exact(rows, inner, columns, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**28), 2**28, (rows, inner)), rng.integers(-(2**28), 2**28, (inner, columns))
    assert (negatives.strassen(a, b, small=3) == a @ b).all()


def test_products_beyond_a_long_stop_at_its_ends():
    big = negatives.LARGEST
    a, b = np.array([[big, big], [1, -1]]), np.array([[big, big], [-big, -big], [3, 4]])
    found = negatives.products(a, b).tolist()
    assert found == [[negatives.MOST, -negatives.MOST, negatives.MOST], [0, 0, -1]]


def plain_negatives(rows, positives=5, negative=3):
    """rows: (vec_id, vector, label), labels as they count."""
    there = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        there.append((vec_id, [int(np.floor(256 * float(x))) for x in vector], label))
    out = []
    for i, (anchor, v, label) in enumerate(there):
        if anchor is None or anchor % 50:
            continue
        scored = []
        for j, (other, w, kind) in enumerate(there):
            if j != i:
                scored.append((-sum(x * y for x, y in zip(v, w)), other is None, other or 0, other, kind))
        scored.sort(key=lambda s: s[:3])
        for own in [s for s in scored if s[4] == label][:positives]:
            p = -own[0]
            inside = [s for s in scored if s[4] != label and 50 * p <= -100 * s[0] <= 95 * p][:negative]
            out += [(anchor, own[3], n + 1, s[3], p, -s[0]) for n, s in enumerate(inside)]
    return sorted(out, key=str)


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(df, F.col("vec_id") % 50 == 0, label)


@pytest.fixture
def small_blocks(monkeypatch):
    """Several blocks, stripes and tiles even for a few rows."""
    for name, value in (("BLOCK", 3), ("STRIPE", 60), ("TILE", 16), ("SMALL", 4)):
        monkeypatch.setattr(negatives, name, value)


def test_negatives_equal_brute_force(table, small_blocks):
    df = table("embeddings")
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in df.collect()]
    found = sorted((tuple(r) for r in mined(df).collect()), key=str)
    assert found == plain_negatives(rows) and found


def test_negatives_of_odd_rows(spark, small_blocks):
    rng = np.random.default_rng(3)
    schema = "vec_id long, embedding array<float>, label int, score string, anchor int, b date, row int"
    rows = [(int(i), [float(x) for x in rng.normal(size=5)], int(i % 3)) for i in rng.integers(0, 120, 150)]
    rows += [(50, None, 1), (100, [1.0, None, 0.0], 1), (150, [float("inf")] * 5, 2), (50, [0.5] * 5, None)]
    rows += [(None, [0.5, 0.1, 0.2, 0.3, 0.4], 1)] * 3 + [(50, [], 1), (100, [0.0] * 5, 2), (0, [2.0, 1.0], 1)]
    rows += [(150, [0.25] * 5, 1)] * 20 + [(151, [0.25] * 5, 2)] * 20  # ties
    df = spark.createDataFrame([(*r, "s", 1, None, 1) for r in rows], schema)
    singles = [[None if x is None else float(np.float32(x)) for x in v] if v is not None else None for _, v, _ in rows]
    moved = [
        (i, v, label if label is None or i is None or i % 7 else (label + 1) % 10)
        for (i, _, label), v in zip(rows, singles)
    ]
    found = sorted((tuple(r) for r in mined(df).collect()), key=str)
    assert found == plain_negatives(moved) and len(found) > 30
    assert mined(df.limit(0)).count() == 0
    assert mined(df.where("vec_id % 50 != 0")).count() == 0


# ---- shards ----------------------------------------------------------------------------


def checked(rows, docs, shards):
    """Shards as the contract has them; returns their bytes."""
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_shards_are_even_and_keep_copies_together(table):
    docs = table("documents")
    rows = sharding.shard(docs).collect()
    sizes = checked(rows, docs, 8)
    mean = sum(sizes.values()) / 8
    longest = max(r["size"] for r in rows)
    assert all(abs(s - mean) < max(longest, 0.02 * mean) for s in sizes.values())
    text = {r.doc_id: r.text for r in docs.collect()}
    shards = defaultdict(set)
    for r in rows:
        shards[text[r.doc_id]].add(r.shard)
    assert max(map(len, shards.values())) == 1


def test_shards_of_a_group_with_a_third_of_all_rows(spark):
    rows = [(i, f"text {i} " * (i % 40), "web", "en") for i in range(900)] + [(2000 + i, "copy " * 22, "web", "en") for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    sizes = checked(sharding.shard(docs).collect(), docs, 8)
    mean = sum(sizes.values()) / 8
    assert all(abs(s - mean) < 0.03 * mean for s in sizes.values())
    seven = checked(sharding.shard(docs, shards=7).collect(), docs, 7)
    assert len(seven) == 7 and max(seven.values()) < 1.05 * sum(seven.values()) / 7
    target = checked(sharding.shard(docs, target_bytes=20_000).collect(), docs, 10**6)
    assert len(target) == -(-sum(sizes.values()) // 20_000) and max(target.values()) < 1.1 * 20_000


def test_shards_of_odd_rows(odd_documents, no_documents):
    odd = odd_documents.withColumnsRenamed({"size": "weight", "node": "unit"})
    for docs in (odd_documents, odd):
        checked(sharding.shard(docs).collect(), docs, 8)
    assert sharding.shard(no_documents).count() == 0
    assert sharding.shard(no_documents, target_bytes=10).count() == 0


def test_shards_use_no_python(table):
    plan = sharding.shard(table("documents"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
