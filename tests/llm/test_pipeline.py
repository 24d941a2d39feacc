import corpus_pipeline
import __spark_entry__ as entry
from roadlark.llm import jaccard, quality, toxicity
from roadlark.llm.queries import read

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = read(spark, FOLDER, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, FOLDER).cache()
        kept.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
        if name in ("quality", "toxicity"):
            operator = quality if name == "quality" else toxicity
            scored = operator.classify(before, read(spark, FOLDER, "labels")).collect()
            good = {r.doc_id for r in scored if r.predicted == (name == "quality")}
            assert {r.doc_id for r in docs.collect()} == good
        if name == "near_duplicates":
            found = jaccard.deduplicate(before).collect()
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in found}
    assert kept[0] >= kept[1] >= kept[2] > 0 and kept[4] > 0
    assert corpus_pipeline.run(spark, FOLDER).count() == kept[4]


def plainly_linked(texts):
    """The smallest place each text is linked to, pair by pair: 0.8 of five-word shingles."""
    sets = []
    for text in texts:
        words = text.lower().split()
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(sets)))
    for j, b in enumerate(sets):
        for i in range(j):
            if root[i] != root[j] and b and 5 * len(sets[i] & b) >= 4 * len(sets[i] | b):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return root


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words)]  # 100 shingles of five words
    for cut in (0, 15, 16, 20, 21, 30):  # the similarity is 1 - cut / 100
        texts.append(" ".join(words[: 104 - cut]))
    apart = [f"v{i}" for i in range(104)]
    texts += [" ".join(apart), " ".join([*apart[:52], "x", *apart[52:]]), " ".join([*apart[:20], "y", *apart[20:60], "z", *apart[60:]])]
    alone = [f"u{i}" for i in range(104)]
    texts += [" ".join(alone), " ".join(alone[:84])]  # at 0.8, and by 0.802 of 4 words below 85%
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = sorted(r.doc_id for r in stage(spark, docs, FOLDER).collect())
    assert kept == sorted(set(plainly_linked(texts))) and 11 not in kept


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(60)]
    near, other = " ".join(words), " ".join([*words[:59], "x"])
    rows = [
        (1, near, "a"), (1, near, "a"), (1, near, "b"), (2, other, "a"), (None, near, "a"),
        (2, "a text that no other row of this table has", "a"),  # beside a copy with its id
        (None, "rows without an id that are equal", "a"), (None, "rows without an id that are equal", "a"),
        (None, "rows without an id that are equal", None),
        (None, "with a smaller id beside it", "a"), (9, "with a smaller id beside it", "a"),
        (3, "twice the same row", None), (3, "twice the same row", None),
        (4, "", "a"), (4, "", "a"), (None, None, "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    found = stage(spark, docs, FOLDER)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in found.collect()) == [
        (0, ""), (0, "rows without an id that are equal"), (1, near), (2, "a text that no other row of this table has"),
        (3, "twice the same row"), (4, ""), (4, ""), (9, "with a smaller id beside it"),
    ]


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
