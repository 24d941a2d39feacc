import random

import pyarrow as pa
import pytest

from roadlark.operators import fuzzy, prefixes, vehicles
from tests.test_vehicles import levenshtein

LETTERS = ["AB", "ABC ", "ABCDEFGH", "AÉ😀B"]


def found(table, names, texts, wanted):
    """Checks the best of each name among the texts that ``wanted`` (name, text, best) takes."""
    expected = {}
    for name, best in names.items():
        like = [(-(1.0 - levenshtein(name, t) / max(len(name), len(t), 1)), r) for r, t in enumerate(texts) if wanted(name, t, best)]
        if like:
            expected[name] = min(like)[1]
    rows = table.to_pylist()
    assert all(texts[r["rank"]] == r["candidate"] for r in rows)
    assert {r["name"]: r["rank"] for r in rows} == expected


@pytest.mark.parametrize("seed", range(40))
def test_a_block_gives_the_best_of_a_comparison_with_all(seed, monkeypatch):
    rng = random.Random(seed)
    for name, sizes in (("PAIRS", (1, 7, 1 << 16)), ("TEXTS", (1, 5, 1 << 13)), ("STARTS", (1, 20, 1 << 20)), ("KEPT_LEVELS", (0, 64))):
        monkeypatch.setattr(prefixes, name, rng.choice(sizes))
    word = lambda: "".join(rng.choices(LETTERS[seed % 4], k=rng.randint(0, rng.choice([3, 8, 14]))))
    texts = sorted({word() for _ in range(rng.randint(1, 60))})
    names = {word(): rng.choice([0.0, 0.0, 0.3, 0.5, 0.8, 1 - 3 / 7]) for _ in range(rng.randint(1, 30))}
    ranks = rng.sample(range(len(texts)), len(texts))
    block = pa.table({"candidate": pa.array([texts[r] for r in ranks], pa.string()), "rank": pa.array(ranks, pa.int64())})
    asked = pa.table({"name": pa.array(list(names), pa.string()), "best": pa.array(list(names.values()), pa.float64())})

    found(prefixes.best_nested(asked, block), names, texts, lambda n, t, best: n in t or t in n)
    most = rng.randint(1, 9)

    def as_good(name, text, best):
        edits, longer = levenshtein(name, text), max(len(name), len(text))
        # Where no edit is allowed they are equal, and were found before.
        return edits <= most and (1 - best) * longer + 1e-9 >= max(1, edits)

    ways = [prefixes.best_within(asked, block, most, 0, backwards) for backwards in (False, True)]
    best = {}
    for row in pa.concat_tables(ways).to_pylist():
        like = 1.0 - levenshtein(row["name"], row["candidate"]) / max(len(row["name"]), len(row["candidate"]), 1)
        best[row["name"]] = min(best.get(row["name"], (1.0,)), (-like, row["rank"], row["candidate"]))
    rows = [{"name": name, "rank": rank, "candidate": text} for name, (_, rank, text) in best.items()]
    found(pa.Table.from_pylist(rows, ways[0].schema), names, texts, as_good)


def test_nothing_is_found_in_nothing():
    none = pa.table({"candidate": pa.array([], pa.string()), "rank": pa.array([], pa.int64())})
    asked = pa.table({"name": pa.array(["A", ""]), "best": pa.array([0.0, 0.0])})
    nobody = asked.slice(0, 0)
    some = pa.table({"candidate": pa.array([""]), "rank": pa.array([0], pa.int64())})
    for search in (prefixes.best_nested, lambda a, b: prefixes.best_within(a, b, 2, 0, True)):
        assert search(asked, none).num_rows == search(nobody, some).num_rows == 0


def test_few_pairs_are_compared_in_a_dense_dimension(spark, monkeypatch):
    words = ["LARGE RING", "SMALL RING", "HOT BOLT", "OLD PLATE"]
    types = sorted(f"{w} {s} BRAND#{b} {n}" for w in words for s in ("ECONOMY", "PROMO") for b in range(1, 9) for n in range(10, 20))
    names = {t.replace("A", "O") for t in types[::7]} | {t.replace(" ", "") for t in types[::9]} | {t.replace("E", "EE") for t in types[::11]}
    asked = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    dimension = spark.createDataFrame([(t, t[:3]) for t in types], "candidate string, candidate_group string")
    expected = {n: min((-(1.0 - levenshtein(n, t) / max(len(n), len(t)) + (0.15 if n in t or t in n else 0.0)), t) for t in types)[1] for n in names}
    # A few pairs for each visit and block, however many types are nearly as good.
    for size, blocks in ((fuzzy.BLOCK, 1), (200, 4)):
        monkeypatch.setattr(fuzzy, "BLOCK", size)
        matches = fuzzy.best_matches(asked, dimension, vehicles.match_score)
        assert {r.name: r.candidate for r in matches.found.collect()} == expected
        assert matches.compared <= 6 * blocks * len(names)
