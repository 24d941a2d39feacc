"""Operators on single texts: nulls, empty tables, brute force and held-out accuracy."""

import math
import re
import time
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from roadlark.llm import html, language, licenses, quality, toxicity

VOCABULARY = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_take_odd_rows_and_no_labels(odd_documents, no_documents, no_labels, operator):
    rows = operator.classify(odd_documents, no_labels).collect()
    assert len(rows) == odd_documents.count() and {r.score for r in rows} == {0.5}
    assert operator.classify(no_documents, no_labels).count() == 0
    assert operator.accepted(no_documents, no_labels).columns == no_documents.columns


@pytest.mark.parametrize(
    "operator, label, folds, held_out, best", [(quality, "quality", 5, 0, 0.99), (toxicity, "toxic", 3, 1, 0.95)]
)
def test_classifiers_on_the_held_out_fold(spark, odd_documents, operator, label, folds, held_out, best):
    # The smaller folders have a few dozen toxic documents in four languages to learn from.
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = operator.classify(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), labels)
    rows = found.join(labels.where(F.col(label).isNotNull()), "doc_id").collect()
    checked = [r for r in rows if r.held_out]
    assert {r.doc_id for r in checked} == {
        r.doc_id for r in labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out).collect()
    }
    assert np.mean([r.predicted == r[label] for r in checked]) >= best
    assert all(0 <= r.score <= 1 for r in rows)
    odd = operator.classify(odd_documents, labels).collect()
    assert len(odd) == odd_documents.count() and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id == 1}) == 1


def test_toxic_documents_of_every_language_are_found(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic is not null")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = toxicity.classify(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = rows.select("lang", "toxic", "predicted").collect()
    for lang in ("de", "en", "es", "fr"):
        found = [r.predicted for r in rows if r.toxic and r.lang == lang]
        assert len(found) >= 10 and np.mean(found) > 0.5, lang
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.01


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += here
        labels |= {label} if here else set()
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(labels))


def test_license_scan_equals_brute_force(spark, table, odd_documents):
    texts = [
        "CC BY cc-by. cc by",
        "cc by",
        "ccby All Rights Reserved! all rights, reserved (c) é-all rights reserved",
        "cc cc by by general public license general public general public license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software)",
        "license mit the under released, not a notice; mit License: RELEASED under the MIT license",
        "0all rights reserved 9",
    ]
    own = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    for docs in (own, odd_documents, table("documents")):
        expected = sorted((str(r.doc_id), *map(str, plain_scan(r.text))) for r in docs.select("doc_id", "text").collect())
        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
        found = licenses.scan(docs).collect()
        assert sorted(tuple(str(r[n]) for n in names) for r in found) == expected
        for row in found:
            assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
            assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
    labels = {r.doc_id: r.labels for r in licenses.scan(own).collect()}
    assert labels[104] == "mit" and labels[105] == "mit"


def test_license_scan_of_nothing(no_documents):
    assert licenses.scan(no_documents).count() == 0


def test_language_of_held_out_documents(table, odd_documents, no_documents):
    docs = table("documents")
    rows = language.identify(docs, VOCABULARY).join(docs.select("doc_id", "lang"), "doc_id").collect()
    checked = [r for r in rows if r.held_out and r.lang is not None]
    assert len(checked) > 200 and np.mean([r.lang == r.lang_pred for r in checked]) > 0.98
    odd = {r.doc_id: r for r in language.identify(odd_documents, VOCABULARY).collect()}
    assert {odd[i].lang_pred for i in (2, 3, 4, 7)} == {"und"} and {odd[i].score for i in (2, 3, 4, 7)} == {0.0}
    assert odd[5].lang_pred == "en" and 0 < odd[5].score <= 1
    assert language.identify(no_documents, VOCABULARY).count() == 0


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    hashes = np.unique(np.array([language._hash(p) for p in pieces], np.uint64))
    vocabulary = language.Vocabulary(hashes, 3)
    weight = {p: 0.05 + 0.1 * i for i, p in enumerate(pieces)}
    probability = np.full((len(pieces) + 1, 1), language.UNKNOWN)
    for p in pieces:
        probability[np.searchsorted(hashes, np.uint64(language._hash(p))), 0] = weight[p]

    def ways(word):
        """Logarithm of the sum, one letter after the other in exact fractions."""
        ahead = [Fraction(1)]
        for end in range(1, len(word) + 1):
            found = sum(Fraction(weight[p]) * ahead[end - len(p)] for p in pieces if word[:end].endswith(p))
            if word[end - 1] not in weight:
                found += Fraction(language.UNKNOWN) * ahead[end - 1]
            ahead.append(Fraction(found))
        return math.log(ahead[-1].numerator) - math.log(ahead[-1].denominator)

    long = ["▁" + "ab" * 35, "▁" + "x" * 70, "▁" + "ab" * 20 + "x" + "ba" * 30, "▁" + "abx" * 200, "▁" + "a" * 31, "▁" + "a" * 32]
    words = ["▁ab", "▁abba", "▁", "▁bxab", *long]
    lattice = language.Lattice(words, vocabulary, vocabulary.quick())
    assert lattice.parts[:4].tolist() == [1] * 4 and lattice.parts[4] == 1 and lattice.parts[5] > 60
    ahead = lattice.by_word(lattice.forward(probability)[lattice.last, 0])
    assert np.allclose(ahead, [ways(w) for w in words])
    assert np.allclose(lattice.by_word(lattice.backward(probability)[lattice.first, 0]), ahead)
    model = language.Model(vocabulary, ["a", "b"], np.hstack([probability, probability / 2]))
    assert [len(g) for g in language.by_letters(words, 80)] == [4, 1, 1, 1, 1, 2]
    assert np.allclose(model.log_likelihoods(words, vocabulary.quick())[:, 0], ahead)


def test_expected_counts_of_long_words_equal_brute_force(spark):
    pieces = ["▁", "a", "b", "ab"]
    hashes = np.unique(np.array([language._hash(p) for p in pieces], np.uint64))
    at = {p: int(np.searchsorted(hashes, np.uint64(language._hash(p)))) for p in pieces}
    vocabulary = language.Vocabulary(hashes, 2)
    probability = np.full((5, 1), 0.2)
    # Each pair of letters is "ab", or "a" and "b".
    sample = spark.createDataFrame([("l", "▁" + "ab" * k, n) for k, n in ((1, 3), (40, 2))], "lang string, word string, n long")
    counts = language.expected_counts(sample, vocabulary, ["l"], probability)[:, 0]
    pairs = 1 * 3 + 40 * 2
    one = 0.2 / (0.2 + 0.04)
    assert np.allclose([counts[at[p]] for p in pieces], [5, pairs * (1 - one), pairs * (1 - one), pairs * one])


def test_words_are_cut_alike_in_learning_and_prediction():
    text = "Ünï\u00a0Code\u3000wide \u2003thin\x1cfile İstanbul  "
    rows = [r for b in language.counted_words(iter([pd.DataFrame({"lang": ["a"], "text": [text]})])) for r in b["word"]]
    assert rows == language.words_of(text) and len(rows) == 6


def test_main_text_of_pages():
    prose = "A long sentence, with commas, that an article might hold, and with more words to follow. " * 3
    page = f"""<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style></head><body>
    <header>Site <a href=/>home</a></header><nav><ul><li><a>one</a></li></ul></nav>
    <div id="sidebar"><p>{prose}</p></div><div class="cookie-notice">We use cookies, really.</div>
    <div class="content"><h1>Title &amp; more</h1><p>{prose}<p>Caf&eacute;&nbsp;&#241;&#x41; <b>bo</b>ld<br>next
    <div class="ad">Buy!</div><ul><li>first<li>second</ul><p>last</p><form>Name <input></form></div>
    <section class="comments"><p>{prose}</p></section><script>var x = "<p>no</p>";</script>
    <footer>&copy; me</footer>"""
    clean = " ".join(prose.split())
    assert html.main_text(page) == f"Title & more {clean} Café ñA bold next first second last"
    assert html.main_text("") == "" == html.main_text("<nav>menu</nav>")
    assert html.main_text("<p>only words") == "only words"
    assert html.main_text("<div>" * 3000 + "deep" + "</div>" * 2000) == "deep"


PROSE = " ".join(["A long sentence, with commas, that an article might hold, and with more words to follow."] * 6)


@pytest.mark.parametrize(
    "wrapper", ["div class='page has-sidebar'", "div class='content no-sidebar'", "div class='post comments-open'",
                "div id='page-header'", "div class='post header'", "form id='aspnetForm'", "section class='widget'"]
)
def test_main_text_in_a_wrapper_with_an_unlikely_name(wrapper):
    tag = wrapper.split()[0]
    body = f"<p>{PROSE}</p><div class='comments'><p>Me too.</p></div><form>Name</form><p>{PROSE}</p>"
    for rest in ("", "<div>All rights reserved.</div>"):
        assert html.main_text(f"<body><{wrapper}>{body}</{tag}>{rest}") == f"{PROSE} {PROSE}"
    inside = f"<body><{wrapper}><h1>Title</h1><p>{PROSE}</p></{tag}><div class='comments'><p>{PROSE}</p><p>{PROSE}</p></div>"
    assert html.main_text(inside) == f"Title {PROSE}"


def test_main_text_drops_what_is_named_so():
    for name in ("comments", "comment-list", "site-footer", "cookie-notice", "widget-2", "nav_menu", "related-posts"):
        page = f"<body><div><p>{PROSE}</p></div><div class='x {name}'><p>{PROSE[:400]}</p></div>"
        assert html.main_text(page) == PROSE
    # A long discussion below a short article is dropped too; alone on its page it is what there is.
    assert html.main_text(f"<p>{PROSE}</p><div id=comments>{f'<p>{PROSE}</p>' * 9}</div>") == PROSE
    assert html.main_text(f"<div id=comments><p>{PROSE}</p></div>") == PROSE


@pytest.mark.parametrize("tag", ["div", "section"])
def test_main_text_keeps_an_article_of_several_parts(tag):
    long, short, note = PROSE * 9, PROSE, "A note of few words, all prose."
    links = "".join(f"<li><a href=/{i}>Another page of this site {i}</a></li>" for i in range(9))
    nav, plain = f"<{tag}><ul>{links}</ul></{tag}>", "x" * 30
    a, b = f"<{tag}>{long}</{tag}>", f"<{tag}>{short}</{tag}>"
    pages = {
        f"{a}{b}": f"{long} {short}",
        f"{b}{a}{nav}": f"{short} {long}",
        f"{nav}<h1>Title</h1>{a}<h2>More</h2><pre>{plain}</pre>{b}": f"Title {long} More {plain} {short}",
        f"{a}<blockquote>{note}</blockquote><ul><li>one</li><li>two</li></ul>{nav}": f"{long} {note} one two",
        f"<{tag}><h1>Title</h1></{tag}>{a}{b}": f"Title {long} {short}",
        f"{a}{note}<{tag}>{note}</{tag}>{nav}{b}": f"{long} {note} {note} {short}",
        f"{a}<{tag}><h3>Last</h3><p>{note}</p></{tag}><{tag}>(c) me</{tag}>": f"{long} Last {note}",
        f"{nav}<div><{tag}>{a}</{tag}><{tag}>{b}</{tag}></div>": f"{long} {short}",
        f"<div><div><p>{short}</p><p>{short}</p></div></div><div><p>{note}</p>{b}</div>": f"{short} {short} {note} {short}",
    }
    for page, expected in pages.items():
        assert html.main_text(f"<body>{page}") == expected, page


def test_main_text_of_short_siblings_and_several_articles():
    long, end = PROSE * 9, "It was over by noon."
    teaser = "<article><h2><a href=/x>Another story of this site, with a long title</a></h2><p>Short.</p></article>"
    comment = f"<article class='comment'><p>{PROSE}</p></article>"
    pages = {
        f"<div>{long}</div><div>{end}</div>": f"{long} {end}",
        f"<div>{end}</div><div>{long}</div>": f"{end} {long}",
        f"<div>{long}</div><div><ul><li>one</li><li>two</li></ul></div>": f"{long} one two",
        f"<div>{long}</div><div>Copyright 2024, all rights reserved.</div><div>Share</div>": long,
        f"<article>{long}</article><article>{end}</article>": f"{long} {end}",
        f"<article>{end}</article><div>Buy!</div><article>{long}</article>": f"{end} {long}",
        f"<div><article>{long}</article></div><div><article>{PROSE}</article></div>": f"{long} {PROSE}",
        f"<article>{long}</article>{teaser}{comment}{comment}": long,
        f"<article>{long}<section>{comment}</section></article>": long,
    }
    for page, expected in pages.items():
        assert html.main_text(f"<body>{page}") == expected, page


def test_points_of_every_element_equal_brute_force(table):
    pages = [r.html for r in table("pages").limit(40).collect()] + ["<div>" * 12 + "<p>a, b<div>c</div>" + "</div>" * 5 + "d"]
    for page in pages:
        tree = html.Tree()
        tree.feed(page)
        tree.close()
        found, points = html.blocks(tree.top), {}
        for holder, text, linked in found:
            own, distance = 0.0 if html.is_heading(holder) else html.points_of(text, linked), int(holder.tag not in html.PASS_ON)
            while holder is not None:
                points[holder] = points.get(holder, 0.0) + (own / distance if distance else 0.0)
                holder, distance = holder.parent, distance + 1
        sums = html.summed(tree.top, found)
        assert sums.keys() == points.keys()
        assert all(abs(sums[node].points - points[node]) < 1e-9 for node in points)


@pytest.mark.parametrize("unit", ["<div>word, ", "<p><b>word, ", "<li><div><i>", "<i>x<li>", "<form class=nav>a<h1>", "<td><i>"])
def test_main_text_of_deep_pages_takes_time_by_their_length(unit):
    times = []
    for repeats in (12_500, 100_000):
        start = time.process_time()
        html.main_text("<body>" + unit * repeats)
        times.append(time.process_time() - start)
    assert times[1] < 30 * max(times[0], 0.1), times


def test_extract_pages(spark, table):
    pages = spark.createDataFrame(
        [(1, "u", "<p>Hello, you.</p>", 5), (1, "u", "<p>Hello, you.</p>", 5), (2, None, None, None), (None, "v", "", 1)],
        "page_id long, url string, html string, n_chars int",
    )
    rows = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in rows) == [
        (0, "v", "", 0), (1, "u", "Hello, you.", 11), (1, "u", "Hello, you.", 11), (2, "", "", 0),
    ]
    assert html.extract(pages.limit(0)).count() == 0
    for row in html.extract(table("pages")).join(table("pages"), "page_id").collect():
        start, article, rest = row.html.partition("<article>")
        whole, close, rest = rest.partition("</article>")
        for cut in re.finditer(r"</p>", whole):
            halves = f"{whole[: cut.end()]}</article><article>{whole[cut.end() :]}"
            assert html.main_text(start + article + halves + close + rest) == row.text
            break
        inside = re.search(r"<article>(.*?)</article>", row.html, re.S)
        expected = re.sub(r"<[^>]*>", " ", inside[1])
        for written, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&")):
            expected = expected.replace(written, char)
        assert row.text == " ".join(expected.split())
