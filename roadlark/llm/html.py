"""Main text of web pages by scoring their trees.

Every paragraph has points for its length and its commas, less its share of link text; it
passes them on to its ancestors, ever less with the distance. The container with the most
points is the article; what stands beside it and is prose too, not links, is kept with it.
Sums go up the tree once, so that a page's cost grows with its length, however deep it is.

Forms, and elements whose class or id says that they are no article, go before that unless
they hold most of the page's points or its title; where little is left they come back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from roadlark.llm.common import small_batches

# Element names of HTML by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head title script style noscript template svg math canvas iframe object audio video nav header footer "
    "aside button select textarea input label fieldset menu dialog".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup "
    "hr html li main ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCKS | {"form", "nav", "header", "footer", "aside", "menu", "fieldset"}
SAME_LEVEL = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
LEVEL_ENDS = frozenset("ul ol dl table tbody thead tfoot article body div section".split())
LEVELS = LEVEL_ENDS | frozenset(tag for tags in SAME_LEVEL.values() for tag in tags) | frozenset(SAME_LEVEL)
_WORDS = (
    r"(?:ads?|advert\w*|adbox|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|"
    r"masthead|menu|modal|nav|navbar|navigation|newsletter|notice|outbrain|pagination|pager|popup|promo\w*|"
    r"related|replies|respond|share|sharing|sidebar|skip|social|sponsor\w*|subscribe|taboola|toolbar|widgets?)"
)
# A whole token of a class or id: such words only, but for what goes with them.
UNLIKELY = re.compile(
    rf"(?:(?:site|global|primary|secondary|top|bottom)[_-]+)*{_WORDS}"
    rf"(?:[_-]+(?:{_WORDS}|posts?|box|links?|list|form|area|\d+))*",
    re.I,
)
# Of these, what may be longer than the article and is none for that.
NEVER = re.compile(
    r"(?:comments?|disqus|replies|respond|ads?|advert\w*|adbox|banner|cookies?|consent|modal|newsletter|outbrain|"
    r"popup|promo\w*|sponsor\w*|subscribe|taboola)(?:[_-]|$)",
    re.I,
)
UNLIKELY_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ARTICLES = frozenset(("article", "main"))

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
BESIDE = HEADINGS | frozenset("pre blockquote ul ol dl table figure".split())
PASS_ON = frozenset("p pre li td dd blockquote".split())  # their points go to the parent

SIBLING_SHARE = 0.2  # of the best container's points that make a sibling part of the text
LINK_SHARE = 0.25  # of a text's letters; prose has fewer in links
SECTION_LETTERS = 100  # a sibling of so many letters that are prose is part of the text; a shorter one
SENTENCE = re.compile(r"\w+\W+\w.*[.!?\u2026\u3002][\"'\u201d\u2019\u00bb)\]]*$", re.S)  # if it ends as a sentence does
NOTICE = re.compile(r"\u00a9|\(c\)|copyright|rights reserved|cookie|newsletter|subscribe|sponsored|advertis", re.I)  # and is none
LITTLE_LETTERS = 200  # a text below that may be what is left of a page dropped by mistake
LITTLE_SHARE = 0.25  # of the page's points
DISTANCES = 16  # levels up to which each distance has its own sum; points from below count at their mean distance


class Node:
    """An element; ``parts`` are texts and elements in page order."""

    __slots__ = ("tag", "parent", "parts", "dropped", "level")

    def __init__(self, tag: str, parent: Node | None, dropped: bool) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.parts: list[str | Node] = []
        # The nearest element, itself included, that list and table elements heed.
        self.level: Node | None = self if parent is None or tag in LEVELS else parent.level


class Tree(HTMLParser):
    """Builds the tree and forgives what pages leave unclosed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = self.at = Node("html", None, False)
        self.open: dict[str, int] = {}
        self.doubtful: list[tuple[Node, bool]] = []  # in page order, and whether its length does not count
        self.signs: list[Node] = []  # elements that an article has

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P and self.open.get("p"):
            self._close("p")
        if tag in SAME_LEVEL:
            self._close_level(SAME_LEVEL[tag])
        at = self.at
        if tag == "br" or tag == "hr":
            at.parts.append(" ")
        if tag in VOID:
            return
        named = unlikely(attrs)
        never = bool(named and NEVER.match(named))
        # An article named a comment or an advertisement is none.
        free = tag in ("main", "body") or (tag == "article" and not never)
        dropped = at.dropped or tag in DROPPED or (not free and hidden(attrs))
        node = Node(tag, at, dropped)
        if not dropped:
            if (named and not free) or tag == "form":
                self.doubtful.append((node, never))
            if (tag in ARTICLES and free) or tag == "h1":
                self.signs.append(node)
        if not dropped or not at.dropped:
            at.parts.append(node)
        self.at = node
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash closes void elements only.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.at.dropped:
            self.at.parts.append(data)

    def _close(self, tag: str) -> None:
        while self.at.parent is not None:
            gone, self.at = self.at, self.at.parent
            self.open[gone.tag] -= 1
            if gone.tag == tag:
                return

    def _close_level(self, tags: set[str]) -> None:
        """Close an open element of ``tags`` unless a list, table or section stands between."""
        node = self.at.level
        while node.parent is not None and node.tag not in LEVEL_ENDS:
            if node.tag in tags:
                self._close(node.tag)
                return
            node = node.parent.level


def hidden(attrs: list) -> bool:
    """Whether an element's attributes say that it is not shown, or no text."""
    for name, value in attrs:
        if name == "hidden":
            return True
        if not value:
            continue
        if name == "role":
            if value.lower() in UNLIKELY_ROLES:
                return True
        elif name == "aria-hidden":
            if value.lower() == "true":
                return True
        elif name == "style" and HIDDEN.search(value):
            return True
    return False


def unlikely(attrs: list) -> str | None:
    """The token of an element's class or id that says that it is no part of an article."""
    for name, value in attrs:
        if value and (name == "class" or name == "id"):
            for token in value.split():
                if UNLIKELY.fullmatch(token):
                    return token
    return None


def walk(top: Node) -> Iterator[tuple[str, Node, str]]:
    """("open" or "close", element, "") and ("text", parent, text) in page order."""
    stack: list[tuple[Node, int]] = [(top, 0)]
    yield "open", top, ""
    while stack:
        node, i = stack.pop()
        if i == len(node.parts):
            yield "close", node, ""
            continue
        stack.append((node, i + 1))
        part = node.parts[i]
        if isinstance(part, str):
            yield "text", node, part
        elif not part.dropped:
            stack.append((part, 0))
            yield "open", part, ""


def blocks(top: Node) -> list[tuple[Node, str, int]]:
    """(nearest block element, its run of text, letters of it in links) in page order."""
    found: list[tuple[Node, str, int]] = []
    holders, run, linked, links = [top], [], 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            found.append((holders[-1], text, min(linked, len(text))))
        run.clear()
        linked = 0

    for event, node, text in walk(top):
        if event == "text":
            run.append(text)
            if links:
                linked += len(text.strip())
        elif node.tag == "a":
            links += 1 if event == "open" else -1
        elif node.tag in BLOCKS:
            flush()
            if event == "open":
                holders.append(node)
            else:
                holders.pop()
                if not holders:
                    holders.append(top)
    flush()
    return found


def is_heading(node: Node) -> bool:
    return node.tag in HEADINGS


def points_of(text: str, linked: int) -> float:
    return (1 + text.count(",") + len(text) / 100) * (1 - linked / len(text))


class Sums:
    """Of an element: its points, and letters of its text, in links, in headings, in lists and
    the like, in articles; ``first`` and ``last`` are the places of its blocks of text."""

    __slots__ = (
        "points", "letters", "linked", "headings", "listed", "articles", "first", "last", "by_distance", "far", "moment"
    )

    def __init__(self) -> None:
        self.points, self.far, self.moment = 0.0, 0.0, 0.0
        self.letters = self.linked = self.headings = self.listed = self.articles = 0
        self.first, self.last = -1, -1
        self.by_distance: list[float] = []

    def add(self, distance: int, points: float) -> None:
        if distance >= DISTANCES:
            self.far += points
            self.moment += points * distance
            return
        while len(self.by_distance) <= distance:
            self.by_distance.append(0.0)
        self.by_distance[distance] += points

    def end(self) -> None:
        """Points for what was added, the less the farther it is."""
        self.points = sum(points / d for d, points in enumerate(self.by_distance) if d)
        if self.far:
            self.points += self.far * self.far / self.moment

    def pass_on(self, above: Sums) -> None:
        for distance, points in enumerate(self.by_distance):
            above.add(distance + 1, points)
        self.by_distance = []
        above.far += self.far
        above.moment += self.moment + self.far
        above.letters += self.letters
        above.linked += self.linked
        above.headings += self.headings
        above.listed += self.listed
        above.articles += self.articles
        above.first = self.first if above.first < 0 else min(above.first, self.first)
        above.last = max(above.last, self.last)


def summed(top: Node, found: list[tuple[Node, str, int]]) -> dict[Node, Sums]:
    """The sums of every element that has text; each element passes its own to its parent once."""
    sums: dict[Node, Sums] = {}
    for i, (holder, text, linked) in enumerate(found):
        own = sums.get(holder)
        if own is None:
            own = sums[holder] = Sums()
            own.first = i
        own.last = i
        own.letters += len(text)
        own.linked += linked
        if is_heading(holder):
            own.headings += len(text)
        else:
            own.add(0 if holder.tag in PASS_ON else 1, points_of(text, linked))
    # What comes later in page order is never above what comes before.
    for node in reversed([node for event, node, _ in walk(top) if event == "open"]):
        own = sums.get(node)
        if own is None:
            continue
        own.end()
        if node.tag in BESIDE:
            own.listed = own.letters
        if node.tag == "article":
            own.articles = own.letters
        if node is not top:
            above = sums.get(node.parent)
            if above is None:
                above = sums[node.parent] = Sums()
            own.pass_on(above)
    return sums


def drop_doubtful(tree: Tree) -> float:
    """Drops the doubtful elements but for those that seem to hold the article; the points
    of the page with all of them."""
    weight: dict[Node, float] = {}
    for holder, text, linked in blocks(tree.top):
        weight[holder] = weight.get(holder, 0.0) + (0.0 if is_heading(holder) else points_of(text, linked))
    for node in reversed([node for event, node, _ in walk(tree.top) if event == "open"]):
        if node in weight and node is not tree.top:
            weight[node.parent] = weight.get(node.parent, 0.0) + weight[node]
    total = weight.get(tree.top, 0.0)
    titles = sum(node.tag == "h1" for node in tree.signs)
    needed: set[Node] = set()
    for sign in tree.signs:
        if sign.tag == "h1":
            tells = titles == 1
        else:
            tells = sign.tag == "main" or weight.get(sign, 0.0) > LITTLE_SHARE * total
        node = sign if tells else None
        while node is not None and node not in needed:
            needed.add(node)
            node = node.parent
    for node, never in tree.doubtful:
        most = not never and 2 * weight.get(node, 0.0) > total
        node.dropped = node not in needed and not most
    return total


def main_text(html: str) -> str:
    """The text of the page's article; empty if it has none."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    if not tree.doubtful:
        return scored(tree.top)[0]
    total = drop_doubtful(tree)
    text, points, sure = scored(tree.top)
    if not sure and len(text) < LITTLE_LETTERS and points <= LITTLE_SHARE * total:
        for node, _ in tree.doubtful:
            node.dropped = False
        text = scored(tree.top)[0]
    return text


def beside(best: Node, sums: dict[Node, Sums], found: list[tuple[Node, str, int]]) -> list[Node]:
    """``best`` and the siblings that are part of its text, in page order."""

    def is_sentence(own: Sums) -> bool:
        if own.letters >= SECTION_LETTERS:
            return True
        text = " ".join(text for _, text, _ in found[own.first : own.last + 1])
        return bool(SENTENCE.search(text)) and not NOTICE.search(text)

    rows = [part for part in best.parent.parts if isinstance(part, Node) and part in sums and not part.dropped]
    least = SIBLING_SHARE * sums[best].points
    taken = []
    for row in rows:
        own = sums[row]
        few_links = own.linked < LINK_SHARE * own.letters
        text = own.letters - own.headings
        whole = row.tag not in BESIDE and text and (row.tag == "p" or own.headings or is_sentence(own))
        taken.append(row is best or own.points > least > 0 or (few_links and bool(whole)))
    first, last = taken.index(True), len(taken) - 1 - taken[::-1].index(True)

    def goes_with(i: int, inside: bool) -> bool:
        row, own = rows[i], sums[rows[i]]
        # A heading may be one link.
        if own.headings == own.letters:
            return True
        return own.linked < LINK_SHARE * own.letters and (inside or own.listed == own.letters)

    for i in range(first, last):
        taken[i] = taken[i] or goes_with(i, True)
    for i in range(first - 1, -1, -1):
        if not goes_with(i, False):
            break
        taken[i] = True
    for i in range(last + 1, len(rows)):
        if not goes_with(i, False):
            break
        taken[i] = True
    return [row for row, yes in zip(rows, taken) if yes]


def articles_beside(best: Node, sums: dict[Node, Sums]) -> list[Node]:
    """The article ``best`` and those beside it, in wrappers of their own or none, that are prose
    too: a page may cut its text into several."""
    at = best
    while at.parent is not None and sums[at.parent].letters == sums[at].letters:
        at = at.parent
    if at.parent is None:
        return [best]
    rows = [part for part in at.parent.parts if isinstance(part, Node) and part in sums and not part.dropped]
    return [best] + [
        row
        for row in rows
        if row is not at
        and sums[row].articles == sums[row].letters
        and sums[row].linked < LINK_SHARE * sums[row].letters
    ]


def scored(top: Node) -> tuple[str, float, bool]:
    """The article's text, its points, and whether the page itself calls it one."""
    found = blocks(top)
    if not found:
        return "", 0.0, False
    sums = summed(top, found)
    best, seen = None, set()
    for holder, _, _ in found:
        node = holder
        while node is not None and node not in seen:
            seen.add(node)
            if best is None or sums[node].points > sums[best].points:
                best = node
            node = node.parent
    node = best
    while node is not None:  # an article is kept whole
        if node.tag in ARTICLES:
            best = node
        node = node.parent
    kept = set(articles_beside(best, sums)) if best.tag == "article" else {best}
    while best.tag not in ARTICLES and best.parent is not None:
        row = beside(best, sums, found)
        kept.update(row)
        # A parent whose whole text is kept stands for it: the article may go on beside it.
        if sum(sums[node].letters for node in row) < sums[best.parent].letters:
            break
        best = best.parent
        kept.add(best)
    inside: dict[Node, bool] = {}

    def belongs(node: Node | None) -> bool:
        path = []
        while node is not None and node not in inside:
            if node in kept:
                inside[node] = True
                break
            path.append(node)
            node = node.parent
        answer = node is not None and inside[node]
        for passed in path:
            inside[passed] = answer
        return answer

    answers = [belongs(holder) for holder, _, _ in found]
    first, last = answers.index(True), len(answers) - answers[::-1].index(True)
    chosen = []
    for answer, (holder, text, linked) in zip(answers[first:last], found[first:last]):
        # Text between kept elements that is in no element of its own.
        if answer or (best.tag != "article" and holder is best.parent and linked < LINK_SHARE * len(text)):
            chosen.append((holder, text, linked))
    points = sum(points_of(text, linked) for holder, text, linked in chosen if not is_heading(holder))
    return " ".join(text for _, text, _ in chosen), points, best.tag in ARTICLES


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with page_id and url, the main text and its length in code points.

    A null or empty page, or one without text outside menus and the like, has an empty
    text. Pages are independent of each other: repeated pages give repeated rows. Other
    columns are not looked at.
    """

    @F.pandas_udf("string")
    def article(batch: pd.Series) -> pd.Series:
        return batch.map(main_text)

    small_batches(pages)
    html = F.coalesce(F.col(f"`{html_column}`"), F.lit(""))
    return pages.select("page_id", "url", article(html).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
