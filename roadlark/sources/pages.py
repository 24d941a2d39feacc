"""Timeline pages (HTML text) to raw posts, and the link to the next page."""

import datetime as dt
import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from roadlark import rules
from roadlark.functions import text as tx
from roadlark.operators.numbering import numbered
from roadlark.session import materialise


def _opening(name: str) -> str:
    """Opening tag of any element that has the class, wherever it stands in the tag."""
    before, after = r"(?:[^\"'<>]*\s)?", r"(?:\s[^\"'<>]*)?"
    return rf"<([a-zA-Z][\w-]*)\s(?:[^<>]*\s)?class\s*=\s*[\"']{before}{name}{after}[\"'][^<>]*>"


# An item runs from its own opening tag up to the next one.
_ITEM = _opening("timeline-item")
_CONTENT = rf"(?s){_opening('tweet-content')}.*?</\1>"
_DATE_LINK = rf"{_opening('tweet-date')}\s*(<a\s[^>]*>)"
_TITLE = r"\stitle\s*=\s*([\"'])(.*?)\1"
_HREF = r"\shref\s*=\s*([\"'])(.*?)\1"
_MORE = rf"{_opening('show-more')}\s*(<a\s[^>]*>)"
_BREAK = r"(?i)<br\s*/?>"
_TAG = r"<[^>]*>"

_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"


def _named() -> Column:
    names = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _decoded(piece: Column) -> Column:
    """What follows an ampersand, with the reference it completes decoded; the ampersand
    stays where there is none."""
    name = F.regexp_extract(piece, _REFERENCE, 1)
    digits = F.when(F.rlike(name, F.lit("^#[0-9]")), F.conv(F.substring(name, 2, 7), 10, 16))
    code = F.lpad(F.coalesce(digits, F.substring(name, 3, 6)), 8, "0")
    # Neither a surrogate half nor beyond the last code point.
    valid = (F.lower(code) <= "0010ffff") & ~F.rlike(F.lower(code), F.lit("^0000d[89a-f]"))
    numeric = F.decode(F.when(valid, F.unhex(code)), "UTF-32")
    char = F.when(F.startswith(name, F.lit("#")), numeric).otherwise(F.try_element_at(_named(), name))
    rest = F.substr(piece, F.length(name) + 2)
    return F.coalesce(F.concat(F.when(name != "", char), rest), F.concat(F.lit("&"), piece))


def _unescape(text: Column) -> Column:
    """Named and numeric character references, each decoded once."""
    pieces = F.split(text, "&", -1)
    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _decoded)
    whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def visible_text(fragment: Column) -> Column:
    lines = F.regexp_replace(fragment, _BREAK, "\n")
    return tx.strip(_unescape(F.regexp_replace(lines, _TAG, "")))


def _attribute(tag, pattern: str) -> Column:
    return _unescape(tx.blank_to_null(F.regexp_extract(tag, pattern, 2)))


def title_date(title: Column) -> Column:
    """Date before the separator, ``Jan 5, 2024 · 8:00 AM UTC``."""
    written = F.split_part(title, F.lit(rules.PAGE_DATE_SEPARATOR), F.lit(1))
    return F.to_date(F.try_to_timestamp(written, F.lit(rules.PAGE_DATE_FORMAT)))


def absolute_link(href: Column, base: str = rules.PAGE_BASE) -> Column:
    """A link of a page as the browser sees it."""
    return (
        F.when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href))
        .otherwise(href)
    )


def public_link(href: Column, hosts: tuple[str, str] = rules.LINK_HOSTS) -> Column:
    return F.replace(absolute_link(href), F.lit(hosts[0]), F.lit(hosts[1]))


_FIELDS = ["content", "tweetlinkid", "created_at"]


def page_items(pages: DataFrame, html: str = "html", carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every complete item of every page with its position; one with a missing field is
    dropped."""
    return _item_fields(pages, html, carry).dropna(subset=_FIELDS)


def _item_fields(pages: DataFrame, html: str, carry: tuple[str, ...]) -> DataFrame:
    """Every item of every page with its position and what there is of its fields.

    The searches in an item run inside the generator: a filter on the fields is not moved
    below it, where it would repeat them.
    """
    pieces = F.split(html, _ITEM, -1)
    found = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda item: F.struct(
            F.regexp_substr(item, F.lit(_CONTENT)).alias("content"),
            F.regexp_extract(item, _DATE_LINK, 2).alias("anchor"),
        ),
    )
    items = pages.select(*carry, F.posexplode(found).alias("position", "item"))
    return items.select(
        *carry,
        "position",
        visible_text(F.col("item.content")).alias("content"),
        public_link(_attribute("item.anchor", _HREF)).alias("tweetlinkid"),
        title_date(_attribute("item.anchor", _TITLE)).alias("created_at"),
    )


def extract_posts(
    pages: DataFrame,
    html: str = "html",
    day: dt.date | None = None,
    mark: str = rules.POST_MARK,
    order: str | None = None,
) -> DataFrame:
    """Posts of the pages that carry the alert mark, of one day or of all.

    With ``order``, a column that tells pages apart such as their crawl number, the posts
    are numbered by pages and positions (``post_seq``), without gaps and once written. What
    is read from the pages is written first: to find the ranges of the order Spark goes over
    the rows twice, and a filter on a computed column computes it again.
    """
    if order:
        items = materialise(_item_fields(pages, html, (order,)), "items").dropna(subset=_FIELDS)
    else:
        items = page_items(pages, html, ())
    posts = items.where(F.contains("content", F.lit(mark)))
    if day is not None:
        posts = posts.where(F.col("created_at") == F.lit(day))
    if not order:
        return posts.select(*_FIELDS)
    placed = posts.select(*_FIELDS, F.col(order).alias("_page"), F.col("position").alias("_position"))
    return numbered(placed, [F.col("_page"), F.col("_position")], "post_seq").drop("_page", "_position")


def next_link(html: Column) -> Column:
    """Link of the last show-more block as written, null if there is none."""
    anchors = F.regexp_extract_all(html, F.lit(_MORE), F.lit(2))
    last = F.try_element_at(anchors, F.lit(-1))
    return _attribute(last, _HREF)


def resolve_link(link: Column, base: str = rules.PAGE_BASE, account: str = rules.PAGE_ACCOUNT) -> Column:
    """Absolute address of a next-page link."""
    return (
        F.when(F.startswith(link, F.lit("http")), link)
        .when(F.contains(link, F.lit(account)), F.concat(F.lit(base), link))
        .otherwise(F.concat(F.lit(f"{base}/{account}"), link))
    )
