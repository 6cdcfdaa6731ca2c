"""Main text of web pages by two-pass block rules.

Pass one labels each block by its place in the page, stop-word density, length and link density; pass two gives
blocks that stayed undecided the label of the nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vendorium.llm.scratch import fresh_name
from vendorium.llm.shipping import ship

# Common function words of the languages at hand, in lower case.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their they "
    "this to was we were which who will with you "
    "aber als auch auf aus bei bin das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit "
    "nach nicht noch nur oder sein sich sie sind um und uns von vor war wir wie wird zu zum zur "
    "au aux avec ce ces cette dans de elle en est et il ils je la le les leur mais ne nous où ou par pas plus pour que qui "
    "sa se ses son sur un une vous "
    "al como con del el ella ellos era esta este fue ha hay las lo los más me mi muy no nos para pero por porque sin sobre "
    "su sus también te tiene todo una uno y ya".split()
)


@dataclass(frozen=True)
class Rules:
    """Lengths in characters and shares that decide a block."""

    short: int = 70  # a block below this length is not decided by its words
    long: int = 200  # at this length a middling stop-word density is enough
    dense: float = 0.20  # share of stop words that running prose has at least
    thin: float = 0.10  # below this share a block is no prose
    linked: float = 0.50  # share of characters in links from which a block is a menu


# Element names and the names by which pages mark what is not the article.
_RAW = "script style textarea title iframe noembed noframes xmp".split()
_CHROME = frozenset("aside button canvas datalist dialog fieldset footer head menu noscript object select svg template".split())
_CHROME_UNLESS_ARTICLE = frozenset("form header nav".split())
_ARTICLE = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OTHER_BLOCKS = frozenset(
    "address blockquote body caption center dd details div dl dt figcaption figure hr html legend li ol p pre section summary "
    "table tbody td tfoot th thead tr ul option optgroup".split()
)
_BLOCKS = _CHROME | _CHROME_UNLESS_ARTICLE | _ARTICLE | _HEADINGS | _OTHER_BLOCKS - {"svg", "button", "canvas"}
_CONTAINERS = _CHROME | _CHROME_UNLESS_ARTICLE | _ARTICLE | frozenset("blockquote body center dd details div dl dt figure li ol p section table tbody td tr ul".split()) | _HEADINGS
_VOID_LIKE = frozenset(("p", "li", "dd", "dt", "td", "tr"))  # an opening tag closes an open one of the same name
_MARKS = frozenset(
    "ad ads adbox adsense adslot advert advertisement advertising advertorial alert banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disclaimer discussion disqus donate footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notification notifications outbrain overlay pager pagination "
    "paywall popup privacy promo promoted promotion recommended recommendations related replies reply respond responses "
    "search share sharing shoutbox sidebar signin signup skip skyscraper social sponsor sponsored subscribe subscription "
    "taboola toolbar widget widgets".split()
)
_SETTINGS = frozenset("has hide no show with without".split())  # `with-sidebar` is about the page, not a sidebar
_OWN_HEADER = frozenset("article content entry post section story".split())  # `entry-header` holds the article's title
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_COMMENTS = re.compile(
    r"(?:\d+\s+)?(?:(?:reader|user|leave a|post a|write a|all)\s+)?(?:comments?|reply|replies|responses?|kommentare?|commentaires?|comentarios?)"
    r"(?:\s*\(?\d*\)?)?[:.]?",
    re.IGNORECASE,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b[^>]*+>.*?(?:</(?P=raw)\b[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<loose>[a-z][^\s/>]*+)[^>]*+>"
    r"|<[!?/][^>]*+>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)|\b(hidden)\b", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    """A piece of text without block tags in it: its place in the page and the characters of it inside links."""

    text: str
    linked: int
    chrome: bool
    article: int  # number of the article or main element around it, 0 outside
    heading: bool


def _marked(attributes: str, in_article: bool) -> bool:
    """Whether class, id, role or style say that an element is not part of the article, or not shown."""
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if hidden or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            for one in value.split():
                parts = [part.lower() for part in _NAME_PARTS.findall(one)]
                if not parts or parts[0] in _SETTINGS:
                    continue
                marks = _MARKS.intersection(parts)
                if marks and not (marks == {"header"} and (in_article or parts[0] in _OWN_HEADER)):
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """Cut a page at its block tags. Comments, scripts, styles and other raw elements give no text.

    Only elements that hold others are tracked. An end tag without its element is passed over; one with it closes all
    that is open inside, so tags that are never closed end with what holds them.
    """
    found: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # name, why it is not the article ("" if it may be), article number
    opened: dict[str, int] = {}
    articles, in_link, heading = 0, False, ""
    texts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(texts).split())
        if text:
            _, why, article = stack[-1] if stack else ("", "", 0)
            if heading and stack and _COMMENTS.fullmatch(text):  # what follows in the element around it are comments
                outer = max((at for at, entry in enumerate(stack) if entry[0] not in _HEADINGS), default=-1)
                if outer >= 0:
                    stack[outer] = (stack[outer][0], "comments", stack[outer][2])
                    why = "comments"
            found.append(Block(text, min(linked, len(text)), bool(why), article, bool(heading)))
        texts.clear()
        linked = 0

    def close(name: str) -> None:
        if opened.get(name):
            while True:
                top = stack.pop()[0]
                opened[top] -= 1
                if top == name:
                    return

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            texts.append(plain)
            if in_link:
                linked += len(" ".join(plain.split()))

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        name = (token["name"] or token["loose"] or "").lower()
        end = token["end"] == "/" or (token["loose"] is not None and token[0].startswith("</"))
        if name == "a":
            in_link = not end
        elif name == "br":
            texts.append(" ")
        elif name in _BLOCKS:
            flush()
            in_link = in_link and not end
        if name in _HEADINGS:
            heading = "" if end else name
        elif name in _BLOCKS:
            heading = ""
        if name not in _CONTAINERS:
            continue
        if end:
            close(name)
            continue
        if name == "body":
            close("head")
        if name in _VOID_LIKE and stack and stack[-1][0] == name:
            close(name)
        _, why, article = stack[-1] if stack else ("", "", 0)
        own = name not in ("body", "html") and bool(token["attributes"]) and _marked(token["attributes"], bool(article))
        if name in _ARTICLE and not own:
            why = "" if why == "soft" else why
            if not why and (not article or name == "article"):
                articles += 1
                article = articles if name == "article" else -articles
        elif own or name in _CHROME:
            why = "hard"
        elif name in _CHROME_UNLESS_ARTICLE and not why and not (article and name == "header"):
            why = "hard" if article else "soft"
        stack.append((name, why, article))
        opened[name] = opened.get(name, 0) + 1
    text(page[at:])
    flush()
    return found


def first_labels(found: Sequence[Block], stop_words: frozenset[str] = STOP_WORDS, rules: Rules = Rules()) -> list[bool | None]:
    """Pass one: True for text of the article, False for anything else, None where the rules leave it open."""
    labels: list[bool | None] = []
    for block in found:
        if block.chrome:
            labels.append(False)
            continue
        size = len(block.text)
        words = _WORD.findall(block.text.lower())
        density = sum(word in stop_words for word in words) / len(words) if words else 0.0
        linked = block.linked / size
        if linked > rules.linked and density < rules.dense:
            labels.append(None if block.heading else False)
        elif size < rules.short or block.heading:
            labels.append(None)
        elif density >= rules.dense or (size >= rules.long and density >= rules.thin):
            labels.append(True)
        elif density < rules.thin and not block.article:
            labels.append(False)
        else:
            labels.append(None)
    return labels


def final_labels(found: Sequence[Block], first: Sequence[bool | None]) -> list[bool]:
    """Pass two: an undecided block takes the label of its nearest decided neighbours.

    Between two labels the nearer counts; at equal distance a heading goes with the block after it, any other is left
    out. Neighbours of a block in an article are those of the same article, and without any it belongs to it. Outside,
    an undecided block without decided neighbours counts as text.
    """
    if any(block.article > 0 for block in found):  # a page with articles: the rest of `main` is nothing special
        areas = [max(0, block.article) for block in found]
    else:
        areas = [abs(block.article) for block in found]
    areas = [0 if block.chrome else area for block, area in zip(found, areas, strict=True)]

    def nearest(order: range) -> list[tuple[int, bool] | None]:
        last: dict[int, tuple[int, bool]] = {}
        near: list[tuple[int, bool] | None] = [None] * len(found)
        for at in order:
            near[at] = last.get(areas[at])
            if first[at] is not None:
                last[areas[at]] = (at, bool(first[at]))
        return near

    before, after = nearest(range(len(found))), nearest(range(len(found) - 1, -1, -1))
    labels = []
    for at, label in enumerate(first):
        if label is not None:
            labels.append(label)
            continue
        left, right = before[at], after[at]
        if left is None or right is None:
            only = left or right
            labels.append(True if only is None or areas[at] and only[1] else only[1])
        elif left[1] == right[1] or at - left[0] < right[0] - at:
            labels.append(left[1])
        elif right[0] - at < at - left[0]:
            labels.append(right[1])
        else:
            labels.append(bool(areas[at]) or (found[at].heading and right[1]))
    return labels


def main_text(page: str | None, stop_words: frozenset[str] = STOP_WORDS, rules: Rules = Rules()) -> str:
    """The kept blocks of a page in order, joined by one space; empty for null, empty and text-free pages."""
    found = blocks(page or "")
    labels = final_labels(found, first_labels(found, stop_words, rules))
    return " ".join(block.text for block, kept in zip(found, labels, strict=True) if kept)


def extract(pages: DataFrame, column: str = "html", stop_words: frozenset[str] = STOP_WORDS, rules: Rules = Rules()) -> DataFrame:
    """All rows of `pages` with every column but `column`, and `text` and `n_chars` (code points) in its place.

    Columns of those names are replaced, in any case. Rows stay where they are: nothing is shuffled, each page is
    parsed whole in time and memory proportional to its length. Repeated rows give repeated rows.
    """
    ship(pages.sparkSession)
    others = [name for name in pages.columns if name.lower() not in (column.lower(), "text", "n_chars")]
    name = fresh_name("_text", others)
    rest = pages.select(*others, pages[column].cast("string").alias(name))
    fields = [field for field in rest.schema.fields[:-1]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page.as_py(), stop_words, rules) for page in batch.column(len(others))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], texts], names=[*others, name])

    done = rest.mapInArrow(work, type(rest.schema)([*fields, rest.schema.fields[-1]]))
    return done.select(*others, F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
