"""Main text of web pages, by block rules in two passes.

Markup is cut into blocks: block elements and two line breaks in a row end one, inline elements do
not. Each block has its text, the share of its characters inside links, the share of stop words, and
the elements that it stands in.

Pass one decides on each block alone. Bad: inside an element that is never content (navigation,
header of the page, footer, sidebar, form, notice, advert, comments; by tag, role, class or id), or mostly links
(in an article: almost only links).
Good: inside an article or main element, or long with enough stop words. Bad: long with few stop words. What is left is short and
undecided.

A page may stand in one form, or in a wrapper whose name looks like that of a sidebar. So if no block outside all
such elements is content by itself, those forms and named elements that hold more than half of the page's text are layout, and
pass one is done again without them. Reader comments are none, told by several comments in them.

Pass two gives each undecided block the label of its nearest decided neighbours: of both if they
agree, else of the nearer one, else bad; headings look down only, as they belong to what follows. On
a page where nothing is decided nothing speaks against a block, and all are good.

Stop words are a parameter; the default list has those of four languages.

Defined cases: a null page counts as empty and gives an empty text; broken and cut-off markup is
read as far as it goes, open elements close at the end; repeated rows repeat their results; an empty
table gives an empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea title noembed noframes xmp object canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

NEVER = frozenset("nav footer aside form button select option dialog menu head".split())
CONTENT = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumb\w*|sidebar\w*|side-bar|footer\w*|"
    r"masthead|topbar|comment\w*|disqus\w*|respond|reply|replies|cookie\w*|consent\w*|gdpr|notice\w*|notification\w*|alert\w*|"
    r"popup\w*|pop-up|modal\w*|overlay\w*|newsletter\w*|subscri\w*|signup|login|share\w*|sharing|social\w*|related\w*|"
    r"recommend\w*|widget\w*|pagination|pager|search\w*|toolbar|copyright|legal|disclaimer)(?=$|[\s_-])", re.I)

HEADER_NAME = re.compile(r"(?:^|[_-])header(?=$|[_-])", re.I)
LAYOUT_NAME = re.compile(r"(?:no|with|without|has|is)[_-]", re.I)

TAG = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)([^>=]*(?:=(?:\s*\"[^\"]*\"|\s*'[^']*')?[^>=]*)*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment\w*|disqus\w*|respond|reply|replies)(?=$|[\s_-])", re.I)
SPACE = re.compile(r"[\x20\x09-\x0D\xa0]+")
WORD = re.compile(r"[^\W\d_]+")

STOP_WORDS = frozenset(
    "the of and to in is that it for on with as was are by this be at from or an not which have has had but they you his her "
    "der die und das ist den von mit zu des auf für im nicht ein eine dem sich als auch es an werden aus er hat dass sie nach "
    "le la les de et des un une du est en que pour dans qui par sur pas au plus avec ce il se sont "
    "el los las y del se por con una para su al lo como más o pero sus le ha me si sin sobre".split())


class Block:
    __slots__ = ("text", "linked", "chars", "content", "never", "heading")

    def __init__(self, text: str, linked: int, content: bool, never: bool, heading: bool):
        self.text, self.linked, self.content, self.never, self.heading = text, linked, content, never, heading
        self.chars = len(text)


NEVER_AT_ALL, BY_NAME, COMMENT = 1, 2, 3


def _never(tag: str, attributes: str, in_content: bool) -> int:
    """Why an element is no content: by what it is, by a name that may also be that of a layout, or as a comment; else 0."""
    if tag in NEVER or (tag == "header" and not in_content):
        return BY_NAME if tag == "form" else NEVER_AT_ALL
    if not attributes:
        return 0
    marks = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role" and value.lower() in BAD_ROLES:
            marks = marks or (BY_NAME if value.lower() == "form" else NEVER_AT_ALL)
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            for word in value.split():
                # "has-sidebar" tells of the layout, "article-header" opens the content.
                if not LAYOUT_NAME.match(word) and (BAD_NAME.search(word) or (not in_content and HEADER_NAME.search(word))):
                    marks = marks or (COMMENT if COMMENTS.search(word) else BY_NAME)
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return NEVER_AT_ALL
    return NEVER_AT_ALL if re.search(r"(?:^|\s)hidden(?:[\s=]|$)", attributes) else marks


class Marked:
    """An element that may be no content: its number, why, and what is in it."""
    __slots__ = ("number", "why", "chars", "comments")

    def __init__(self, number: int, why: int, chars: int, comments: int):
        self.number, self.why, self.chars, self.comments = number, why, chars, comments


def blocks(page: str, layout: frozenset[int] = frozenset(), marked: list[Marked] | None = None) -> list[Block]:
    """The blocks of a page in order, without those of no text. Elements are numbered in order; those in ``layout`` are
    no reason to leave out what is in them. ``marked`` is filled with the elements that are one."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, Marked | None]] = []  # tag, content, never, heading, mark
    opened: dict[str, int] = {}
    unclosed: set[str] = set()
    parts: list[str] = []
    linked, links, content, never, heading = 0, 0, False, False, False
    number, chars, comments = 0, 0, 0

    def end() -> None:
        nonlocal parts, linked, chars
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
            if text:
                out.append(Block(text, linked, content, never, heading))
                chars += len(text)
        parts, linked = [], 0

    def leave(n: int) -> None:
        nonlocal content, never, links, heading
        while len(stack) > n:
            tag, *_, mark = stack.pop()
            opened[tag] -= 1
            links -= tag == "a"
            if mark is not None:
                mark.chars, mark.comments = chars - mark.chars, comments - mark.comments
        content, never, heading = stack[-1][1:4] if stack else (False, False, False)

    def enter(tag: str, mark: Marked | None = None) -> None:
        opened[tag] = opened.get(tag, 0) + 1
        stack.append((tag, content, never, heading, mark))

    def closing(tag: str, at: int) -> int:
        """Where the next end tag of this kind ends; -1 if there is none."""
        if tag in unclosed:
            return -1
        close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
        if not close:
            unclosed.add(tag)
        return close.end() if close else -1

    at, n = 0, len(page)
    while at < n:
        found = TAG.search(page, at)
        stop = found.start() if found else n
        if stop > at:
            text = page[at:stop]
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag not in INLINE or tag == "a":
                if tag not in INLINE:
                    end()
                if opened.get(tag):
                    leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in RAW:
            if not (tag in ("svg", "math") and found[3].endswith("/")):
                at = closing(tag, at)
                at = n if at < 0 else at
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                if links and stack[-1][0] == "a":
                    leave(len(stack) - 1)  # links do not nest
                enter(tag)
                links += 1
            elif _never(tag, found[3], content):
                # A hidden or marked inline element hides its text, not the block's.
                at = max(at, closing(tag, at))
            continue
        end()
        if tag in VOID or found[3].endswith("/"):
            continue
        if tag in CLOSES_P or tag in ("li", "tr", "td", "th", "dt", "dd"):
            peers = ("p",) if tag in CLOSES_P else ("li",) if tag == "li" else ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else ("tr",)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in peers:
                    leave(i)
                    break
                if stack[i][0] not in INLINE and stack[i][0] != "p":
                    break
        content = content or tag in CONTENT
        heading = heading or tag in HEADINGS
        number += 1
        why, mark = _never(tag, found[3], content), None
        if why:
            comments += why == COMMENT
            if marked is not None:
                mark = Marked(number, why, chars, comments)
                marked.append(mark)
            never = never or number not in layout
        enter(tag, mark)
    end()
    leave(0)
    return out


def _layout(found: list[Block], marked: list[Marked], long: int, links: float) -> frozenset[int]:
    """Forms and named elements that hold most of the text of a page that has no content outside of them."""
    if any(not b.never and b.chars >= long and b.linked <= links * b.chars for b in found):
        return frozenset()
    total = sum(b.chars for b in found)
    return frozenset(m.number for m in marked if m.why != NEVER_AT_ALL and 2 * m.chars > total
                     and not (m.why == COMMENT and m.comments > 1))


def main_text(page: str, stop_words: frozenset[str] = STOP_WORDS, long: int = 70, dense: float = 0.15, sparse: float = 0.05,
              links: float = 0.4, content_links: float = 0.9) -> str:
    """The text of the good blocks, joined by spaces."""
    marked: list[Marked] = []
    found = blocks(page, marked=marked)
    if layout := _layout(found, marked, long, links):
        found = blocks(page, layout)
    labels: list[bool | None] = []
    for b in found:
        words = WORD.findall(b.text.lower()) if not (b.never or b.content) else []
        share = sum(w in stop_words for w in words) / len(words) if words else 0.0
        if b.never or (b.linked > (content_links if b.content else links) * b.chars and not b.heading):
            labels.append(False)
        elif b.content:
            labels.append(True)
        elif b.chars >= long and share >= dense:
            labels.append(True)
        elif b.chars >= long and share < sparse:
            labels.append(False)
        else:
            labels.append(None)
    decided = [i for i, x in enumerate(labels) if x is not None]
    final, after = list(labels), 0
    for i, label in enumerate(labels):
        if label is None:
            while after < len(decided) and decided[after] < i:
                after += 1
            right = decided[after] if after < len(decided) else None
            left = decided[after - 1] if after and not found[i].heading else None
            if not decided:
                final[i] = True
            elif right is None and left is None:
                final[i] = False
            elif left is None or right is None:
                final[i] = labels[left if right is None else right]
            elif labels[left] == labels[right]:
                final[i] = labels[left]
            else:
                final[i] = labels[left] if i - left < right - i else labels[right] if right - i < i - left else False
    return " ".join(b.text for b, good in zip(found, final) if good)


def extract_main_text(pages: DataFrame, html_column: str = "html", stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """The input without its markup column, with text and n_chars."""
    columns = [f for f in pages.schema.fields if f.name.lower() not in ("text", "n_chars", html_column.lower())]
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", stop_words) for p in batch.column("_h_html").to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in columns) + "text string, n_chars long"
    return pages.select(*(f"`{c}`" for c in names), F.col(html_column).alias("_h_html")).mapInArrow(run, schema)
