"""HTML extraction by tag-path ratios.

A page is read into blocks of text in page order, each with its root-to-leaf path of tags
(and classes). For every path of the page

* the text ratio is the mean number of characters of its blocks,
* the punctuation ratio the mean number of punctuation marks.

Both are written along the page, block by block, smoothed by a Gaussian, and fused to one
value. A path is content if the mean of its blocks' values reaches a share of their
deviation; the best path always is. Blocks beside content in the same container (headings, short
paragraphs) belong to it. Menus, headers, footers, sidebars, notices, adverts, forms and
comments never do: elements are known by tag, role or a word of their class or id. Inside an
article or main element the whole class or the role must say so; if a word of a class does, the
path must reach the share of the deviation by itself, as it must in a header of the article, whose headings stay.
Ids of headings are titles and say nothing.

Pages are read as they are: end tags may be missing (a block ends an open paragraph), the
page may break off anywhere, scripts may hold tags.

Paths are nodes of a trie of the page's steps, so time and memory grow with the page however deep it nests.

Defined cases
  * tags that are never closed nest as deep as they come; end tags without a start and raw elements without an
    end (other than scripts and styles) are passed over;
  * null or empty html, or no content: empty text;
  * white space, no-break spaces included, and ``<br>`` become one space inside a block;
  * repeated rows, null ids or urls: one result row for every row; no rows: no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Share of the deviation of the fused values that the mean of a path's blocks must reach.
THRESHOLD = 0.6
_SMOOTH = np.exp(-0.5 * (np.arange(-2, 3) / 1.0) ** 2)
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
# Elements by what HTML says of them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe xmp svg select option button head".split())
_CLOSING = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in _RAW}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover "
    "mtable mtr mtd mstyle mspace mpadded semantics annotation".split())
_UNMARKED = _INLINE - {"a"}
_CLOSES = {tag: frozenset({tag}) for tag in ("li", "option", "tr")} | {
    "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"})}
_SCOPES = frozenset("html body article section div main nav aside footer header form ul ol table dl blockquote figure".split())
_OUTSIDE_TAGS = frozenset("nav header footer aside form menu dialog".split())
_OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert newsletter subscribe subscription signup login popup modal overlay comment comments reply "
    "replies disqus respond nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer header masthead sidebar "
    "sidebars aside widget widgets share sharing social related recommended toolbar skip search copyright legal complementary "
    "contentinfo form".split())
# Of these, names that article text bears too: inside an article the ratios decide.
_DOUBTED_NAMES = frozenset(
    "related recommended legal copyright search skip form toolbar login alert promo promotion".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Whether a block is content by its elements: yes, only if its path's ratio says so, no.
_CONTENT, _DOUBTFUL, _OUTSIDE = range(3)


class Path:
    """A root-to-leaf path of tags as a node of the page's trie: equal paths are one object, and a step costs one.

    `article` is the innermost article or main element on the path, itself included.
    """

    __slots__ = ("parent", "step", "name", "article", "depth", "below")

    def __init__(self, parent: Path | None = None, step: str = ""):
        self.parent, self.step, self.name = parent, step, step.partition(".")[0]
        self.article = self if self.name in ("article", "main") else parent.article if parent else None
        self.depth: int = parent.depth + 1 if parent else 0
        self.below: dict[str, Path] = {}

    def child(self, step: str) -> Path:
        found = self.below.get(step)
        if found is None:
            found = self.below[step] = Path(self, step)
        return found

    def marked(self) -> set[Path]:
        """The path's node and all nodes below it."""
        found, waiting = set(), [self]
        while waiting:
            node = waiting.pop()
            found.add(node)
            waiting += node.below.values()
        return found

    def __str__(self) -> str:
        steps, node = [], self
        while node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


class Block:
    __slots__ = ("path", "kind", "text")

    def __init__(self, path: Path, kind: int, text: str):
        self.path, self.kind, self.text = path, kind, text

    @property
    def outside(self) -> bool:
        return self.kind == _OUTSIDE


def _kind(tag: str, in_article: bool, classes: set[str], role: set[str], names: set[str]) -> int:
    """What an element's tag, role, class and id say; `names` are the words of all three."""
    if tag == "header" and in_article:
        return _DOUBTFUL  # the article's own: its headings stay
    if tag in _OUTSIDE_TAGS or tag == "head":
        return _OUTSIDE
    if tag in ("html", "body", "article", "main"):
        return _CONTENT
    if not in_article:
        return _CONTENT if names.isdisjoint(_OUTSIDE_NAMES) else _OUTSIDE
    # inside an article, words are parts of titles and styles; only a whole class or a role names the element
    if not (classes | role).isdisjoint(_OUTSIDE_NAMES - _DOUBTED_NAMES):
        return _OUTSIDE
    words = {word for name in classes for word in _NAME_WORDS.findall(name)}
    return _CONTENT if words.isdisjoint(_OUTSIDE_NAMES) else _DOUBTFUL


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page, in page order."""
    found: list[Block] = []
    # tag, node of the path, kind, whether an article or main element is open here
    stack: list[tuple[str, Path, int, bool]] = []
    root = Path()
    pieces: list[str] = []
    place: tuple[Path, int] | None = None  # path and kind where the block's first text stood
    open_tags: Counter[str] = Counter()

    def flush():
        nonlocal place
        if place is not None:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append(Block(root if place[0].step == "a" and place[0].parent is root else place[0], place[1], text))
        pieces.clear()
        place = None

    def pop_to(index: int):
        gone = [tag for tag, *_ in stack[index:]]
        if any(tag not in _INLINE for tag in gone):
            flush()
        open_tags.subtract(gone)
        del stack[index:]

    # raw elements whose end no longer comes are not looked for again
    endless: set[str] = set()
    at, end = 0, len(page)
    while at < end:
        mark = _MARK.search(page, at)
        text = page[at:mark.start() if mark else end]
        if text and place is None and not text.isspace():
            place = (stack[-1][1], stack[-1][2]) if stack else (root, _CONTENT)
        if text:
            pieces.append(text)
        if mark is None:
            break
        at = mark.end()
        if mark[2] is None:
            continue
        tag = mark[2].lower()
        if mark[1]:
            if open_tags[tag] > 0:
                for index in range(len(stack) - 1, -1, -1):
                    if stack[index][0] == tag:
                        pop_to(index)
                        break
                    if tag in _INLINE and stack[index][0] in _SCOPES:
                        break
            continue
        if tag in _RAW and tag != "head":
            close = None if tag in endless else _CLOSING[tag].search(page, at)
            if close is None:
                endless.add(tag)
            # a raw element that never ends takes nothing with it but its own tag, except for scripts and styles
            at = close.end() if close else (end if tag in ("script", "style", "textarea", "title") else at)
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag not in _INLINE:
            flush()
            closes = _CLOSES.get(tag, frozenset()) | {"p"}
            if any(open_tags[c] > 0 for c in closes):
                for index in range(len(stack) - 1, -1, -1):
                    if stack[index][0] in closes:
                        pop_to(index)
                        break
                    if stack[index][0] in _SCOPES:
                        break
        names, classes, role, shown = set(), set(), set(), ""
        if "=" in mark[3]:
            for kind, value in _ATTRIBUTE.findall(mark[3]):
                value = value.strip("\"'").lower()
                # camelCase and digits part words too
                if kind.lower() != "id" or tag not in _HEADINGS:
                    names.update(_NAME_WORDS.findall(value))
                if kind.lower() == "role":
                    role.update(value.split())
                elif kind.lower() == "class":
                    classes.update(value.split())
                    shown = "." + re.sub(r"\d+", "0", value.replace(" ", ".").replace("/", "."))
        _, above, kind, in_article = stack[-1] if stack else ("", root, _CONTENT, False)
        own = _kind(tag, in_article, classes, role, names)
        stack.append((tag, above if tag in _UNMARKED else above.child(tag + shown), max(own, kind), in_article or tag in ("article", "main")))
        open_tags[tag] += 1
    flush()
    return found


def select(found: list[Block]) -> list[Block]:
    """The blocks whose paths are content, by fused ratios of text and punctuation."""
    if not found:
        return []
    number: dict[Path, int] = {}
    path = np.array([number.setdefault(block.path, len(number)) for block in found])
    blocks_of = np.bincount(path)
    letters = np.array([len(b.text) for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in found], float)
    # each block stands for its path: means over the path's blocks, along the page
    along = np.stack([(np.bincount(path, x) / blocks_of)[path] for x in (letters, marks)])
    own = along[0] * (1 + along[1])  # what a path's own blocks say, without their neighbours
    weights = np.convolve(np.ones(len(found)), _SMOOTH, "same") if len(found) >= len(_SMOOTH) else None
    if weights is not None:
        along = np.stack([np.convolve(a, _SMOOTH, "same") / weights for a in along])
    fused = along[0] * (1 + along[1])
    value = np.bincount(path, fused) / blocks_of
    inside = np.bincount(path, [not b.outside for b in found]) > 0
    if not inside.any():
        return []
    least = THRESHOLD * fused.std()
    best = int(np.where(inside, value * blocks_of, -1.0).argmax())  # of equal ones the first on the page
    good = inside & (value >= least) & (value >= 0.1 * value[best])
    good[best] = True
    nodes = list(number)
    content = {nodes[k] for k in np.flatnonzero(good)}
    # what stands in the container of the best path belongs to it, however short
    container = nodes[best].parent or nodes[best]
    container = container.article or container
    around = container.marked() - {container} if container.step not in ("", "html", "body") else None
    chosen = []
    for block, ratio in zip(found, own, strict=True):
        if block.outside or (block.kind == _DOUBTFUL and ratio < least and block.path.name not in _HEADINGS):
            continue
        if around is not None:
            # an article or main element that holds the container parts it from what stands elsewhere
            if block.path in around or (block.path in content and (container.article is None or block.path.article is not None)):
                chosen.append(block)
        elif block.path in content or block.path.step[:1] == "h":
            chosen.append(block)
    return chosen


def main_text(page: str | None) -> str:
    return "\n".join(block.text for block in select(blocks(page))) if page else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, text and n_chars (code points) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=names)

    source = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string"))
    schema = T.StructType([*source.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names
    return source.mapInArrow(run, schema)
