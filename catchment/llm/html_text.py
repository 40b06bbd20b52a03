"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each with the path of tags from the root down. Per path,
text length and punctuation are aggregated per node; the ratios are smoothed over paths
that follow one another, the share of text outside links is taken in, and the three are
fused into one score with two priors. A path below elements that name themselves a menu,
header, footer, sidebar, notice, advert, form or comment list counts a tenth per such
element; a path inside (outside) the article or main elements counts by the share of the
page's running text that stands inside (outside) them. Paths whose score passes
``threshold`` standard deviations are content, and headings beside or above such paths.

The ratios find where the content stands; they don't weigh its parts against one another. So the
elements that hold content paragraphs (an article, or the division that they lie in) give all else
that they hold too, whatever its path: tables, lists, quotations, preformatted text. Left out there
are only elements that name themselves boilerplate, and paths that are links for the greater part.
The body as such gives what stands in it directly, not its divisions. Only what a browser does not
show as text (scripts, hidden elements, controls) is left out unscored. Content nodes are put
together to blocks, in page order.

Each page is worked on by itself, so nothing is shuffled and a page costs what it is long, also
when its elements are nested deeply or never closed.

Nulls and ties: a null or empty page gives an empty text. A null id or url stays null. Rows
that repeat are extracted each. Broken or cut-off markup ends where the page ends. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("button caption head body html td th tr tbody thead tfoot option optgroup legend".split())
NEVER = frozenset("head script style noscript template iframe object svg math canvas audio video textarea select option button title input map".split())
ASIDE = frozenset("form nav aside menu dialog footer search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(["article", "main"])
#: What a path counts per element around it that names itself boilerplate, and the least that it counts for its side of the articles.
NAMED, SIDE = 0.1, 0.05
#: Words in a class, id or role that name something other than the article.
BOILER = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "dialog discussion disqus footer footnav form gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar sidebars signup "
    "skip social sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets complementary contentinfo alert alertdialog "
    "teaser teasers outbrain taboola login byline hidden".split()
)
#: Elements that make up running text, as opposed to those that divide a page.
TEXTUAL = frozenset("p li td th tr tbody thead tfoot table ul ol dl dt dd blockquote pre h1 h2 h3 h4 h5 h6 hgroup figure figcaption caption center address summary legend menu dir".split())
PUNCT = re.compile(r"[.,;:!?、。，！？；：…]")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
NAMES = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")


#: What an element that may go without its end tag closes, and where the search for that ends.
PEERS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol menu dl table tbody thead tfoot select".split())


def _names(attrs: str) -> list[str]:
    """Lower-case words of an element's class, id and role."""
    return [w.lower() for m in NAMES.finditer(attrs) for w in PART.findall(m[1] or m[2] or m[3] or "")]


class Page:
    """A page's text nodes, its paths and its block elements.

    ``nodes`` are [block number, path, never, inside a link, block element, pieces of text]. A path
    is (number of the sequence of block names, number of elements around that name themselves
    boilerplate, whether it is inside an article). Sequences and elements are numbered as they
    open and know the one above, so that depth costs nothing.
    """

    def __init__(self, html: str):
        self.nodes: list[list] = []
        self.name, self.above = [""], [0]  # of sequences
        self.kind, self.parent = [""], [0]  # of elements
        self._read(html)

    def _read(self, html: str) -> None:
        stack: list[tuple[str, bool, int, bool, bool, int, int]] = []  # name, never, boilerplate around, article, link, sequence, element
        top = ("", False, 0, False, False, 0, 0)
        numbers: dict[tuple[int, str], int] = {}
        open_: dict[str, int] = {}
        nodes, block, at, size = self.nodes, 0, 0, len(html)

        def leave(i: int) -> bool:
            """Close all from ``i`` on; whether a block ends."""
            nonlocal top
            ends = any(x[0] in BLOCKS for x in stack[i:])
            for x in stack[i:]:
                open_[x[0]] -= 1
            del stack[i:]
            top = stack[-1] if stack else ("", False, 0, False, False, 0, 0)
            return ends

        while at < size:
            m = TOKEN.match(html, at)
            token = m[0]
            at = m.end()
            name = m[1]
            _, never, named, article, link, sequence, element = top
            path = (sequence, named, article)
            if name is None:
                if token[0] != "<" or len(token) == 1:
                    if nodes and nodes[-1][:5] == [block, path, never, link, element]:
                        nodes[-1][5].append(token)
                    else:
                        nodes.append([block, path, never, link, element, [token]])
                continue
            name = name.lower()
            if token[1] == "/":
                for i in range(len(stack) - 1, -1, -1) if open_.get(name) else ():
                    if stack[i][0] == name:
                        block += leave(i)
                        break
                    # An end tag of an inline element does not end the blocks around it.
                    if name not in BLOCKS and stack[i][0] in BLOCKS:
                        break
                block += name in BLOCKS
                continue
            if token[-1] != ">":
                break  # the page ends inside a tag
            if name in CLOSES_P and open_.get("p"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        block += leave(i)
                        break
                    if stack[i][0] in BLOCKS:
                        break
            peers = PEERS.get(name, ())
            if any(open_.get(x) for x in peers):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in peers:
                        block += leave(i)
                        if name != "tr" or not stack or stack[-1][0] not in peers:
                            break
                    elif stack[i][0] in LISTS:
                        break
            block += name in BLOCKS
            _, never, named, article, link, sequence, element = top
            attrs = m[2] or ""
            if name == "br" or name == "hr":
                nodes.append([block, (sequence, named, article), never, link, element, [" "]])
            if name in VOID or attrs.endswith("/") and name not in BLOCKS and name not in RAW:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s>/]", re.I).search(html, at)
                if end is None:
                    break
                at = html.find(">", end.start()) + 1 or size
                block += name in BLOCKS
                continue
            words = _names(attrs) if attrs else []
            is_article = name in ARTICLE or "articlebody" in "".join(words) or words == ["main"]
            other = name in ASIDE or name == "header" and not article or bool(words) and not is_article and name not in ("html", "body") and not BOILER.isdisjoint(words)
            if name in BLOCKS:
                below = numbers.setdefault((sequence, name), len(self.name))
                if below == len(self.name):
                    self.name.append(name), self.above.append(sequence)
                self.kind.append(name), self.parent.append(element)
                sequence, element = below, len(self.kind) - 1
            top = (name, never or name in NEVER or bool(attrs and HIDDEN.search(attrs)), named + other, article or is_article and not named, link or name == "a", sequence, element)
            stack.append(top)
            open_[name] = open_.get(name, 0) + 1

    def home(self, element: int) -> int:
        """The dividing element that a piece of running text belongs to."""
        while self.kind[element] in TEXTUAL:
            element = self.parent[element]
        return element


class Paths:
    """What the nodes of each path add up to, and the score of each."""

    def __init__(self, nodes: list[list]):
        self.order: dict[tuple, int] = {}
        sums: list[list[float]] = []  # text length, punctuation, text inside links, nodes
        for _, path, never, link, _, pieces in nodes:
            text = "".join(pieces)
            if never or not (n := len(text.strip())):
                continue
            k = self.order.setdefault(path, len(self.order))
            if k == len(sums):
                sums.append([0.0] * 4)
            for j, x in enumerate((n, len(PUNCT.findall(text)), n if link else 0, 1)):
                sums[k][j] += x
        self.length, self.marks, self.linked, self.count = np.array(sums).reshape(-1, 4).T

    def scores(self) -> np.ndarray:
        ratio = np.array([self.length / self.count, self.marks / self.count])
        wide = np.pad(ratio, ((0, 0), (1, 1)), mode="edge")
        smooth = 0.25 * wide[:, :-2] + 0.5 * ratio + 0.25 * wide[:, 2:]
        named, inside = np.array([p[1] for p in self.order]), np.array([p[2] for p in self.order])
        running = np.where(named == 0, self.length - self.linked, 0)
        side = np.where(inside, running[inside].sum(), running[~inside].sum()) / max(running.sum(), 1)
        return np.sqrt(smooth[0] * (smooth[1] + 0.1)) * (1 - self.linked / self.length) * NAMED**named * (SIDE + side)

    def chosen(self, threshold: float) -> tuple[set, set]:
        """Paths that the fused ratios and priors select, and those that are links for the greater part."""
        if not self.order:
            return set(), set()
        score = self.scores()
        return {p for p, k in self.order.items() if score[k] > 0 and score[k] >= threshold * score.std()}, {p for p, k in self.order.items() if self.linked[k] > 0.5 * self.length[k]}


def main_text(html: str | None, threshold: float = 0.5) -> str:
    """The article of a page: its blocks joined by blank lines."""
    if not html:
        return ""
    page = Page(html)
    good, links = Paths(page.nodes).chosen(threshold)
    over = set(good)
    for sequence, *rest in good:
        while sequence and (page.above[sequence], *rest) not in over:
            sequence = page.above[sequence]
            over.add((sequence, *rest))
    homes = {page.home(n[4]) for n in page.nodes if not n[2] and n[1] in good and not n[1][1] and "".join(n[5]).strip()}
    held = [False] * len(page.kind)
    for e in range(1, len(held)):
        # Divisions of the body stand by themselves.
        held[e] = e in homes or held[page.parent[e]] and (page.kind[page.parent[e]] not in ("body", "html") or page.kind[e] in TEXTUAL)
    held[0] = 0 in homes

    blocks: list[list[str]] = []
    last = None
    for block, path, never, _, element, pieces in page.nodes:
        heading = page.name[path[0]] in HEADINGS and (page.above[path[0]], *path[1:]) in over
        if never or not (path in good or heading or held[element] and not path[1] and path not in links):
            continue
        if block == last:
            blocks[-1] += pieces
        else:
            blocks.append(list(pieces))
            last = block
    done = (SPACE.sub(" ", unescape("".join(b))).strip() for b in blocks)
    return "\n\n".join(b for b in done if b)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.5) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, threshold) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=EXTRACTED)

    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
