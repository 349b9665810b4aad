"""Main text of web pages by tree scoring.

A page is read into a tree with the usual repairs of broken markup. Each paragraph has
points for its length and commas and passes them to the blocks around it, in full to the
nearest, half to the next, less to those further out; a block's points are discounted by
the share of its text that is links. The best block is the article, together with the
siblings that look like parts of it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wattspindle.llm.common import MB, extended, slices, without

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attributes>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<loose>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_COMMAS = ",،、，;；"

#: Elements that never hold article text.
DROPPED = set(
    "script style noscript template iframe object embed svg canvas button input select label legend"
    " textarea option nav footer aside head menu dialog audio video map datalist title".split()
)
#: Elements whose content is text up to their end tag.
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol"
    " p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Start tags that end an open paragraph, and elements beyond which they do not look.
ENDS_PARAGRAPH = BLOCKS - {"body", "caption", "dd", "dt", "html", "legend", "li", "tbody", "tfoot", "thead", "tr"}
SCOPE = {"table", "td", "th", "caption", "button", "object", "template", "html"}
#: Start tags that end an open element of the given kinds, within the given parents.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Words in class, id or role of what stands around an article.
AROUND = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices popup modal"
    " overlay newsletter subscribe subscription signup promo promotion sponsor sponsored share sharing"
    " social related recommended recommendations comment comments commentlist disqus respond reply replies"
    " widget toolbar pagination pager tags copyright search login alert toast paywall contentinfo"
    " complementary dialog toc skip".split()
)
#: Words before one of them that make it a statement about the block instead.
SAYS = {"has", "no", "with", "without", "is", "show", "hide", "open"}
ARTICLE = {"article", "content", "main", "post", "entry", "story", "text", "body"}
ANCHORED = {"html", "body", "main", "article"}
#: Elements of running text: a name says something about them only if it is the whole name.
RUNNING = {"p", "li", "dt", "dd", "td", "th", "blockquote", "pre", "span", "em", "strong", "b", "i", "a"} | HEADINGS
#: Length from which a block counts as a paragraph.
PARAGRAPH = 25


def _words(name: str) -> list[str]:
    return [w.lower() for w in _NAME.findall(name)]


def _around(attributes: dict[str, str], running: bool) -> bool:
    for key in ("class", "id", "role"):
        for name in attributes.get(key, "").split():
            words = _words(name)
            if running and len(words) > 1:
                continue
            for i, word in enumerate(words):
                if word in AROUND and not (i and words[i - 1] in SAYS):
                    return True
    return False


class _Page:
    """Elements in page order as parallel lists, and text pieces between block breaks."""

    def __init__(self, source: str):
        self.tags, self.parents = ["#page"], [-1]
        #: Dropped for good; and set apart by its name, unless it holds most of the text.
        self.dropped, self.around, self.positive = [False], [False], [False]
        #: (element, text, in a link); None marks the edge of a block.
        self.pieces: list[tuple[int, str, bool] | None] = []
        self.stack = [0]
        self.open: dict[str, int] = {}
        self._read(source)

    def _push(self, tag: str, attributes: str) -> None:
        pairs = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
        parent = self.stack[-1]
        hidden = tag in DROPPED or (
            bool(attributes)
            and (
                pairs.get("aria-hidden", "").lower() == "true"
                or "hidden" in pairs
                or "display:none" in pairs.get("style", "").replace(" ", "").lower()
            )
        )
        around = tag in ("header", "form") or (bool(pairs) and tag not in ANCHORED and _around(pairs, tag in RUNNING))
        names = pairs.get("class", "") + " " + pairs.get("id", "") if pairs else ""
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(self.dropped[parent] or hidden)
        self.around.append(around)
        self.positive.append(tag in ("article", "main") or bool(ARTICLE.intersection(_words(names))))
        self.stack.append(len(self.tags) - 1)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, depth: int) -> None:
        for at in self.stack[depth:]:
            self.open[self.tags[at]] -= 1
        del self.stack[depth:]

    def _end_open(self, kinds: set[str], scope: set[str]) -> None:
        if not any(self.open.get(k) for k in kinds):
            return
        found = None
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[depth]]
            if tag in kinds:
                found = depth
            elif tag in scope:
                break
        if found is not None:
            self._pop_to(found)

    def _read(self, source: str) -> None:
        at, end, pieces = 0, len(source), self.pieces
        while at < end:
            token = _TOKEN.match(source, at)
            at = token.end()
            text = token["text"]
            if text is not None:
                if not self.dropped[self.stack[-1]]:
                    pieces.append((self.stack[-1], html.unescape(text), self.open.get("a", 0) > 0))
                continue
            tag = token["open"] or token["loose"]
            if tag:
                tag = tag.lower()
                attributes = token["attributes"] or token["rest"] or ""
                if tag in ENDS_PARAGRAPH:
                    self._end_open({"p"}, SCOPE)
                elif tag in ENDS:
                    self._end_open(*ENDS[tag])
                if tag in BLOCKS:
                    pieces.append(None)
                elif tag in ("br", "td", "th"):
                    pieces.append((self.stack[-1], "\n" if tag == "br" else " ", False))
                if tag in VOID:
                    continue
                self._push(tag, attributes)
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
                    done = close.search(source, at)
                    at = done.end() if done else end
                    self._pop_to(len(self.stack) - 1)
            elif token["close"]:
                tag = token["close"].lower()
                if tag in BLOCKS:
                    pieces.append(None)
                if self.open.get(tag):
                    depth = len(self.stack) - 1
                    while self.tags[self.stack[depth]] != tag:
                        depth -= 1
                    self._pop_to(depth)

    def blocks(self) -> list[tuple[int, list[tuple[int, str, bool]]]]:
        """(element, pieces) of each run of text between block edges or double line breaks."""
        result, own = [], []
        for piece in [*self.pieces, None]:
            if piece is not None and piece[1] == "\n" and own and own[-1][1] == "\n":
                own.pop()
                piece = None
            if piece is not None:
                own.append(piece)
                continue
            if any(p[1].strip() for p in own):
                first = next(p for p in own if p[1].strip())
                result.append((self._block_of(first[0]), own))
            own = []
        return result

    def _block_of(self, at: int) -> int:
        while self.tags[at] not in BLOCKS and self.parents[at] >= 0:
            at = self.parents[at]
        return at


def extract(source: str | None) -> str:
    """The article's blocks, one a line; empty if there is no text."""
    page = _Page(source or "")
    n = len(page.tags)
    tags, parents = page.tags, page.parents
    blocks = page.blocks()
    length, linked, prose = [0] * n, [0] * n, [0] * n
    lengths = []
    for block, pieces in blocks:
        total = 0
        for at, text, link in pieces:
            size = len(text.strip())
            length[at] += size
            linked[at] += size * link
            total += size
        lengths.append(total)
        prose[block] += total * (total >= PARAGRAPH)
    for at in range(n - 1, 0, -1):
        length[parents[at]] += length[at]
        linked[parents[at]] += linked[at]
        prose[parents[at]] += prose[at]
    # Menus by name and forms go, unless they hold most of a page that names no article or
    # hold the article itself; so do lists of links outside of an article.
    gone = list(page.dropped)
    links, articles, inside = [0] * n, [0] * n, [False] * n
    for at in range(1, n):
        inside[at] = inside[parents[at]] or tags[at] == "article"
        links[parents[at]] += tags[at] == "a"
        articles[at] += tags[at] in ("article", "main") and length[at] > 0
    for at in range(n - 1, 0, -1):
        links[parents[at]] += links[at]
        articles[parents[at]] += articles[at]
    for at in range(1, n):
        if page.around[at] and (2 * length[at] <= length[0] or articles[0] and not articles[at]):
            gone[at] = True
        elif tags[at] == "form" and not articles[at] and 2 * prose[at] <= prose[0]:
            gone[at] = True
        elif tags[at] in ("ul", "ol", "dl", "table", "div", "section") and links[at] >= 3 and not inside[at]:
            gone[at] |= linked[at] > 0.6 * length[at]
        gone[at] |= gone[parents[at]]
    points = [0.0] * n
    for (at, pieces), size in zip(blocks, lengths, strict=True):
        if size < PARAGRAPH or gone[at] or tags[at] in HEADINGS:
            continue
        commas = sum(text.count(c) for _, text, _ in pieces for c in _COMMAS)
        value = 1 + commas + min(size // 100, 3)
        up, share = (parents[at] if tags[at] in ("p", "pre", "blockquote", "li", "td") else at), 1.0
        for level in range(1, 6):
            if up < 0:
                break
            points[up] += value * share
            share = 1 / 2 if level == 1 else 1 / (3 * level)
            up = parents[up]
    for at in range(n):
        if points[at]:
            points[at] *= 1 - linked[at] / max(length[at], 1)
            points[at] *= 1.5 if page.positive[at] else 1.0
    best = max(range(n), key=lambda i: (points[i], -i))
    if not points[best]:
        named = [i for i in range(n) if tags[i] in ("article", "main") and length[i] and not gone[i]]
        best = named[0] if named else 0
    # What stands in the same article belongs to it, wrapped or not.
    up = best
    while up > 0 and tags[up] != "article":
        up = parents[up]
    best = up if up > 0 else best
    roots = {best}
    if tags[best] not in ("#page", "html", "body"):
        named = page.positive[parents[best]] and tags[parents[best]] != "body"
        heads = {parents[at] for at in range(1, n) if tags[at] in ("h1", "h2")}
        for at in range(1, n):
            if parents[at] == parents[best] and at != best and not gone[at]:
                dense = linked[at] / max(length[at], 1)
                similar = points[at] >= max(10.0, 0.2 * points[best])
                long = tags[at] == "p" and length[at] >= 80 and dense < 0.25
                titled = (tags[at] in ("h1", "h2") or at in heads) and at < best and tags[parents[at]] != "body"
                part = named and 0 < length[at] and dense < 0.5
                if similar or long or titled or part:
                    roots.add(at)
    kept = [False] * n
    for at in range(n):
        kept[at] = not gone[at] and (at in roots or (at > 0 and kept[parents[at]]))
    # The heading in an article's own header belongs to it.
    for at in range(1, n):
        if tags[at] in ("h1", "h2") and gone[at] and not page.dropped[at]:
            up = parents[at]
            while up > 0 and tags[up] != "header":
                up = parents[up]
            if up > 0 and kept[parents[up]]:
                kept[at] = True
    for at in range(1, n):
        if kept[parents[at]] and not page.dropped[at] and tags[parents[at]] in ("h1", "h2"):
            kept[at] = True
    lines = []
    for _, pieces in blocks:
        line = " ".join("".join(text for at, text, _ in pieces if kept[at]).split())
        if line:
            lines.append(line)
    return "\n".join(lines)


def main_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """Pages with ``text`` and ``n_chars`` in place of ``source``.

    The whole page counts. A null or empty page, and one without text, gives an empty
    text. Broken, cut off or deeply nested markup is read as far as it goes. Columns
    named like a result are replaced; every row gives one row.
    """
    kept = without(pages, *{"text", "n_chars"} - {source})
    names = [c for c in kept.columns if c != source]
    schema = extended(kept.select(*[f"`{c}`" for c in names]), "text string, n_chars long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, source, 4 * MB):
            texts = [extract(s) for s in batch.column(source).to_pylist()]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return kept.mapInArrow(run, schema)
