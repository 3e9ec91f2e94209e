"""Main text of web pages by composite text density.

For every DOM node of the page: C characters and T tags below it, LC characters and LT tags of
links. Its composite density is C/T scaled by a logarithm of how rare links are,
``log(C/LC * T/LT) / log(log-base)``, where the base grows with the share of links in the node and in the
body, so link-heavy nodes sink. A block's density sum is the sum over its child blocks (inline markup counts
as tags only). The block with the largest density sum fixes a threshold, the least density on its
path from the body; of every block that reaches it, the subtree with the largest sum is main text
(if the first lies in an article or main element, only blocks in such elements are asked).

Nodes that are boilerplate by their element or by their class or id (menus, footers, sidebars,
adverts, forms, comments, ...) are cut before densities are computed, but an element that is so only
by its names, or a form, stays if it holds the page's article or most of its text. Tolerates unclosed and
misnested markup. One page at a time, flat arrays, no recursion; a map over the pages.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import slices

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_CUT = frozenset("head script style noscript template nav aside footer button select option input textarea iframe object "
                 "svg canvas dialog menu title".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
#: Start tags that close an open paragraph; list items, cells and rows close their own kind.
_CLOSES_P = _BLOCK - {"body", "html", "tbody", "tfoot", "thead", "tr"}
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
#: Words of a class, id or role that mark boilerplate.
_HINT = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|"
                   r"notice|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
                   r"recommended|recommendations|sidebar|side-bar|widget|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|"
                   r"footer|masthead|topbar|comments?|commentlist|disqus|respond|replies|reader-comments|contentinfo|"
                   r"complementary|search|toolbar|skip-link)(?:$|[\s_-])", re.I)
#: Names that say how a page is laid out, not what the element is.
_LAYOUT = re.compile(r"(?<!\S)(?:(?:has|no|not|with|without|hide|show)[_-]\S*|content[_-]sidebar\S*|\S*[_-](?:open|opened|closed|enabled|"
                     r"disabled|active|inactive|hidden|visible|collapsed|expanded|allowed))(?!\S)", re.I)
#: Words of elements that may well be longer than the article.
_LONG = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|related|recommended|"
                   r"recommendations)(?:$|[\s_-])", re.I)
_HEADERS = frozenset(("header", "site-header", "page-header", "global-header"))
_CONTENT = frozenset(("article", "main", "body", "html"))


class _Dom:
    """Nodes in page order: parent, tag, and text runs (node, text) between them."""

    def __init__(self, page: str):
        self.parent, self.tag, self.cut = [-1], ["html"], [False]
        self.hint = [0]  # 1: boilerplate by its names, 2: of a kind that may be long, 3: a form
        self.runs: list[tuple[int, str]] = []
        self.within = [False]  # in an article or main element, or one itself
        self.open: dict[str, int] = {}  # elements on the stack by name: an end tag without one costs nothing
        stack = [0]
        at = 0
        find = _TOKEN.search
        while True:
            m = find(page, at)
            if m is None:
                self._text(stack[-1], page[at:])
                break
            if m.start() > at:
                self._text(stack[-1], page[at:m.start()])
            at = m.end()
            end, start = m[1], m[2] or m[4]
            if end is not None:
                self._close(stack, end.lower())
            elif start is not None:
                tag, attributes = start.lower(), m[3] or m[5] or ""
                if tag == "html" or tag == "body" and "body" in self.tag:
                    continue
                self._open(stack, tag, attributes)
                if tag in _RAW and stack[-1] == len(self.tag) - 1:  # everything up to the end tag is its content
                    stop = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(page, at)
                    at = stop.start() if stop else len(page)

    def _text(self, node: int, text: str) -> None:
        if text and not self.cut[node]:
            self.runs.append((node, text))

    def _open(self, stack, tag, attributes):
        if tag in _CLOSES_P:
            self._close_in_scope(stack, {"p"}, {"article", "section", "div", "td", "th", "table", "body", "li", "button", "object"})
        if tag in _CLOSES:
            self._close_in_scope(stack, *_CLOSES[tag])
        above = stack[-1]
        node = len(self.tag)
        self.parent.append(above)
        self.tag.append(tag)
        cut = self.cut[above] or tag in _CUT
        if not cut and tag == "header":
            cut = not self.within[above]  # the page's header, not an article's
        hint = 3 if tag == "form" else 0
        if not cut and attributes:
            names = [_LAYOUT.sub(" ", x[1] or x[2] or x[3] or "") for x in _NAMES.findall(attributes)]
            if any(_HINT.search(x) or not _HEADERS.isdisjoint(x.lower().split()) for x in names):
                hint = 2 if any(map(_LONG.search, names)) else 1
        self.cut.append(cut)
        self.within.append(self.within[above] or tag in ("article", "main"))
        self.hint.append(hint)
        if tag == "br":
            self._text(above, " ")
        if tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
        elif tag in _BLOCK and not cut:
            self.runs.append((node, ""))

    def _cut_stack(self, stack, i):
        for node in stack[i:]:
            self.open[self.tag[node]] -= 1
        del stack[i:]

    def _close(self, stack, tag):
        if not self.open.get(tag):
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == tag:
                self._cut_stack(stack, i)
                return

    def _close_in_scope(self, stack, kinds, walls):
        if not any(map(self.open.get, kinds)):
            return
        for i in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[i]]
            if t in kinds:
                self._cut_stack(stack, i)
                if "p" in kinds:
                    return
            elif t in walls:
                return


def _cut_hinted(dom: _Dom, own: list[int]) -> None:
    """Cut hinted elements unless they hold the page's article (of the article and main elements without a
    hint the one with most text outside hinted elements) or more than half of the page's text (if
    names mark them, not beside an article; kinds that may be long: if no text stands outside hinted elements). ``own``: characters of each node
    that are not in links."""
    n = len(dom.tag)
    if not any(dom.hint):
        return
    parent, tag, hint, cut = dom.parent, dom.tag, dom.hint, dom.cut
    chars, article, home, bare = [0] * n, [0] * n, [0] * n, [True] * n
    for i in range(n):
        if i:
            bare[i] = bare[parent[i]] and (not hint[i] or tag[i] in _CONTENT)
            home[i] = home[parent[i]]
        if tag[i] in ("article", "main") and not hint[i]:
            home[i] = home[i] or i
        elif hint[i] and tag[i] not in _CONTENT:
            home[i] = 0
        if not cut[i]:
            chars[i] = own[i]
            article[home[i]] += own[i]
    outside = sum(c for c, b in zip(chars, bare) if b)
    for i in range(n - 1, 0, -1):
        if not cut[i]:
            chars[parent[i]] += chars[i]
    stays, inside = set(), [False] * n
    up = max(range(1, n), key=lambda i: article[i])
    named = article[up] > 0
    if named:
        inside[up] = True
        while up > 0:
            stays.add(up)
            up = parent[up]
    for i in range(1, n):
        inside[i] = inside[i] or inside[parent[i]]
        if hint[i] and tag[i] not in _CONTENT and not cut[i] and i not in stays:
            cut[i] = 2 * chars[i] <= chars[0] or (hint[i] == 2 and outside > 0) or (hint[i] < 3 and named and not inside[i])
        cut[i] = cut[i] or cut[parent[i]]


def _densities(chars, tags, link_chars, link_tags):
    """Composite density of every node from the counts below it; the body's counts are node 0's."""
    body_share = link_chars[0] / max(chars[0], 1)
    out = []
    for c, t, lc, lt in zip(chars, tags, link_chars, link_tags):
        if c == 0:
            out.append(0.0)
            continue
        t, lc1, lt1 = max(t, 1), max(lc, 1), max(lt, 1)
        base = math.log(c / max(c - lc, 1) * lc + body_share * c + math.e)
        scale = math.log(max(c / lc1 * t / lt1, 1.0)) / math.log(max(base, 1.0001))
        out.append(c / t * scale)
    return out


def main_text(page: str | None) -> str:
    """Blocks of the main text in page order, joined by two line feeds; empty if there is none."""
    if not page:
        return ""
    dom = _Dom(page)
    n = len(dom.tag)
    parent, tag = dom.parent, dom.tag
    texts = [(node, html.unescape(raw)) for node, raw in dom.runs]
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in texts:
        chars[node] += len(" ".join(text.split()))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or tag[i] == "a"
    _cut_hinted(dom, [0 if linked else c for c, linked in zip(chars, in_link)])
    for i in range(1, n):
        if in_link[i]:
            link_chars[i] = chars[i]
            link_tags[i] = 1
    for i in range(n - 1, 0, -1):
        if dom.cut[i]:
            continue
        p = parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i]
    density = _densities(chars, tags, link_chars, link_tags)
    is_block = [i == 0 or tag[i] in _BLOCK for i in range(n)]
    home, total = [0] * n, [0.0] * n  # nearest block above, density sums
    for i in range(1, n):
        home[i] = parent[i] if is_block[parent[i]] else home[parent[i]]
        if is_block[i] and not dom.cut[i]:
            total[home[i]] += density[i]
    strongest = list(range(n))  # of each block's subtree, the block with the largest sum
    for i in range(n - 1, 0, -1):
        if is_block[i] and not dom.cut[i]:
            a, b = strongest[i], strongest[home[i]]
            if (total[a], chars[a], -a) > (total[b], chars[b], -b):
                strongest[home[i]] = a
    best = strongest[0]
    homes = [i for i in range(n) if tag[i] in ("article", "main") and chars[i] and not dom.cut[i]]
    if homes:  # the page names its article: text beside the one that holds most of the best block is not of it
        largest = max(homes, key=lambda i: chars[i])
        up = largest
        while up > best:
            up = parent[up]
        if up == best and 2 * chars[largest] >= chars[best]:
            best = largest
    threshold, up, named = density[best], best, False
    while up > 0:
        named = named or tag[up] in ("article", "main")
        up = parent[up]
        threshold = min(threshold, density[up])
    asked = [False] * n
    for i in range(n):
        asked[i] = not named or tag[i] in ("article", "main") or (i > 0 and asked[parent[i]])
    chosen = {best} | {strongest[i] for i in range(n) if asked[i] and is_block[i] and not dom.cut[i]
                       and chars[i] and density[i] >= threshold}
    inside = [False] * n
    block = [0] * n
    for i in range(n):
        inside[i] = i in chosen or (i > 0 and inside[parent[i]])
        block[i] = i if is_block[i] else block[parent[i]]
    blocks, held, current = [], [], None
    for node, text in texts:
        if not inside[node] or dom.cut[node]:
            continue
        if block[node] != current:
            blocks.append("".join(held))
            held, current = [], block[node]
        held.append(text if tag[node] not in ("td", "th") else f" {text} ")
    blocks.append("".join(held))
    return "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: one row per input row.

    Null or empty html, and pages without text outside boilerplate, give the empty text. Repeated
    rows give repeated rows; other columns are not read; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                text = pa.array([main_text(h) for h in part.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], names=["page_id", "url", "text"])

    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [src.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return src.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
