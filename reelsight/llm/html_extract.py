"""Main text of web pages by line-block distribution.

The markup is stripped into lines, one for each block element, in page order.
A line's weight is its characters outside links; lines of menus, headers,
footers, sidebars, notices, adverts, forms, reader comments, scripts and
styles keep their place with weight 0.  Sums of the weights over a sliding
window of lines form the distribution: text surges where the sum rises above
a threshold (a share of the largest sum) and dives where it falls to it again.
The span with the greatest weight holds the main text.

Where the densest line of this span stands in an element that marks an article
(article, main, or a block named as content), the span is widened or cut
to that element and its siblings with the same name, so that short first and last paragraphs are neither lost nor
joined by neighbours.  In pages without such marks the lowest block around
the densest line that holds nine tenths of the span's weight takes that place;
if only the body does, the surge and dive points themselves decide, and a
heading right before the surge belongs to the text.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p "
    "pre search section select summary table tbody td tfoot th thead tr ul video audio object canvas".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never main text.
DROP = frozenset("nav footer aside form script style select button dialog menu head noscript template iframe "
                 "textarea title svg math object canvas video audio map datalist search".split())
#: Elements that end an open paragraph.
CLOSES_P = BLOCK - {"option", "optgroup", "html", "body", "head"}
#: Words in class, id or role that name something other than the text; an
#: element goes if one of its names does so and none names the text.
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager "
    "sidebar side aside widget widgets rail related recommended recommendations trending popular "
    "footer colophon masthead topbar toolbar siteheader pageheader "
    "comment comments reply replies respond disqus discussion reactions "
    "cookie cookies consent gdpr notice notices alert popup modal overlay subscribe newsletter signup login paywall "
    "share sharing social toc search form contentinfo complementary dialog".split())
#: Words in class, id, role or itemprop that name the text.
KEEP_NAMES = frozenset("article articlebody main maincontent content post postbody entry story body".split())
#: Names that win over those of the text: adverts and readers' comments.
STRONG_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo "
                         "comment comments reply replies respond disqus".split())
#: Names of readers' comments, which are articles in some pages.
COMMENT_NAMES = frozenset("comment comments reply".split())
#: Words before what an element has or lacks, and last words that tell a state.
NOT_IT = frozenset("no not non has have with without hide".split())
STATES = frozenset("open opened closed enabled disabled on off allowed available".split())

TOKEN = re.compile(
    r"<!--(?:.*?)(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value after = only; elsewhere it is an ordinary character
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)*+)>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
WORD = re.compile(r"[a-z]+")


class _Node:
    """An open element: what its text counts as."""

    __slots__ = ("tag", "dropped", "named", "article", "up", "link", "marks", "gone", "heading", "depth")

    def __init__(self, tag, up, dropped=False, article=0, link=False, named=False):
        self.tag, self.up, self.dropped, self.article, self.link, self.named = tag, up, dropped, article, link, named
        self.marks = None  # numbers of the marked blocks in it, by mark
        self.depth = 0 if up is None else up.depth + 1
        self.heading = tag in HEADING or up is not None and up.heading
        self.inherit()

    def inherit(self):
        """Whether it or an element around it is dropped."""
        self.gone = self.dropped or self.up is not None and self.up.gone


def _names(attrs: str) -> tuple[frozenset[str], bool, bool, bool]:
    """Of class, id, role and itemprop: the names of the text, whether one
    names something else, whether one names a reader's comment; and whether
    the element is hidden.

    Each name is taken as a whole: 'article-footer' is a footer, not text.
    What follows no-, has-, with- and the like tells what the element is not,
    and names such as comments-open tell a state; neither drops anything.  A
    name of an advert or of readers' comments takes away the names of the text."""
    text, other, comment, hidden, strong = set(), False, False, False, False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            hidden = True
        elif name in ("class", "id", "role", "itemprop"):
            for part in value.split():
                words = WORD.findall(part)
                words = words[:next((i for i, w in enumerate(words) if w in NOT_IT), len(words))]
                if len(words) > 1 and words[-1] in STATES:
                    continue
                names = {*words, "".join(words)}
                if names & DROP_NAMES:
                    other = True
                    strong = strong or bool(names & STRONG_NAMES)
                    comment = comment or bool(names & COMMENT_NAMES)
                elif names & KEEP_NAMES:
                    text.add("-".join(words))
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return frozenset() if strong else frozenset(text), other, comment, hidden


def lines(page: str) -> list[tuple[str, int, object, bool]]:
    """(text, weight, innermost open element, is a heading) of every
    non-empty line of the page, boilerplate with weight -1."""
    out, buf = [], []
    linked = 0
    root = node = _Node("", None)
    article_no = 0
    pos, n = 0, len(page)
    block_owner = root

    def text(s):
        nonlocal linked, block_owner
        if not s or node.tag in RAW:
            return
        s = _html.unescape(s) if "&" in s else s
        if not buf:
            block_owner = node
        buf.append(s)
        if node.link:
            linked += len("".join(s.split()))

    def flush():
        nonlocal linked
        if buf:
            t = " ".join("".join(buf).split())
            if t:
                weight = -1 if block_owner.gone else max(0, len(t.replace(" ", "")) - linked)
                out.append((t, weight, block_owner, block_owner.heading))
            buf.clear()
        linked = 0

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            text(page[pos:])
            break
        m = TOKEN.match(page, lt)
        if m is None:
            nxt = page[lt + 1:lt + 3]
            if nxt[:1].isascii() and (nxt[:1].isalpha() or nxt[:1] == "/" and nxt[1:].isalpha()):
                m = LOOSE.match(page, lt)
                if m is not None and m[4] == "":  # the page ends inside a tag
                    text(page[pos:lt])
                    break
            if m is None:
                text(page[pos:lt + 1])
                pos = lt + 1
                continue
        text(page[pos:lt])
        pos = m.end()
        if not m[2]:
            continue
        tag, closing, attrs = m[2].lower(), bool(m[1]), m[3] or ""
        if closing:
            at = node
            while at is not root and at.tag != tag:
                # an inline or paragraph end tag does not reach out of its container
                if tag not in BLOCK and at.tag in BLOCK or tag == "p" and at.tag != "p" and at.tag in BLOCK:
                    at = root
                    break
                at = at.up
            if tag in BLOCK:
                flush()
            if at is not root:
                node = at.up
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:  # an open paragraph ends, with what is open in it
                at = node
                while at is not root and (at.tag not in BLOCK or at.tag == "p"):
                    if at.tag == "p":
                        node = at.up
                        break
                    at = at.up
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}[tag]
                at = node
                while at is not root and at.tag not in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select"):
                    if at.tag in same:
                        node = at.up
                        if tag != "tr":
                            break
                    at = at.up
        if tag in VOID or attrs.rstrip().endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        names, other, comment, hidden = _names(attrs) if attrs.strip() else (frozenset(), False, False, False)
        inside = node.article
        other = other and not names
        named = other and not hidden and tag in ("div", "section", "td")
        dropped = tag in DROP or hidden or other and (comment and tag == "article" or tag not in ("html", "body", "article", "main"))
        if tag == "header" and not inside:
            dropped = True
        article = inside
        if not dropped and not inside:
            if tag in ("article", "main"):
                article_no += 1
                article = article_no
            elif names and tag in ("div", "section", "td"):  # siblings with one mark are one text
                node.marks = node.marks or {}
                if names not in node.marks:
                    article_no += 1
                    node.marks[names] = article_no
                article = node.marks[names]
        node = _Node(tag, node, dropped, article, tag == "a" or node.link, named)
        if tag in ("article", "main") and node.up.gone and not dropped:
            # an article inside a form that wraps the page, in a menu left open, or in a block with an odd name
            way, at = [node], node.up
            while at is not root:
                if at.dropped and (at.tag in ("form", "nav", "header") or at.named):
                    at.dropped = False
                way.append(at)
                at = at.up
            for at in reversed(way):
                at.inherit()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
            node = node.up
            if end is None:
                break  # the rest of the page is its content
            pos = end.end()
    flush()
    return out


def surges(weights: list[int], window: int = 3, share: float = 0.15) -> list[tuple[int, int]]:
    """[start, end) of each span of lines between a surge and the next dive.

    The sum of each window of lines is put down to its first line.  A surge
    is where the sums rise above ``share`` of the largest one, moved to the
    first weighty line of that window; a dive where they fall to it."""
    n = len(weights)
    w = [max(0, x) for x in weights]
    sums = [sum(w[i:i + window]) for i in range(n)]
    limit = share * max(sums, default=0)
    spans, start = [], None
    for i in range(n):
        if start is None and sums[i] > limit:
            start = i
            while start < i + window - 1 and start < n - 1 and w[start] * window <= limit:
                start += 1
        elif start is not None and i > start and sums[i] <= limit:
            spans.append((start, i))
            start = None
    if start is not None:
        spans.append((start, n))
    return spans


def _block_of(got: list, lo: int, hi: int, peak: int, share: float = 0.9) -> list[int]:
    """The lines of the lowest element around the densest line that holds
    ``share`` of the span's weight; none if only the body does."""
    whole = sum(max(0, x[1]) for x in got[lo:hi])
    nodes: dict[int, _Node] = {}  # all elements around lines, each met once
    for _, _, at, _ in got:
        while at is not None and id(at) not in nodes:
            nodes[id(at)] = at
            at = at.up
    inner_first = sorted(nodes.values(), key=lambda x: -x.depth)
    held = dict.fromkeys(nodes, 0)
    for _, w, at, _ in got[lo:hi]:
        held[id(at)] += max(0, w)
    for x in inner_first:
        if x.up is not None:
            held[id(x.up)] += held[id(x)]
    block = got[peak][2]
    while block is not None and (block.tag not in BLOCK or block.tag in ("p", "li", "td", "tr", *HEADING)
                                 or held[id(block)] < share * whole):
        block = block.up
    if block is None or block.tag in ("body", "html", ""):
        return []
    inside: dict[int, bool] = {}
    for x in reversed(inner_first):
        inside[id(x)] = x is block or x.up is not None and inside[id(x.up)]
    return [i for i, (_, _, at, _) in enumerate(got) if inside[id(at)]]


def main_text(page: str, window: int = 3, share: float = 0.15) -> str:
    """The main text of one page: its blocks joined by newlines."""
    got = lines(page)
    weights = [x[1] for x in got]
    spans = surges(weights, window, share)
    if not spans:  # nothing but links: take a marked article's lines
        spans = [(0, len(got))]
    lo, hi = max(spans, key=lambda s: (sum(x for x in weights[s[0]:s[1]] if x > 0), -s[0]), default=(0, 0))
    if lo == hi:
        return ""
    peak = max(range(lo, hi), key=lambda i: (weights[i], -i))
    article = got[peak][2].article
    if not article:
        marked = [x[2].article for x in got if x[1] >= 0 and x[2].article]
        if marked and all(x <= 0 for x in weights[lo:hi]):
            article = marked[0]
    if article:
        return "\n".join(t for t, wt, node, _ in got if wt >= 0 and node.article == article)
    inside = _block_of(got, lo, hi, peak)
    if inside:
        texts = [i for i in inside if weights[i] > 0]
        return "\n".join(got[i][0] for i in inside if weights[i] >= 0 and texts[0] <= i <= texts[-1])
    if lo and got[lo - 1][3] and weights[lo - 1] >= 0:
        lo -= 1
    return "\n".join(t for t, wt, *_ in got[lo:hi] if wt >= 0)


def extract(pages: DataFrame, html: str = "html", window: int = 3, share: float = 0.15) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    A null or empty page, or one without main text, gives an empty text and
    0.  Repeated rows stay; a null id or url is passed on; an empty table
    gives no rows; other columns are not read."""
    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            got = [main_text(x, window, share) if x else "" for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col(html).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
