"""Main text of web pages by minimum-cut labelling.

A page is read into blocks, the runs of text between block-level tags, each with
the elements that hold it. A linear classifier turns tags, class names, links
and length into a score; its sign says content or boilerplate, its size is the
capacity of the edge to that terminal. A name of boilerplate is one cost among
others: it is weighed against names of content, and falls with the share of the
page's unlinked sentences that the named element holds. So does the cost of a form,
which on some sites holds the whole page. Smoothness edges join neighbours in page
order and blocks with near ancestors in the document tree. The minimum cut
between the terminals labels all blocks at once, so that a short line between
paragraphs stays and a long text in a menu goes.

The cut is exact: blocks whose score exceeds all their edges are decided and
folded into their neighbours first, and blocking flows on levels solve what is left.
Reading takes time in proportion to the page, however deep its elements lie.

Pages are independent, so a task holds one page at a time and nothing is
shuffled. Cases: a null or empty page has an empty text, as has one without
content. Tags that are never closed, stray ends, truncated pages and broken
character references are read as browsers do, approximately. Repeated rows get
equal answers; other columns are kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.llm.registry import query, table

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|itemprop)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
UNSEEN = {"script", "style", "noscript", "template", "title", "textarea", "svg", "math", "iframe", "object", "canvas", "audio", "video", "xmp", "noembed", "noframes"}
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = {"hr", "br", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
P_SCOPE = {"button", "td", "th", "table"}
ENDS_P = BLOCKS - {"button", "label", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary", "head", "html", "body", "select"}
# a start tag closes an open element of these names, up to the scope in the second set
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
OUTSIDE_TAGS = {"nav", "aside", "footer", "menu", "button", "select", "option", "label", "dialog", "search", "dir"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "status", "menu", "menubar", "toolbar", "tablist", "note"}
FORMS = {"form", "fieldset"}  # tags, and a role, that cost as much unless they hold the page's sentences
OUTSIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos promotion banner banners sidebar sidebars rail aside widget widgets nav"
    " navbar navigation menu menus submenu footer foot header masthead topbar breadcrumb breadcrumbs crumbs pagination pager toolbar comment comments reply"
    " replies respond disqus discussion reactions feedback cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay"
    " lightbox warning announcement newsletter subscribe subscription signup signin login register share sharing shares social follow related recommended recommendations more"
    " popular trending teaser teasers outbrain taboola tags tagcloud legal copyright disclaimer skip hidden print form search searchbox paywall".split()
)
# names of several words in one, like "commentlist" or "rightsidebar"
OUTSIDE_PARTS = re.compile("comment|sidebar|footer|navbar|navig|menu|advert|cookie|newsletter|breadcrumb|sponsor|masthead|disqus|popup|subscri|notification")
INSIDE_NAMES = set("article content post entry story main body text articlebody maincontent".split())
# what a name says of its neighbours, not of itself: "has-sidebar", "post-with-comments", "withSidebar"
BESIDE = re.compile(r"(?:(?<![a-z])(?:has|with|without|no)(?=[-_A-Z]|sidebar|comment|menu|footer|nav|header|banner)|(?<=[a-z])(?:Has|With|Without|No)(?=[A-Z]))[\w-]*")
HEADS = {"header", "head"}

# weights of the classifier
IN_ARTICLE, NOT_IN_ARTICLE, OUTSIDE = 3.0, -3.0, -14.0
# a name of boilerplate; one compounded with a name of content, like "post-comments"; one beside a name of content, like "content sidebar"
NAMED, COMPOUND, BESIDES = -9.0, -6.0, -3.0
APART = -4.5  # names from here on part zones
# share of the page's paragraphs in an element from which, and at which, its name costs less, and nothing; with a title in it
MASS, TITLED_MASS = (0.5, 0.9), (0.3, 0.7)
PARAGRAPH, HEADING, TITLE, ITEM = 1.0, 0.5, 2.0, -0.3
LINKED, LENGTH, SHORT, SENTENCE, RIGHTS = -4.0, 2.0, -0.5, 0.5, -3.0
LONG_TEXT, SHORT_TEXT = 200, 20  # characters
# capacities of the smoothness edges
NEXT, SIBLING, ACROSS = 1.0, 1.5, 0.1


class Element:
    __slots__ = ("tag", "parent", "depth", "outside", "named", "inside", "holds", "within", "open_p")

    def __init__(self, tag: str, parent: Element | None, outside: bool, named: float, inside: bool) -> None:
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.outside, self.named, self.inside = outside, named, inside
        self.holds = False  # an article or main element
        self.within = inside or (parent is not None and parent.within)
        # the open paragraph that a block ends
        self.open_p = self if tag == "p" else None if parent is None or tag in P_SCOPE else parent.open_p


class Block(NamedTuple):
    text: str
    linked: int
    element: Element


def in_article(e: Element | None) -> bool:
    return e is not None and e.within


def name_cost(value: str, parent: Element | None) -> tuple[float, bool]:
    """What the words of a class or id cost, and whether one names content."""
    cost, inside = 0.0, False
    for token in BESIDE.sub(" ", value).split():
        names = {x.lower() for x in NAME.findall(token)}
        content = bool(names & INSIDE_NAMES)
        if names & OUTSIDE_NAMES or OUTSIDE_PARTS.search(token.lower()):
            if content and names & OUTSIDE_NAMES <= HEADS and not OUTSIDE_PARTS.search(token.lower()) and in_article(parent):
                continue  # the head of an article holds its title
            cost = min(cost, COMPOUND if content else NAMED)
        else:
            inside |= content
    return (max(cost, BESIDES) if inside else cost), inside


def element(tag: str, rest: str, parent: Element | None) -> Element:
    outside, named, inside = tag in OUTSIDE_TAGS, OUTSIDE if tag in FORMS else 0.0, tag in ("article", "main")
    if tag in ("header", "hgroup"):  # the head of an article holds its title, that of a page does not
        outside = not in_article(parent)
    if rest and len(rest) > 4:
        for key, a, b, c in ATTRIBUTE.findall(rest):
            key, value = key.lower(), a or b or c
            if key in ("class", "id") and tag not in ("html", "body"):
                cost, content = name_cost(value, parent)
                named = min(named, cost)
                inside |= content
            elif key == "role":
                outside |= value.lower() in OUTSIDE_ROLES
                named = OUTSIDE if value.lower() in FORMS else named
                inside |= value.lower() in ("main", "article")
            elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                outside = True
            elif key == "itemprop":
                inside |= value.lower() == "articlebody"
    e = Element(tag, parent, outside, named, inside and named > APART)
    if tag in ("article", "main") and named > APART:
        up = parent
        while up and not up.holds:
            up.holds = True
            up = up.parent
    return e


def read_blocks(page: str) -> list[Block]:
    """The page's blocks in order."""
    root = Element("", None, False, 0.0, False)
    here, blocks, parts = root, [], []
    linked = in_link = 0
    at, n = 0, len(page)
    open_tags: Counter[str] = Counter()

    def leave(e: Element) -> None:
        """Closes elements up to and with ``e``."""
        nonlocal here
        while True:
            open_tags[here.tag] -= 1
            last, here = here, here.parent
            if last is e:
                return

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                blocks.append(Block(text, linked, here))
            parts.clear()
        linked = 0

    while at < n:
        m = TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            text = page[at:end]
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), m[1] or m[4]
        if tag in UNSEEN:
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                at = over.start() if over else n
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            parts.append("\n")
        elif tag in BLOCKS:
            flush()
            if closing:
                if open_tags[tag] > 0:
                    e = here
                    while e.tag != tag:
                        e = e.parent
                    leave(e)
                    in_link = 0
            elif tag not in VOID:
                if tag in ENDS_P and here.open_p is not None:
                    leave(here.open_p)
                if tag in CLOSES:
                    names, scope = CLOSES[tag]
                    if any(open_tags[x] > 0 for x in names):
                        e = here
                        while e is not root and e.tag not in names and e.tag not in scope:
                            e = e.parent
                        if e.tag in names:
                            leave(e)
                here = element(tag, m[3] or m[6] or "", here)
                open_tags[tag] += 1
    flush()
    return blocks


class Zone(NamedTuple):
    outside: bool
    inside: bool
    named: float

    @property
    def apart(self) -> bool:
        return self.outside or self.named <= APART


class Mass(NamedTuple):
    of: dict[Element, float]  # characters of unlinked sentences in an element
    whole: float
    titled: set[Element]  # elements that hold a title


def masses(blocks: list[Block]) -> Mass:
    of: dict[Element, float] = {}
    titled: set[Element] = set()
    for b in blocks:
        e = b.element
        of[e] = of.get(e, 0.0) + (max(0, len(b.text) - b.linked) if b.text[-1] in ".!?…" else 0)
        while e.parent is not None and e.parent not in of:
            e = e.parent
            of[e] = 0.0
        e = b.element if b.element.tag == "h1" else None
        while e is not None and e not in titled:
            titled.add(e)
            e = e.parent
    whole = 0.0
    for e in sorted(of, key=lambda e: -e.depth):
        if e.parent is None:
            whole = of[e]
        elif not e.outside:  # what is outside by its tag speaks for no wrapper
            of[e.parent] += of[e]
    return Mass(of, whole, titled)


def zone(e: Element, known: dict[Element, Zone], mass: Mass) -> Zone:
    """Whether an element lies in boilerplate, or in an article, and what its names and those around it cost."""
    path = []
    while e is not None and e not in known:
        path.append(e)
        e = e.parent
    z = known[e] if e is not None else Zone(False, False, 0.0)
    for e in reversed(path):
        # a wrapper named after what it also holds, like "with-sidebar", is no boilerplate
        cost = 0.0 if e.holds else e.named
        if cost:
            low, high = TITLED_MASS if e in mass.titled else MASS
            share = mass.of[e] / mass.whole if mass.whole else 0.0
            cost *= 1 - min(1.0, max(0.0, (share - low) / (high - low)))
        known[e] = z = Zone(z.outside or e.outside, z.inside or e.inside, max(OUTSIDE, z.named + cost))
    return z


def score(b: Block, z: Zone, page_has_article: bool) -> float:
    """The classifier: above 0 for content."""
    n = len(b.text)
    s = LENGTH * min(1.0, n / LONG_TEXT) + LINKED * min(1.0, b.linked / n)
    s += OUTSIDE if z.outside else z.named
    if z.inside:
        s += IN_ARTICLE
    elif page_has_article:
        s += NOT_IN_ARTICLE
    tag = b.element.tag
    if tag == "p":
        s += PARAGRAPH
    elif tag == "h1":
        s += TITLE
    elif tag in ("h2", "h3", "h4", "h5", "h6"):
        s += HEADING
    elif tag == "li":
        s += ITEM
    if n < SHORT_TEXT:
        s += SHORT
    if b.text[-1] in ".!?…":
        s += SENTENCE
    if b.text[0] == "©" or "all rights reserved" in b.text[:200].lower():
        s += RIGHTS
    return s


def distance(a: Element, b: Element) -> int:
    """Steps to the first common ancestor, from the deeper side."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges(blocks: list[Block], zones: list[Zone]) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for i, b in enumerate(blocks):
        e = b.element
        if i:
            out.append((i - 1, i, ACROSS if zones[i].apart != zones[i - 1].apart else NEXT / max(1, distance(blocks[i - 1].element, e) - 1)))
        holder = e.parent or e
        if holder in last:
            j = last[holder]
            out.append((j, i, ACROSS if zones[i].apart != zones[j].apart else SIBLING))
        last[holder] = i
    return out


def minimum_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: a node against its score pays its size, an edge between labels its capacity. Ties are content."""
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    u, label = list(scores), [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is not None or abs(u[i]) < (w := sum(near[i].values())) or (u[i] < 0 and -u[i] <= w):
            continue
        label[i] = u[i] >= 0
        for j, w in near[i].items():
            u[j] += w if label[i] else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        _augment(rest, u, near, label)
    return label


def _augment(rest: list[int], u: list[float], near: list[dict[int, float]], label: list) -> None:
    """Maximum flow by blocking flows on levels; what still reaches the sink is boilerplate."""
    place = {i: k for k, i in enumerate(rest)}
    s, t = len(rest), len(rest) + 1
    out: list[list[int]] = [[] for _ in range(t + 1)]  # edges by number; 2k and 2k + 1 are each other's reverse
    to: list[int] = []
    cap: list[float] = []

    def add(x: int, y: int, forth: float, back: float) -> None:
        out[x].append(len(to))
        out[y].append(len(to) + 1)
        to.extend((y, x))
        cap.extend((forth, back))

    for i in rest:
        if u[i] > 0:
            add(s, place[i], u[i], 0.0)
        elif u[i] < 0:
            add(place[i], t, -u[i], 0.0)
        for j, w in near[i].items():
            if i < j:
                add(place[i], place[j], w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (t + 1)  # steps to the sink
        level[t] = 0
        queue = deque([t])
        while queue:
            y = queue.popleft()
            for e in out[y]:
                x = to[e]
                if level[x] < 0 and cap[e ^ 1] > tiny:
                    level[x] = level[y] + 1
                    queue.append(x)
        if level[s] < 0:
            break
        tried = [0] * (t + 1)
        path: list[int] = []
        x = s
        while True:
            if x == t:
                flow = min(cap[e] for e in path)
                cut = 0
                for k in range(len(path) - 1, -1, -1):
                    cap[path[k]] -= flow
                    cap[path[k] ^ 1] += flow
                    if cap[path[k]] <= tiny:
                        cut = k
                x = to[path[cut] ^ 1]
                del path[cut:]
            elif tried[x] < len(out[x]):
                e = out[x][tried[x]]
                if cap[e] > tiny and level[to[e]] == level[x] - 1:
                    path.append(e)
                    x = to[e]
                else:
                    tried[x] += 1
            elif path:
                x = to[path.pop() ^ 1]
                tried[x] += 1
            else:
                break
    for i in rest:
        label[i] = level[place[i]] < 0


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    known: dict[Element, Zone] = {}
    mass = masses(blocks)
    zones = [zone(b.element, known, mass) for b in blocks]
    has_article = any(z.inside and not z.apart for z in zones)
    labels = minimum_cut([score(b, z, has_article) for b, z in zip(blocks, zones, strict=True)], edges(blocks, zones))
    return " ".join(b.text for b, ok in zip(blocks, labels, strict=True) if ok)


def extract(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without the page itself, with its main text."""
    names = pages.columns
    at = names.index(page)
    others = [c for c in names if c != page]
    if text in others:
        raise ValueError(f"there is a column {text} already; name another")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                got = [main_text(x.as_py()) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(part.columns) if i != at), pa.array(got, pa.string())], [*others, text])

    return pages.mapInArrow(run, T.StructType([*(f for f in pages.schema.fields if f.name != page), T.StructField(text, T.StringType(), False)]))


@query("op1_mincut")
def op1_mincut(spark, folder):
    got = extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return got.withColumn("n_chars", F.length("text").cast("long"))
