"""Main text of web pages by composite text density.

A page is read into a tree of nodes. Every node has the characters and tags below it and those inside links. Its
density is characters per tag, adjusted by how much of them are links. The densities of a node's children add up to
its density sum; the subtree with the largest sum is the core of the article, and the nearest article or main element around
it is taken whole. The least density on the path from the core up to the body is the threshold: every other subtree at or
above it is taken whole too, and a main heading that stands beside them. On that path, short of the body, texts and
elements of running text are taken however short they are, unless links hold most of them. Only block-level children
count in a sum: a bold word is no part of a page by itself.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments of readers are known by
their elements, roles and the words of their class and id; they are left out before densities are computed. A name of
which only some words are listed is a weak mark: within an article it counts for classes only, and only where links hold
most of the text; on a page without article and main, what it marks stays where nearly all unlinked text lies in it.

Defined results: a null, empty or text-free page has an empty text; broken markup is read the way browsers do in the
common cases (unclosed paragraphs, list items and cells end where the next one begins, stray end tags are ignored, an
unfinished tag at the end is dropped); a page is handled whole, whatever its length, in time that grows with it, also where
its markup is broken or deeply nested; repeated rows stay; an empty table
gives no rows.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
# A start tag closes an open element of these kinds, unless one of the fences lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}
PARAGRAPH_FENCES = frozenset("button table td th caption object marquee".split())

LEFT_OUT = frozenset(
    "head script style noscript template nav footer aside form button select textarea input iframe object svg canvas "
    "audio video dialog menu title datalist map".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
# Words of class and id names that mark parts around an article.
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay sidebar sidebars widget widgets related recommended "
    "share sharing social comment comments disqus replies respond breadcrumb breadcrumbs menu menus nav navbar navigation "
    "footer header masthead toolbar pagination pager newsletter subscribe subscription signup login search copyright".split()
)
# A weakly marked part outside of articles stays with so many times the unlinked text of all that is not left out.
MOST_OF_PAGE = 5
# Elements of running text; around the core they are part of it unless links hold most of them.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol dl blockquote pre table figure address details".split())
CARRIES_ARTICLE = frozenset("html body main article".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile(r"[>\"']")
_BOGUS = re.compile(r"<[!?]|</[^a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """An element: its children and texts in page order, and the counts that densities need."""

    __slots__ = ("tag", "parts", "out", "chars", "tags", "link_chars", "link_tags", "density", "total", "carries", "block", "mark")

    def __init__(self, tag: str, out: bool, mark: str = ""):
        self.tag, self.out, self.parts, self.mark = tag, out, [], mark
        self.chars = self.link_chars = self.link_tags = 0
        self.tags = 1
        self.density = self.total = 0.0
        self.carries = False
        self.block = tag in BLOCKS


def _left_out(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is a part around the article, by its name, role, class or id; and the attribute that says so
    where that is a weak mark, of which only some words are listed."""
    if tag in LEFT_OUT:
        return True, ""
    if not attributes or attributes.isspace() or tag in CARRIES_ARTICLE:
        return False, ""
    weak = ""
    strong = False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if key == "role" and LEFT_OUT_ROLES & set(value.lower().split()):
            return True, ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True, ""
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, ""
        if key in ("class", "id"):
            for name in value.split():
                listed = [w.lower() in LEFT_OUT_WORDS for w in _NAME_WORD.findall(name)]
                strong = strong or bool(listed) and all(listed)
                if any(listed) and weak != "class":
                    weak = key
    return strong or bool(weak), "" if strong else weak


class _Open:
    """The open elements, and where those of each tag stand, so that closing never walks over others."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, tags) -> int:
        return max((d[-1] for d in map(self.depths.get, tags) if d), default=0)

    def close(self, tags, fences) -> None:
        """Ends the innermost element of ``tags`` and all within it, unless a fence lies between."""
        depth = self.last(tags)
        if depth and depth >= self.last(fences):
            for node in self.stack[depth:]:
                self.depths[node.tag].pop()
            del self.stack[depth:]


def _tag_end(page: str, at: int, unclosed: set[int]) -> int:
    """Where the tag whose name ends at ``at`` ends, -1 if nowhere: the first ``>`` outside quotes, or else the first at all.

    ``unclosed`` remembers the quotes from which no end can be reached, so that no stretch is searched twice.
    """
    first = page.find(">", at)
    seen = []
    while first >= 0 and (m := _QUOTE_OR_END.search(page, at)):
        i = m.start()
        if page[i] == ">":
            return i
        if i in unclosed:
            break
        seen.append(i)
        at = page.find(page[i], i + 1) + 1
        if not at:
            break
    unclosed.update(seen)
    return first


def _last_text(text: str) -> str:
    """Text after which no tag ends: what begins like a comment or declaration goes, and an unfinished tag at the very end."""
    bogus = _BOGUS.search(text)
    return text[:bogus.start()] if bogus else re.sub(r"<[a-zA-Z/!?][^<]*\Z", "", text)


def parse(page: str) -> Node:
    """The tree of a page. Texts are kept as they stand in the source, undecoded. One pass forward, in linear time."""
    root = Node("html", False)
    opened, unclosed = _Open(root), set()
    at, text_from, end = 0, 0, len(page)

    def text_to(stop: int) -> None:
        if stop > text_from:
            opened.stack[-1].parts.append(page[text_from:stop])

    while (at := page.find("<", at)) >= 0:
        start = at
        found = _TAG.match(page, start)
        if found:
            stop = _tag_end(page, found.end(), unclosed)
            if stop < 0:
                break
            at = stop + 1
        elif page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = stop + 3 if stop >= 0 else end
        elif _BOGUS.match(page, start):
            at = page.find(">", start) + 1 or end
        else:
            at += 1
            continue
        text_to(start)
        text_from = at
        if not found:
            continue
        closing, tag, attributes = found[1], found[2].lower(), page[found.end():at - 1]
        if closing:
            opened.close((tag,), () if tag in BLOCKS else ("table", "article", "main", "body"))
            continue
        if tag == "html":
            continue
        if tag in ENDS_PARAGRAPH:
            opened.close(("p",), PARAGRAPH_FENCES)
        if tag in CLOSES:
            opened.close(*CLOSES[tag])
        node = Node(tag, *_left_out(tag, attributes))
        opened.stack[-1].parts.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = text_from = stop and page.find(">", stop.start()) + 1 or end
            continue
        opened.push(node)
    if rest := _last_text(page[text_from:]):
        opened.stack[-1].parts.append(rest)
    return root


def _children(node: Node) -> list[Node]:
    return [c for c in node.parts if isinstance(c, Node) and not c.out]


def _visible(text: str) -> int:
    return len("".join(text.split()))


def _in_order(root: Node) -> list[Node]:
    """Nodes from the root down, parents first, without those left out."""
    order, rest = [], [root]
    while rest:
        node = rest.pop()
        order.append(node)
        rest += reversed(_children(node))
    return order


def prune(root: Node) -> None:
    """Take back what is left out by a class name but holds the article; keep the heading of an article's header."""
    everything, rest = [], [(root, False)]
    while rest:
        node, inside = rest.pop()
        everything.append((node, inside))
        rest += [(c, inside or node.tag in ("article", "main")) for c in node.parts if isinstance(c, Node)]
    heading: set[int] = set()
    for node, inside in reversed(everything):
        kids = [c for c in node.parts if isinstance(c, Node)]
        node.carries = node.tag in ("article", "main") or any(c.carries for c in kids)
        if node.tag in ("h1", "h2") or any(id(c) in heading for c in kids):
            heading.add(id(node))
        if node.out and node.tag not in LEFT_OUT and node.carries:
            node.out = False
        if node.tag == "header":
            node.out = not (inside and id(node) in heading) and not node.carries
        elif node.out and node.tag not in LEFT_OUT and inside and node.tag in ("div", "hgroup", "h1", "h2") and id(node) in heading:
            node.out = False
    if any(node.out and node.mark for node, _ in everything):
        _take_back(everything)


def _take_back(everything: list[tuple[Node, bool]]) -> None:
    """Take back what is left out by a weak mark but reads as article text; ``everything`` has parents first."""
    # Unlinked and linked characters of each node with the weakly marked parts below it, and unlinked ones without.
    plain, linked, kept = {}, {}, {}
    for node, _ in reversed(everything):
        kids = [c for c in node.parts if isinstance(c, Node)]
        own = sum(_visible(html.unescape(t)) for t in node.parts if isinstance(t, str))
        a, b, c = (own + sum(d[id(k)] for k in kids) if d is not linked else sum(d[id(k)] for k in kids) for d in (plain, linked, kept))
        if node.out and not node.mark:
            a = b = 0
        if node.tag == "a":
            a, b, c = 0, a + b, 0
        plain[id(node)], linked[id(node)], kept[id(node)] = a, b, 0 if node.out else c
    rest = kept[id(everything[0][0])]
    has_article = any(node.tag in ("article", "main") for node, _ in everything)
    within: set[int] = set()
    for node, inside in everything:
        a, b = plain[id(node)], linked[id(node)]
        if node.out and node.mark and node.tag != "header":
            if inside or id(node) in within:
                node.out = not (node.mark == "id" or a >= b)
            elif not has_article and a > b and a >= MOST_OF_PAGE * rest:
                node.out = False
                within.add(id(node))
        if id(node) in within:
            within.update(id(c) for c in node.parts if isinstance(c, Node))


def measure(root: Node) -> None:
    """Counts, densities and density sums of all nodes."""
    order = _in_order(root)
    link_of: dict[int, bool] = {id(root): False}
    for node in order:
        for c in _children(node):
            link_of[id(c)] = link_of[id(node)] or c.tag == "a"
    for node in reversed(order):
        node.chars = sum(_visible(html.unescape(t)) for t in node.parts if isinstance(t, str))
        if link_of[id(node)]:
            node.link_chars = node.chars
        for c in _children(node):
            node.block = node.block or c.block
            node.chars += c.chars
            node.tags += c.tags
            node.link_chars += c.link_chars
            node.link_tags += c.link_tags + (c.tag == "a")
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in order:
        node.total = sum(c.density for c in _children(node) if c.block)


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_link_share: float) -> float:
    """Characters per tag times the logarithm of how little of them is linked; its base grows with the linked part."""
    if not chars:
        return 0.0
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + page_link_share * chars + math.e)
    ratio = (chars / max(link_chars, 1)) * (tags / max(link_tags, 1))
    # Without any link on a page the base is one for all nodes; the natural logarithm then serves.
    scale = math.log(base) if base > 1 + 1e-9 else 1.0
    return chars / tags * math.log(max(ratio, 1.0)) / scale


def core(body: Node, parent: dict[int, Node]) -> tuple[Node, float]:
    """The subtree with the largest density sum, and the least density on its path to the body."""
    best = max(_in_order(body), key=lambda n: n.total)  # the first, that is the outermost, of equals
    if not best.total:
        best = body
    threshold, node = best.density, best
    while node is not body:
        node = parent[id(node)]
        threshold = min(threshold, node.density)
    return best, threshold


def content(root: Node) -> list[Node | str]:
    """The nodes that are taken whole, and texts beside them, in page order."""
    order = _in_order(root)
    parent = {id(c): node for node in order for c in _children(node)}
    body = next((n for n in order if n.tag == "body"), root)
    best, threshold = core(body, parent)
    path, node = [best], best
    while node is not body:
        node = parent[id(node)]
        path.append(node)
    # An article is whole: the core grows to the nearest article or main that holds it.
    best = next((n for n in path if n.tag in ("article", "main")), best)
    on_path = {id(n) for n in path}
    taken, rest = [], [(body, False)]
    while rest:
        node, framed = rest.pop()
        if isinstance(node, str):
            taken.append(node)
        elif node is best:
            taken.append(node)
        elif id(node) in on_path:
            # Around the core, short of the body, running text belongs to it however short it is.
            inside = node is not body
            rest += [(c, inside) for c in reversed(node.parts) if (inside if isinstance(c, str) else not c.out)]
        elif framed and (not node.block or node.tag in PROSE) and 2 * node.link_chars <= node.chars:
            taken.append(node)
        elif node.block and node.chars and (node.density >= threshold or node.tag == "h1"):
            taken.append(node)
        else:
            rest += [(c, False) for c in reversed(_children(node))]
    return taken


def blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks in page order: character references decoded, white space made one space, trimmed."""
    done: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(now)).split())
        now.clear()
        if text:
            done.append(text)

    for top in nodes:
        # Pieces of running text side by side are one block.
        if not isinstance(top, str) and top.block:
            flush()
        rest: list = [top]
        while rest:
            part = rest.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                now.append(part)
            elif not part.out:
                if part.tag == "br":
                    now.append(" ")
                elif part.tag in BLOCKS:
                    flush()
                    rest.append(None)
                    rest += reversed(part.parts)
                else:
                    rest += reversed(part.parts)
    flush()
    return done


def main_text(page: str | None) -> str:
    """The main text of a page, one line per block."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    measure(root)
    return "\n".join(blocks(content(root)))


def extract(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and its length in characters ``n_chars`` for every row."""
    rows = pages.select(*keep, page)
    schema = rows.select(*keep).schema.add("text", T.StringType()).add("n_chars", T.LongType())

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(len(keep))]
            yield pa.record_batch(
                [*[batch.column(i) for i in range(len(keep))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    return rows.mapInArrow(run, schema)


def op8_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
