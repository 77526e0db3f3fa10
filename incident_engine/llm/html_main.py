"""Main text of web pages by tag-path ratios.

Every block of text has a path of element names from the root. Text length and punctuation are summed
per path, as averages over the blocks of the path, fused, smoothed along the page, and compared with a
threshold. The blocks of selected paths are main text wherever they stand. They vote for the element that
holds the content, and headings and short items in it, or in a selected block's own container, go along, all
without elements that carry no article text (menus, forms, hidden parts and so on). A class or id
that speaks of such a part deletes nothing: it makes a path of its own and lowers that path's score.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_engine.llm.batches import free_name, map_texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, up to their end tag.
RAW = frozenset("script style noscript template textarea title iframe".split())
#: Elements that an end in their own opening tag closes, as they are not HTML's.
FOREIGN = frozenset("svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that group blocks of one piece of text.
HOLDERS = frozenset("article main section div blockquote td".split())
#: Elements that an opening tag of the key closes, if no element of the second set lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Elements that never hold article text, and those that do not unless they wrap the content of the page.
NOISE_TAGS = frozenset("nav aside footer menu head svg object select annotation annotation-xml".split())
BOX_TAGS = frozenset("form button dialog fieldset".split())
BOX_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Words of class or id that speak for a part of a page outside its article: the smoothed score of a
#: block is multiplied by MARKED for each element around it with such a word.
MARKED = 0.25
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disclaimer footer form header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup promo promotion reader related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
#: Words that make a class name speak of the layout around a part, not of the part: has-sidebar, no-header.
LAYOUT_WORDS = frozenset("has have no not with without".split())
TAG = re.compile(
    r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|$)""",
    re.S,
)
#: A name and, in quotes or bare, its value: names inside of other names or of values are never seen.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；]")
#: Smoothing weights over neighbouring blocks (a Gaussian of deviation 1, cut at two blocks).
KERNEL = [math.exp(-k * k / 2) for k in range(-2, 3)]


@dataclass
class Block:
    """A run of text directly in one element; `linked` of its characters are in links."""

    node: int
    text: str
    linked: int


class Tree:
    """The elements of a page in the order of their opening tags, so a parent's number is below its children's.

    Element 0 is the page. All passes over it follow parents by number and take time in proportion to its size.
    """

    def __init__(self) -> None:
        self.tag, self.parent, self.marked, self.boxed = [""], [0], [False], [False]

    def add(self, tag: str, parent: int, marked: bool, boxed: bool) -> int:
        for column, value in zip((self.tag, self.parent, self.marked, self.boxed), (tag, parent, marked, boxed)):
            column.append(value)
        return len(self.tag) - 1

    def summed(self, values: dict[int, int]) -> list[int]:
        """Sums of values by element over all elements inside each."""
        total = [values.get(e, 0) for e in range(len(self.tag))]
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def ends(self) -> list[int]:
        """The last element inside each."""
        end = list(range(len(self.tag)))
        for e in range(len(end) - 1, 0, -1):
            end[self.parent[e]] = max(end[self.parent[e]], end[e])
        return end

    def inherited(self, own: list[bool]) -> list[int]:
        """How many of an element and those around it are flagged."""
        depth = [int(own[0])]
        for e in range(1, len(own)):
            depth.append(depth[self.parent[e]] + own[e])
        return depth

    def paths(self, starred: list[bool]) -> list[int]:
        """A number for the path of block elements down to each element; equal paths have equal numbers."""
        known: dict[tuple[int, str, bool], int] = {}
        path = [0]
        for e in range(1, len(self.tag)):
            above = path[self.parent[e]]
            key = above, self.tag[e], starred[e]
            path.append(known.setdefault(key, len(known) + 1) if self.tag[e] in BLOCKS else above)
        return path

    def holders(self) -> list[int]:
        """The innermost element that groups blocks, of each element; 0 if that is the page."""
        found = [0]
        for e in range(1, len(self.tag)):
            found.append(e if self.tag[e] in HOLDERS else found[self.parent[e]])
        return found

    def innermost_blocks(self) -> list[int]:
        """The innermost block element of each element; 0 if that is the page."""
        found = [0]
        for e in range(1, len(self.tag)):
            found.append(e if self.tag[e] in BLOCKS else found[self.parent[e]])
        return found


def attributes_of(raw: str) -> dict[str, str]:
    """Attributes of an opening tag by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(raw):
        if name:
            found.setdefault(name.lower(), next((v for v in values if v), ""))
    return found


def _is_noise(tag: str, attributes: dict[str, str]) -> bool:
    return tag in NOISE_TAGS or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"


def _is_boxed(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    return tag in BOX_TAGS or (tag == "header" and not in_article) or attributes.get("role", "").lower() in BOX_ROLES


def _is_marked(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a class or id speaks for noise. Headings and the page's frame never do, nor the id of a section that
    has other words too (a link's target), nor the word header inside an article, where it holds the title."""
    if tag in ("html", "body", "article", "main", *HEADINGS):
        return False
    for key in ("class", "id"):
        for name in attributes.get(key, "").lower().split():
            found = WORD.findall(name)
            noise = NOISE_WORDS & set(found) - ({"header"} if in_article else set())
            if noise and not set(found) & LAYOUT_WORDS and not (key == "id" and tag == "section" and set(found) - noise):
                return True
    return False


class _Open:
    """The open elements, with the places of each name, so that no step looks through all of them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool]] = []  # name, element, in noise
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, tag: str, node: int, noise: bool) -> None:
        self.at[tag].append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node, noise))

    def pop(self) -> int:
        tag, node, _ = self.stack.pop()
        self.at[tag].pop()
        if tag in BLOCKS:
            self.blocks.pop()
        return node

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of some names, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def first_above(self, place: int, tags: set[str]) -> int | None:
        """The outermost open element of some names inside the given place."""
        found = [self.at[t][i] for t in tags if (i := bisect_right(self.at.get(t, ()), place)) < len(self.at.get(t, ()))]
        return min(found, default=None)

    def in_noise(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]


def blocks_of(page: str) -> tuple[Tree, list[Block]]:
    """The elements of a page, and all blocks of text outside of noise in page order, references decoded."""
    tree, out, opened = Tree(), [], _Open()
    text: list[str] = []
    owner, linked, at, n = 0, 0, 0, len(page)

    def top() -> int:
        return opened.stack[-1][1] if opened.stack else 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                out.append(Block(owner, joined, linked))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        cuts = any(t in BLOCKS or tree.marked[e] for t, e, _ in opened.stack[depth:])
        if cuts:
            flush()
        while len(opened.stack) > depth:
            opened.pop()

    while at < n:
        m = TAG.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not opened.in_noise():
            owner = owner if text else top()
            text.append(piece)
            if opened.at["a"]:
                linked += len(piece)
        if not m:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            depth = opened.last(tag)
            if depth >= 0 and (tag in BLOCKS or not opened.blocks or opened.blocks[-1] < depth):
                close(depth)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        closed = m[3].endswith("/")
        if tag in VOID or closed and tag not in BLOCKS:
            if tag in ("br", "hr") and text:
                text.append(" ")
            continue
        if tag in BLOCKS:
            depth = opened.last("p")
            if depth > opened.last("td", "th", "button"):
                close(depth)
            closes, stops = CLOSES.get(tag, (set(), set()))
            above = opened.first_above(opened.last(*stops), closes)
            if above is not None:
                close(above)
            flush()
        inside = bool(opened.at["article"] or opened.at["main"])
        attributes = attributes_of(m[3]) if m[3] else {}
        noise = opened.in_noise() or _is_noise(tag, attributes)
        mark = not noise and bool(attributes) and _is_marked(tag, attributes, inside)
        box = not noise and _is_boxed(tag, attributes, inside)
        if mark or box:
            flush()
        opened.push(tag, tree.add(tag, top(), mark or box, box), noise)
    flush()
    return tree, out


def without_boxes(tree: Tree, blocks: list[Block]) -> tuple[list[bool], list[Block], set[int]]:
    """Flags of the elements whose mark counts, the blocks outside of boxes, and the elements of a title in a header.

    An element that holds half of the page's unlinked text or more wraps the content: its mark is cleared, and
    as a box it stays. Other boxes go with all they hold, but for the title: on a page without article and main
    element whose only headings of the first level stand in page headers, these stay.
    """
    unlinked: dict[int, int] = defaultdict(int)
    for b in blocks:
        unlinked[b.node] += max(0, len(b.text) - b.linked)
    held = tree.summed(unlinked)
    marked = [m and 2 * h < held[0] for m, h in zip(tree.marked, held)]
    headers = tree.inherited([m and box and t == "header" for m, box, t in zip(marked, tree.boxed, tree.tag)])
    boxes = tree.inherited([m and box for m, box in zip(marked, tree.boxed)])
    block_of = tree.innermost_blocks()
    kept = [b for b in blocks if not boxes[b.node]]
    if not {"article", "main"} & set(tree.tag) and not any(tree.tag[block_of[b.node]] == "h1" for b in kept):
        kept = [b for b in blocks if not boxes[b.node] or tree.tag[block_of[b.node]] == "h1" and headers[b.node] == boxes[b.node]]
    return marked, kept, {b.node for b in kept if boxes[b.node]}


def path_scores(paths: list[int], blocks: list[Block]) -> dict[int, float]:
    """Fused ratio per tag path: mean text length times the share of punctuation, links left out.

    `paths` has the path number of each block. On a page whose text is nearly all links, they count as text.
    """
    text, links = sum(len(b.text) for b in blocks), sum(min(len(b.text), b.linked) for b in blocks)
    all_links = 10 * links >= 9 * text
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for p, b in zip(paths, blocks):
        length[p] += len(b.text) if all_links else max(0, len(b.text) - b.linked)
        marks[p] += len(PUNCTUATION.findall(b.text))
        count[p] += 1
    return {p: length[p] / count[p] * math.log2(2 + marks[p] / count[p]) for p in count}


def smoothed(raw: list[float]) -> list[float]:
    """Weighted means over neighbouring blocks."""
    total = sum(KERNEL)
    return [sum(w * raw[i + k] for k, w in zip(range(-2, 3), KERNEL) if 0 <= i + k < len(raw)) / total for i in range(len(raw))]


def content_blocks(tree: Tree, blocks: list[Block]) -> list[Block]:
    """The blocks of the paths over the threshold, and what goes with them in the element that holds them."""
    marked, blocks, titles = without_boxes(tree, blocks)
    if not blocks:
        return []
    by_element, depth = tree.paths(marked), tree.inherited(marked)
    paths = [by_element[b.node] for b in blocks]
    score = path_scores(paths, blocks)
    smooth = [s * MARKED ** depth[b.node] for b, s in zip(blocks, smoothed([score[p] for p in paths]))]
    mean = sum(smooth) / len(smooth)
    threshold = min(mean, math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth)) or mean)
    by_path = defaultdict(list)
    for p, s in zip(paths, smooth):
        by_path[p].append(s)
    chosen = {p for p, s in by_path.items() if sum(s) / len(s) >= threshold and score[p] > 0}
    taken: dict[int, int] = defaultdict(int)
    for p, b in zip(paths, blocks):
        if p in chosen:
            taken[b.node] += len(b.text)
    weight, block_of, holder, end = tree.summed(taken), tree.innermost_blocks(), tree.holders(), tree.ends()
    total = sum(taken.values())
    held = [e for e in range(1, len(tree.tag)) if weight[e] and tree.tag[e] in BLOCKS]
    articles = [e for e in held if tree.tag[e] in ("article", "main") and 2 * weight[e] >= total]
    if articles:
        root = max(articles)
    else:  # the deepest element that holds nearly all chosen text
        root = max((e for e in held if 10 * weight[e] >= 9 * total and tree.tag[e] not in ("p", "li", "td", "th", *HEADINGS)), default=None)

    def in_root(b: Block) -> bool:
        return root is not None and root <= b.node <= end[root]

    beside = {holder[b.node] for p, b in zip(paths, blocks) if p in chosen and not in_root(b)} - {0}

    def goes_along(b: Block) -> bool:
        """Whether a block that its own path does not select belongs to the selected ones beside it."""
        e = block_of[b.node]
        return tree.tag[e] in HEADINGS and not marked[e] or not depth[b.node] and 2 * b.linked < len(b.text)

    return [
        b
        for p, b in zip(paths, blocks)
        if p in chosen or (root is None or in_root(b) or holder[b.node] in beside) and goes_along(b) or b.node in titles
    ]


def main_text(page: str) -> str:
    """The main text of a page: its content blocks in page order, joined by two line feeds."""
    return "\n\n".join(b.text for b in content_blocks(*blocks_of(page)))


def extract(pages: DataFrame, html: str = "html", name: str = "main") -> DataFrame:
    """`pages` with a struct column `name`: `text` (empty if there is none) and `n_chars`.

    A null or empty page gives the empty text; markup that breaks off or is not closed is read as far
    as it goes. Pages are handled one by one, so repeated rows give equal texts. If a column is called
    `name` already, the new one ends in underscores.
    """
    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(p) for p in column.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]

    return map_texts(pages, html, free_name(pages, name), result, run)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("main.text"), F.col("main.n_chars"))
