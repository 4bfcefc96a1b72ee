"""HTML main text by composite text density (after Sun, Song and Liao, SIGIR 2011).

Every element gets a density: its characters per tag, weighed down by its share of link characters and link tags.  The
sum of the children's densities picks the content subtree: the container with the largest sum.  The least density on the
path from it to the body is the threshold that any element beside the path must reach to belong to the content as well.
An article around the subtree (the outermost one) belongs to it whole, with headings and other short blocks; so does a
main without article, but for blocks beside the subtree that miss the threshold and are links for more than half.
Where there is neither, short blocks beside the path belong to the content by their place, since no density can tell a headline: the heading before the content and what
lies between, paragraphs and lists between blocks that reach the threshold, and those that follow the last one at once.

Elements that by their tag, role, class or id are menus, headers, footers, sidebars,
notices, adverts, forms or comments never count, but a class, role or id alone never switches off the page's article.  Names are weighed in two ways: one made of
such words only decides by itself; one that says comments, consent, promotion or the like among other words decides unless the element holds what the page would be without (``_switch_off``).
Elements after the text that repeat one structure of a name, a time or a reply link and a few words are reader comments, whatever they are called (``_threads``).

Unclosed and misnested tags are repaired as browsers do for the common cases.  Nothing recurses, and what is open is known by tag, so time grows
with the page alone, however deep it is.

Defined results: a null or empty page has the empty text; text without any tag is the whole page's text; of equal
sums the innermost, first container is taken, and a name outweighs any density; very long pages are read whole; repeated rows give repeated rows; other columns are
ignored, whatever their names, and a result column of a carried column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import scan_texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of an article.
DROPPED = frozenset("script style noscript template iframe svg canvas head nav aside form button select textarea menu dialog object audio video map math footer title".split())
#: What may stand in a head; anything else ends one that is still open.
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
CONTAINERS = frozenset("body html main article section div td th center fieldset details blockquote".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption pre figure figcaption header address hr hgroup summary".split()) | DROPPED
#: A start tag on the left closes an open element on the right, if no element of the third set lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
#: Words in class, id or role that mark an element as no content.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar sidebar side "
    "aside footer header masthead topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription "
    "signup login search comment comments disqus respond replies reply share sharing social related recommended recommendations more "
    "pagination pager widget toolbar complementary contentinfo dialog tracking".split()
)
#: Words that stand beside such a word in a name without changing what it says; any other word does.
PLAIN = frozenset("site main primary secondary left right top bottom area container wrapper box bar block section list links link item items inner posts buttons icons".split())
#: Words that say within any name what an element is for.
TELLING = frozenset(
    "advert adverts advertisement advertising sponsor sponsored promo promos promotion breadcrumb breadcrumbs cookie cookies consent gdpr popup newsletter subscribe subscription "
    "signup login comment comments discussion discussions disqus respond replies".split()
)
#: Blocks that belong to the content by their place beside it.
SIMPLE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hgroup".split())
_TOKEN = re.compile(r"[a-z]+")


def _marks(value: str) -> set:
    """The marks among names: each word of a name like ``site-footer`` is a mark or plain, or one of any name's words is telling."""
    found = set()
    for name in value.lower().split():
        words = set(_TOKEN.findall(name))
        found |= words & (MARKS if words <= MARKS | PLAIN else TELLING)
    return found


class _Tree(HTMLParser):
    """Elements in document order as parallel lists; a text belongs to the block that is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.off, self.marked, self.names = ["body"], [-1], [False], [False], [""]
        self.tags, self.chars, self.link_tags, self.link_chars = [0], [0], [0], [0]
        self.texts: list[tuple[int, str]] = []
        self.stack, self.link = [0], False
        self.open: dict[str, list[int]] = {"body": [0]}  # by tag, where on the stack its open elements are
        self.blocks, self.fences = [], [0]  # where blocks and containers are

    def _push(self, tag: str) -> None:
        at = len(self.stack)
        self.stack.append(len(self.tag) - 1)
        self.open.setdefault(tag, []).append(at)
        if tag in BLOCKS:
            self.blocks.append(at)
        if tag in CONTAINERS:
            self.fences.append(at)

    def _cut(self, k: int) -> None:
        """Closes all from place k of the stack on."""
        for i in self.stack[k:]:
            self.open[self.tag[i]].pop()
        del self.stack[k:]
        for places in (self.blocks, self.fences):
            while places and places[-1] >= k:
                places.pop()

    def _last(self, tags) -> int:
        """The place on the stack of the innermost open element with one of the tags; 0 if there is none."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _bad(self, tag: str, attrs: list) -> str | None:
        """``off`` for what never is content, ``marked`` for what its names call so."""
        if tag in DROPPED:
            return "off"
        inside = bool(self.open.get("article") or self.open.get("main"))
        if tag == "header":
            return None if inside else "marked"
        if tag in ("article", "main", "body", "html"):
            return None
        marked = None
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and "display:none" in value.replace(" ", "")):
                return "off"
            if name in ("class", "id", "role") and value:
                found = _marks(value)
                if found - {"header"} or (found and not inside):  # an article may have a header with its title
                    marked = "marked"
        return marked

    def _end_head(self) -> None:
        k = self._last(("head",))
        if k:
            self._cut(k)

    def _close_within(self, tags: set, fence: set) -> None:
        """Closes the innermost element with one of the tags, unless a fence or a container lies within it."""
        k = self._last(tags)
        if k and k >= self.fences[-1] and k > self._last(fence):
            self._cut(k)

    def handle_starttag(self, tag, attrs):
        if tag == "body" or (self.tag[self.stack[-1]] == "head" and tag not in HEAD):
            self._end_head()
        here = self.stack[-1]
        if tag in ("html", "body"):
            return
        if tag == "br" or tag == "wbr":
            self.tags[here] += 1
            self.texts.append((here, " " if tag == "br" else ""))
            return
        if tag == "a":
            self.tags[here] += 1
            self.link_tags[here] += 1
            self.link = True
            return
        if tag not in BLOCKS:
            bad = self._bad(tag, attrs) and tag not in VOID
            self.tags[here] += 1
            if not bad:
                return
        self.link = False
        if tag in BLOCKS:
            self._close_within({"p"}, set())
        if tag in CLOSES:
            self._close_within(*CLOSES[tag])
        if tag[0] == "h" and tag[1:].isdigit():
            self._close_within({"h1", "h2", "h3", "h4", "h5", "h6"}, set())
        here = self.stack[-1]
        self.tag.append(tag)
        self.parent.append(here)
        self.names.append(next((value or "" for name, value in attrs if name == "class"), ""))
        bad = self._bad(tag, attrs)
        self.off.append(self.off[here] or bad == "off")
        self.marked.append(bad == "marked")
        for column in (self.tags, self.chars, self.link_tags, self.link_chars):
            column.append(0)
        if tag not in VOID:
            self._push(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("div", "p", "section") or tag not in BLOCKS:
            return
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        k = self._last((tag,))
        if k and (tag in BLOCKS or not self.blocks or k > self.blocks[-1]):  # the end of an inline element never closes a block
            self._cut(k)
            self.link = False

    def handle_data(self, data):
        if self.tag[self.stack[-1]] == "head" and not data.isspace():
            self._end_head()
        here = self.stack[-1]
        if self.off[here]:
            return
        self.texts.append((here, data))
        n = len(data) - data.count(" ") - data.count("\n")
        self.chars[here] += n
        if self.link:
            self.link_chars[here] += n


def _switch_off(tree: _Tree) -> None:
    """Marked elements go off with all they hold, but for those that hold the page's article: one with more text than any article
    or main outside marks or, where no such has text, more than half of the page's text; or one within an article or main that without it would have
    less than a quarter of the text that it holds."""
    n = len(tree.tag)
    if any(tree.marked):
        under = [False] * n
        for i in range(1, n):
            under[i] = tree.marked[i] or under[tree.parent[i]]
        whole, net, largest = list(tree.chars), list(tree.chars), [0] * n  # all text; without marked parts; of the largest article in it
        outside = 0
        frame = [0] * n  # the article or main around an element, or the page
        for i in range(1, n):
            frame[i] = tree.parent[i] if tree.tag[tree.parent[i]] in ("article", "main") else frame[tree.parent[i]]
        for i in range(n - 1, 0, -1):
            p = tree.parent[i]
            if tree.tag[i] in ("article", "main") and not tree.off[i]:
                largest[i] = max(largest[i], net[i])
                outside = outside if under[i] else max(outside, net[i])
            whole[p] += whole[i]
            net[p] += 0 if tree.marked[i] else net[i]
            largest[p] = max(largest[p], largest[i])
        for i in range(1, n):
            alone = frame[i] and 5 * whole[i] > 4 * whole[frame[i]]
            if tree.marked[i] and (alone or largest[i] > outside or (not outside and 2 * whole[i] > whole[0])):
                tree.marked[i] = False
    for i in range(1, n):
        tree.off[i] = tree.off[i] or tree.marked[i] or tree.off[tree.parent[i]]


def _threads(tree: _Tree, home: int, chars: list[int]) -> list[int]:
    """Elements of the article that hold a thread of reader comments: the last of its children with text, at least three of whose children in a row are alike (tag, names and the tags of
    their children in order), each with a stub of at most 60 characters (a short block, or words beside its blocks), and which hold less text than the rest of the article."""
    kids: dict[int, list[int]] = {}
    for i in range(1, len(tree.tag)):
        if not tree.off[i]:
            kids.setdefault(tree.parent[i], []).append(i)
    held = [i for i in kids.get(home, []) if chars[i]]
    found = []
    while len(held) > 1 and tree.tag[held[-1]] in ("section", "div", "ul", "ol"):
        last = held.pop()
        inner = kids.get(last, [])
        if len(inner) == 1:  # a wrapper around the thread
            inner = kids.get(inner[0], [])
        shape = lambda i: (tree.tag[i], tree.names[i], tuple(tree.tag[j] for j in kids.get(i, [])))
        alike = [i for i in inner if tree.tag[i] in ("div", "li", "article", "section") and len(kids.get(i, [])) + (tree.chars[i] > 0) > 1]
        same = max((sum(shape(i) == s for i in alike) for s in {shape(i) for i in alike}), default=0)
        stub = [i for i in alike if 0 < tree.chars[i] <= 60 or any(0 < chars[j] <= 60 and tree.tag[j] not in ("h2", "h3", "h4") for j in kids[i])]
        if same < 3 or len(stub) < 3 or 2 * len(stub) < len(inner) or 2 * chars[last] > chars[home]:
            break
        found.append(last)
    return found


def _beside(tree: _Tree, kids: list[int], on_path: set, density: list[float], threshold: float, chars: list[int], link_chars: list[int], titled: list[bool]) -> set[int]:
    """Of the children of an element on the path, which is no article, those that belong to the content: dense ones, and short ones by their place."""
    picked = [i for i in kids if i in on_path or density[i] >= threshold > 0]
    prose = [tree.tag[i] in SIMPLE and chars[i] > 0 and 2 * link_chars[i] <= chars[i] for i in kids]
    first, last = kids.index(picked[0]), kids.index(picked[-1])
    out = set(picked) | {i for i, ok in zip(kids[first:last], prose[first:last]) if ok}
    if not any(titled[i] for i in out):
        head = next((n for n in range(first - 1, -1, -1) if titled[kids[n]] and chars[kids[n]] <= 400), None)
        if head is not None:
            out |= {kids[head]} | {i for i, ok in zip(kids[head:first], prose[head:first]) if ok}
    for i, ok in zip(kids[last + 1 :], prose[last + 1 :]):
        if not ok:
            break
        out.add(i)
    return out


def _density(c: int, t: int, lc: int, lt: int, ratio: float) -> float:
    """Characters per tag, its logarithm's base growing with the share of links (composite text density)."""
    if not c:
        return 0.0
    t = max(t, 1)
    plain = max(c - lc, 1)
    base = math.log(c / plain * lc + ratio * c + math.e)
    return c / t * math.log(max(c / max(lc, 1) * (t / max(lt, 1)), 1.0) + 1e-9, max(base, 1.0001)) if lc else c / t


def main_text(html: str | None) -> str:
    """The page's article as blocks joined by an empty line."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _switch_off(tree)
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = list(tree.chars), list(tree.tags), list(tree.link_chars), list(tree.link_tags)
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = tree.parent[i]
        if not tree.off[i]:
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
    ratio = link_chars[0] / max(chars[0], 1)
    density = [0.0 if tree.off[i] else _density(chars[i], tags[i], link_chars[i], link_tags[i], ratio) for i in range(n)]
    total = [0.0] * n
    for i in range(1, n):
        total[tree.parent[i]] += density[i]
    best = 0
    for i in range(n):
        if tree.tag[i] in CONTAINERS and not tree.off[i] and chars[i] and (total[i] > total[best] or (total[i] == total[best] and tree.parent[i] == best)):
            best = i
    path, i = [], best
    while i >= 0:
        path.append(i)
        i = tree.parent[i]
    threshold, on_path = min(density[i] for i in path), set(path)
    home = next((i for i in reversed(path) if tree.tag[i] == "article"), next((i for i in path if tree.tag[i] == "main"), best))
    within = set(path[: path.index(home) + 1])
    titled, kids = [t == "h1" for t in tree.tag], {}
    for i in range(n - 1, 0, -1):
        titled[tree.parent[i]] |= titled[i] and not tree.off[i]
    for i in range(1, n):
        if tree.parent[i] in on_path and tree.parent[i] not in within and not tree.off[i]:
            kids.setdefault(tree.parent[i], []).append(i)
    whole = tree.tag[home] in ("article", "main")
    beside = {i for mine in kids.values() if len(mine) > 1 for i in (_beside(tree, mine, on_path, density, threshold, chars, link_chars, titled) if not whole else [i for i in mine if density[i] >= threshold > 0])}
    for i in _threads(tree, home, chars):
        tree.off[i] = True
    chosen = [False] * n
    chosen[home] = True
    for i in range(1, n):  # parents come first
        p = tree.parent[i]
        if tree.off[i] or (tree.off[p] and p):
            tree.off[i] = True
            continue
        if i in on_path:
            chosen[i] = i in within
        elif p in within and p != best and tree.tag[home] == "main":
            chosen[i] = density[i] >= threshold or 2 * link_chars[i] <= chars[i]
        elif p in on_path and p not in within:
            chosen[i] = i in beside
        else:
            chosen[i] = chosen[p]
    blocks, now, last = [], [], -1
    for i, text in tree.texts:
        if not chosen[i]:
            continue
        if i != last:
            blocks.append(" ".join("".join(now).split()))
            now, last = [], i
        now.append(text)
    blocks.append(" ".join("".join(now).split()))
    return "\n\n".join(b for b in blocks if b)


def extract_main_text(pages: DataFrame, html_col: str = "html", carried: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per page the carried columns and ``text``; one pass without shuffle over the whole pages."""
    return scan_texts(pages, list(carried), html_col, "text string", lambda: lambda pages: [pa.array([main_text(x) for x in pages.to_pylist()], pa.string())])
