"""HTML extraction by tree scoring.

A page is parsed into a light tree, and elements whose tag, role or state says that they hold no article text
(menus, page headers, footers, sidebars, forms, dialogs, scripts, styles, hidden parts) are cut off. Then

1. each paragraph gives points for its length and its commas to its ancestors, less with each level; a container's
   points are discounted by its link density;
2. the words of class and id weigh on the points: a block with a telling name ("article-comments", "main-nav", "ad-slot") is cut unless it
   holds most of the page's points; one with a doubtful name ("share", "related", "discussion", "alert") must earn its place by
   the points of its own paragraphs, and is cut where it is built like reader comments;
3. the container with the most points is kept. From it up to the article or body around it, siblings are kept that score well
   or read like its paragraphs and headings; inside an article or main, those that hold text and are no list of links.

Scale: pages are independent; the work is a map over Arrow batches without a shuffle, and a task
holds one batch of pages.

Edge cases: null or empty html gives an empty text; markup that is not closed or nested wrongly is repaired
as browsers do it for paragraphs and lists; repeated rows are extracted alike; an empty table
gives an empty result; other columns are not read; whole pages are read, whatever their length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formbook.llm.common import ship

#: Elements whose content is no text of the page. What ``math`` holds is text, but for its annotations.
_RAW = frozenset("script style noscript template svg iframe object textarea select title annotation annotation-xml".split())
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption header footer nav aside form fieldset address details summary hr center".split())
_CLOSES = {  # an open element of these is closed by the start of the key
    **{t: ("p",) for t in _BLOCK - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "summary"}},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
_SCOPE = frozenset("html body table td th ul ol dl div article section main blockquote form aside nav header footer figure".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and roles that never hold article text.
_CUT_TAGS = frozenset("nav footer aside form button fieldset dialog menu".split())
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words of class and id that name such parts (reader comments first), and words that only hint at them.
_COMMENT_WORDS = frozenset("comment comments commentlist commenter commentary disqus replies responses talkback guestbook".split())
_TELLING = _COMMENT_WORDS | frozenset(
    "nav navbar navigation menu menus sidebar sidebars footer masthead breadcrumb breadcrumbs pagination pager paging cookie cookies consent gdpr newsletter subscribe subscription signup "
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors popup modal overlay outbrain taboola toolbar skip skiplink".split()
)
_DOUBTFUL = frozenset("aside header share sharing social related recommended recommendations register reply respond letters search alert notice notices feedback login form widget widgets banner promo promos promotion".split())
#: Nouns that say nothing of what is inside, so that the word before them names the part; words that only say that a part is there.
_PLAIN_NOUNS = frozenset("section sections list box container wrapper wrap area block blocks item items link links button buttons bar left right top bottom main slot unit inner outer group panel body content text thread row column col icons zone region holder posts articles stories news topics".split())
_ABOUT = frozenset("has with no without show hide is layout page template".split())
#: Words that mark an article, and those that mark the head of a comment.
_ARTICLE_WORDS = frozenset("article post entry story section chapter content".split())
_AUTHOR_WORDS = frozenset("author user username avatar byline commenter nickname".split())
_DATE_WORDS = frozenset("date time timestamp posted ago datetime".split())
#: Points that a block of a doubtful name must have: about one paragraph of 250 characters with two commas.
EARNED = 5.0


class Node:
    __slots__ = ("articles", "attrs", "author", "children", "commas", "date", "heads", "inner_n", "link_n", "links", "names", "own", "parent", "points", "scope", "tag", "text_n")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.attrs = tag, parent, attrs
        #: The article or main that the node is in.
        self.scope: Node | None = None if parent is None else parent if parent.tag in ("article", "main") else parent.scope
        self.children: list = []
        self.points, self.own, self.text_n, self.link_n = 0.0, 0.0, 0, 0
        self.names: list[list[str]] = []


class Scanner:
    """Tags of a page from left to right, in time linear in its length: what one look finds (the next sign of a kind, or that there is none) serves the next looks too."""

    def __init__(self, source: str):
        self.source, self.seen, self.quotes = source, {}, True

    def find(self, what: str, at: int) -> int:
        """The first place of ``what`` from ``at`` on, or the page's length; ``at`` only grows for each ``what``."""
        if self.seen.get(what, -1) < at:
            found = self.source.find(what, at)
            self.seen[what] = len(self.source) if found < 0 else found
        return self.seen[what]

    def tag_end(self, at: int) -> int:
        """The > that ends a tag, not one inside quotes. From the first tag on whose quotes leave it without one, quotes are plain signs."""
        if self.quotes and self.find(">", at) < len(self.source):
            here = at
            while (end := self.find(">", here)) < len(self.source):
                quote = min(self.find('"', here), self.find("'", here))
                if end <= quote:
                    return end
                here = self.source.find(self.source[quote], quote + 1) + 1
                if not here:
                    break
            self.quotes = False
            self.seen.clear()
        return self.find(">", at)

    def tags(self) -> Iterator[tuple[int, int, str | None, bool, str]]:
        """(start, end, name, closing, attributes); name is None for what is dropped: comments, declarations, scripts and the like."""
        source, at, n = self.source, 0, len(self.source)
        while (start := self.find("<", at)) < n:
            at = start + 1
            if source.startswith("<!--", start):
                end = min(self.find("-->", start + 4) + 3, n)
                yield start, end, None, False, ""
            elif source.startswith(("<!", "<?"), start):
                if (end := self.find(">", at) + 1) > n:
                    return  # no tag ends any more
                yield start, end, None, False, ""
            elif m := _NAME.match(source, start):
                name = m[2].lower()
                end = self.tag_end(m.end()) if name not in _RAW else self.find(">", m.end())
                if end >= n:
                    return  # no tag ends any more
                attrs = source[m.end() : end]
                end += 1
                if name in _RAW and not m[1]:
                    if not attrs.endswith("/"):
                        closes = re.compile(rf"</{name}\s*>", re.I).search(source, end)
                        end = closes.end() if closes else n
                    yield start, end, None, False, ""
                else:
                    yield start, end, name, bool(m[1]), attrs
            else:
                continue
            at = end


def parse(source: str) -> Node:
    root = Node("html", None)
    at, here = 0, root
    #: Open elements, and of each scope among them how many of each tag are open in it.
    path, inside, overall = [root], [Counter()], Counter()

    def shut(upto: int) -> Node:
        """Close the open elements from place ``upto`` of the path on."""
        while len(path) > upto:
            node = path.pop()
            overall[node.tag] -= 1
            if node.tag in _SCOPE:
                inside.pop()
            inside[-1][node.tag] -= 1
        return path[-1]

    for start, end, tag, closing, attrs in Scanner(source).tags():
        if start > at:
            here.children.append(source[at:start])
        at = end
        if tag is None:
            continue
        if closing:
            # An element is closed from inside its scope alone; scopes are closed from anywhere in them.
            if (overall if tag in _SCOPE else inside[-1])[tag] > 0:
                place = len(path) - 1
                while path[place].tag != tag:
                    place -= 1
                if place:
                    here = shut(place)
            continue
        if closes := _CLOSES.get(tag):
            place = len(path) - 1
            while place and any(inside[-1][t] > 0 for t in closes):
                node = path[place]
                if node.tag in closes:
                    here = shut(place)
                elif node.tag in _SCOPE:
                    break
                place -= 1
        if tag in ("html", "body") and here is root:
            root.tag = tag  # one root for both
            continue
        node = Node(tag, here, attrs)
        here.children.append(node)
        if tag not in _VOID and not attrs.endswith("/"):
            here = node
            path.append(node)
            overall[tag] += 1
            inside[-1][tag] += 1
            if tag in _SCOPE:
                inside.append(Counter({tag: 1}))  # itself too: a cell is closed by the next one
    if at < len(source):
        here.children.append(source[at:])
    return root


def around(node: Node) -> Node | None:
    """The article or main that a node is in."""
    return node.scope


def unwanted(node: Node) -> bool:
    """Whether tag, role or state alone says that a node holds no article text; notes the words of its names."""
    if node.tag == "head":
        return True
    attrs = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(node.attrs)} if node.attrs else {}
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    node.names = [w for n in named if (w := [x.lower() for x in re.findall("[A-Z]?[a-z]+|[A-Z]+", n)])]
    if node.tag in ("body", "html", "main"):
        return False
    if node.tag in _CUT_TAGS or attrs.get("role", "").lower() in _CUT_ROLES:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    return node.tag == "header" and around(node) is None


def naming(node: Node) -> frozenset:
    """The words that name what a block is: of each name its last word, and the one before plain nouns."""
    found = set()
    for words in node.names:
        if words[0] in _ABOUT and len(words) > 1:
            continue
        found.update(a + b for a, b in zip(words, words[1:], strict=False) if a + b in _TELLING)  # side-bar, sideBar
        at = len(words) - 1
        found.add(words[at])
        while at and words[at] in _PLAIN_NOUNS:
            at -= 1
        found.add(words[at])
    return frozenset(found)


def commented(node: Node) -> bool:
    """Built like reader comments: two children or more that each have an author and a date."""
    return node.heads >= 2


def named_away(node: Node, total: float, articles: bool, authors: bool) -> bool:
    """Whether the name or the build of a scored block, weighed with its points, cuts it off.

    ``total``: the points of the page's paragraphs; ``articles``: whether it has article or main elements with text; ``authors``: whether any name is one of an author.
    """
    if not node.names and not authors or node.tag in ("body", "html", "main") or node.tag not in _BLOCK and node.tag not in ("span", "a", "ins"):
        return False
    most = 2 * node.own > total
    if authors and not most and commented(node):
        return True
    words = naming(node)
    if not words & (_TELLING | _DOUBTFUL):
        return False
    if node.articles:
        return False
    if words & _COMMENT_WORDS and (articles or node.own < total):
        return True
    if words & _TELLING:
        return articles or not (most and node.own >= 3 * EARNED)
    if own_part(node):
        return False
    if "header" in words and (around(node) is not None or any(w in _ARTICLE_WORDS for n in node.names for w in n)):
        return False
    return (articles or not most) and node.own * (1 - node.link_n / max(node.text_n, 1)) < EARNED


def own_part(node: Node) -> bool:
    """A section of an article with a heading and a sentence of its own, whatever it is called."""
    if node.tag != "section" or node.scope is None or 4 * node.link_n > node.text_n:
        return False
    parts = [c for c in node.children if not isinstance(c, str)]
    return any(c.tag in _HEADINGS for c in parts) and any(c.tag == "p" and c.text_n for c in parts)


def lengths_of_runs(root: Node) -> None:
    """Give every block the length and the commas of the text that is in it but in no block inside it, as ``blocks_of`` would write it."""
    stack: list = [(root, False)]
    blocks, run = [root], []

    def flush() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            blocks[-1].inner_n += len(text)
            blocks[-1].commas += sum(map(text.count, ",،、，"))
            run.clear()

    while stack:
        x, ends = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif ends:
            flush()
            blocks.pop()
        elif x.tag == "br":
            run.append(" ")
        else:
            if x.tag in _BLOCK:
                flush()
                blocks.append(x)
                stack.append((x, True))
            stack.extend((c, False) for c in reversed(x.children))
    flush()


def summed(order: list[Node]) -> None:
    """For every node, from its descendants up: lengths of text and of links, commas, links, heads of comments, articles with text (but for those in comments)."""
    talk: set[int] = set()  # nodes that are comments, or in them
    for node in order:
        node.text_n = node.link_n = node.inner_n = node.commas = node.links = node.heads = 0
        words = {w for n in node.names for w in n}
        node.author, node.date, node.articles = bool(words & _AUTHOR_WORDS), node.tag == "time" or bool(words & _DATE_WORDS), False
        if node.parent is not None and id(node.parent) in talk or node.names and naming(node) & _COMMENT_WORDS:
            talk.add(id(node))
    if order:
        lengths_of_runs(order[0])
    for node in reversed(order):
        for c in node.children:
            if isinstance(c, str):
                node.text_n += len(c.strip())
        if node.tag == "a":
            node.link_n = node.text_n
            node.links += 1
        if (up := node.parent) is not None:
            up.text_n += node.text_n
            up.link_n += node.link_n
            up.inner_n += node.inner_n
            up.commas += node.commas
            up.links += node.links
            up.heads += node.author and node.date
            up.author |= node.author
            up.date |= node.date
            up.articles |= node.articles or node.tag in ("article", "main") and node.text_n > 0 and id(node) not in talk


def prune(root: Node) -> list[Node]:
    """Cut off what is unwanted; the nodes that stay, parents first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or not unwanted(c)]
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return order


def blocks_of(nodes: list) -> list[str]:
    """Texts of blocks in page order."""
    found, run = [], []
    stack: list = list(reversed(nodes))
    end = object()
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif x is end or x.tag in _BLOCK:
            found.append("".join(run))
            run = []
            if x is not end:
                stack.append(end)
                stack.extend(reversed(x.children))
        elif x.tag == "br":
            run.append(" ")
        else:
            stack.extend(reversed(x.children))
    found.append("".join(run))
    return [t for b in found if (t := " ".join(entities.unescape(b).split()))]


#: Levels above a paragraph that it gives points to.
LEVELS = 10


def score(order: list[Node]) -> list[Node]:
    """Give every container its points, and in ``own`` those of all paragraphs inside; containers that got any."""
    summed(order)
    for node in order:
        node.points, node.own = 0.0, 0.0
    scored = {}
    for node in order:
        leaf = node.tag in ("p", "pre", "td", "blockquote", "dd", "li") or node.tag in _BLOCK and any(isinstance(c, str) and c.strip() for c in node.children)
        if not leaf or node.text_n < 25 or node.parent is None:
            continue
        length, commas = (node.inner_n, node.commas) if node.tag != "td" else (sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str)), sum(c.count(x) for c in node.children if isinstance(c, str) for x in ",،、，"))
        points = (1 + commas + min(length / 100, 3.0)) * (1 - node.link_n / max(node.text_n, 1))
        node.own += points
        up, level = node.parent if node.tag != "div" or any(not isinstance(c, str) and c.tag == "p" for c in node.children) else node, 0
        while up is not None and level < LEVELS:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[id(up)] = up
            up, level = up.parent, level + 1
    for node in reversed(order):
        if node.parent is not None:
            node.parent.own += node.own
    for node in scored.values():
        node.points *= (1 - node.link_n / max(node.text_n, 1)) * (1.25 if any(n[-1] in _ARTICLE_WORDS for n in node.names) or node.tag in ("article", "main") else 1.0)
    return list(scored.values())


def link_list(node: Node) -> bool:
    """A block that is mostly links, and several of them."""
    return node.tag in ("ul", "ol", "div", "table", "section", "dl") and node.link_n > 0.7 * node.text_n and node.links >= 3


def reads(node: Node, best: Node, before: bool) -> bool:
    """Whether a sibling of the best container, or of one around it, belongs to the text."""
    density = node.link_n / max(node.text_n, 1)
    if around(node) is not None:
        return bool(node.text_n) and density < 0.7
    if node.points >= max(10.0, 0.2 * best.points):
        return True
    if node.tag in _HEADINGS:
        return before and density < 0.5
    return node.tag == "p" and node.text_n > 0 and (density < 0.25 if node.text_n > 80 else density == 0 and bool(re.search(r"[.!?…](?:\s|$)", "".join(blocks_of([node])))))


def extract(source: str | None) -> str:
    """The main text of a page."""
    if not source:
        return ""
    root = parse(source)
    order = prune(root)
    scored = score(order)
    total, articles = root.own, root.articles
    authors = any(w in _AUTHOR_WORDS for x in order for n in x.names for w in n)
    stack, cut = [root], False
    while stack:
        node = stack.pop()
        kept = [c for c in node.children if isinstance(c, str) or not named_away(c, total, articles, authors)]
        cut |= len(kept) < len(node.children)
        node.children = kept
        stack.extend(c for c in kept if not isinstance(c, str))
    if cut:
        order = prune(root)
        scored = score(order)
    best = max(scored, key=lambda x: x.points, default=None)
    if best is None:
        articles = [x for x in order if x.tag in ("article", "main")]
        best = max(articles, key=lambda x: x.text_n, default=root)
    # From the best container up: what stays of each level stands around what stays of the level below.
    chosen: deque = deque([best])
    node, scope = best, best if best.tag in ("article", "main") else around(best)
    inside = scope is not None

    def stays(c, before: bool) -> bool:
        return inside and bool(c.strip()) if isinstance(c, str) else reads(c, best, before)

    while node.parent is not None and node is not scope:
        siblings, place = node.parent.children, next(i for i, c in enumerate(node.parent.children) if c is node)
        chosen.extendleft(c for c in reversed(siblings[:place]) if stays(c, True))
        chosen.extend(c for c in siblings[place + 1 :] if stays(c, False))
        node = node.parent
    chosen = list(chosen)
    stack = [c for c in chosen if not isinstance(c, str)]
    while stack:
        node = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not link_list(c)]
        stack.extend(c for c in node.children if not isinstance(c, str))
    return "\n\n".join(blocks_of(chosen))


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship(pages.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(of, "page_id long, url string, text string, n_chars long")
