"""Main text of a web page by tree scoring.

A page is read into a tree (unclosed paragraphs, list items and cells end where
the next begins). Subtrees that hold no article text are set aside first:
scripts, styles, forms, menus, headers, footers, sidebars, and elements whose
role, class or id names a notice, an advert, a sidebar, comments and so on. A
form, class or id alone is weak evidence, so its text is read, and the element
stays when it holds the page's principal article or main, or (unless it is named
as comments, a notice or an advert) most of the text outside links. A heading's
class or id says nothing, and neither does an id of a section (both are often made
from the heading's words). Inside an article a name counts only as a whole (related
or related-posts, not related-work): a class of an advert, a notice or comments sets
its element aside, any other name only if a form control in it or links around half
of its text bear that out. Every
block of text gives points, for its length and its commas, to the element that
contains it, and smaller shares to two more ancestors. An element's score is its
points discounted by link density (the share of its characters inside links).
The best container wins, or the article or main around it, and what stands beside
that is kept by its link density. Without an article or main the same is done on
every level up to the page, so titles, code and short paragraphs around the best
container stay. The blocks of all that are the text, in page order.

White space inside a block becomes one space, and character references are
decoded. Defined results: null or empty html gives an empty text; a page without
any block outside the parts set aside gives an empty text; nesting of any depth
and unclosed tags, comments and quotes are read to the end, in time linear in the
page: what a tag closes and which block a text belongs to are read off the tops of
stacks of their own.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.llm.common import utf8

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ASIDE_TAGS = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video head title nav footer aside form button select"
    " textarea input dialog menu noembed noframes xmp fieldset".split()
)
FORM_TAGS = frozenset("form fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion cookie cookies"
    " consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social sidebar"
    " nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment comments commentlist disqus replies reply"
    " respond related recommended recommendations widget pagination pager login toolbar skip".split()
)
# Of those, names of parts that can be longer than the article beside them.
PART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored cookie cookies consent gdpr newsletter"
    " comment comments commentlist disqus replies reply respond".split()
)
# Words that add nothing to a name of a part: comment-list, share-buttons.
PART_WORDS = frozenset(
    "area block box button buttons container content form group holder inner item items link links list outer panel post posts section"
    " slot unit wrap wrapper".split()
)
CONTROLS = frozenset("input select textarea button".split())
# With one of these, a compound class tells the state of a page, not what the element is: has-sidebar, comments-open.
STATES = frozenset("has no with without open closed enabled disabled free".split())
# How an element is set aside: for certain; with links or controls in it; if it does not hold the page's text; a part never does by length alone.
CERTAIN, BORNE_OUT, LIKELY, PART = 1, 2, 3, 4
PAGE_HEADS = frozenset("header head pageheader siteheader topbar".split())
CLOSES_P = BLOCKS - frozenset("caption td th tr tbody thead tfoot dd dt li option optgroup legend summary body html title".split())
# A tag ends the innermost open element of its family if that is one of the named kinds.
CLOSES = {
    "li": ("list", ("li",)),
    "dt": ("terms", ("dt", "dd")),
    "dd": ("terms", ("dt", "dd")),
    "tr": ("table", ("tr", "td", "th")),
    "td": ("table", ("td", "th")),
    "th": ("table", ("td", "th")),
    "option": ("select", ("option",)),
}
FAMILIES = {"list": "ul ol menu dir li", "terms": "dl dt dd", "table": "table tr td th", "select": "select option"}
FAMILY = {tag: family for family, tags in FAMILIES.items() for tag in tags.split()}
CONTAINERS = frozenset("article blockquote body center div html main section".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TAG_REST = re.compile(r"""[^"'>]*""")
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[a-z0-9]+")
COMMAS = re.compile("[,،、，]")
SHARES = (1.0, 0.5, 1 / 3)  # of a block's points, to the container and its ancestors
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
MENU_DENSITY = 0.5  # with more of its characters inside links, a block is a menu


class Page:
    """The tree of one page as parallel lists; nodes are in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.aside, self.last = ["#root"], [-1], [False], [0]
        self.doubtful: dict[int, int] = {}  # BORNE_OUT, LIKELY and PART nodes
        self.controls: list[int] = []  # the elements that hold form controls
        self.blocks: list[tuple[int, list[tuple[int, str, bool]]]] = []  # owner, pieces of text: node, text, inside a link
        self._stack, self._open, self._fresh = [0], {}, True
        self._blocks, self._families = [0], {family: [] for family in FAMILIES}  # open nodes
        self._read(source)
        if self.doubtful:
            self._settle()

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        no_quote = {'"': n + 1, "'": n + 1}  # from here on there is no such quote
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                break
            if lt > at:
                self._text(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif s.startswith(("<!", "<?"), lt):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                closing = s.startswith("</", lt)
                name = NAME.match(s, lt + 1 + closing)
                if not name:
                    if closing:  # a bogus comment
                        end = s.find(">", lt)
                        at = n if end < 0 else end + 1
                    else:
                        self._text("<")
                        at = lt + 1
                    continue
                tag, end = name.group().lower(), name.end()
                while True:  # to the tag's end, over quoted values
                    end = TAG_REST.match(s, end).end()
                    if end >= n or s[end] == ">":
                        break
                    close = -1 if end >= no_quote[s[end]] else s.find(s[end], end + 1)
                    if close < 0:
                        no_quote[s[end]] = min(no_quote[s[end]], end)
                        end += 1
                    else:
                        end = close + 1
                rest, at = s[name.end() : end], min(n, end + 1)
                if closing:
                    self._close(tag)
                else:
                    self._start(tag, rest)
                    if tag in RAW:
                        found = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(s, at)
                        at = n if found is None else found.start()
        while len(self._stack) > 1:
            self._pop()
        self.last[0] = len(self.tag) - 1

    def _text(self, raw: str) -> None:
        if self.aside[self._stack[-1]]:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not self._fresh:
            pieces = self.blocks[-1][1]
        elif text.isspace() or not text:
            return
        else:
            pieces = []
            self.blocks.append((self._blocks[-1], pieces))
            self._fresh = False
        pieces.append((self._stack[-1], text, bool(self._open.get("a"))))

    def _start(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._fresh = True
        if tag == "br":
            self._text(" ")
        if tag in CLOSES_P and self._open.get("p"):
            self._close("p")
        if tag in CLOSES:
            family, kinds = CLOSES[tag]
            opened = self._families[family]
            while opened and self.tag[opened[-1]] in kinds:
                self._close(self.tag[opened[-1]])
        if tag in CONTROLS:
            self.controls.append(self._stack[-1])
        if tag in VOID:
            return
        node, above = len(self.tag), self._stack[-1]
        self.tag.append(tag)
        self.parent.append(above)
        self.last.append(node)
        found = self._aside_by(tag, rest)
        self.aside.append(self.aside[above] or found == CERTAIN)
        if found > CERTAIN and not self.aside[above]:
            self.doubtful[node] = found
        self._stack.append(node)
        self._open[tag] = self._open.get(tag, 0) + 1
        if tag in BLOCKS:
            self._blocks.append(node)
        if tag in FAMILY:
            self._families[FAMILY[tag]].append(node)

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._fresh = True
        if not self._open.get(tag):
            return
        while self._pop() != tag:
            pass

    def _pop(self) -> str:
        node = self._stack.pop()
        self.last[node] = len(self.tag) - 1
        tag = self.tag[node]
        self._open[tag] -= 1
        if tag in FAMILY:
            self._families[FAMILY[tag]].pop()
        if tag in BLOCKS:
            self._blocks.pop()
            self._fresh = True
        return tag

    def _aside_by(self, tag: str, rest: str) -> int:
        """0, CERTAIN, BORNE_OUT, LIKELY or PART."""
        if tag in ASIDE_TAGS and tag not in FORM_TAGS:
            return CERTAIN
        in_article = self._open.get("article", 0) > 0
        if tag == "header" and not in_article:
            return CERTAIN
        found = LIKELY if tag in FORM_TAGS else 0
        if not rest or rest.isspace() or tag in ("html", "body"):
            return found
        for m in ATTRIBUTE.finditer(rest):
            name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return CERTAIN
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return CERTAIN
            if name == "role" and value in ASIDE_ROLES:
                if value != "form":
                    return CERTAIN
                found = max(found, LIKELY)
            if name in ("class", "id") and tag != "main" and tag not in HEADINGS:
                for token in value.split():
                    found = max(found, self._named(tag, name, token, in_article))
        return found

    def _named(self, tag: str, attribute: str, token: str, in_article: bool) -> int:
        """What one word of a class or id says."""
        words = WORDS.findall(token)
        if len(words) > 1 and not STATES.isdisjoint(words):
            return 0
        part, aside = not PART_NAMES.isdisjoint(words), not ASIDE_NAMES.isdisjoint(words)
        if in_article or (tag == "section" and attribute == "id"):
            if not aside or not all(w in ASIDE_NAMES or w in PART_WORDS for w in words):
                return 0
            return PART if part and attribute == "class" else BORNE_OUT
        if part:
            return PART
        return LIKELY if aside or token.replace("-", "") in PAGE_HEADS else 0

    def _settle(self) -> None:
        """Sets aside the doubtful elements that do not hold the page's text."""
        n = len(self.tag)
        text, plain = [0] * n, [0] * n  # characters outside links; those outside doubtful elements too
        linked_text, controls = [0] * n, [0] * n
        for node in self.controls:
            controls[node] += 1
        doubted = [False] * n
        for node in range(1, n):
            doubted[node] = doubted[self.parent[node]] or node in self.doubtful
        for _, pieces in self.blocks:
            for node, piece, linked in pieces:
                size = len(SPACE.sub(" ", piece).strip())
                if linked:
                    linked_text[node] += size
                else:
                    text[node] += size
                    plain[node] += 0 if doubted[node] else size
        for node in range(n - 1, 0, -1):
            for counts in (text, plain, linked_text, controls):
                counts[self.parent[node]] += counts[node]
        holders = []
        for tag in ("main", "article"):
            found = [i for i in range(n) if self.tag[i] == tag and not self.aside[i] and self.doubtful.get(i) != PART and text[i]]
            if found:
                holder = max(found, key=lambda i: (text[i], -i))
                # A main with more text of its own than an article in a doubtful element: that one is a teaser.
                if not (holders and doubted[holder] and plain[holders[0]] > text[holder]):
                    holders.append(holder)
        for node in range(1, n):
            if self.aside[self.parent[node]]:
                self.aside[node] = True
            elif node in self.doubtful:
                holds = any(node <= h <= self.last[node] for h in holders)
                most = self.doubtful[node] != PART and 2 * text[node] > text[0]
                borne_out = self.doubtful[node] != BORNE_OUT or controls[node] or linked_text[node] >= text[node]
                self.aside[node] = bool(borne_out) and not (holds or most)


def main_text(source: str) -> str:
    """The main text of one page: blocks joined by newlines."""
    page = Page(source)
    blocks = []
    for owner, pieces in page.blocks:
        pieces = [p for p in pieces if not page.aside[p[0]]]
        text = SPACE.sub(" ", "".join(p[1] for p in pieces)).strip()
        if text:
            blocks.append((owner, text, sum(len(p[1]) for p in pieces if p[2])))
    if not blocks:
        return ""
    n = len(page.tag)
    points, chars, linked_chars = [0.0] * n, [0] * n, [0] * n
    for owner, text, linked in blocks:
        chars[owner] += len(text)
        linked_chars[owner] += min(linked, len(text))
        node = owner if page.tag[owner] in CONTAINERS or owner == 0 else page.parent[owner]
        worth = 1 + len(COMMAS.findall(text)) + len(text) / 100
        for share in SHARES:
            points[node] += worth * share
            node = page.parent[node]
            if node < 0:
                break
    for node in range(n - 1, 0, -1):  # children come after their parents
        chars[page.parent[node]] += chars[node]
        linked_chars[page.parent[node]] += linked_chars[node]
    density = [linked_chars[i] / chars[i] if chars[i] else 0.0 for i in range(n)]
    score = [points[i] * (1 - density[i]) for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    around = best
    while around > 0 and page.tag[around] not in ("article", "main"):
        around = page.parent[around]
    top = around if around > 0 else best
    kept, path = [False] * n, [False] * n
    kept[top] = True
    node = page.parent[top]
    while node >= 0:
        path[node] = True
        _keep_children(page, node, chars, density, kept, path)
        node = -1 if around > 0 else page.parent[node]
    for node in range(1, n):
        kept[node] = kept[node] or kept[page.parent[node]]
    return "\n".join(
        text for owner, text, linked in blocks if kept[owner] or (path[owner] and linked <= MENU_DENSITY * len(text))
    )


def _keep_children(page: Page, parent: int, chars, density, kept, path) -> None:
    """Marks the children that are no menus. A heading made of links goes with
    what it heads."""
    children, child = [], parent + 1
    while child <= page.last[parent]:
        if chars[child]:
            children.append(child)
        child = page.last[child] + 1
    follows = False  # the next child stays
    for child in reversed(children):
        if kept[child] or path[child]:
            follows = True
            continue
        kept[child] = density[child] <= MENU_DENSITY or (page.tag[child] in HEADINGS and follows)
        follows = kept[child]


def main_text_column(source: Column) -> Column:
    """The main text of each page; empty if there is none."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(str(b.as_py(), "utf-8", "replace")) for b in batch], pa.string())

    return extract(utf8(source))
