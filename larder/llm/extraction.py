"""HTML extraction: a minimum cut labels the blocks of a page as content or boilerplate.

A page is read into blocks (runs of text between block-level tags) and the elements above them. A
linear classifier gives every block and element a signed cost: positive ones are capacities from
the content terminal, negative ones capacities to the boilerplate terminal. Smoothness edges join
blocks that follow each other, blocks with their element and elements with their parent. The
blocks on the content side of the minimum cut are the main text.

A page is one row and its blocks never leave it, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larder.llm.common import with_struct

# Costs of the classifier, in tenths; above zero speaks for content.
ROOT, ARTICLE, CONTENT_WORD, MARKED, INNER_HEADER, OUTSIDE_ARTICLE = 40, 10**9, 60, -200, -30, -200
LONG_TEXT, SOME_TEXT, SHORT_TEXT, SENTENCE, HEADING, LINKED, LEGAL = 30, 10, 0, 10, 20, -60, -40
# Smoothness: block and its element, element and parent, neighbours below one element, other neighbours.
IN_ELEMENT, IN_PARENT, SAME_ELEMENT, NEXT_BLOCK = 100, 100, 20, 10
IN_MARKED, OF_MARKED = 200, 0  # what lies in a marked element holds to it; it does not hold to its parent
LONG_CHARS, SOME_CHARS = 80, 25

_set = lambda text: frozenset(text.split())
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title xmp iframe noembed noframes")
INLINE = _set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var"
)
DROPPED = _set("head script style noscript template svg iframe object canvas audio video")
MARKED_TAGS = _set("nav footer aside form button select option label fieldset textarea dialog menu datalist")
MARKED_ROLES = _set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar")
MARKED_WORDS = _set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner "
    "sidebar nav navbar navigation menu breadcrumb breadcrumbs pagination pager masthead topbar toolbar footer "
    "header cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended widget comment comments commentlist disqus respond "
    "reply replies search skip"
)
COMMENT_WORDS = _set("comment comments commentlist disqus respond reply replies")
CONTENT_WORDS = _set("article content post entry story main body text")
ALLOWING = _set("with has no without")  # "content with-sidebar" is no sidebar
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
CLOSES = {
    "li": _set("li"), "dt": _set("dt dd"), "dd": _set("dt dd"), "tr": _set("tr td th"), "td": _set("td th"),
    "th": _set("td th"), "option": _set("option"),
}
SCOPES = _set("ul ol dl table select div section article main body html")

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LEGAL = re.compile(r"©|all rights reserved|\bcopyright\b", re.I)
_SENTENCE_END = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")


class _Page:
    """Elements (parent, tag, evidence) and blocks (element, text, linked characters) of one page."""

    def __init__(self, html: str):
        self.parent, self.tag, self.evidence, self.holds = [-1], ["body"], [ROOT], [False]
        self.marked = [False]  # is, or lies in, a menu, footer, sidebar or comment
        self.articles: set[int] = set()
        self.blocks: list[tuple[int, str, int]] = []
        self.stack: list[tuple[str, int, bool]] = [("body", 0, False)]  # tag, element, is dropped
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.linked = 0
        self.read(html)
        self.flush()

    def flush(self) -> None:
        words = "".join(self.parts).split()
        if words:
            self.blocks.append((self.stack[-1][1], " ".join(words), self.linked))
        self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        if raw and not self.stack[-1][2]:
            plain = unescape(raw)
            self.parts.append(plain)
            if self.open["a"]:
                self.linked += sum(map(len, plain.split()))

    def read(self, html: str) -> None:
        at, size, tags = 0, len(html), _TAG
        while at < size:
            begin = html.find("<", at)
            if begin < 0:
                begin = size
            self.text(html[at:begin])
            if begin == size:
                return
            at = begin
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                at = size if end < 0 else end + 3
            elif html.startswith(("<!", "<?"), at):
                end = html.find(">", at)
                at = size if end < 0 else end + 1
            elif not html[at + 1 : at + 3].lstrip("/")[:1].isalpha():
                self.text("<")
                at += 1
            else:
                found = tags.match(html, at)
                if found is None and tags is _TAG:
                    tags = _PLAIN_TAG  # a quote stays open to the end: from here on tags end at the next >
                    found = tags.match(html, at)
                if found is None:
                    if html.find(">", at) < 0:
                        return  # a tag that is cut off
                    self.text("<")
                    at += 1
                    continue
                at = found.end()
                name = found[2].lower()
                if found[1]:
                    self.close(name)
                else:
                    self.begin(name, found[3])
                    if name in RAW and self.stack[-1][0] == name:
                        end = _RAW_END[name].search(html, at)
                        at = size if end is None else end.start()

    def pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1

    def begin(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.text(" ")
            return
        unseen = name in DROPPED or name in RAW
        if name not in INLINE and not unseen:
            self.flush()
            if self.open["p"]:
                depth = len(self.stack) - 1
                while self.stack[depth][0] in INLINE:
                    depth -= 1
                if self.stack[depth][0] == "p":
                    del_from = depth
                    while len(self.stack) > del_from:
                        self.pop()
            closed = CLOSES.get(name, ())
            depth = len(self.stack) - 1
            while closed and depth > 0 and self.stack[depth][0] not in SCOPES:
                if self.stack[depth][0] in closed:
                    while len(self.stack) > depth:
                        self.pop()
                depth -= 1
        if name in VOID:
            return
        _, element, dropped = self.stack[-1]
        dropped = dropped or unseen
        if not dropped and (name not in INLINE or name == "span"):
            evidence = self.classify(name, attributes, element)
            if name == "span" and evidence != MARKED:
                evidence = None
                self.marked.pop()
            if evidence is not None:
                self.flush()
                self.parent.append(element)
                self.tag.append(name)
                self.evidence.append(evidence)
                self.holds.append(False)
                element = len(self.parent) - 1
                if evidence == ARTICLE or (name == "h1" and evidence >= 0):
                    above = element
                    while above >= 0 and not self.holds[above]:
                        self.holds[above] = True
                        above = self.parent[above]
                if evidence == ARTICLE:
                    self.articles.add(element)
        self.stack.append((name, element, dropped))
        self.open[name] += 1

    def close(self, name: str) -> None:
        if not self.open[name]:
            return
        seen = name not in DROPPED and name not in RAW
        if (name not in INLINE and seen) or (self.stack[-1][0] == "span" and self.tag[self.stack[-1][1]] == "span"):
            self.flush()
        if name in INLINE:  # does not close block elements that are still open
            depth = len(self.stack) - 1
            while depth > 0 and self.stack[depth][0] in INLINE and self.stack[depth][0] != name:
                depth -= 1
            if self.stack[depth][0] != name:
                return
        while self.stack[-1][0] != name:
            self.pop()
        self.pop()

    def classify(self, name: str, attributes: str, element: int) -> int:
        given = {}
        for found in _ATTRIBUTE.finditer(attributes):
            key = (found[1] or found[3]).lower()
            given.setdefault(key, unescape((found[2] or "").strip("\"'")))
        words, allowed = set(), False
        self.marked.append(self.marked[element] or name in ("nav", "footer", "aside"))
        for key in ("class", "id"):
            for word in _NAME_PARTS.findall(given.get(key, "")):
                word = word.lower()
                if not allowed:
                    words.add(word)
                allowed = word in ALLOWING
        role = given.get("role", "").lower()
        style = given.get("style", "").replace(" ", "").lower()
        if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
            return MARKED
        if words & COMMENT_WORDS or self.marked[-1]:
            self.marked[-1] = True
            return MARKED
        if name in ("article", "main") or role in ("main", "article") or given.get("itemprop") == "articleBody":
            return ARTICLE
        if name in MARKED_TAGS or role in MARKED_ROLES:
            return MARKED
        if name == "header" or "header" in words:
            if self.in_article(element):
                return INNER_HEADER
            self.marked[-1] = name == "header"
            return MARKED
        if words & MARKED_WORDS:
            return MARKED
        return CONTENT_WORD if words & CONTENT_WORDS and name not in HEADINGS else 0

    def in_article(self, element: int) -> bool:
        return any(self.open[t] for t in ("article", "main")) or element in self.articles


def _block_cost(tag: str, text: str, linked: int, inside: bool, held: bool) -> int:
    n = len(text)
    cost = LONG_TEXT if n >= LONG_CHARS else SOME_TEXT if n >= SOME_CHARS else SHORT_TEXT
    cost += SENTENCE if _SENTENCE_END.search(text) else 0
    cost += HEADING if tag in HEADINGS else 0
    cost += LINKED * min(linked, n) // n
    if not inside and n < 4 * LONG_CHARS and _LEGAL.search(text):
        cost += LEGAL
    return cost + (OUTSIDE_ARTICLE if held and not inside else 0)


def _content_side(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the content side of a minimum cut: Dinic's maximum flow on the residual graph.

    A cost above zero is a capacity from the content terminal, below zero one to the other terminal.
    """
    n = len(costs)
    near: list[list[int]] = [[] for _ in range(n)]
    end, left = [], []
    for a, b, weight in edges:
        near[a].append(len(end))
        near[b].append(len(end) + 1)
        end += [b, a]
        left += [weight, weight]
    excess = [max(c, 0) for c in costs]
    room = [max(-c, 0) for c in costs]
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if excess[i])
        for i in queue:
            level[i] = 0
        met = False
        while queue:
            i = queue.popleft()
            met = met or room[i] > 0
            for e in near[i]:
                if left[e] and level[end[e]] < 0:
                    level[end[e]] = level[i] + 1
                    queue.append(end[e])
        if not met:
            break
        turn = [0] * n
        for start in range(n):
            path: list[int] = []
            i = start
            while excess[start]:
                if room[i]:
                    push = min([excess[start], room[i], *(left[e] for e in path)])
                    excess[start] -= push
                    room[i] -= push
                    for e in path:
                        left[e] -= push
                        left[e ^ 1] += push
                    path, i = [], start
                    continue
                while turn[i] < len(near[i]):
                    e = near[i][turn[i]]
                    if left[e] and level[end[e]] == level[i] + 1:
                        break
                    turn[i] += 1
                if turn[i] < len(near[i]):
                    path.append(near[i][turn[i]])
                    i = end[path[-1]]
                elif path:
                    i = end[path.pop() ^ 1]
                    turn[i] += 1
                else:
                    break
    content = [not r for r in room]  # ties go to content: only what still reaches the other terminal is left out
    queue = deque(i for i in range(n) if room[i])
    while queue:
        for e in near[queue.popleft()]:
            if left[e ^ 1] and content[end[e]]:
                content[end[e]] = False
                queue.append(end[e])
    return content


def main_text(html: str | None) -> tuple[str, int, int]:
    """The main text of a page, its number of blocks and of blocks kept."""
    page = _Page(html or "")
    blocks = page.blocks
    if not blocks:
        return "", 0, 0
    used = sorted(_with_parents(page.parent, {b[0] for b in blocks}))
    place = {element: i for i, element in enumerate(used)}
    within: dict[int, bool] = {}  # element is an article or below one; parents come first
    below: dict[int, bool] = {-1: False}  # element is marked or below a marked one
    costs, edges = [], []
    for element in used:
        evidence, above = page.evidence[element], page.parent[element]
        if evidence == MARKED and page.holds[element] and not page.marked[element]:
            evidence = 0  # a form or a named box around the whole page
        costs.append(evidence)
        within[element] = element in page.articles or within.get(above, False)
        below[element] = evidence == MARKED or below[above]
        if above >= 0:
            weight = IN_MARKED if below[above] else OF_MARKED if below[element] else IN_PARENT
            edges.append((place[element], place[above], weight))
    held = any(within[b[0]] for b in blocks)
    first = len(used)
    for i, (element, text, linked) in enumerate(blocks):
        costs.append(_block_cost(page.tag[element], text, linked, within[element], held))
        edges.append((first + i, place[element], IN_MARKED if below[element] else IN_ELEMENT))
        if i:
            same = page.parent[element] == page.parent[blocks[i - 1][0]]
            edges.append((first + i, first + i - 1, SAME_ELEMENT if same else NEXT_BLOCK))
    kept = _content_side(costs, edges)[first:]
    text = "\n".join(b[1] for b, keep in zip(blocks, kept) if keep)
    return text, len(blocks), sum(kept)


def _with_parents(parent: list[int], elements: set[int]) -> set[int]:
    found = set()
    for element in elements:
        while element >= 0 and element not in found:
            found.add(element)
            element = parent[element]
    return found


RESULT = StructType([
    StructField("text", StringType(), False),
    StructField("n_chars", LongType(), False),
    StructField("n_blocks", LongType(), False),
    StructField("n_kept", LongType(), False),
])


def extract(pages: DataFrame, html: str = "html", into: str = "main", keep: list[str] | None = None) -> DataFrame:
    """Adds the struct ``into``: main text, its code points, blocks of the page and blocks kept.

    Null and empty pages, and pages without text, have the empty text. White space inside a block
    becomes one space, blocks are joined by one line feed in page order, and character references
    are decoded once. Broken markup is read as far as it goes: unclosed elements end with the page
    and a tag that is cut off is dropped. Repeated rows and extra columns stay; a column named
    ``into`` is replaced.
    """

    def setup():
        def run(values: list[str | None]) -> list[dict]:
            out = []
            for value in values:
                text, n_blocks, n_kept = main_text(value)
                out.append({"text": text, "n_chars": len(text), "n_blocks": n_blocks, "n_kept": n_kept})
            return out

        return run

    return with_struct(pages, [html], into, RESULT, setup, keep)
