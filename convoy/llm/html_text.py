"""Main text of web pages by composite text density.

The page is read into a tree. For every node, C characters and T tags below it, of which LC characters and LT tags in
links, give the composite density

    C / T * log_b(C / LC * T / LT),   b = ln(C / (C - LC) * LC + LCb / Cb * C + e),

with LCb and Cb of the body. T counts the node itself; bold type, line breaks and other inline tags but links are part
of the text and do not count. A node's sum is that of its children's densities, own text counting as a child. The node
with the largest sum is the core, of equal ones an ``article`` or ``main`` before others and the outermost; the smallest
density on the path from the body to it is the threshold. The text is that of every largest-sum subtree below nodes
that reach the threshold, and of headings that stand before the core in elements around it below the body. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out before densities
are computed.

Forms and what only its class, id or role calls noise may be a wrapper of the text, so this noise is lifted from the
elements around the longest article, and on pages without one from those around the core that hold most of the page's
text. Reader comments are taken for the article only if there is no other. A class or id counts as a whole, or by its
first word where that word names nothing else (``sidebar-left``, but not ``has-sidebar`` or ``share-price``).

Reading takes time in proportion to the page: stray end tags are told by a count of open elements, and once a quote is
left open, tags before it end at their first ``>``.

Defined results: a very long page is read whole; ties are settled as said above; a null or empty page and one without text outside those parts and wrappers give an empty text; broken markup is
read as far as it can be (unclosed and stray tags, unquoted attributes, unfinished comments); rows that are equal or
share an id get a row each; an empty table gives an empty table. Other columns are carried through; ``text`` and
``n_chars`` are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import shelter, small_batches

COLUMNS = ("text", "n_chars")

#: The elements of HTML that have no content, that hold raw text, and that are inline.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Elements that never hold article text.
NOISE_TAGS = frozenset(
    "script style noscript template head title nav footer aside button select option textarea iframe svg canvas "
    "object embed dialog menu audio video map xmp noembed noframes".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Classes and ids that mark adverts, menus, notices, sidebars, forms and comments.
NOISE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended "
    "recommendations share sharing social comment comments commentlist disqus reply replies respond footer header "
    "masthead pagination pager toolbar skip topbar "
    "site-header site-footer page-footer global-header global-footer main-nav main-menu main-navigation site-nav site-navigation "
    "nav-menu nav-bar nav-links menu-bar top-bar top-nav tool-bar side-bar left-sidebar right-sidebar left-nav right-nav "
    "share-bar share-buttons share-links social-bar social-buttons social-icons social-links social-media social-share "
    "related-articles related-content related-links related-posts related-stories recommended-articles recommended-posts "
    "comment-area comment-form comment-list comment-section comments-area comments-list comments-section "
    "reader-comments user-comments post-comments reply-form login-form signup-form search-form skip-link skip-to-content "
    "google-ad banner-ad top-ad side-ad ad-banner".split()
)
#: First words of hyphenated classes and ids that name nothing but noise.
NOISE_PREFIXES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored sponsors promo cookie cookies "
    "consent gdpr popup modal newsletter navbar breadcrumb breadcrumbs sidebar commentlist disqus pagination".split()
)
#: Classes and ids of reader comments.
_REPLIES = frozenset(
    "comment comments commentlist disqus reply replies respond comment-area comment-form comment-list comment-section "
    "comments-area comments-list comments-section reader-comments user-comments post-comments reply-form".split()
)
#: The own state of an element: text, noise that nothing lifts, noise that may wrap the text, reader comments.
_TEXT, _HARD, _SOFT, _REPLY = range(4)
#: Elements whose start ends an open element of the second kind.
_CLOSES = {
    **{t: frozenset(["p"]) for t in (
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
        "main menu nav ol p pre section table ul"
    ).split()},
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
#: Closing by start tags does not reach beyond these.
_FENCES = frozenset("html body article section main div td th table ul ol dl blockquote aside nav header footer form figure".split())
#: Open elements among which the start of another looks for one to end; others are passed over.
_MARKS = _FENCES.union(*_CLOSES.values())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PARTS = re.compile(r"[a-z0-9]+")


class Page:
    """Nodes in page order; a node's parent stands before it."""

    def __init__(self, source: str):
        self.tag, self.parent, self.state = ["#root"], [-1], [_TEXT]
        self.texts: list[tuple[int, str, int]] = []  # (node, decoded text, block borders before it), in page order
        self.borders = 0
        self.open: Counter = Counter()  # open elements by name
        self.marks: list[int] = []  # depths of open elements in _MARKS
        self._plain_until, self._last_end = 0, source.rfind(">")
        stack, at, size, look = [0], 0, len(source), 0
        while (start := source.find("<", look)) >= 0:
            if source.startswith("<!", start) or source.startswith("<?", start):
                comment = source.startswith("<!--", start)
                end = source.find("-->", start + 4) + 2 if comment else source.find(">", start)
                end = size - 1 if end < (start + 4 if comment else start) else end
                name = None
            else:
                name = _NAME.match(source, start)
                end = self._tag_end(source, name.end()) if name else -1
                if end < 0:
                    look = start + 1
                    continue
            self._text(stack[-1], source[at:start])
            at = look = end + 1
            if name is None:
                continue
            tag = name[2].lower()
            if name[1]:
                self._close(stack, tag)
                continue
            self._open(stack, tag, source[name.end():end])
            if tag in RAW:
                found = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                at = look = size if found is None else found.start()
        self._text(stack[-1], source[at:])
        self.noise = self._noise()

    def _tag_end(self, source: str, start: int) -> int:
        """The place of the ``>`` that ends a tag, -1 if there is none. Quotes hide it, but not one that is left open."""
        if start > self._last_end:
            return -1
        at = start
        while at >= self._plain_until:
            stop = _STOP.search(source, at)
            if stop is None:
                self._plain_until = len(source)
            elif stop[0] == ">":
                return stop.start()
            else:
                end = source.find(stop[0], stop.end())
                if end < 0:
                    self._plain_until = len(source) if stop.start() == at else stop.start()
                    break
                at = end + 1
        return source.find(">", start)

    def _text(self, node: int, text: str) -> None:
        if text and self.tag[node] not in RAW:
            self.texts.append((node, html.unescape(text), self.borders))

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        ends = _CLOSES.get(name)
        if ends:
            for depth in reversed(self.marks):
                tag = self.tag[stack[depth]]
                if tag in ends:
                    self.borders += 1
                    self._cut(stack, depth)
                    break
                if tag in _FENCES:
                    break
        node = len(self.tag)
        self.borders += name not in INLINE
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.state.append(self._state(name, attributes))
        if name not in VOID:
            if name in _MARKS:
                self.marks.append(len(stack))
            self.open[name] += 1
            stack.append(node)

    def _cut(self, stack: list[int], depth: int) -> None:
        """Ends the open elements from ``depth`` on."""
        for node in stack[depth:]:
            self.open[self.tag[node]] -= 1
        while self.marks and self.marks[-1] >= depth:
            self.marks.pop()
        del stack[depth:]

    def _state(self, name: str, attributes: str) -> int:
        if name in NOISE_TAGS:
            return _HARD
        if name in ("html", "body", "article", "main"):
            return _TEXT
        if name == "header":
            return _TEXT if self._in_article() else _HARD
        state = _SOFT if name == "form" else _TEXT
        if "=" not in attributes:
            return state
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id"):
                for words in map(_PARTS.findall, value.split()):
                    whole = "-".join(words)
                    if whole in _REPLIES or words and words[0] in ("commentlist", "disqus"):
                        return _REPLY
                    if whole == "header" and self._in_article():
                        continue
                    if whole in NOISE_WORDS or words and words[0] in NOISE_PREFIXES:
                        state = _SOFT
            if key == "role" and value.strip() in NOISE_ROLES:
                state = _SOFT
        return state

    def _in_article(self) -> bool:
        return self.open["article"] + self.open["main"] > 0

    def _noise(self) -> list[bool]:
        """For each node, whether it or an element around it is noise; wrappers of the text are not."""
        n, state = len(self.tag), self.state
        if _SOFT in state or _REPLY in state:
            hard, reply, own = [False] * n, [False] * n, [0] * n
            for node in range(1, n):
                hard[node] = hard[self.parent[node]] or state[node] == _HARD
                reply[node] = reply[self.parent[node]] or state[node] == _REPLY
            for node, text, _ in self.texts:
                if not hard[node]:
                    own[node] += len("".join(text.split()))
            clean = list(own)  # characters below a node without the noise in it
            for node in range(n - 1, 0, -1):
                if state[node] == _TEXT:
                    clean[self.parent[node]] += clean[node]
            articles = [i for i in range(n) if self.tag[i] in ("article", "main") and clean[i] and not hard[i]]
            if articles:
                up = max(articles, key=lambda i: (not reply[i], clean[i], -i))
                while up > 0:
                    state[up] = _TEXT
                    up = self.parent[up]
            else:
                self._lift_core(hard, reply, own)
        out = [False] * n
        for node in range(1, n):
            out[node] = out[self.parent[node]] or state[node] != _TEXT
        return out

    def _lift_core(self, hard: list[bool], reply: list[bool], own: list[int]) -> None:
        """Lifts the noise around the core of the density sum from elements with more than half of the text."""
        n = len(self.tag)
        self.noise = [a or b for a, b in zip(hard, reply)]
        core, held = self._densities()[0], [0 if noise else c for noise, c in zip(self.noise, own)]
        for node in range(n - 1, 0, -1):
            held[self.parent[node]] += held[node]
        while core is not None and core > 0:
            if 2 * held[core] > held[0]:
                self.state[core] = _TEXT
            core = self.parent[core]

    def _close(self, stack: list[int], name: str) -> None:
        if not self.open[name]:
            return
        depth = len(stack) - 1
        while self.tag[stack[depth]] != name:
            depth -= 1
        self.borders += any(self.tag[n] not in INLINE for n in stack[depth:])
        self._cut(stack, depth)

    def _densities(self) -> tuple:
        """(core, body, density of each node, density sum of each node, whether a node is below the body and no noise)."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags, own = ([0] * n for _ in range(5))
        in_link = [False] * n
        for node in range(1, n):
            in_link[node] = self.tag[node] == "a" or in_link[self.parent[node]]
        for node, text, _ in self.texts:
            if not self.noise[node]:
                count = len("".join(text.split()))
                own[node] += count
                chars[node] += count
                link_chars[node] += count if in_link[node] else 0
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            if not self.noise[node]:
                chars[up] += chars[node]
                tags[up] += tags[node] + self._counts(node)
                link_chars[up] += link_chars[node]
                link_tags[up] += link_tags[node] + in_link[node]
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        if not chars[body]:
            body = 0
        if not chars[body]:
            return None, 0, [], [], []
        share = link_chars[body] / chars[body]

        def density(c: int, t: int, lc: int, lt: int) -> float:
            if not c:
                return 0.0
            base = log(c / max(1, c - lc) * lc + share * c + e)
            return max(0.0, c / max(1, t) * log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / log(base)) if base > 1 else c / max(1, t) * log(max(e, c))

        dense = [density(chars[i], tags[i] + 1, link_chars[i], link_tags[i]) for i in range(n)]
        total = [density(own[i], 1, own[i] if in_link[i] else 0, 1 if in_link[i] else 0) for i in range(n)]
        for node in range(n - 1, 0, -1):
            if not self.noise[node]:
                total[self.parent[node]] += dense[node]
        inside = [False] * n
        inside[body] = True
        for node in range(body + 1, n):
            inside[node] = inside[self.parent[node]] and not self.noise[node]
        core = max((i for i in range(n) if inside[i]), key=lambda i: (total[i], self.tag[i] in ("article", "main"), -i))
        return core, body, dense, total, inside

    def _counts(self, node: int) -> bool:
        tag = self.tag[node]
        return tag == "a" or tag not in INLINE and tag not in VOID

    def content(self) -> list[bool]:
        """For each node, whether its text belongs to the main text."""
        n = len(self.tag)
        core, body, dense, total, inside = self._densities()
        keep = [False] * n
        if core is None:
            return keep
        path, threshold, up = set(), dense[core], core
        while up != body:
            path.add(up)
            up = self.parent[up]
            threshold = min(threshold, dense[up])
        best = list(range(n))  # the largest sum below each node
        for node in range(n - 1, 0, -1):
            rival = self.parent[node]
            if inside[node] and total[best[node]] > total[best[rival]]:
                best[rival] = best[node]
        keep[core] = True
        for node in range(n):
            if inside[node] and node != body and (dense[node] >= threshold or node < core and self._heads(node, path)):
                keep[best[node]] = True
        for node in range(1, n):
            keep[node] = (keep[node] or keep[self.parent[node]]) and not self.noise[node]
        return keep

    def _heads(self, node: int, path: set[int]) -> bool:
        """Whether a node before the core is a heading, itself or within others, of an element around the core."""
        while self.tag[node] in _HEADINGS or self.tag[node] == "header":
            node = self.parent[node]
            if node in path:
                return True
        return False

    def text(self) -> str:
        """Blocks of the main text in page order, joined by one space."""
        keep = self.content()
        out, before = [], -1
        for node, text, borders in self.texts:
            if keep[node]:
                if borders != before:
                    out.append(" ")
                    before = borders
                out.append(text)
        return " ".join("".join(out).split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) taken from ``html``."""
    small_batches(pages.sparkSession, 500)
    plain, _, back = shelter(pages, COLUMNS)

    @F.pandas_udf("string")
    def run(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s) for s in sources], dtype=object)

    return plain.withColumn("text", run("html")).select(*back, "text", F.length("text").cast("long").alias("n_chars"))
