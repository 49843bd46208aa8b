"""Main text of pages and personal data."""

import hashlib
import html
import re

import numpy as np
import pytest

import messy
from convoy.llm import html_text, pii
from convoy.llm.common import read_table
from convoy.llm.queries import op7_html_extraction, op8_pii_spans

SF = "/root/testdata/sf0.01"


def test_articles_of_the_tables(spark):
    pages = {r.page_id: r.html for r in read_table(spark, SF, "pages").collect()}
    rows = op7_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        bare = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))
        assert r.text == " ".join(html.unescape(bare).split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize(("source", "want"), [
    ("", ""), ("plain text", "plain text"), ("<p>x", "x"), ("<script>never closed <p>hi", ""), ("<article><p>a<!-- unfinished", "a"),
    ("<div class=ad>buy</div><div><p>Hello <b>wor</b>ld &amp; more</p><p>again</p></div>", "Hello world & more again"),
    (
        "<body><header>Top</header><main><h1>T</h1><p>Some text long enough to count here.</p><section class='comments'><p>I agree a "
        "lot and this comment is longer than the article itself, yes it is.</p></section></main><aside>side</aside><form><label>mail"
        "</label><input></form></body>", "T Some text long enough to count here.",
    ),
    (
        "<body><div id=content><h2>Title</h2><p>First part with text, quite long for what it is.</p><p>Second part also.</p></div>"
        "<div class=sidebar><a href=x>l1</a><a href=y>l2</a></div></body>", "Title First part with text, quite long for what it is. Second part also.",
    ),
    ("<ul><li>one<li>two</ul>", "one two"), ("<a href=\"x>broken</a> text <p>more", "broken text more"), ("<article>a&nbsp;\n b&#233;&lt;</article>", "a bé<"),
])
def test_pages(source, want):
    assert html_text.main_text(source) == want


ARTICLE = "<article><h1>Title</h1><p>Some text of an article that is long enough to count.</p></article>"
ARTICLE_TEXT = "Title Some text of an article that is long enough to count."
BARE = "<h1>Title</h1><p>Some text of a page that has no such element, and it goes on.</p><p>More.</p>"
BARE_TEXT = "Title Some text of a page that has no such element, and it goes on. More."


@pytest.mark.parametrize(("source", "want"), [
    *((f"<body><nav>x</nav><div class='{c}'>{ARTICLE}</div><div class=footer>f</div></body>", ARTICLE_TEXT) for c in (
        "container has-sidebar", "page-with-comments", "sidebar", "modal", "widget alert")),
    (f"<body><form id=aspnetForm action=x><div id=nav>n</div>{ARTICLE}<input></form></body>", ARTICLE_TEXT),
    (f"<body><form id=aspnetForm><div class=menu><a href=x>n</a></div><div id=content>{BARE}</div></form></body>", BARE_TEXT),
    (f"<body><div class='promo'><div>{BARE}</div></div><div class='sidebar'><a href=x>n</a></div></body>", BARE_TEXT),
    (f"<div class=comments><div>{ARTICLE}</div></div>", ARTICLE_TEXT),
    ("<article><div class='article-header'><h1>T</h1></div><p class='market-share'>Shares fell.</p><div class=header>H</div></article>", "T Shares fell. H"),
    (f"<main>{ARTICLE}<section id=comments><article><p>{'I agree. ' * 30}</p></article></section></main>", ARTICLE_TEXT),
    (f"<body>{ARTICLE}<div class='related'><article>Read on</article></div><form><article>Sign up</article></form></body>", ARTICLE_TEXT),
    (f"<body><div class=x>{BARE}</div><div class='comment-list'><p>{'I agree. ' * 30}</p></div><div class='sidebar-left'>side</div></body>", BARE_TEXT),
    ("<article><p>Text here.</p><div class='ad-slot'>buy</div><div class='adslot_3'>buy</div><div class='share-buttons'>tweet</div><form>mail</form></article>", "Text here."),
])
def test_wrappers_are_no_noise(source, want):
    assert html_text.main_text(source) == want


def test_deep_page():
    assert html_text.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"


def test_messy_pages(spark):
    rows = [(1, "u", "<p>a</p>", "old", "h"), (None, None, None, None, None), (1, "u", "<p>a</p>", "old", "h"), (2, "v", "", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _x string")
    out = html_text.extract_text(pages)
    assert out.columns == ["page_id", "url", "html", "_x", "text", "n_chars"]
    assert sorted(((r.text, r.n_chars) for r in out.collect())) == [("", 0), ("", 0), ("a", 1), ("a", 1)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [d if k % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for k, d in enumerate(reversed(digits))]
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_of_the_tables(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    rows = op8_pii_spans(spark, SF).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[0] == k for b in base) for k in PLAIN)
        line = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(line) <= set(spans)
        found += len(spans) - len(line)
        for span in spans:
            kind, a, b = span.split(":")
            assert kind != "secret" or re.fullmatch(r"[0-9A-Za-z_+/=-]{16,}", texts[r.doc_id][int(a): int(b)])
    tokens = sum(len(re.findall(r'(?i)token = "[0-9a-f]{40}"', t or "")) for t in texts.values())
    assert tokens * 0.9 <= found <= tokens + 20


def brute(lattice, weights):
    """(log of the sum over all segmentations, the best score), by trying each."""
    scores = lattice.features @ weights
    starting = {}
    for k, (i, j) in enumerate(lattice.segments):
        starting.setdefault(i, []).append((j, k))

    def walk(i):
        if i == lattice.n:
            return [0.0]
        out = list(walk(i + 1))
        for j, k in starting.get(i, []):
            out += [s + scores[k, kind] for s in walk(j) for kind in range(scores.shape[1])]
        return out

    every = np.array(walk(0))
    return np.logaddexp.reduce(every), every.max()


def test_dynamic_programs_equal_enumeration():
    rng = np.random.default_rng(7)
    for text in ("a1 b2", "x@y.z 3", "10.0.1", "+1 (2) 3"):
        lattice = pii.Lattice(text, 0, len(text))
        weights = rng.normal(size=(len(pii.FEATURES), len(pii.KINDS)))
        total, best = brute(lattice, weights)
        chance, whole = lattice.posteriors(weights)
        assert whole == pytest.approx(total) and (chance <= 1 + 1e-9).all()
        found = lattice.decode(weights)
        assert sum((lattice.features @ weights)[k, kind] for k, kind in found) == pytest.approx(best)
        ends = [lattice.segments[k] for k, _ in found]
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:])) and all(j - i <= pii.LONGEST for i, j in ends)


def test_messy_rows(spark):
    docs = messy.frame(spark)
    out = pii.mark_pii(docs, pii.train(docs))
    rows = out.collect()
    assert len(rows) == len(messy.ROWS) and {"_hash", "a b", "size"} <= set(out.columns)
    odd = next(r for r in rows if r.doc_id == 2**60 + 1)
    assert (odd.n_email, odd.n_ip, odd.n_card, odd.n_phone) == (1, 1, 1, 1)
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if not r.text)
    assert pii.mark_pii(messy.empty(spark), pii.train(messy.empty(spark))).count() == 0


UUID, MIXED, PREFIXED = "550e8400-e29b-41d4-a716-446655440000", "a1b2c3d4e5f6a7b8", "sk-proj-4f9a8b7c6d5e4f3a-1b2c"
BASE64 = "a1B2/c3D4+e5F6/g7H8+i9J0/k1L2+m3N4/o5P6+q7R8/s9T0+u1V2/w3X4+y5Z6/a7B8+c9D0/e1F2+g3H4/=="


@pytest.mark.parametrize("key", [UUID, MIXED, PREFIXED, BASE64, "7" * 16, "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6"])
def test_every_labelled_key_is_a_candidate(key):
    text = f'api_key = "{key}" # 1'
    ((kind, a, b),) = [s for s in pii.silver(text) if pii.KINDS[s[0]] == "secret"]
    lattice = pii.Lattice(text, 0, len(text))
    assert text[a:b] == key and (a, b) in {(lattice.starts[i], lattice.ends[j - 1]) for i, j in lattice.segments}
    assert len(lattice.segments) == len(set(lattice.segments))


def test_keys_of_many_tokens_are_found():
    examples = [(t, pii.silver(t)) for k in range(6) for t in (
        f'x{k} token = "{UUID[:-1]}{k}" y', f"api_key: {MIXED[:-1]}{k} and", f"secret={PREFIXED}{k}\n", f'auth = "{BASE64[:-3]}{k}==" z', f"in {1990 + k} we had {k} of 12-{k}", f"v1.{k}.0 is out")]
    weights = pii.fit_model(examples)
    for key in (UUID.replace("55", "9c"), "f9e8d7c6b5a4f3e2", PREFIXED.replace("4f", "0b"), BASE64.replace("a1", "zQ9")):
        text = f'the token = "{key}" of 12 others'
        added = pii.find_spans(text, weights)[1]
        assert [text[a:b] for kind, a, b in added if pii.KINDS[kind] == "secret"] == [key]


def test_labels_without_a_segment_are_reported():
    text = "mail a1b2c3d4e5f6g7h8@mail.example.org now"
    with pytest.warns(UserWarning, match="1 labelled span"):
        pii.fit_model([(text, pii.silver(text))])


def plain_core(source):
    """Density, sums, core and threshold by recursion over a nested list of (tag, children), for well-formed pages."""
    from html.parser import HTMLParser
    from math import e, log

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = ("body", [])
            self.stack = [self.root]

        def handle_starttag(self, tag, attrs):
            if tag not in ("html", "body"):
                node = (tag, [])
                self.stack[-1][1].append(node)
                if tag not in html_text.VOID:
                    self.stack.append(node)

        def handle_endtag(self, tag):
            if tag not in ("html", "body"):
                self.stack.pop()

        def handle_data(self, data):
            self.stack[-1][1].append(data)

    reader = Reader()
    reader.feed(source)

    def size(text):
        return len("".join(text.split()))

    def counts(node, link=False):
        link = link or node[0] == "a"
        c = t = lc = lt = 0
        for child in node[1]:
            if isinstance(child, str):
                c, lc = c + size(child), lc + link * size(child)
            elif child[0] not in html_text.NOISE_TAGS:
                a = counts(child, link)
                own = child[0] == "a" or child[0] not in html_text.INLINE and child[0] not in html_text.VOID
                c, t, lc, lt = c + a[0], t + a[1] + own, lc + a[2], lt + a[3] + (link or child[0] == "a")
        return c, t, lc, lt

    all_c, _, all_lc, _ = counts(reader.root)

    def density(c, t, lc, lt):
        if not c:
            return 0.0
        base = log(c / max(1, c - lc) * lc + all_lc / all_c * c + e)
        return max(0.0, c / max(1, t) * log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / log(base)) if base > 1 else c / max(1, t) * log(max(e, c))

    def of(node, link=False):
        c, t, lc, lt = counts(node, link)
        return density(c, t + 1, lc, lt)

    def walk(node, link=False):
        link = link or node[0] == "a"
        own = sum(size(x) for x in node[1] if isinstance(x, str))
        kids = [x for x in node[1] if not isinstance(x, str) and x[0] not in html_text.NOISE_TAGS]
        yield node, density(own, 1, own if link else 0, 1 if link else 0) + sum(of(k, link) for k in kids)
        for k in kids:
            yield from walk(k, link)

    nodes = list(walk(reader.root))
    best = max(total for _, total in nodes)
    core = next(node for node, total in nodes if total >= best - 1e-9)

    def text(node):
        return "".join(x if isinstance(x, str) else (" " + text(x) + " " if x[0] not in html_text.INLINE else text(x)) for x in node[1])

    return core[0], " ".join(html.unescape(text(core)).split())


def test_core_is_that_of_a_plain_version(spark):
    pages = [
        "<body><div><p>One long paragraph of text here.</p><p>Another <b>one</b> of text.</p></div><div><a href=x>link</a><a href=y>link two</a></div></body>",
        "<body><section><h2>Head</h2><p>Words and words and words.</p><ul><li>item one</li><li>item two</li></ul></section><p>short</p></body>",
    ]
    for source in pages:
        tag, want = plain_core(source)
        page = html_text.Page(source)
        core = page._densities()[0]
        assert page.tag[core] == tag and html_text.main_text(source).startswith(want[:10]) and want in html_text.main_text(source)


def test_articles_are_found_without_their_tag(spark):
    for r in read_table(spark, SF, "pages").collect():
        renamed = re.sub(r"(</?)article>", r"\1div>", r.html)
        assert html_text.main_text(renamed) == html_text.main_text(r.html)


@pytest.mark.parametrize("unit", ['<a "', "</i>", "<b>", '<a ">" ', "<hr><span>", "<header></header><div>", "<a ", "<li><b>"])
def test_broken_pages_take_time_in_proportion(unit):
    import time

    source = unit * (1_000_000 // len(unit))
    start = time.process_time()
    html_text.main_text("<b>" * 1000 + source + "'")
    assert time.process_time() - start < 15


def test_long_stretch_of_numbers_is_bounded():
    import tracemalloc

    weights = np.zeros((len(pii.FEATURES), len(pii.KINDS)))
    weights[0] = -4.0
    peaks = []
    for n in (4000, 16_000):
        tracemalloc.start()
        pii.find_spans("12 34 " * (n // 6), weights)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 5 * peaks[0] and peaks[1] < 300 * 16_000
