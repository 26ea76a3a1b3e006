from __future__ import annotations

import html as entities
import random
import re
import time
from collections import Counter

import pytest

from sensorspan.llm import html
from sensorspan.llm.common import table

from .conftest import SF

CASES = {
    "nothing": ("", ""),
    "plain article": ("<body><nav>Menu</nav><article><h1>T &amp; t</h1><p>a\n  b</p></article><footer>F</footer>", "T & t\n\na b"),
    "open paragraphs": ("<article><p><b>a<br>b<p>c</b><p>d</article>e", "a b\n\nc\n\nd"),
    "raw parts": ("<article>a<script>if (x<y) '</p>'</script><style>p{}</style> b<!-- c --></article>", "a b"),
    "inside the article": (
        "<article><p>a</p><aside>s</aside><div class='ad'>x</div><form><input value=v>go</form>"
        "<section id=comments><p>mine</p></section><div class='cookie-notice'>c</div><p>z</p></article>",
        "a\n\nz",
    ),
    "main": ("<header><h1>Site</h1></header><main><p>a</p></main><aside>b</aside>", "a"),
    "named content": ("<div class=top><p>n</p></div><div id=content><p>a<p>b</div>", "a\n\nb"),
    "lists and tables": ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
    "references": ("<article>&lt;p&gt; &#233;&#xe9; &eacute; &nbsp; x &unknown; &amp;amp;</article>", "<p> éé é x &unknown; &amp;"),
    "inline tags join": ("<article>a<i>b</i><a href=/>c</a> d</article>", "abc d"),
    "unended tag": ("<article><p>a</p><p", "a"),
    "odd quotes": ("<article><p title='>' data-x=\">\">a</p></article>", "a"),
    "hidden": ("<article><p hidden>a</p><p style='display: none'>b</p><p>c</p></article>", "c"),
    "a name on the body": ("<body class='sidebar nav'><article>a</article></body>", "a"),
    "an odd name around it": ("<div class='content has-sidebar'><p>t</p><article>Main text here.</article></div>", "Main text here."),
    "an odd name on it": ("<article class='post comment-open'>Main text here.</article>", "Main text here."),
    "a name that is a topic": ("<section id='social-policy'><article>Main text here.</article></section>", "Main text here."),
    "a form around it": ("<form action=/><input name=q>Search<article>Main text here.</article></form>", "Main text here."),
    "a part's name around it": ("<div class='widget'><article>Main text here.</article></div>", "Main text here."),
    "a part's name on it": ("<main><article class='post sponsored'>Main text here.</article></main>", "Main text here."),
    "comments that are articles": (
        "<article><p>Main text here.</p><section class='comments-area'><article class='comment'>First!</article></section></article>"
        "<div id=comments><article>Second!</article></div>",
        "Main text here.",
    ),
    "comments in main": ("<main><p>Main text here.</p><article class='comment'>First!</article></main>", "Main text here."),
    "an advert in a line": ("<article><p>a <span class=ad>Buy!</span> b</p></article>", "a b"),
    "an apostrophe in a bare value": ("<article title=it's>don't</article>", "don't"),
    "an unended value": ("<article><p title=\"x>a</p><p>b</p></article>", "a\n\nb"),
    "a header in the article": ("<article><header><h1>T</h1></header><p>a</p></article>", "T\n\na"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    source, text = CASES[name]
    assert html.article_text(html.parse(source)[0], set()) == text


def test_the_given_pages(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r for r in html.extract_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for page in rows:
        inside = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside)
        plain = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in blocks]
        text = "\n\n".join(b for b in plain if b)
        assert got[page["page_id"]]["text"] == text
        assert got[page["page_id"]]["n_chars"] == len(text)


def nameless(i, words):
    links = "".join(f"<a href=/{k}>Section {k}</a> " for k in range(5))
    return f"<html><body><div><p>Welcome to the site</p>{links}</div><div><h2>Title {i}</h2><p>{words}</p></div><div><p>All rights reserved</p></div></body></html>"


def test_templates_of_hosts_that_name_no_article(spark):
    draw = random.Random(3)
    rows = [(i, f"http://h{i % 2}.org/{i}", nameless(i, " ".join(draw.choices("abcdefgh", k=20)))) for i in range(40)]
    rows += [(100, "http://single.org/", nameless(100, "only page"))]
    got = {r["page_id"]: r["text"] for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, source in rows[:-1]:
        words = re.search(r"</h2><p>(.*?)</p>", source)[1]
        assert got[i] == f"Title {i}\n\n{words}"
    assert got[100] == "Welcome to the site\n\nTitle 100\n\nonly page\n\nAll rights reserved"


def test_copies_of_an_article_are_not_a_template(spark):
    same = "<body><article><h1>Same</h1><p>same words</p></article></body>"
    rows = [(i, "http://c.org/", same) for i in range(10)]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Same\n\nsame words"} and len(got) == 10


def test_classes_share_an_occurrence_vector(spark):
    pages = spark.createDataFrame([(i, "h", f"<div><p>fixed</p><p>{i}</p><ul>{'<li>x' * i}</ul></div>") for i in range(1, 7)], "page_id long, host string, html string")
    found = html.deduce_templates(html.page_tokens(pages)).collect()
    by = {r["token"]: r for r in found}
    once = {by[html.key("/div")]["class_id"], by[html.key("/div/ul")]["class_id"], by[html.key("/div/p\nfixed")]["class_id"]}
    assert len(once) == 1
    assert by[html.key("/div/ul/li")]["class_id"] not in once
    assert html.key("/div/p\n3") not in by


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://a.org/", "<article>x</article>"), (3, "http://a.org/", "<p>" + "word " * 100_000), (4, "http://a.org/", "text only"), (4, "http://a.org/", "text only")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for extra in ("token", "host", "text", "n", "body", "template"):
        frame = frame.withColumn(extra, frame["url"])
    got = sorted(((r["page_id"], r["n_chars"]) for r in html.extract_text(frame).collect()), key=str)
    assert got == sorted([(1, 0), (2, 0), (None, 1), (3, 499_999), (4, 9), (4, 9)], key=str)
    assert html.extract_text(frame.limit(0)).collect() == []


def articles(n, seed=5):
    draw = random.Random(seed)
    return [" ".join(draw.choices("abcdefghijkl", k=60)) for _ in range(n)]


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_a_notice_repeated_inside_the_articles_of_a_host_goes(spark):
    notice = "<div>Please support our work with a gift.</div>"
    texts = articles(12)
    rows = [(i, "http://n.org/", f"<article><h2>Summary</h2><p>{t}</p>{notice}</article>") for i, t in enumerate(texts)]
    rows += [(100 + i, f"http://m{i}.org/", f"<article><p>{t}</p>{notice}</article>") for i, t in enumerate(texts)]
    got = extracted(spark, rows)
    for i, t in enumerate(texts):
        assert got[i] == f"Summary\n\n{t}"
        assert got[100 + i] == f"{t}\n\nPlease support our work with a gift."  # one page tells nothing of its host


def test_versions_of_one_article_stay_whole(spark):
    same = articles(4)
    rows = [(i, "http://v.org/", "<article>" + "".join(f"<p>{t}</p>" for t in [*same, f"Version {i}"]) + "</article>") for i in range(8)]
    assert extracted(spark, rows) == {i: "\n\n".join([*same, f"Version {i}"]) for i in range(8)}


def test_classes_against_brute_force(spark):
    draw = random.Random(8)
    parts = ["<p>one</p>", "<p>two</p>", "<ul><li>x</ul>", "<div class=k>y</div>", "<ul><li>x<li>x</ul>", "<p>three</p>"]
    rows = [(i, f"h{i % 3}", "<div>" + "".join(draw.sample(parts, draw.randint(0, 6))) + "</div>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, host string, html string")
    got = {(r["host"], r["token"]): r for r in html.deduce_templates(html.page_tokens(pages)).collect()}
    expected = {}
    for host in ("h0", "h1", "h2"):
        bodies, vectors = {}, {}
        for _, h, source in rows:
            if h == host:
                blocks, tags = html.parse(source)
                body = "\n".join(b.text for b in blocks)
                counts = [Counter(tags), Counter(b.token for b in blocks)]
                tokens = [(t, False) for t in counts[0]] + [(t, True) for t in counts[1]]
                page = ([t for t, _ in tokens], [*counts[0].values(), *counts[1].values()], [k for _, k in tokens])
                bodies[body] = min(bodies.get(body, page), page)
        for body, (tokens, counts, kinds) in bodies.items():
            for token, n, is_text in zip(tokens, counts, kinds):
                vectors.setdefault((token, is_text), []).append((body, n))
        classes = {}
        for token, vector in vectors.items():
            classes.setdefault(frozenset(vector), []).append(token)
        for vector, members in classes.items():
            common = 2 * len(vector) >= len(bodies)
            if len(vector) >= html.MIN_PAGES and (common or not all(is_text for _, is_text in members)):
                expected.update({(host, token): (len(vector), common, frozenset(t for t, _ in members)) for token, _ in members})
    groups = {}
    for r in got.values():
        groups.setdefault((r["host"], r["class_id"]), set()).add(r["token"])
    assert {k: (r["n_pages"], r["common"], frozenset(groups[r["host"], r["class_id"]])) for k, r in got.items()} == expected and expected


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "<article>Main text here.</article>",
        "<span>x" * 100_000,
        "<p><button>" + "<div>a" * 100_000,
        "<div class=widget>a" * 50_000 + "<article>Main text here.</article>",
        "<a x " * 100_000 + "'",
        "<a b=\"" * 100_001,
        "<li>" * 100_000,
    ],
    ids=["nested", "inline", "paragraph", "parts", "tags", "quotes", "items"],
)
def test_time_grows_with_the_page(source):
    def seconds(page):
        start = time.process_time()
        text = html.article_text(html.parse(page)[0], set())
        return time.process_time() - start, text

    taken, text = seconds(source)
    assert taken < 5
    if "Main text" in source:
        assert text == "Main text here."
