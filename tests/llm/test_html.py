"""HTML extraction: minimum cuts against all labellings, pages by hand, and
the article element of the test pages."""

import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest

from aisle.llm import html_extract as he
from aisle.llm import queries


def energy(labels, costs, joins):
    total = sum(-c if x else 0 for x, c in zip(labels, costs))
    return total + sum(w for i, j, w in joins if labels[i] != labels[j])


def test_minimum_cut_against_all_labellings():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 9)
        costs = [rnd.uniform(-2, 2) for _ in range(n)]
        joins = [(i, j, rnd.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5]
        got = he.minimum_cut(np.array(costs), joins)
        best = min(energy(x, costs, joins) for x in itertools.product([False, True], repeat=n))
        assert energy(got, costs, joins) == pytest.approx(best)


def test_long_chain_of_doubt():
    n = 4000
    costs = np.array([0.4 if i % 7 else -1.5 for i in range(n)])
    joins = [(i, i + 1, 1.0) for i in range(n - 1)]
    low = [0.0, 0.0]  # the best of a chain, by dynamic programming
    for i in range(n):
        step = [min(low[x] + (1.0 if i and x != y else 0.0) for x in (0, 1)) - (costs[i] if y else 0) for y in (0, 1)]
        low = step
    assert energy(he.minimum_cut(costs, joins), costs, joins) == pytest.approx(min(low))


@pytest.mark.parametrize("inside", [
    '<svg class="i"/>', "<svg/>", "<SVG viewBox='0 0 > 1'\n/>", '<math display="block" />', "<svg><path d='M0'/><text>x</text></svg>", "<svg a='/'><g/>x</svg>",
    '<svg href=a/b width="1"/>', "<svg-icon name='x'></svg-icon>", "<title-bar></title-bar>", "<style-guide/>", "<math-field></math-field>",
    "<script-x></script-x>", "<svg:use></svg:use>", "<script>a</script >", "<title>t</title>"])
def test_raw_elements_end(inside):
    page = he.blocks(f"<body><p>a{inside} b</p><p>c</p></body>")
    assert [b.text for b in page] == ["a b", "c"]


def test_raw_element_names():
    assert [b.text for b in he.blocks("<p>a</p><title-bar>b</title-bar><p>c</p><style-guide>d</style-guide>")] == ["a", "b", "c", "d"]
    assert [b.text for b in he.blocks("<p>a</p><script/>b</script><p>c</p><svg>d")] == ["a", "c"]


PARAGRAPH = "A paragraph of the article with some words, and a comma. It has two sentences."


@pytest.mark.parametrize("before, after", [
    ("<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>", "<footer>&copy; host &middot; A sentence, in the footer.</footer>"),
    ("<header><div class=logo>Site name</div><p>A slogan, with words enough to look like text.</p></header>", "<aside><h3>Read more</h3><p>Another story, told in one long sentence.</p></aside>"),
    ("<div class='cookie-notice'><p>We use cookies, and here is a long sentence about them.</p></div>", "<section id='comments'><h2>Comments</h2><div class='comment'><p>I liked this article very much, thank you.</p></div></section>"),
    ("<div id=sidebar><p>Something by the side, in a sentence of its own.</p></div>", "<form><label>Your name</label><input><textarea>typed text</textarea><button>Send</button></form>"),
    ("<div class='ad'>Buy this thing now, it is a good thing to buy.</div><script>document.write('<p>no</p>')</script>", "<style>p{color:red}</style><!-- a <p>remark</p> --><noscript><p>no script</p></noscript>"),
    ("<div role='navigation'><a href=x>One</a> <a href=y>Two</a></div>", "<div class='newsletter-signup'>Subscribe to our letter, and read us every week.</div>"),
])
@pytest.mark.parametrize("container", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div>{}</div>"])
def test_pages_by_hand(before, after, container):
    inner = f"<h1>The title &amp; more</h1><p>{PARAGRAPH}<p><b>{PARAGRAPH}</p><p>Line<br>two,   <i>of\n</i> &#233;.</p><ul><li>A point of the list, in words.</li></ul>"
    page = f"<!DOCTYPE html><html><head><title>T</title><meta name=x></head><body>{before}{container.format(inner)}{after}</body></html>"
    assert he.extract(page) == f"The title & more\n{PARAGRAPH}\n{PARAGRAPH}\nLine two, of é.\nA point of the list, in words."


def test_comments_inside_the_article():
    page = f"<body><article><p>{PARAGRAPH}</p><div class='comments'><p>{PARAGRAPH} says a reader</p></div></article></body>"
    assert he.extract(page) == PARAGRAPH


SECOND = "The second paragraph tells more of it, in plain words. It ends here."
TWO = f"<p>{PARAGRAPH}</p><p>{SECOND}</p>"


@pytest.mark.parametrize("page, lines", [
    (f"<body class='has-sidebar no-ads'><div>{TWO}</div></body>", [PARAGRAPH, SECOND]),
    (f"<body class='sidebar'><div>{TWO}</div></body>", [PARAGRAPH, SECOND]),
    (f"<body><div id='page-sidebar'><div>{TWO}</div></div></body>", [PARAGRAPH, SECOND]),  # wraps the page
    (f"<body><div class='content-with-sidebar'>{TWO}</div></body>", [PARAGRAPH, SECOND]),
    (f"<body><form id='aspnetForm'><div>{TWO}<input><select><option>one</select></div></form></body>", [PARAGRAPH, SECOND]),
    (f"<body><article>{TWO}<section class='bottom-line'><p>{PARAGRAPH}</p></section></article></body>", [PARAGRAPH, SECOND, PARAGRAPH]),
    (f"<body><article>{TWO}<p id='author'>{PARAGRAPH}</p></article></body>", [PARAGRAPH, SECOND, PARAGRAPH]),
    (f"<body><article>{TWO}<p class='related-work'>{PARAGRAPH}</p></article></body>", [PARAGRAPH, SECOND, PARAGRAPH]),
    (f"<body><article><header><h1>Title</h1></header>{TWO}</article></body>", ["Title", PARAGRAPH, SECOND]),
    (f"<body><article>{TWO}<p>text <button>b</button> more</p></article></body>", [PARAGRAPH, SECOND, "text more"]),
    (f"<body><div class='x4'>We use cookies to improve your visit, and you can accept them.</div><div class='x9'>{TWO}</div></body>",
     [PARAGRAPH, SECOND]),
    (f"<body><div class='post entry sidebar'>{TWO}</div><div class='x'><a href=a>One</a></div></body>", [PARAGRAPH, SECOND]),
])
def test_names_that_mislead(page, lines):
    assert he.extract(page) == "\n".join(lines)


OPAQUE = ("<body><div class=q1><a href=a>Home</a> <a href=b>News</a></div><div class=k7><a href=c>Sport</a></div>"
          f"<div class=z2><h1>Title</h1><p>{PARAGRAPH}</p><p>Short.</p><p>{SECOND}</p><p>Three words here</p><p>{PARAGRAPH}</p></div>"
          "<div class=b0><a href=d>Imprint</a> <a href=e>Contact</a></div><div class=b1>Log in</div></body>")


def test_cut_decides_opaque_pages(monkeypatch):
    """No name says anything here: doubtful blocks reach the flow, and their
    labels are neither those of the names nor those of each block's looks."""
    reached = []
    plain = he._reachable
    monkeypatch.setattr(he, "_reachable", lambda nodes, cost, near: reached.extend(nodes) or plain(nodes, cost, near))
    assert he.extract(OPAQUE).split("\n") == ["Title", PARAGRAPH, "Short.", SECOND, "Three words here", PARAGRAPH]
    page = he.blocks(OPAQUE)
    assert all(b.evidence == 0 for b in page)
    assert len(reached) >= 2
    alone = he.costs_of(page) > 0
    kept = he.minimum_cut(he.costs_of(page), he.arcs(page))
    assert (alone != kept).any()


def test_names_and_looks_can_disagree():
    """A paragraph under a name of boilerplate in the middle of an article,
    told apart from a notice under the same name."""
    page = he.blocks(f"<article><p>{PARAGRAPH}</p><p class=widget>{SECOND}</p><p>{PARAGRAPH}</p><p class=widget>Subscribe</p></article>")
    assert list(he.minimum_cut(he.costs_of(page), he.arcs(page))) == [True, True, True, False]


@pytest.mark.parametrize("page", ["<b>" * 40000 + "<p>" * 40000, "<b>" * 40000 + "</div>" * 40000, "<b><div>" + "<i>" * 40000 + "</b>" * 40000,
                                  "<center>" * 40000 + "x", "<b>" * 40000 + "<p>x" * 40000])
def test_deep_pages_take_linear_time(page):
    start = time.process_time()
    he.extract(page)
    assert time.process_time() - start < 10


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p", ""), (f"<article><p>{PARAGRAPH}</p><p>cut <a href='x", f"{PARAGRAPH}\ncut"),
    (f"<article><p>{PARAGRAPH} 1 < 2 &amp &am</article>", f"{PARAGRAPH} 1 < 2 & &am"), ("<nav><a>x</a></nav>", ""),
    ("<article>" + "<div>" * 3000 + PARAGRAPH, PARAGRAPH), ("<article>" + f"<p>{PARAGRAPH}" * 5000, "\n".join([PARAGRAPH] * 5000)),
    ("<a href=\"" * 3000, "")])
def test_edge_cases(page, text):
    assert he.extract(page) == text


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op8_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]]["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert (r["text"], r["n_chars"]) == ("\n".join(filter(None, parts)), len("\n".join(filter(None, parts))))
        assert r["url"] == pages[r["page_id"]]["url"]


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert (he.fit(df, "page_id", "html") == he.WEIGHTS).all()
    odd = spark.createDataFrame([(1, None, "id"), (1, "<p>x", "id"), (None, f"<article>{PARAGRAPH}", "id")], "page_id long, html string, id string")
    weights = he.fit(odd, "page_id", "html")
    got = [r[0] for r in odd.select(he.extract_column(odd.html, weights)).collect()]
    assert got[0] == "" and got[1] in ("", "x") and got[2] == PARAGRAPH
