"""Page extraction: cuts against brute force, and pages with a known article."""

import itertools
import random

import pytest

from cloakline.llm import pages

SHAPES = pages.log_odds({(s, y): 10 for s in range(72) for y in (0, 1)})  # says nothing: markup alone


def cut_cost(costs, edges, side):
    return (sum(c for c, s in zip(costs, side) if c > 0 and not s) - sum(c for c, s in zip(costs, side) if c < 0 and s)
            + sum(c for a, b, c in edges if side[a] != side[b]))


def test_cut_is_least_and_largest():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randrange(1, 8)
        costs = [draw.randrange(-5, 6) for _ in range(n)]
        edges = [(*draw.sample(range(n), 2), draw.randrange(1, 5)) for _ in range(draw.randrange(0, 12))] if n > 1 else []
        got = pages.least_cut(costs, edges)
        every = [list(s) for s in itertools.product([False, True], repeat=n)]
        best = min(cut_cost(costs, edges, s) for s in every)
        assert cut_cost(costs, edges, got) == best
        assert sum(got) == max(sum(s) for s in every if cut_cost(costs, edges, s) == best)


PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar no-js"><header id="masthead"><h1>No site</h1><form action="/s"><input name=q><button>No find</button></form></header>
<nav><ul><li><a href="/a">No</a><li><a href="/b">No</a></ul></nav><div class="cookie-notice">No cookies, please. <a>OK</a></div>
<main><!-- no --><article><header><h1>Yes: a &lt;title&gt; &amp; more</h1></header><p>Yes, the first
   paragraph&nbsp;of it.<div class="ad">No, buy this. It is a whole sentence.</div><p>Yes, <b>bold<br>and <a href=x>linked</a>.
<ul><li>yes item one<li>yes item <i>two</ul><aside>No: see also this other page.</aside><blockquote>Yes, a quote.</blockquote>
<table><tr><td>yes a<td>yes b</table><pre>yes   code &copy; &#233;</pre><p>Yes</p><footer>No: posted by someone</footer></article>
<section id="comments"><h2>No</h2><article class="comment"><p>No, a reader's long comment, with commas, and a full stop.</p></article></section></main>
<aside class="sidebar"><p>No, teaser text of a sidebar.</p></aside><noscript>No script</noscript><footer>&copy; no</footer><script>no"""
WANT = """Yes: a <title> & more
Yes, the first paragraph of it.
Yes, bold and linked.
yes item one
yes item two
Yes, a quote.
yes a
yes b
yes code © é
Yes"""
PLAIN = """<div id=wrap><div id="top-menu"><a>no</a> | <a>no</a></div><div><p>Yes, a story without any markup of its own, told at length.</p>
<div class="newsletter">No, subscribe.</div><p>Yes, it ends here.</p></div><div class="widget">No</div></div>"""


def test_article_of_a_page():
    assert pages.main_text(PAGE, SHAPES) == WANT
    assert pages.main_text(PLAIN, SHAPES) == "Yes, a story without any markup of its own, told at length.\nYes, it ends here."


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain text", "plain text"), ("<", "<"), ("a < b &am c &amp d", "a < b &am c & d"), ("<p>", ""), ("</p></div>x", "x"),
    ("<!-- open <p>no", ""), ("<script>no", ""), ("<p>a<p>b</div>c", "a\nb\nc"), ("<p title='a>b'>c</p>", "c"),
    ("<P>x</P><SCRIPT>no</Script >y", "x\ny"), ("<form><article><p>yes</p></article><p>no</p></form>", "yes"),
    ("<nav>no</nav>", ""), ("<div hidden>no</div><p style='display: none'>no</p>yes", "yes"), ("<textarea>no</textarea>yes", "yes"),
])
def test_small_pages(page, want):
    assert pages.main_text(page, SHAPES) == want


def test_long_pages():
    text = "".join(f"<p>Yes, paragraph {i} of a long page.</p>" + ("<div class=ad>No.</div>" if i % 3 == 0 else "") for i in range(4000))
    got = pages.main_text(f"<nav>no</nav><article>{text}</article>", SHAPES).split("\n")
    assert got == [f"Yes, paragraph {i} of a long page." for i in range(4000)]
    deep = "<div>" * 3000 + "yes" + "</div>" * 3000
    assert pages.main_text(deep, SHAPES) == "yes"


def test_through_spark(spark):
    rows = [(i, f"u{i}", p) for i, p in enumerate([PAGE, PAGE, PLAIN, None, "", "<nav>no</nav>"])] + [(None, None, PAGE)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, row string")
    got = pages.extract(df, out="main").collect()
    assert sorted((r["page_id"] or 0, r["main"][:3], r["text"], r["row"]) for r in got)[0][2:] == ("x", "y")
    by = {r["page_id"]: r["main"] for r in got}
    assert by[0] == by[1] == by[None] == WANT and by[3] == by[4] == by[5] == ""
    assert pages.extract(df.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark):
    """Every page of the given table marks its article: the text is its blocks, whole."""
    import html
    import re
    from cloakline.llm import queries
    sf = "/root/testdata/sf0.01"
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op13_pages(spark, sf).collect()
    assert len(got) == len(source)
    for r in got:
        article = re.search("<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
