"""Main text of pages: reading broken markup, template counts, and the whole query."""

from __future__ import annotations

import html as references
import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from commitlake.llm import main_text as M
from commitlake.llm import queries, url_filter
from commitlake.llm.common import prepare

SCHEMA = "page_id long, url string, html string"


def text(source, template=()):
    return M.Page(source).main_text(set(template))[0]


@pytest.mark.parametrize(
    "source, want",
    [
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one two"),
        ("<p>o<b>n</b>e<br>two\n\t three</p>", "one two three"),
        ("<p>a &lt;b&gt; &#233; &#x1F600; &eacute;&nbsp;x &amp y", None),
        ("<div>a<div>b</div>c</div>d", "a b c d"),
        ("<script>var t='</p><p>no';</script>yes", "yes"),
        ("<SCRIPT>if (a<b) x='<i title=\"'</SCRIPT>yes<style>p{}</style>", "yes"),
        ("x<!-- <p>no</p> -->y<!-- open", "xy"),
        ("<script>never closed <p>no", ""),
        ("1 < 2 and 3 > 2 <3", "1 < 2 and 3 > 2 <3"),
        ("<p title='a>b' class=x>ok</p>", "ok"),
        ('<p title="open>still', "still"),
        ("</p></div></b>ok</article>", "ok"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
        ("<nav><a href=/>menu</a></nav>body<footer>no</footer>", "body"),
        ("<header>site</header><form>q<input value=x></form><aside>s</aside>body", "body"),
        ("<div class='side-bar ad'>no</div><div id=cookie-consent>no</div><div role=navigation>no</div>x", "x"),
        ("<body class='no-sidebar'><div class=sidebar-left><article>kept</article></div>", "kept"),
        ("outside<article><header><h1>T</h1></header><p>x<footer>no</footer><div class=comments>no</div></article>", "T x"),
        ("<main>intro<article>a</article></main>", "a"),
        ("<main>only main</main>rest", "only main"),
        ("<article>short</article><article>the much longer one</article>", "the much longer one"),
        ("<article><p>a</p></article><section class=comments><article class=comment>a long comment here</article></section>", "a"),
        ("<nav><ul><li>menu<article>inside an open menu</article>", "inside an open menu"),
        ("<div itemprop=articleBody>body</div>other", "body"),
        ("<p>a<p>" * 500, " ".join("a" * 500)),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<", "<"),
        ("<!doctype html><?xml?>", ""),
        ("", ""),
    ],
)
def test_text_of_a_page_alone(source, want):
    if want is None:
        want = "a <b> é \U0001f600 é x & y"
    assert text(source) == want


def page(i, article, menu="menu", extra=""):
    return (
        f"<html><body><div class=m{0}><a href=/{i}>{menu} {i}</a></div><div class=box>word {i} changes</div>"
        f"<article><h1>Title {i}</h1>{article}{extra}</article><div class=end>Imprint of the site</div></body></html>"
    )


def run(spark, rows, **options):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.main_text(df, url_filter.host_of(F.col("url")), **options).select("page_id", "url", "main.*")
    return {r.page_id: r for r in out.collect()}


@pytest.mark.parametrize("hosts", [M.BROADCAST_HOSTS, 0])
def test_subtrees_that_recur_on_a_host_go(spark, hosts):
    rows = [(i, f"http://a.com/{i}", page(i, f"<p>text {i}</p>", extra="<div class=x>Follow us now</div>")) for i in range(6)]
    rows += [(100, "http://b.com/1", page(7, "<p>text</p>", extra="<div class=x>Follow us now</div>"))]
    got = run(spark, rows, broadcast_hosts=hosts)
    for i in range(6):
        # menu, box and imprint by their shape, the box inside the article by its content
        assert (got[i].text, got[i].n_template) == (f"Title {i} text {i}", 4)
    # a host's only page has no template
    assert (got[100].text, got[100].n_template) == ("Title 7 text Follow us now", 0)


def test_copies_of_articles_and_shared_passages_stay(spark):
    shared = "<p>" + "a passage of many words " * 20 + "</p>"
    copy = "<div><p>the same article</p><p>on many pages</p></div>"
    rows = [(i, f"http://a.com/{i}", page(i, shared)) for i in range(20)]
    rows += [(100 + i, f"http://a.com/c{i}", page(0, copy, menu=f"m{i}")) for i in range(30)]
    got = run(spark, rows)
    for i in range(20):
        assert got[i].text == f"Title {i} " + ("a passage of many words " * 20).strip()
    for i in range(30):
        assert got[100 + i].text == "Title 0 the same article on many pages"


def test_pages_without_an_article(spark):
    def old(i):
        return f"<body><div class=top><a href=1>Start</a> <a href=2>News {i}</a></div><div class=c><p>story {i}</p><p>more</p></div><div class=b>Hosted by us</div>"

    got = run(spark, [(i, f"http://a.com/{i}", old(i)) for i in range(5)])
    assert {i: r.text for i, r in got.items()} == {i: f"story {i} more" for i in range(5)}


def test_awkward_rows(spark):
    prepare(spark)
    big = "<article>" + "<p>long words &amp; more</p>" * 20_000 + "</article>"
    rows = [(None, None, None), (1, None, "<p>x</p>"), (2, "http://a.com", None), (3, "http://a.com", ""), (4, "no host", "<p>y"), (5, "http://A.com/x", big)]
    rows += [(6, "http://a.com/r", page(6, "<p>again</p>"))] * 5
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("host", "template", "site_host", "site_template", "text", "n_chars", "s"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    out = M.main_text(df, url_filter.host_of(F.col("url")))
    assert out.columns == [*df.columns, "main"]
    got = [(r.page_id, r.main.text, r.main.n_chars) for r in out.orderBy("page_id").collect()]
    want = " ".join(["long words & more"] * 20_000)
    assert got[:6] == [(None, "", 0), (1, "x", 1), (2, "", 0), (3, "", 0), (4, "y", 1), (5, want, len(want))]
    # one page five times is one page: no template
    assert got[6:] == [(6, "Title 6 again", 13)] * 5
    assert M.main_text(df.limit(0), url_filter.host_of(F.col("url"))).count() == 0


def test_op13_gives_the_article_of_every_page(spark):
    sf = f"{TESTDATA}/sf0.01"
    sources = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op13_main_text(spark, sf).collect()
    assert len(rows) == len(sources)
    for r in rows:
        body = re.search("<article>(.*)</article>", sources[r.page_id].html, re.DOTALL)[1]
        body = re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", body))
        assert r.text == " ".join(references.unescape(body).split())
        assert r.url == sources[r.page_id].url and r.n_chars == len(r.text)
    # the hosts' counts delete what no rule has to
    assert sum(r.n_template >= 3 for r in rows) > 200
