import html
import re
import time

import pytest

from roadlens.llm import html_text as H

SF = "/root/testdata/sf0.01"
LONG = "The house of the miller was on the hill and it was not far from the river that is in the valley."
OTHER = "It is with this that he had to be at the mill by noon, for the bread was in the oven and they were on the way."
CODE = "int main return zero float alpha beta gamma delta epsilon zeta eta theta kappa lambda sigma omega printf scanf malloc"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("only words", ""),
        (f"<p>{LONG}", LONG),
        (f"<P>{LONG}<p>Short.<p>{OTHER}", f"{LONG} Short. {OTHER}"),
        (f"<nav><a href=x>Home</a> {LONG}</nav><p>{LONG}</p><footer>{OTHER}</footer>", LONG),
        (f"<ul><li><a href=/a>{LONG}</a></li></ul><p>{OTHER}</p>", OTHER),
        (f"<article><h1>Title</h1><p>{LONG}</p><p>x &amp;lt; y</p></article><div>{OTHER}</div>", f"Title {LONG} x &lt; y"),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p><footer>by me</footer></article>", f"Title {LONG}"),
        (f"<article><p>{LONG}</p><pre>{CODE}</pre></article>", f"{LONG} {CODE}"),
        (f"<p>{LONG}</p><footer>x</footer><div>{CODE}</div>", LONG),
        (f"<article><p>{LONG}</p><div class='ad-box'>{OTHER}</div><aside>{OTHER}</aside><section id=comments><p>{OTHER}</p></section></article>", LONG),
        (f"<article><p>{LONG}</p></article><article class='comment'><p>{OTHER}</p></article>", LONG),
        (f"<article><p>Only short.</p></article>", "Only short."),
        (f"<main><p>{LONG}</p><form><p>{OTHER}</p></form></main>", LONG),
        (f"<form id=f><main><p>{LONG}</p></main></form>", LONG),
        (f"<body class='has-sidebar'><p>{LONG}</p></body>", LONG),
        (f"<div class='cookie-notice'>{OTHER}</div><p>{LONG}</p><div role=alert>{OTHER}</div>", LONG),
        (f"<p>{LONG}</p><p hidden>{OTHER}</p><p style='display: none'>{OTHER}</p>", LONG),
        (f"<p>{LONG} in<b>li</b>ne<br>end &eacute;&#233;&#xe9;&nbsp;x</p>", f"{LONG} inline end ééé x"),
        (f"<p>{LONG} a<span class=ad>buy <span>now</span> all</span>b</p>", f"{LONG} ab"),
        (f"<title>T</title><script>var t = '<p>{OTHER}</p>';</script><style>p{{}}</style><!-- <p>{OTHER}</p> --><p>{LONG}</p>", LONG),
        (f"<p title='a > b' data-x=\"<p>\">{LONG}</p>", LONG),
        (f"<p it's>{LONG}</p>", LONG),
        (f"<p>{LONG}</p><script>never closed <p>{OTHER}</p>", LONG),
        (f"<p>{LONG}</p><!-- never closed <p>{OTHER}</p>", LONG),
        (f"<p>{LONG}</p><div class=\"open", LONG),
        (f"<p>{LONG} 1 < 2 and 3 > 2 <3</p></b></div></p>", f"{LONG} 1 < 2 and 3 > 2 <3"),
        (f"<article><h2>Head</h2><p>{LONG}</p><h2><a href=#>Next</a></h2><p>{OTHER}</p></article>", f"Head {LONG} Next {OTHER}"),
        (f"<table><tr><td>{LONG}<td>{OTHER}<tr><td>x</table>", f"{LONG} {OTHER} x"),
        (f"<article><p>{LONG}\n\t  and  so  </p>\n</article>", f"{LONG} and so"),
    ],
)
def test_rules(page, text):
    assert H.main_text(page) == text


def test_open_blocks_take_the_label_of_the_nearest_decided():
    block = lambda text, **how: H.Block(*(dict(text=text, linked=0, stops=0.0, heading=False, in_article=False, boilerplate=False, container=0) | how).values())
    good, bad, short, head = block("x" * 99, stops=0.4), block("x" * 99), block("x"), block("x", heading=True)
    assert H.labels([bad, short, short, short, good]) == [False, False, False, True, True]  # the one in the middle: that before it
    assert H.labels([bad, head, good]) == [False, True, True] and H.labels([good, head, bad]) == [True, False, False]
    assert H.labels([short, good, short]) == [True] * 3 and H.labels([short]) == [False] and H.labels([]) == []
    own, far = short._replace(container=1), good._replace(container=1)
    assert H.labels([far, bad, own, bad]) == [True, False, True, False]  # its own element first
    assert H.labels([short._replace(in_article=True), good]) == [True, False]


def test_articles_of_the_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    bodies = {" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("text is not null").collect()}
    out = {r["page_id"]: r for r in H.extracted(pages).collect()}
    for p in pages.collect():
        r = out[p["page_id"]]
        head = " ".join(html.unescape(re.search("<h1>(.*?)</h1>", p["html"]).group(1)).split())
        assert r["url"] == p["url"] and r["n_chars"] == len(r["text"]) and r["text"].startswith(head)
        assert r["text"][len(head) :].strip() in bodies  # the rest is a document, whole


def test_pages_that_do_not_mark_their_article(spark):
    pages = [r["html"].replace("<article>", "<div>").replace("</article>", "</div>") for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    right = sum(H.main_text(p) == H.main_text(p.replace("</div><div><h1>", "</div><article><h1>").replace("</div><footer>", "</article><footer>")) for p in pages)
    assert right >= 0.8 * len(pages)


@pytest.mark.parametrize("piece", ["<b>", "<div>", "</i>", "<p title=\">", "<p '>", "<!--", "<title>", "<li>", "<a href=x>", "&", "&#", "<", "</", "<script", f"<p>{LONG}</p>", "<ul><li>x", "<span class=ad>", "<article>", "İ<script></script>"])
def test_time_is_linear(piece):
    took = []
    for n in (20_000, 80_000):
        start = time.perf_counter()
        H.main_text(piece * n)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 1


def test_tables(spark):
    schema = "page_id long, url string, html string, text int, n_chars string, __html2 string"
    rows = [(1, "u", f"<p>{LONG}</p>", 5, "n", "z")] * 2 + [(None, None, None, None, None, None), (3, "v", "", 1, "", "")]
    out = H.extracted(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "u", LONG, len(LONG))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert H.extracted(spark.createDataFrame([], schema)).count() == 0
    long = f"<article><p>{LONG}</p>" + f"<p>{OTHER} &amp; \U0001f600</p>" * 60_000
    (r,) = H.extracted(spark.createDataFrame([(1, "u", long)], "page_id long, url string, html string")).collect()
    assert r["text"] == LONG + f" {OTHER} & \U0001f600" * 60_000 and r["n_chars"] == len(r["text"])
