import html as H
import re

import pyarrow.parquet as pq

from tavola.llm.style_tree import article, extract, op5_style_tree_text
from tests.llm.conftest import TINY


def reference(page):
    """The article element of the given tables' pages by plain splitting."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(H.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x)).split())
              for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_every_page_of_the_table(spark):
    for d in (TINY, "/root/testdata/sf0.01"):
        pages = pq.read_table(f"{d}/pages.parquet").to_pylist()
        got = {r.page_id: r for r in op5_style_tree_text(spark, d).collect()}
        assert len(got) == len(pages)
        for p in pages:
            assert got[p["page_id"]].text == reference(p["html"])
            assert got[p["page_id"]].n_chars == len(reference(p["html"])) and got[p["page_id"]].url == p["url"]


def test_markup():
    none = frozenset()
    page = """<!DOCTYPE html><html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <form action=x><input><button>Go</button></form><div id="cookie-notice">We use</div><main><article><header><h1>A &amp; B</h1></header>
    <p>One<br>two <a href="x">link</a><p>Th&eacute;   <b>bold<p>three &lt;p&gt; &#8212; x<ul><li>i<li>ii</ul><aside>see also</aside>
    <div class="ad">buy</div><script>if (a < b) "</p>"</script><!-- no --><pre>a  b</pre><table><tr><td>c<td>d</table>
    <section class="comments"><article class="comment"><p>me first</p></article></section></article></main><footer>&copy;</footer>"""
    assert article(page, none).split("\n\n") == ["A & B", "One two link", "Thé bold", "three <p> — x", "i", "ii", "a b", "c", "d"]
    assert article(None, none) == "" and article("", none) == "" and article("<p>a<!-- open", none) == "a"
    assert article("plain > text < here", none) == "plain > text < here"
    assert article("<div><p>x</p></div><ul><li><a href=1>m</a><li><a href=2>n</a></ul><p>y <a>z</a> words words</p>", none) == "x\n\ny z words words"
    assert article('<div hidden>a</div><div style="display: none">b</div><p>c', none) == "c"
    assert article("<p>" * 30_000 + "x" * 300_000, none) == "x" * 300_000


def test_style_tree_entropy(spark):
    rows = []
    for i in range(8):
        rows.append((i, f"https://A.example.com:80/{i}?q", f"<div class=top>Hello reader of our site</div><div class=txt><p>story {i} text</p>"
                     f"<p>All rights kept</p></div><div class='k{i}'>Same everywhere</div>"))
        rows.append((100 + i, "http://b.example.com/x", "<article><p>same article</p><div class=q>same part</div></article>"))
        rows.append((200 + i, f"http://c.example.com/{i}", f"<article><h1>t</h1><p>art {i}</p><p>shared</p><div class=follow>follow us</div></article>"))
        rows.append((300 + i, None, "<div class=top>Hello</div>"))
    rows += [(400, "http://one.example.com", None), (400, "http://one.example.com", ""), (None, "nonsense", "<p>x")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text) for r in extract(df).collect()]
    want = []
    for i in range(8):
        want += [(i, f"story {i} text\n\nAll rights kept"), (100 + i, "same article\n\nsame part"), (200 + i, f"t\n\nart {i}\n\nshared"), (300 + i, "Hello")]
    want += [(400, ""), (400, ""), (None, "x")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert extract(df.limit(0)).count() == 0
