import pytest

import html

from cdrflow.llm import html_extract as H

PARAGRAPH = "Some sentence of the article with words enough to count, and then a little more of it."
FULL = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav><div id="cookieNotice">We use cookies</div>
<div class="wrap"><div class="post-12 entry"><header><h2>Title</h2><span>by X</span></header><!-- c -->
<p>{PARAGRAPH}<p>Tom &amp; Ann&nbsp;&#8212; <b>bold</b>
 <a href="y">link</a><br>next<div class="ad-slot">Buy now</div><ul><li>one<li>two</ul><script>var a="<p>x</p>";</script>
<form><p>Mail me</p></form></div><aside>side</aside><div class="comments"><p>{PARAGRAPH * 4}</p></div></div>
<div role="contentinfo">foot</div></body></html>"""
EXPECTED = f"Title\n\n{PARAGRAPH}\n\nTom & Ann \u2014 bold link next\n\none\n\ntwo"


def test_article_only():
    assert H.extract(FULL, [H.vote(FULL)[0]])[0] == EXPECTED


def test_odd_pages():
    assert H.extract(None, []) == ("", None) and H.vote("") is None and H.vote("<script>x") is None
    assert H.extract("plain &lt;text", [""])[0] == "plain <text"
    assert H.extract("<p>a<p>b</p>c", [])[0] == "a\n\nb\n\nc"
    assert H.extract("<a 'broken <b>x", [])[0].endswith("x")
    long = "word " * 200_000
    assert H.extract(f"<article><p>{long}</p></article>", [])[0] == long.strip()
    assert H.extract("<div>" * 3000 + "deep", [])[0] == "deep"


def test_the_host_decides(spark):
    """On one page the links list has more text; the host's other pages say where the article is."""
    page = '<body><div class="text-{i}"><p>{p}</p></div><div class="more"><p>{m}</p></div></body>'
    rows = [(i, "http://h.net/a", page.format(i=i, p=PARAGRAPH, m="short")) for i in range(8)]
    rows += [(8, "http://H.net/b", page.format(i=9, p="Brief.", m=PARAGRAPH * 2)), (9, None, None), (9, None, None), (None, "u", "<p>x")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    out = H.main_text(df).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r.text for r in out}
    assert by[8] == "Brief." and by[9] == "" and by[None] == "x" and by[0] == PARAGRAPH
    assert H.main_text(df.limit(0)).count() == 0


def test_generated_pages_give_their_article(spark):
    import re

    from conftest import SF001

    for r in H.main_text(spark.read.parquet(f"{SF001}/pages.parquet")).join(
        spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        inside = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert re.sub(r"\s+", "", r.text) == re.sub(r"\s+", "", "".join(blocks))
        assert r.text.split("\n\n") == [b for b in blocks if b] or "<br>" in inside


def test_hosts_with_several_templates(spark):
    """Some pages have a teaser where the others have the article; rare and single templates count too."""
    one = '<body><div class="text"><p>{p}</p></div></body>'
    two = '<body><div class="text"><p>Teaser.</p></div><div class="{c}"><p>{p}</p></div></body>'
    rows = [(i, one) for i in range(70)] + [(100 + i, two.replace("{c}", "story")) for i in range(30)]
    rows += [(200 + i, two.replace("{c}", "rare")) for i in range(3)] + [(300, two.replace("{c}", "once"))]
    rows += [(400 + 10 * t + i, two.replace("{c}", f"t{'abcdefgh'[t]}")) for t in range(8) for i in range(4)]
    data = [(i, f"http://h.net/{i}", page.format(p=f"{i} {PARAGRAPH * 3}")) for i, page in rows]
    out = H.main_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"{i} {PARAGRAPH * 3}" for i, _ in rows} and len(out) == len(rows)


def text_of(source):
    return H.extract(source, [])[0]


def test_a_form_around_the_page_does_not_hide_the_article():
    body = "<h1>Title</h1><p>The first paragraph of the article.</p><p>And the second one.</p>"
    page = f"<html><body><form action=x><div class=page>{body}</div><input name=q><button>Go</button></form></body></html>"
    assert text_of(page) == "Title\n\nThe first paragraph of the article.\n\nAnd the second one."
    plain = "<body><form><div><p>A long paragraph that is all there is to read here.</p></div></form></body>"
    assert text_of(plain) == "A long paragraph that is all there is to read here."


def test_other_forms_stay_out():
    page = ("<body><article><h1>T</h1><p>Text.</p><form><h3>Subscribe</h3><p>A rather long call to leave your address with us, "
            "longer than the article.</p><label>Mail</label></form></article><form><p>Search</p></form></body>")
    assert text_of(page) == "T\n\nText."


@pytest.mark.parametrize("piece", ["<div>x", "<div class=a1>", "<p>x<div>", "<li>x<ul>", "<a ", "<a href='", "<a href=\"x", "<button><div>", "</div><b>x", "<td>x"])
def test_a_megabyte_of_odd_markup_takes_linear_time(piece):
    import time

    source = piece * (1_000_000 // len(piece))
    began = time.process_time()
    H.extract(source, ["/body/div"])
    assert time.process_time() - began < 20


def test_text_of_deep_elements_is_kept():
    source = "<body>" + "".join(f"<div>word{i} " for i in range(2000)) + "</div>" * 2000 + "<div>after</div></body>"
    words = H.extract(source, [""])[0].split()  # of the whole page
    assert words[:2] == ["word0", "word1"] and words[-2:] == ["word1999", "after"] and len(words) == 2001
