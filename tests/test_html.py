"""HTML to Markdown: one hand-written case a rule."""

import pytest

from folio.operators.convert import html_to_markdown

CASES = [
    ("perch&eacute; &uuml;ber &agrave; &#8217; &#x2019; &amp;lt;", "perché über à ’ ’ &lt;"),
    ("<ul><li>a</li><li><p>b</p></li></ul><ol><li>x<li>y</ol><p>z", "- a\n- b\n\n1. x\n2. y\n\nz"),
    ("<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>", "- a\n   - b\n- c"),
    ("<blockquote><p>one</p><p>two</p></blockquote><p>out</p>", "> one\n>\n> two\n\nout"),
    ("<table><tr><th>h</th><th>k</th></tr><tr><td>1</td><td><p>2</p></td></tr></table><p>after</p>", "| h | k |\n| --- | --- |\n| 1 | 2 |\n\nafter"),
    ("<dl><dt>term</dt><dd>def</dd></dl>", "term\n:   def"),
    ("<p class='chapter'>Kapitel 1</p>", "## Kapitel 1"),
    ("<div class=\"chapter\"><p>Kapitel 1</p></div><p>text</p>", "## Kapitel 1\n\ntext"),
    ("<span class=\"chapter\">Kapitel 1</span><p>a <span class=\"x9\">b</span> c</p>", "## Kapitel 1\n\na b c"),
    ("<p>a<br>b</p>", "a b"),
    ("<p>see <a href='http://x/'>this</a></p>", "see [this](http://x/)"),
    ("<p><img alt='pic' src=\"http://x/a.png\"></p>", "![image_1](images/image_1.png)"),
    ("<p><img src='http://x/a.png' alt=\"pic\"></p>", "![image_1](images/image_1.png)"),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(CASES)], "page_id long, html string")
    got = {r.page_id: r.md for r in html_to_markdown(df).collect()}
    bad = [(h, want, got[i]) for i, (h, want) in enumerate(CASES) if got[i].strip() != want]
    assert not bad, bad


@pytest.mark.parametrize("page", [None, "", "<p", "<table><td>x", "</ul></table>", "<li>" * 2000])
def test_broken_pages(spark, page):
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert html_to_markdown(df).count() == 1
