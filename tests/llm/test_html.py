"""Rendering of pages: layout, implied tags, visibility, and pages that are no pages."""

import random
import re

import pytest

from tablewright.llm.html_text import extract, page_text

CASES = {
    "<p>one<p>two <b>bold</b>, x": "one\n\ntwo bold, x",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>a<li>b<ol start=3><li>c</ol><li>d</ul>": "- a\n- b\n  3. c\n- d",
    "<table><tr><th>name<th>n<tr><td>long name<td>22</table>": "name       n\nlong name  22",
    "<table><td>a<td>b<tr><td colspan=2>wide<td>c</table>": "a     b\nwide     c",
    "<pre>  x\n y</pre>": "  x\n y",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "x<script>var t = '</p>';</script>y<style>p{}</style><!-- no -->z": "xyz",
    "<head><title>no</title></head><body>yes": "yes",
    "<p hidden>no<p style='display: none'>no<p aria-hidden=true>no<p>yes": "yes",
    "a &amp; b &lt;c&gt; &eacute;": "a & b <c> é",
    "</p></ul><td>loose</b>": "loose",
    "<p>cut <a href='x": "cut",
    "<table><tr><td>x<table><tr><td>y</table></table>z": "x\n\ny\n\nz",
}


# Declarations that are no comments, and comments that hold them.
CONDITIONAL = {
    "<!--[if lt IE 9]><p>old</p><![endif]--></head><body><p>Visible one</p><!-- x --><p>two</p>": "Visible one\n\ntwo",
    "<!--[if lt IE 9]><p>old</p><![endif]--><p>Visible one</p>": "Visible one",
    "<!--[if !IE]><!--><p>shown</p><!--<![endif]--><p>two": "shown\n\ntwo",
    "<![if !IE]><p>shown</p><![endif]><p>two": "shown\n\ntwo",
    "a<![CDATA[ x > y": "a y",
    "a<script>//<![CDATA[\nif (1 > 0) x();\n//]]></script>b<![cut": "ab",
}


@pytest.mark.parametrize("html", CONDITIONAL)
def test_conditional_comments(html):
    assert page_text(html) == CONDITIONAL[html]


# Drawings, formulas, and heads that nothing closes.
SHOWN = {
    "<p>so <math><mfrac><mi>a</mi><mn>2</mn></mfrac><mo>=</mo><mi>b</mi></math>.": "so a 2 = b .",
    "<math><semantics><mi>x</mi><annotation>no</annotation><annotation-xml>no</annotation-xml></semantics></math>": "x",
    "a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>One <tspan>label</tspan></text><text>two</text></svg>b": "a One label two b",
    "<svg><defs/><path d='M0'/><text>label</text><style>no</style></svg>": "label",
    "x<svg class=icon />y<math/>z<desc>d</desc>": "xyzd",
    "<svg><text><![CDATA[a > b]]></text></svg><![CDATA[no]]>c": "a > b c",
    "<head><title>no</title><a href=x>link</a> and <p>more": "link and\n\nmore",
    "<head><meta charset=x><span>in <div>block</div></span>": "in\nblock",
    "<head><script>no</script><img src=x>text": "text",
    "<head><noscript><img src=x>no</noscript><link rel=x><title>no</title></head>yes": "yes",
}


@pytest.mark.parametrize("html", SHOWN)
def test_what_browsers_show(html):
    assert page_text(html) == SHOWN[html]


@pytest.mark.parametrize("html", CASES)
def test_cases(html):
    assert page_text(html) == CASES[html]


def visible(html):
    """All visible words by deleting what is not shown; no layout."""
    html = re.sub(r"(?s)<!--.*?-->|<(script|style|head)\b.*?</\1>|<!DOCTYPE[^>]*>", " ", html)
    html = re.sub(r"</?(?:b|a)\b[^>]*>", "", html)
    import html as h

    return h.unescape(re.sub(r"<[^>]*>", " ", html)).split()


def test_no_visible_word_is_lost_or_added(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract(table).collect()
    pages = {r.page_id: r.html for r in table.collect()}
    for r in rows:
        words = [w for w in r.text.split() if w != "-"]
        assert words == [w for w in visible(pages[r.page_id]) if w != "-"]
        assert r.n_chars == len(r.text)


def test_anything_is_a_page():
    rnd = random.Random(1)
    bits = ["<", ">", "</", "<p", "<td>", "</table>", "<table>", "<li>", "<!--", "-->", "<![", "&", "&#x;", "=", "'", '"', "x", " ", "\n", "<pre>", "<ol start=x>", "<br/>"]
    for _ in range(1500):
        page_text("".join(rnd.choice(bits) for _ in range(rnd.randrange(40))))
    assert page_text("<div>" * 20_000 + "deep") == "deep"
    assert page_text(None) == page_text("") == ""
