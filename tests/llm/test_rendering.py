import re
import time

import pytest

from tandem.llm.queries import QUERIES
from tandem.llm.rendering import render, visible_text


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("a &amp; b&nbsp;c", "a & b\xa0c"),
    ("<p>One <b>two</b>\n three<p>Four<br>five<div>six</div>", "One two three\n\nFour\nfive\n\nsix"),
    ("in<b>si</b>de <i> x </i> y", "inside x y"),
    ("<h1>T</h1>tail<hr>end", "T\n\ntail\n\nend"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>x<li>y<p>z</ol>", "9. x\n10. y\n\n    z"),
    ("<dl><dt>T<dd>D<dt>U<dd>E</dl>", "T\n  D\nU\n  E"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td colspan=2>wide cell<tr><td>Pie<td>12</table>",
     "Name   Qty\nApple  3\nwide cell\nPie    12"),
    ("<table><tr><td>a<br>b<td>c<tr><td>dd<td><table><tr><td>x<td>y</table></table>", "a   c\nb\ndd  x  y"),
    ("<pre> a\n  b</pre>c", " a\n  b\n\nc"),
    ("<p hidden>no</p><p style='color:red;display: none'>no</p><p style=visibility:hidden>no</p>yes", "yes"),
    ("<head><title>no</title><style>p{}</style></head><script>'<p>'</script><noscript>no</noscript>yes", "yes"),
    ("a<!-- <p> -->b<!---->c<!DOCTYPE x>d<?php ?>e", "abcde"),
    ("a < b <3 > c", "a < b <3 > c"),
    ("</p></div>x</b><p>y</i>", "x\n\ny"),
    ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("<script>never closed <p>x", ""),
    ("text <!-- never closed", "text"),
    ("<div title='a>b' data-x=\"</div>\">x</div>", "x"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<select><option>o<option>p</select>", "o\np"),
    ("<td>lost<li>item", "lost\n- item"),
    ("<p title=it's>It's visible</p>", "It's visible"),
    ("<a href=\"x\"\">say 5\" tall</a>", "say 5\" tall"),
    ("<p \"title=x\">a</p><i 'b'>b</i> <p =\"hidden\">c</p \"x>d", "a\n\nb\n\nc\n\nd"),
    ("<p title=\"a\"hidden\">seen<p title='a'hidden>not", "seen"),
    ("<a href=\"x>never closed</a> <i title = 'a>b'>rest</i>", "never closed rest"),
    ("<div style='visibility:hidden'>a<p style='visibility:visible'>shown</p></div>b", "shown\n\nb"),
    ("<div style='display:none'>a<p style='visibility:visible;display:block'>not</p></div>b", "b"),
    ("<p style='/* no */ display /* x */ : /**/ none /* y */'>not</p><p style='color:red; display:none; display:block'>b</p>", "b"),
    ("<p style='display:none!important;display:block'>not</p>b", "b"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<table><tr><td rowspan=2 colspan=2>AA<td>B<tr><td>C<tr><td>D<td>E<td>F</table>", "AA    B\n      C\nD  E  F"),
    ("x<br><br>y<br>", "x\n\ny"),
    ("<br>x<p>y<br></p><br>z", "x\n\ny\n\n\nz"),
    ("<pre>\n a\n\n b</pre>", " a\n\n b"),
    ("<ol><li>a<li value=5>b<li>c</ol><ol reversed><li>x<li>y</ol>", "1. a\n5. b\n6. c\n\n2. x\n1. y"),
    ("<details><summary>more</summary>not<p>not</details><details open><summary>s</summary>yes</details>", "more\ns\nyes"),
    ("a<textarea>\ntyped</textarea>b", "a typed b"),
    ("<table><tr><td>\u4f60\u597d<td>x<tr><td>abcdef<td>y</table>", "\u4f60\u597d    x\nabcdef  y"),
    ("<a href=x=\"b>c\">d</a><br/><img alt=/>e", "c\">d\ne"),
])
def test_layout(html, text):
    assert render(html) == text


def test_deep_and_long_pages():
    assert render("<div>" * 50000 + "x") == "x"
    assert render("<ul><li>" * 3000 + "x").endswith("- x")
    assert render("<p>" + "word " * 100000).split() == ["word"] * 100000
    assert render("<b" * 20000 + "<<<" * 1000 + "</" * 1000) is not None


def plain_words(html):
    """All words, by another way: tags to blanks."""
    return re.sub("<[^>]*>", " ", html).split()


@pytest.mark.parametrize("part, times", [
    ("<div>", 20000), ("<table><tr><td>x", 20000), ("<blockquote>x", 50000), ("<ul><li>x", 50000), ("<dl><dd>x", 50000),
    ("<table><tr><td rowspan=9999 colspan=1000>x<tr>", 5000), ("<tr><td>x<td colspan=1000>y", 20000), ("</p></b>x", 50000),
    ("<p><b>x", 50000), ("<pre>x\n", 20000), ("<li value=7>x", 50000)])
def test_work_and_output_stay_in_proportion(part, times):
    for start in ("", "<p><button>", "<table><tr><td>"):
        html = start + part * times
        began = time.process_time()
        text = render(html)
        assert time.process_time() - began < 10
        assert len(text) < 100 * len(html)
        assert "".join(word for word in text.split() if word not in ("-", "7.")) == "".join(plain_words(html))


def test_rows(spark):
    rows = [(1, "<p>a<p>b", "u"), (1, "<p>a<p>b", "u"), (2, None, "u"), (3, "", "u"), (None, "é", "u")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    found = visible_text(pages)
    assert found.dtypes == [("page_id", "bigint"), ("text", "string"), ("n_lines", "bigint"), ("n_chars", "bigint")]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "a\n\nb", 3, 4), (1, "a\n\nb", 3, 4), (2, "", 0, 0), (3, "", 0, 0), (None, "é", 1, 1)], key=str)
    assert visible_text(pages.limit(0)).count() == 0


def test_query_keeps_every_visible_word(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in QUERIES["op10_visible_text"](spark, sf_dir).collect()}
    assert found.keys() == pages.keys()
    for i, html in pages.items():
        body = re.sub(r"(?s)<!--.*?-->|<head>.*?</head>|<(script|style)\b.*?</\1>", " ", html)
        plain = re.sub(r"</?(?:b|i|a|span)\b[^>]*>", "", body)
        plain = re.sub(r"<[^>]*>", " ", plain).replace("&copy;", "©").replace("&middot;", "·").replace("&amp;", "&")
        assert [w for w in found[i].split() if w != "-"] == [w for w in plain.split() if w != "-"]
