from __future__ import annotations

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import html_text
from tests.llm.helpers import bag

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "a &lt;b&gt; &amp; c < d <3 &eacute;": "a <b> & c < d <3 é",
    "<p>one<p>two<br>three</p>four": "one\n\ntwo\nthree\n\nfour",
    "<ul><li>a<li>b<ol><li>c<li>d</ol><li>e</ul>": "- a\n- b\n  1. c\n  2. d\n- e",
    "<ol start=9><li>nine<li>ten</ol>": "9. nine\n10. ten",
    "<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>": "Name   N\nalpha  1\nb      22",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A  B\n   C",
    "<table><tr><td colspan=2>x y<td>z<tr><td>aaa<td>b<td>c</table>": "x y     z\naaa  b  c",
    "<table><tr><td>a<br>bb<td>c</table>": "a   c\nbb",
    "<td>cell outside</td>": "cell outside",
    "<head><title>T</title><style>p{}</style></head><body>x<script>var a='</p>';</script>y": "xy",
    "a<!-- b -->c<!doctype html><?php x ?>d": "acd",
    "<div hidden>a</div><p style='Display : None'>b</p><p style='visibility:hidden'>c</p>d": "d",
    "<noscript>a</noscript><template>b</template><input type=hidden value=x>c": "c",
    "<details><summary>S</summary>hid</details><details open><summary>T</summary>see</details>": "S\nT\nsee",
    "<pre>\n a\n  b</pre>c": " a\n  b\n\nc",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<b>bold<i>both</b>rest</i>": "boldbothrest",
    "<dl><dt>a<dd>b<dt>c<dd>d</dl>": "a\n  b\nc\n  d",
    "<select><option>x<option>y</select>": "x\ny",
    "<textarea>a &amp; <b></textarea>": "a & <b>",
    "<a title='x > y' href=\"a>b\">link</a>": "link",
    "x</div></p>y": "x\n\ny",
    "<svg><text>no</text></svg>yes": "yes",
    "<h1>T</h1><div>a</div><div>b</div>": "T\n\na\nb",
    "<p>open": "open",
    "text<b": "text",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert html_text.visible_text(page) == CASES[page].strip("\n")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <ul> <li> </ul> <table> <tr> <td> </td> </table> <b> </b> <br> <div> </div> <pre> </pre> "
    "<h1> <script> </script> <details> <head> <body> <html> <option> <dd> <caption> x y".split() + ["&amp;", " ", "\n", "<", "\""]
)))
def test_any_order_of_tags(parts):
    html_text.visible_text("".join(parts))


def test_hard_pages_take_linear_time():
    begin = time.perf_counter()
    for page in ("<div>" * 20000 + "x", '<a href="' * 20000, "<b a='\"'" * 20000, "<" * 100000,
                 "<table><tr><td>" * 2000 + "deep", "<p><span>" * 20000, "</p>" * 50000):
        html_text.visible_text(page)
    assert time.perf_counter() - begin < 20


def naive_columns(rows):
    """Cell by cell on a dictionary of taken places."""
    taken, starts = set(), []
    for r, row in enumerate(rows):
        at, own = 0, []
        for _, wide, high in row:
            while (r, at) in taken:
                at += 1
            own.append(at)
            n = 1
            while n < wide and (r, at + n) not in taken:
                n += 1
            taken |= {(r + i, at + c) for i in range(high) for c in range(n)}
            at += n
        starts.append(own)
    used = sorted({c for own in starts for c in own})
    width = {c: 0 for c in used}
    for row, own in zip(rows, starts):
        for (lines, wide, _), c in zip(row, own):
            fits = max(map(len, lines), default=0)
            if wide == 1 and fits <= html_text.WIDEST:
                width[c] = max(width[c], fits)
    out = []
    for row, own in zip(rows, starts):
        for i in range(max((len(c[0]) for c in row), default=0)):
            line, reached = "", 0
            for c, (lines, _, _) in zip(own, row):
                left = sum(width[x] + 2 for x in used if x < c)
                line += " " * (left - reached)
                line += (lines[i] if i < len(lines) else "").ljust(width[c]) + "  "
                reached = left + width[c] + 2
            out.append(line.rstrip())
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(
    st.lists(st.sampled_from(["a", "bb", "long cell", ""]), max_size=2), st.integers(1, 4), st.integers(1, 5)
), max_size=5), max_size=7))
def test_spans_equal_a_naive_grid(rows):
    assert html_text.columns(rows) == naive_columns(rows)


def test_hostile_spans_take_linear_time():
    begin = time.perf_counter()
    wide = "<td colspan=1000 rowspan=65534>"
    stairs = "".join(f"<tr><td rowspan={i % 977 + 2}>a<td>b" for i in range(8000))
    for page in (wide * 4000, f"<tr>{wide}" * 4000, (wide * 3 + "<tr>") * 2000, stairs,
                 "<tr>" + "<td>" * 4000 + "<td>" + "x<br>" * 4000,
                 "<tr>" + "<td>" * 3000 + "<tr><td colspan=1000><td colspan=1000>a<td>b" * 3000):
        found = html_text.visible_text(f"<table>{page}end</table>")
        assert found.replace("\n", " ").split()[-1].endswith("end")
        assert len(found) < 300 * len(page)
    assert time.perf_counter() - begin < 20


def test_pages(spark):
    data = [(i, None, page) for i, page in enumerate(CASES)] + [(None, "u", None), (0, None, ""), (7, "", "x " * 50000)]
    pages = spark.createDataFrame(data, "page_id bigint, text string, html string").repartition(3)
    expected = [(i, html_text.visible_text(p or "")) for i, _, p in data]
    expected = [(i, t, len(t), len(t.split("\n")) if t else 0) for i, t in expected]
    assert sorted(map(str, bag(html_text.extracted(pages)))) == sorted(map(str, expected))
    assert html_text.extracted(pages.limit(0)).count() == 0
