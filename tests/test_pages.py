import datetime

import pytest

from daybook.operators import pages
from daybook.sources.page_files import read_pages

HOME = """<!DOCTYPE html>
<html lang="ko">
<head>
  <meta charset="UTF-8">
  <meta name="description" content="A home page">
  <title> Home
  </title>
  <link rel="stylesheet" href="style.css">
  <script>var x = '<a href="no.html">no</a><li>no</li>';</script>
</head>
<body>
<!-- <a href="hidden.html">no</a> -->
<ul>
  <li><a href="profile.html">Me &amp; you</a></li>
  <li class="x"><a class="k" href='/list.html#top'>The <b>list</b></a></li>
  <LI>third<br/>line</LI>
</ul>
<p>Built <time datetime="1987-03-09">long ago</time>, mended <time datetime="20245-01-01T10:00">x</time>
and <time datetime="1999-12-31T23:59">late</time></p>
<a href="https://else.example/">else</a> <a name="x">none</a> <a href="mailto:a@b.example">mail</a>
<a href="?page=2">more</a> <a href="#here">here</a> <a href="//cdn.example/x">cdn</a>
<figure>(1931년 map)</figure><i>no (12년) year</i><div>(2008년)</div>
</body></html>"""

PLAIN = "<html><head><title>Plain</title></head><body>" \
    "<dl><dt>One</dt><dd>first <b>text</b></dd><dt>Two</dt><dd>second</dd><dd>third</dd>" \
    "<dt>One</dt><dd>again</dd></dl></body></html>"

DAY = """<html><body>
<p><b>5:05</b> - ferry leaves</p>
<h2>Harbour <i>east</i></h2>
<p><b>11:40</b> - unload</p>
<p>crew only</p>
<p id="p"><b>12:15</b> - <u>count</u> crates</p>
<h2>Night</h2>
<h2>Office</h2>
<p><b>22:30</b> - lock up</p>
</body></html>"""

# An own layout: cells as (text, rows, columns), with the grid that they make.
LAYOUT = [
    [("k", 2, 2), ("l", 1, 1), ("m", 4, 1)],
    [("n", 2, 1)],
    [("o", 1, 1), ("p", 3, 1)],
    [("q", 2, 1), ("r", 1, 1)],
    [("s", 1, 2)],
    [("whole", 1, 4)],
    [("t", 9, 3), ("u", 1, 1)],
]
LAYOUT_GRID = [
    "k k l m",
    "k k n m",
    "o p n m",
    "q p r m",
    "q p s s",
    "whole whole whole whole",
    "t t t u",
]


def layout_table():
    rows = "".join(
        "<tr>"
        + "".join(
            f'<td colspan="{columns}" rowspan="{rows}">{text}<br>more</td>'
            for text, rows, columns in cells
        )
        + "</tr>"
        for cells in LAYOUT
    )
    return f"<html><table class='w'>{rows}</table></html>"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (1, "http://site.example/a/home.html?x=1#y", HOME),
        (2, "http://site.example", PLAIN),
        (3, "http://site.example/a/day.html", DAY),
        (4, "file:/tmp/layout.html", layout_table()),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_facts(corpus):
    facts = {r.page_id: (r.lang, r.title, r.description) for r in pages.page_facts(corpus).collect()}
    assert facts == {
        1: ("ko", "Home", "A home page"),
        2: (None, "Plain", None),
        3: (None, None, None),
        4: (None, None, None),
    }


def test_links(corpus):
    found = pages.page_links(corpus).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, r.href, r.kind) for r in found] == [
        (1, 0, "profile.html", "internal"),
        (1, 1, "/list.html#top", "internal"),
        (1, 2, "https://else.example/", "external"),
        (1, 3, "mailto:a@b.example", "mailto"),
        (1, 4, "?page=2", "internal"),
        (1, 5, "#here", "internal"),
        (1, 6, "//cdn.example/x", "external"),
    ]


def test_inlinks(spark, corpus):
    more = spark.createDataFrame(
        [(9, "http://site.example", '<a href="list.html">l</a><a href="list.html#a">m</a>')],
        corpus.schema,
    )
    found = {r.target: r.links for r in pages.inlinks(corpus.union(more)).collect()}
    assert found == {
        "http://site.example/a/profile.html": 1,
        "http://site.example/list.html": 3,
        "http://site.example/a/home.html?page=2": 1,
        "http://site.example/a/home.html": 1,
    }


def test_links_are_resolved(spark):
    html = (
        '<a title=">" href="./b.html">1</a><a href="b.html">2</a><a href="../x/b.html">3</a>'
        '<a href="//s.example/x/b.html">4</a><a href="http://S.example/up.html">5</a>'
        '<a href="http://other.example/x/b.html">6</a><a href="..">7</a><a href="mailto:a@b.c">8</a>'
    )
    frame = spark.createDataFrame(
        [(1, "http://s.example/x/a.html", html)], "page_id int, url string, html string"
    )
    assert {r.target: r.links for r in pages.inlinks(frame).collect()} == {
        "http://s.example/x/b.html": 4,
        "http://S.example/up.html": 1,
        "http://s.example/": 1,
    }


def test_items(corpus):
    found = pages.page_items(corpus).orderBy("pos").collect()
    assert [(r.page_id, r.pos, r.text) for r in found] == [
        (1, 0, "Me &amp; you"),
        (1, 1, "The list"),
        (1, 2, "third\nline"),
    ]


def test_nested_items(spark):
    html = (
        "<ul>\n <li>a <b>1</b><ol class='x'>\n <li>b</li>\n <li>c<ul><li>d</ul>after d</ol>tail</li>\n"
        " <li>e<li>f</ul> outside <li>g</li> gone"
    )
    frame = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    found = pages.page_items(frame).orderBy("pos").collect()
    assert [r.text for r in found] == ["a 1\ntail", "b", "c\nafter d", "d", "e", "f", "g"]


def plain_items(html):
    """The same by a stack, one page at a time."""
    import re

    items, held = [], [-1]
    for piece in re.split(r"(?i)(?=</?(?:li|[uo]l)[\s>])", html):
        found = re.match(r"(?i)</?(?:li|[uo]l)(?=[\s>])", piece)
        mark = found[0].lower() if found else ""
        if mark in ("<ul", "<ol"):
            held.append(-1)
        elif mark in ("</ul", "</ol") and len(held) > 1:
            held.pop()
        elif mark == "<li":
            held[-1] = len(items)
        elif mark:
            held[-1] = -1
        text = re.sub(r"<[^>]*>", "", piece).strip()
        if mark == "<li":
            items.append([text])
        elif text and max(held) >= 0:
            items[max(held)].append(text)
    return ["\n".join(item).strip() for item in items]


def test_lists_in_lists_equal_a_stack(spark):
    import random

    rng = random.Random(5)
    marks = ["<ul>", "</ul>", "<ol class=x>", "</ol>", "<li>", "<li>", "<li a>", "</li>", "t", "<b>w</b>", "u"]
    htmls = ["<li>first<ul>" + "".join(rng.choice(marks) + (str(i) if rng.random() < 0.4 else "") for i in range(rng.randint(1, 60))) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")
    found = {}
    for row in pages.page_items(frame).orderBy("page_id", "pos").collect():
        found.setdefault(row.page_id, []).append(" ".join(row.text.split()))
    for i, html in enumerate(htmls):
        if re_list(html):
            assert found[i] == [" ".join(x.split()) for x in plain_items(html)], html


def re_list(html):
    """Whether an item of the page holds a list, as only then it is read by pieces."""
    import re

    items = re.findall(r"(?is)<li(?:\s[^>]*)?>.*?(?=</li\s*>|<li[\s>]|</[uo]l\s*>|\Z)", html)
    return any(re.search(r"(?i)<[uo]l[\s>]", item) for item in items)


def test_many_nested_items_are_read_in_time(spark):
    import time

    html = "<ul>" + "".join(f"<li>a{i}<ul><li>b{i}</li></ul>c{i}</li>" for i in range(4000)) + "</ul>"
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    pages.page_items(frame.limit(1)).count()
    start = time.perf_counter()
    found = [row.text for row in pages.page_items(frame).orderBy("pos").collect()]
    assert time.perf_counter() - start < 10
    assert found == [text for i in range(4000) for text in (f"a{i}\nc{i}", f"b{i}")]


def test_descriptions(corpus):
    rows = pages.description_rows(corpus).orderBy("pos").collect()
    assert [(r.page_id, r.term, r.text) for r in rows] == [
        (2, "One", "first text"),
        (2, "Two", "second\nthird"),
        (2, "One", "again"),
    ]
    maps = {r.page_id: r.descriptions for r in pages.description_map(corpus).collect()}
    assert maps == {
        1: {},
        2: {"One": "first text\nagain", "Two": "second\nthird"},
        3: {},
        4: {},
    }


def test_schedule(corpus):
    found = pages.schedule_lines(corpus).orderBy("section_pos", "pos").collect()
    assert [(r.page_id, r.section, r.pos, r.minute, r.text) for r in found] == [
        (3, None, 0, 305, "ferry leaves"),
        (3, "Harbour east", 0, 700, "unload"),
        (3, "Harbour east", 1, 735, "count crates"),
        (3, "Office", 0, 1350, "lock up"),
    ]


def test_dates(corpus):
    found = pages.dated_marks(corpus).orderBy("kind", "pos").collect()
    assert [(r.kind, r.pos, r.day, r.year) for r in found] == [
        ("caption", 0, None, 1931),
        ("caption", 1, None, 2008),
        ("time", 0, datetime.date(1987, 3, 9), 1987),
        ("time", 1, None, 20245),
        ("time", 2, datetime.date(1999, 12, 31), 1999),
    ]


def grid(slots):
    found = {}
    for r in slots:
        found.setdefault((r.page_id, r.table_pos), {})[(r.row, r.column)] = r.text.split("\n")[0]
    return found


def test_table_slots(corpus):
    slots = pages.table_slots(corpus).collect()
    assert len(slots) == 28
    cells = grid(slots)[(4, 0)]
    lines = [" ".join(cells[(row, column)] for column in range(4)) for row in range(7)]
    assert lines == LAYOUT_GRID


def test_wide_spans(spark):
    html = '<table><tr><td colspan="0000012">a</td><td colspan=123456>b</td></tr></table>'
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert pages.table_slots(frame).count() == 12 + 1000


def test_odd_tables(spark):
    html = (
        "<table><tr><td rowspan=0>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>"
        "<table><tr></tr><tr><td rowspan='9' colspan=\"2\">x</td></tr></table><table></table>"
    )
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    slots = pages.table_slots(frame).collect()
    assert len(slots) == len(grid(slots)[(1, 0)]) + len(grid(slots)[(1, 1)])
    assert grid(slots) == {
        (1, 0): {(0, 0): "a", (1, 0): "a", (2, 0): "a", (0, 1): "b", (1, 1): "c", (2, 1): "d"},
        (1, 1): {(1, 0): "x", (1, 1): "x"},
    }


def test_left_out_closing_tags(spark):
    html = (
        "<ul><li>a<li class=x>b</ul><ol><li>c</ol>"
        "<dl><dt>One<dd>first<dd>more<dt>Two<dd>second</dl>"
        "<h2>Day<p><b>09:00</b> - up<p><b>10:00</b> - out"
        "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>"
        "<li>last<!-- <li>hidden"
    )
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    items = pages.page_items(frame).orderBy("pos").collect()
    assert [r.text for r in items] == ["a", "b", "c", "last"]
    assert pages.description_map(frame).first().descriptions == {
        "One": "first\nmore", "Two": "second"
    }
    lines = pages.schedule_lines(frame).orderBy("pos").collect()
    assert [r.time for r in lines] == ["09:00", "10:00"] and lines[0].text == "up"
    assert grid(pages.table_slots(frame).collect()) == {
        (1, 0): {(0, 0): "a", (0, 1): "b", (1, 0): "a", (1, 1): "c"}
    }


def test_page_files(spark, tmp_path):
    (tmp_path / "a.html").write_text(HOME, encoding="utf-8")
    (tmp_path / "b.html").write_text(PLAIN, encoding="utf-8")
    corpus = read_pages(spark, str(tmp_path))
    assert corpus.columns == ["page_id", "url", "html"]
    assert {r.title for r in pages.page_facts(corpus).collect()} == {"Home", "Plain"}
    targets = {r.target.rsplit("/", 1)[1] for r in pages.inlinks(corpus).collect()}
    assert "profile.html" in targets
