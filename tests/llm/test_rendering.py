import random
import re
import time
from html import unescape

import pytest

from tellerloom.llm.queries import QUERIES
from tellerloom.llm.rendering import Columns, extract, parse, render


def lines(*expected):
    return "\n".join(expected)


def plain_words(html):
    """Words of a page without its head, scripts, styles and comments, by substitution."""
    html = re.sub(r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "", html)
    # Inline elements do not end a word.
    html = re.sub(r"(?i)</?(?:b|a|i|em|span|strong)\b[^>]*>", "", html)
    return unescape(re.sub(r"<[^>]*(?:>|$)", " ", html)).split()


def rendered_words(text):
    return [word for word in text.split() if word != "-"]


def test_query_keeps_every_visible_word(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.page_id: r.text for r in QUERIES["op2_rendering"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        assert rendered_words(found[page.page_id]) == plain_words(page.html)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # Implied tags and block spacing.
        ("<p>one<p>two <b>bold</b>  text<br>next<div>div</div>tail",
         lines("one", "", "two bold text", "next", "", "div", "tail")),
        ("<title>T</title>x</p>y<h1>a<h2>b", lines("x", "", "y", "", "a", "", "b")),
        ("<div>a</div>b<div>c<div>d</div></div>", lines("a", "b", "c", "d")),
        ("a<br><br>b<hr>c", lines("a", "", "b", "", "c")),
        ("<pre>\n  a\n\n    b</pre>", lines("  a", "", "    b")),
        ("<blockquote>q<p>r</blockquote>", lines("  q", "", "  r")),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", lines("t", "    d", "u", "    e")),
        # Lists.
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", lines("- a", "- b", "  - c", "- d")),
        ("<ol start=3><li>x<li value=9>y<p>z</ol>", lines("3. x", "9. y", "", "   z")),
        ("<ol reversed><li>a<li>b</ol>", lines("2. a", "1. b")),
        ("<ul><li></li><li>a</ul>", "- a"),
        # Tables.
        ("<table><tr><th>Name<th>Age<tr><td>Alice Long<td>30</table>",
         lines("Name        Age", "Alice Long  30")),
        ("<table><tr><td rowspan=2>Bob<td>4<tr><td>5</table>", lines("Bob  4", "     5")),
        ("<table><tr><td>a<br>b<td>c<tr><td colspan=2>wide one<tr><td>d<td>e</table>",
         lines("a  c", "b", "wide one", "d  e")),
        ("<table><tfoot><tr><td>f<tbody><tr><td>b<thead><tr><td>h</table>", lines("h", "b", "f")),
        ("<table><caption>C</caption><tr><td>x</table>y", lines("C", "", "x", "", "y")),
        ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", lines("a     d", "", "b  c")),
        # Visibility.
        ("<p hidden>no</p><div style='color:red; display : none'>no</div>yes", "yes"),
        ("<div style='visibility:hidden'>no <i style='visibility:visible'>yes</i></div>", "yes"),
        ("<script>var t='</p>';</script><style>p{}</style><template>no</template>ok", "ok"),
        ("<details><summary>s</summary>no</details><details open>o</details>", lines("s", "o")),
        ("<dialog>no</dialog><dialog open>d</dialog><input type=hidden value=no>", "d"),
        ("<body style='display:none'>no", ""),
        # Characters, comments and broken tags.
        ("a &amp; b &copy; &nbsp;c &#x41; &unknown;", "a & b ©  c A &unknown;"),
        ("a < b <3 x<!-- c > --><!-->d", "a < b <3 xd"),
        ("<a href='a>b' title=\"q\">l</a><!-- not closed", "l"),
        ("x <a href='not closed", "x"),
        ("<textarea>\n<b>raw</b> &lt;</textarea>", "<b>raw</b> <"),
        ("<script>never closed <p>no", ""),
        ("", ""),
        ("   \n ", ""),
    ],
)
def test_layout(html, text):
    assert render(html) == text


def test_trees_of_tag_soup_have_the_parts_left_out():
    table = parse("<table><td>x").children[1].children[0]
    assert [table.name, table.children[0].name, table.children[0].children[0].name] == [
        "table",
        "tbody",
        "tr",
    ]
    assert [n.name for n in parse("<p>a<li>b").children] == ["head", "body"]


@pytest.mark.parametrize(
    "html",
    ["<div>" * 50_000 + "x" + "</div>" * 50_000, "<a '" * 50_000 + "x", "<!--" * 50_000]
    + ["<b>" * 50_000 + "x", "<table><tr><td>" * 5_000 + "x", "<ul><li>" * 5_000 + "x"]
    + ["</p>" * 30_000 + "x", "<p>" * 50_000 + "x", "&amp" * 50_000, "x" * 2_000_000],
    ids=lambda html: html[:12],
)
def test_deep_broken_and_long_pages(html):
    text = render(html)
    if "x" in re.sub(r"(?s)<!--.*|<a '.*", "", html):
        assert "x" in text


PARTS = (
    "<div hidden>no</div><p style='display:none'>no</p><i style='visibility:hidden'>no</i>"
    "<details><summary>s</summary>no</details><template>no</template>"
    "<ul><li>a<li>b</ul><table><tr><td>long<td>c<tr><td>d<td>e</table>"
)


@pytest.mark.parametrize("tag", ["div", "font", "span", "section"])
def test_parts_far_down_are_those_at_the_top(tag):
    open_tags, end_tags = f"<{tag}>" * 300, f"</{tag}>" * 300
    expected = lines("s", "", "- a", "- b", "", "long  c", "d     e")
    assert render(PARTS) == expected
    assert render(open_tags + PARTS) == expected
    assert render(open_tags + PARTS + end_tags + "<p>tail") == lines(expected, "", "tail")


def test_ends_of_deep_elements_leave_their_ancestors_open():
    fonts = "<font>" * 300
    assert render(f"<div hidden>{fonts}<div>no</div>no</div>yes") == "yes"
    assert render(f"<ul><li>a{fonts}<ul><li>b</ul><li>c</ul>") == lines("- a", "  - b", "- c")
    nested = "<div style='visibility:hidden'>" + "<div>" * 300 + "no" + "</div>" * 300
    assert render(nested + "no</div>yes") == "yes"


def test_deep_lists_quotes_and_tables():
    assert render("<ul><li>a" * 300) == lines(*("  " * i + "- a" for i in range(300)))
    assert render("<ol><li>" * 300 + "x<br>y") == lines("1. " * 300 + "x", "   " * 300 + "y")
    quoted = "<blockquote>" * 300 + "x<br><br>y" + "</blockquote>" * 300
    assert render(quoted) == lines("  " * 300 + "x", "", "  " * 300 + "y")
    table = "<table><tr><td>a<td>b<tr><td colspan=2>" * 300 + "x"
    assert render(table).count("a  b") == 300
    assert len(render("<blockquote>" * 2000 + "x<br>" * 2000)) == 2000 * 4002 - 1


@pytest.mark.parametrize(
    ("css", "html", "text"),
    [
        (".x{display:none}", "<p class=x>no<p class='a x'>no<p class=X>yes", "yes"),
        ("#a, p.b { color:red; display : NONE }", "<i id=a>no</i><p class=b>no</p><i class=b>yes</i>", "yes"),
        ("p{display:none}", "<p>no<div>yes</div>", "yes"),
        ("*{visibility:hidden} .v{visibility:visible}", "no <b class=v>yes <i>no</i></b>", "yes"),
        ("div{visibility:hidden}", "<div>no <p style='visibility:visible'>yes</div>", "yes"),
        ("div{visibility:collapse}b{visibility:inherit}", "<div><b>no</b></div>yes", "yes"),
        # The cascade: important, then the attribute, then specificity, then order.
        (".x{display:none} p{display:block}", "<p class=x>no</p>yes", "yes"),
        ("p{display:none} p{display:block}", "<p>yes", "yes"),
        ("p{display:none!important}", "<p style='display:block'>no</p>yes", "yes"),
        ("p{display:none}", "<p style='display:block'>yes", "yes"),
        ("#i{display:none} p.a.b{display:block}", "<p id=i class='a b'>no</p>yes", "yes"),
        ("p{display:none;display:block}", "<p>yes", "yes"),
        ("", "<p style='display:none;display:block'>yes", "yes"),
        ("", "<p style='x:y;visibility:hidden !important;visibility:visible'>no</p>yes", "yes"),
        (".s{display:block}", "<p hidden class=s>yes</p><p hidden>no", "yes"),
        ("input{display:block}", "<input type=hidden value=no>yes", "yes"),
        # Descendants and children.
        ("nav .x{display:none}", "<nav><div><p class=x>no</div></nav><p class=x>yes", "yes"),
        ("nav>p{display:none}", "<nav><p>no</p><div><p>yes</div></nav>", "yes"),
        ("div > .a .b{display:none}", "<div><p class=a><i><b class=b>no</b></i></p></div><b class=b>yes", "yes"),
        ("body div div{display:none}", "<div>yes<div>no</div></div>", "yes"),
        # What does not apply to a page on a screen.
        ("p:hover{display:none} p[x]{display:none} a+p{display:none}", "<a>y</a><p x>es", "y\n\nes"),
        ("@media print{p{display:none}} @media screen{i{display:none}}", "<p>yes</p><i>no</i>", "yes"),
        ("@media (max-width:9px){p{display:none}}", "<p>yes", "yes"),
        ("@import 'x;'; @font-face{display:none} b{display:none}", "<b>no</b>yes", "yes"),
        ("@supports (x){p{display:none}}", "<p>yes", "yes"),
        # Comments, strings, broken sheets.
        ("/* p{display:none} */ i{content:'}';display:none}", "<p>yes</p><i>no</i>", "yes"),
        ("<!-- p{display:none} -->", "<p>no</p>yes", "yes"),
        ("}} p{display:none", "<p>yes", "yes"),
        ("> p{display:none} p >{display:none} ,{display:none}", "<p>yes", "yes"),
        ("html{visibility:hidden} b{visibility:visible}", "no<b>yes</b>", "yes"),
        ("body{display:none}", "no", ""),
    ],
)
def test_style_sheets(css, html, text):
    assert render(f"<style>{css}</style>{html}") == text
    assert render(f"<html><head><title>t</title><style>{css}</style></head><body>{html}") == text
    # A sheet further down applies to all of the page.
    assert render(f"{html}<style type='text/css' media='screen, print'>{css}</style>") == text


def test_sheets_for_other_media_or_in_other_languages_do_not_apply():
    for attributes in ("media=print", "type=text/less", "media='(min-width: 1px)'"):
        assert render(f"<style {attributes}>p{{display:none}}</style><p>yes") == "yes"


def test_columns_are_aligned_at_any_width():
    for width in (59, 60, 61, 80, 500):
        wide = "w" * width
        page = f"<table><tr><td>{wide}<td>b<tr><td>a<td>c</table>"
        assert render(page) == lines(f"{wide}  b", f"{'a'.ljust(width)}  c")


def plain_table(rows):
    """Columns as wide as their widest cell, two spaces apart; empty columns and rows take no room."""
    columns = max(map(len, rows))
    widths = [max((len(row[i]) for row in rows if i < len(row)), default=0) for i in range(columns)]
    out = []
    for row in rows:
        cells = [c.ljust(w) for c, w in zip(row, widths, strict=False) if w]
        if any(row):
            out.append("  ".join(cells).rstrip())
    return "\n".join(out)


def test_plain_tables_are_laid_out_like_by_hand():
    rng = random.Random(6)
    for _ in range(300):
        rows = [
            ["x" * rng.choice([0, 0, 1, 3, 9, 70]) for _ in range(rng.randint(1, 5))]
            for _ in range(rng.randint(1, 6))
        ]
        html = "".join("<tr>" + "".join(f"<td>{cell}" for cell in row) for row in rows)
        assert render(f"<table>{html}</table>") == plain_table(rows)


def plain_places(rows):
    """The columns of cells of (across, down), by marking every covered place."""
    covered, found = set(), []
    for number, row in enumerate(rows):
        column, places, new = 0, [], set()
        for across, down in row:
            while (number, column) in covered:
                column += 1
            places.append(column)
            new |= {(number + d, column + a) for d in range(1, down) for a in range(across)}
            column += across
        covered |= new
        found.append(places)
    return found


def test_spans_cover_what_marking_every_place_covers():
    rng = random.Random(7)
    for _ in range(300):
        rows = [
            [(rng.choice([1, 1, 2, 4]), rng.choice([1, 1, 2, 3, 9])) for _ in range(rng.randint(0, 5))]
            for _ in range(rng.randint(1, 9))
        ]
        columns, found = Columns(), []
        for number, row in enumerate(rows):
            columns.next_row(number)
            column, places, covered = 0, [], []
            for across, down in row:
                column = columns.free_from(column)
                places.append(column)
                if down > 1:
                    covered.append((column, column + across, number + down))
                column += across
            for start, end, until in covered:
                columns.cover(start, end, until)
            found.append(places)
        assert found == plain_places(rows)


LONG = {
    "nested tables": "<table><tr><td>a<td>b<tr><td colspan=2>" * 10_000,
    "tables alone in tables": "<table><tr><td>" * 27_000 + "x",
    "tables beside text": "<table><tr><td>a<br>c<td>" * 16_000,
    "wide and long spans": "<table><tr>" + "<td colspan=1000 rowspan=65534>s" * 10 + "<tr><td>x" * 44_000,
    "spans of all lengths": "<table><tr>"
    + "".join(f"<td rowspan={i + 2}>a" for i in range(10_000))
    + "<tr><td>x" * 24_000,
    "spans like stairs": "<table>" + "".join(f"<tr><td rowspan={i + 2}>a" for i in range(18_000)),
    "nested lists": "<ul><li>a" * 44_000,
    "a wide cell": "<table><tr><td>" + "w" * 200_000 + "<td>b" + "<tr><td>a<td>b" * 14_000,
    "many rules": "<style>" + "".join(f"p.c{i}{{display:none}}" for i in range(9_000)) + "</style>"
    + "".join(f"<p class=c{i}>x" for i in range(12_000)),
}


@pytest.mark.parametrize("name", LONG)
def test_long_pages_take_a_time_in_proportion(name):
    html = LONG[name]
    assert len(html) > 380_000
    began = time.process_time()
    text = render(html)
    assert time.process_time() - began < 5
    assert len(text) < 20 * len(html) + (1 << 25)
    if name != "many rules":
        assert sum(map(text.count, "abcswx")) == len(re.sub("<[^>]*>", "", html))


def test_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, "u"), (2, "", "u"), (None, "<p>a", "u"), (3, "<p>b", "u"), (3, "<p>b", "u")],
        "page_id long, html string, text string",
    )
    rows = extract(pages).collect()
    assert sorted((str(r.page_id), r.text) for r in rows) == [
        ("1", ""),
        ("2", ""),
        ("3", "b"),
        ("3", "b"),
        ("None", "a"),
    ]
    assert extract(pages.limit(0)).count() == 0
