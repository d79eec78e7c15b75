import html
import re
import time

import pytest
from pyspark.sql import functions as F

from kinfold.llm.html_text import extract, main_text

LONG = "A sentence of the article, with commas, and a full stop. " * 6
CASES = [
    (None, ""), ("", ""), ("   ", ""), ("plain text only, no markup.", "plain text only, no markup."), ("<html><body></body></html>", ""),
    (f"<body><nav><a href='/a'>Home</a></nav><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><footer>Foot</footer>", f"Head {LONG.strip()} Short."),
    (f"<div class='menu'>m</div><div id=main><h2>T</h2><p>{LONG}<p>x &amp; y &lt;z&gt; &copy 1</div><div class='comments'><p>{LONG * 2}</p></div>", f"T {LONG.strip()} x & y <z> © 1"),
    (f"<article><p>{LONG}</p><aside>side</aside><div class=\"cookie-notice\">We use</div><form><p>Sign</p></form><p>End</p></article>", f"{LONG.strip()} End"),
    (f"<body><p>one<br>two  \n three<b>bold</b>ly <i>x</i><p>{LONG}", f"one two three" + f"boldly x {LONG.strip()}"),
    (f"<article><script>var a='<p>no</p>';</script><style>p{{}}</style><p>{LONG}</p><!-- <p>no</p> --></article>", LONG.strip()),
    (f"<article><p>{LONG} 1 < 2 and a<b", f"{LONG}1 < 2 and a".strip()),
    (f"<article><p hidden>no</p><p style='display: none'>no</p><div aria-hidden=true>no</div><p>{LONG}</article>", LONG.strip()),
    (f"<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>{LONG}</article>", f"a b c d {LONG.strip()}"),
    (f"<p>{LONG}</p><a href=\"unclosed>{LONG}", f"{LONG}{LONG.strip()}"),
]

ARTICLE = f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article>"
PROSE = f"<h1>Head</h1><p>{LONG}</p><p>Short.</p>"
TEXT = f"Head {LONG.strip()} Short."
MENU = "<nav><a href='/a'>Home</a> <a href='/b'>Away</a></nav>"
FOOT = "<footer>&copy; example</footer>"
LAYOUTS = [
    f"<body>{MENU}<div class='content has-sidebar'>{ARTICLE}<div class='sidebar'><p>Also read this.</p></div></div>{FOOT}</body>",
    f"<body>{MENU}<div class='layout no-sidebar'>{PROSE}</div>{FOOT}</body>",
    f"<body><div id='page-with-header'><header>Site name</header>{PROSE}</div>{FOOT}</body>",
    f"<body><form action='/'><input name=q><label>Find</label>{MENU}<div>{PROSE}</div>{FOOT}</form></body>",
    f"<body>{MENU}<div class='post comments-open'>{PROSE}</div><div class='comments'><p>First! {LONG}</p></div>{FOOT}</body>",
    f"<body>{MENU}<article><section class='discussion'>{PROSE}</section></article>{FOOT}</body>",
    f"<body>{MENU}<div class='film-review reviews'>{PROSE}</div>{FOOT}</body>",
    f"<body>{MENU}<main><div class='notice'>Read our rules.</div>{PROSE}<div id=disqus_thread><p>{LONG * 3}</p></div></main>{FOOT}</body>".replace("disqus_thread", "comments"),
    f"<body>{ARTICLE}<section class=comments>{'<p>' + LONG * 9 + '</p>'}</section></body>",
    f"<body><aside>{LONG}</aside>{ARTICLE}<div class=related><p>{LONG * 3}</p></div></body>",
]


@pytest.mark.parametrize("page", LAYOUTS)
def test_names_do_not_decide_alone(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize("page", ["<b>" * 40_000 + "</i>" * 40_000, "<i><p>" + "<b>" * 40_000 + "</i>" * 40_000, "<div>" * 40_000 + "x" + "</p>" * 40_000, "<p>x<i>" * 30_000,
                                  "<table><tr><td>" * 20_000 + "y", "<ul><li>" * 20_000 + "<li>" * 20_000, "<div class='nav'>" * 20_000 + "z" + "<b>q</b>" * 20_000, "<a href=\"" * 30_000])
def test_work_is_linear(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 5


@pytest.mark.parametrize("page,want", CASES)
def test_small_pages(page, want):
    assert main_text(page) == want


def test_table_against_the_article_element(spark):
    """The pages of the table mark their article, so a plain pattern gives the text."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(df).collect()}
    rows = df.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_odd_rows(spark):
    big = "<div>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    df = spark.createDataFrame([(1, "u", None), (None, None, big), (2, "u", "<p>x"), (2, "u", "<p>x")], "page_id long, url string, html string").withColumn("n_chars", F.lit("q"))
    got = sorted(((r.page_id, r.text) for r in extract(df).collect()), key=str)
    assert got == sorted([(1, ""), (None, LONG.strip()), (2, "x"), (2, "x")], key=str)
    assert extract(df, carry=True).select("row.*").columns == df.columns
    assert extract(df.limit(0)).count() == 0
