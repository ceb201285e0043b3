import html
import re
import time

import pytest
from cases import clashing

from candlemill.llm import html_text as h

PARTS = {
    "": "",
    "no markup at all": "no markup at all",
    "<p>one<p>two <b>three</b>  x&amp;y&nbsp;z": "one\ntwo three x&y z",
    "<body><nav>menu</nav><article><h1>T</h1><p>Text here is long enough.</p><p>Er.</p></article><footer>f</footer>": "T\nText here is long enough.\nEr.",
    "<body><div class='cookie-notice'>We use cookies, do you accept all of them today?</div><div id=wrap><div class=sidebar>side words</div>"
    "<div class=content><h1>Head</h1><p>The first paragraph of the text.</p><form><label>Name</label></form><ul><li>one<li>two</ul>"
    "<p>The last paragraph of the text.</div><div class=comments><p>reader says hi</p></div></div><div class=footer>foot</div>": "Head\nThe first paragraph of the text.\none\ntwo\nThe last paragraph of the text.",
    "<script>var a='</p>';</script><style>p{}</style><p>Only this</p>": "Only this",
    "<p>a<br>b<!-- no --></p><p hidden>no</p><p><span class=ad>buy</span>rest</p>": "a b\nrest",
    "<nav>only a menu</nav>": "",
}


@pytest.mark.parametrize("page", PARTS)
def test_parts(page):
    assert h.main_text(page) == PARTS[page]


def test_pages_against_their_articles(spark, sf_dir):
    rows = h.report(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<(?:b|br)>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<p>" + "long text " * 50_000)]
    table = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "main_text", "text")
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in h.report(table).collect())
    assert got == [(0, 499_999), (1, 0), (2, 0), (2, 0)]
    assert h.report(table.limit(0)).count() == 0


WORDS = "These are some words of the article that go on for quite a while, as paragraphs of a real text do. " * 3
WHOLE = {
    # names of sections and headings, and names that only contain a boilerplate word
    f"<main><section id='binary-search'><h2 id='search'>Search</h2><p>{WORDS}</p></section><div class='section' id='tags'><p>{WORDS}</p></div>"
    f"<h2 id='social-impact'>Impact</h2><div class='skip-lists'><p>{WORDS}</p></div><div class='page-footer'>f</div><div id=sidebar>s</div></main>": ["Search", WORDS, WORDS, "Impact", WORDS],
    # title and lead beside the body text
    f"<body><div class=top-story><h1>A title of some words</h1><p>{WORDS}</p></div><div class=text>{f'<p>{WORDS}</p>' * 12}</div><nav>menu</nav></body>": ["A title of some words", *[WORDS] * 13],
    # paragraphs around a large table
    f"<div><p>{WORDS}</p><table>{f'<tr><td>{WORDS}</td><td>7</td></tr>' * 12}</table><p>{WORDS}</p></div>": [WORDS, *[WORDS, "7"] * 12, WORDS],
    # two articles without a main element
    f"<body><article><p>{WORDS}</p><p>{WORDS}</p></article><article><h2>Er.</h2><p>{WORDS}</p></article></body>": [WORDS, WORDS, "Er.", WORDS],
}


@pytest.mark.parametrize("page", WHOLE)
def test_no_text_of_the_article_is_lost(page):
    assert h.main_text(page) == "\n".join(" ".join(b.split()) for b in WHOLE[page])


def test_menus_without_names_stay_out():
    menu = "<div>" + "<ul>" + "<li><a href=x>go</a></li>" * 30 + "</ul></div>"
    page = f"<body>{menu}<div>{f'<p>{WORDS}</p>' * 6}</div></body>"
    assert h.main_text(page) == "\n".join([WORDS.strip()] * 6)


BODY = f"<div class=body>{f'<p>{WORDS}</p>' * 8}</div>"
AROUND = {
    # title and lead above the element of the text
    f"<body><div id=page><h1>Title</h1><p class=lead>A short lead.</p>{BODY}</div></body>": ["Title", "A short lead.", *[WORDS] * 8],
    # a short last paragraph in an element of its own, but no legal line
    f"<body>{BODY}<div><p>The end.</p></div><div><p>\u00a9 2020 Someone.</p></div></body>": [*[WORDS] * 8, "The end."],
    f"<body>{BODY}<section><h2>More</h2><p>Short.</p></section></body>": [*[WORDS] * 8, "More", "Short."],
    # the title in the article's header, without the byline
    f"<body><article><header><h1>Title</h1><span>by me</span></header><p>{WORDS}</p></article></body>": ["Title", WORDS],
    f"<body><header><h1>Site</h1></header><article><p>{WORDS}</p></article></body>": [WORDS],
    # a menu without a name in the element of the text; a list with text stays
    f"<body><div>{'<ul>' + '<li><a href=x>go on</a>' * 3 + '</ul>'}<p>{WORDS}</p><ul><li><a href=x>one</a><li>two</ul></div></body>": [WORDS, "one", "two"],
    f"<body>{BODY}<div class=gdpr-box>We keep data.</div><div class=user-responses><p>{WORDS}</p></div></body>": [WORDS] * 8,
}


@pytest.mark.parametrize("page", AROUND)
def test_blocks_around_the_text(page):
    assert h.main_text(page) == "\n".join(" ".join(b.split()) for b in AROUND[page])


@pytest.mark.parametrize("piece", ["<div>", "<ul><p>x", "<tr><div>", "<tbody>x", "<i></b>", "<a ", "<!--", "<![", "<!", "</a ", '<a x="', "<script>"])
def test_markup_without_an_end_takes_linear_time(piece):
    begin = time.process_time()
    h.main_text("<p>text</p>" + piece * 100_000)
    assert time.process_time() - begin < 10


def test_odd_declarations():
    assert h.main_text("<p>a<![foo]>b<![if x]>c<!x>d<!---->e<!-->f") == "abcdef"
    assert h.main_text("<p>text</p><!-- no end <p>more</p>") == "text"
