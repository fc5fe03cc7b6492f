import pytest

from slotline.llm import html_template

PAGES = "page_id long, url string, html string, host string, text string, container string, salt int, one int"

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body class="page"><header><h2>Site</h2></header><nav><ul><li><a href=x>Home<li><a>News</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="sidebar"><p>Side</p></div>
<article><header><h1>The  title%d</h1></header><p>One &eacute; &lt;b&gt;<b>bold</b>text<br>two\n lines %d<p>Unclosed <i>here</i>
<div class="ad">Buy</div><form><input value=x><button>Send</button>Name</form><ul><li>first<li>second</ul>
<!-- hidden <p>no</p> --><script>no()</script><table><tr><td>a<td>b</table>last
<section class="comments"><p>A reader wrote</p></section></article>
<aside>Aside</aside><footer>&copy; foot</footer></body></html>"""

TEXT = "The title%d\nOne é <b>boldtext\ntwo lines %d\nUnclosed here\nfirst\nsecond\na\nb\nlast"

#: No element is named for the article; a block is the same on all pages of the host.
PLAIN = """<html><body><div class="menu">Home</div><div class="box x%d"><div class="q"><p>Text number %d is long enough to hold nearly
all of it, with some more words.</p><p>And %d.</p></div></div><div class="box2"><p>Always the same words</p></div>
<div class="footer-links">Imprint</div></body></html>"""


@pytest.fixture
def make_pages(spark):
    return lambda *rows: spark.createDataFrame([(*r, *[None] * 5) for r in rows], PAGES)


def texts(pages):
    return {r["page_id"]: r["text"] for r in html_template.extract(pages).collect()}


def test_the_article_and_nothing_else(make_pages):
    rows = [(i, f"http://h{i % 2}.example/{i}", ARTICLE % (i, i)) for i in range(14)]
    assert texts(make_pages(*rows)) == {i: TEXT % (i, i) for i in range(14)}


def test_a_template_without_a_named_article(make_pages):
    rows = [(i, f"http://plain.example/{i}", PLAIN % (i, i, i)) for i in range(12)]
    expected = {i: f"Text number {i} is long enough to hold nearly all of it, with some more words.\nAnd {i}." for i in range(12)}
    assert texts(make_pages(*rows)) == expected


#: The title and lead stand beside the element that holds nearly all text; with names for the article and without.
LEAD = """<html><body><div class="menu">Home</div><div class="%s"><h1>Title %d</h1><p>Lead %d</p><div class="%s"><p>Text number %d
is long enough to hold nearly all of it, %s.</p></div><p>Closing %d</p></div><p>Always the same words</p></body></html>"""


@pytest.mark.parametrize("outer, inner", [("post", "entry-content"), ("a", "b"), ("a", "entry-content"), ("post", "b")])
def test_title_and_lead_beside_the_text_are_kept(make_pages, outer, inner):
    long = "with some more words " * 20 + "to end"
    rows = [(i, f"http://lead.example/{i}", LEAD % (outer, i, i, inner, i, long, i)) for i in range(12)]
    assert texts(make_pages(*rows)) == {
        i: f"Title {i}\nLead {i}\nText number {i} is long enough to hold nearly all of it, {long}.\nClosing {i}" for i in range(12)
    }


def test_copies_of_a_page_keep_their_text(make_pages):
    rows = [(i, f"http://same.example/{i}", ARTICLE % (1, 1)) for i in range(20)]
    assert set(texts(make_pages(*rows)).values()) == {TEXT % (1, 1)}


def test_odd_pages(make_pages):
    rows = [
        (1, None, None), (2, "", ""), (3, "nonsense", "plain text &amp; no tags"), (4, "http://x", "<p>a<p>b &am <b"),
        (5, "http://x", "<article>" + "<p>word</p>" * 30_000), (6, "http://x", "</div></article><main>\xa0in \n main</main>out"),
        (7, "http://x", "<div>" * 3000 + "deep"), (7, "http://x", "<div>" * 3000 + "deep"), (None, "http://x", "<script>only"),
        (8, "http://x", "<article><p>a</p><!-- never closed <p>b"), (9, "http://x", "<article data-x='>'>t<p title=\"<p>\">u"),
    ]
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in html_template.extract(make_pages(*rows)).collect()]
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)
    text = {i: t for i, t, _ in found}
    assert text[1] == text[2] == text[None] == ""
    assert text[3] == "plain text & no tags" and text[5] == "\n".join(["word"] * 30_000)
    assert text[6] == "in main" and text[7] == "deep" and text[8] == "a" and text[9] == "t\nu"


def test_no_pages(make_pages):
    assert html_template.extract(make_pages()).count() == 0


def test_equal_vectors_make_a_class(make_pages):
    """Tokens that occur alike on the same pages have one number, others another."""
    rows = [(i, "http://h/", f"<div class=a><p>x</p></div>{'<section>s</section>' if i % 2 else ''}") for i in range(8)]
    hosted = html_template._hosted(make_pages(*rows))
    seen = {(r["host"], r["token"]): (r["pages"], r["vector"]) for r in html_template.occurrences(hosted).collect()}
    assert seen["h", "<div class=a>"] == seen["h", "<div class=a><p>"] and seen["h", "<section>"][0] == 4
    assert seen["h", "<section>"][1] != seen["h", "<div class=a>"][1]
