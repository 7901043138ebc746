import random
import re
import time
from html import unescape

import duckdb
import pytest

from sievemill.llm.main_text import extract_pages, main_text
from tests.llm.helpers import MIDDLE

BODY = "<p>First one, with &amp; a mark. And more of it.</p><p>Second   one,\n which is longer; it says a lot.</p>"


@pytest.mark.parametrize(
    "page,text",
    [
        ("<html><head><title>T</title></head><body><nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>Head</h1>" + BODY + "</article><footer>&copy; x</footer></body></html>", "Head\nFirst one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
        ("<div class='page-header'>Top</div><div id=main-content>" + BODY + "</div><div class=sidebar><p>Side text, a lot of it, really.</p></div>", "First one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
        ("<main>" + BODY + "<section id=comments><article><p>A comment, of someone.</p></article></section><form><p>Sign, up.</p></form></main>", "First one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
        ("<article><p><b>Open<br><p>Next&nbsp;word<script>var t='</p>'</script><!-- no --></article>", "Open\nNext word"),
        ("<article><p>Cut off in the mid", "Cut off in the mid"),
        ("no tags at all,  just\ntext", "no tags at all, just text"),
        ("", ""), (None, ""), ("<html><body><nav>Only menu</nav></body></html>", ""), ("<<>><p", "<<>>"), ("a < b and c > d", "a < b and c > d"),
        ("<article><p>x</p><div class='cookie-notice'>We use, cookies.</div><p>y, z.</p></article>", "x\ny, z."),
        ("<article><style>p{}</style><ul><li>One, two.<li>Three, four.</ul><table><tr><td>A, b.<td>C.</table></article>", "One, two.\nThree, four.\nA, b.\nC."),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("attributes", ['title="the hidden gem"', "data-x='a role=menu b'", 'title = "see class=sidebar there"', "data-class=sidebar", 'alt=x title="id=footer hidden"'])
def test_words_of_values_are_not_attributes(attributes):
    assert main_text(f"<article><section {attributes}><p {attributes}>One, two.</p></section><p>Three, four.</p></article>") == "One, two.\nThree, four."


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", 'title="a b" hidden', "title='x'hidden", 'title="hidden" class="big sidebar"', "role = menu", "aria-hidden=true"])
def test_attributes_still_leave_elements_out(attributes):
    assert main_text(f"<article><p {attributes}>One, two.</p><p>Three, four.</p></article>") == "Three, four."


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert len(main_text("<article>" + "<p>word, word.</p>" * 20000 + "</article>").split("\n")) == 20000
    main_text("<a href=\"" * 3000)


def test_pages(spark):
    rows = [(1, "u", "<article><p>é, x.</p></article>", "z"), (None, None, None, "z"), (1, "u", "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in extract_pages(df).collect()) == [("1", "", 0), ("1", "é, x.", 5), ("None", "", 0)]
    assert extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>Hello.<span class=\"ad\">buy <span>now</span> cheap!</span> and more.</p></article>", "Hello. and more."),
        ("<article><p>One, two.</p><nav><div>a<div>b</div></div><ul><li>c</ul></nav><p>Three.</p></article>", "One, two.\nThree."),
        ("<article><p>One, two.</p><form><p>x<section>y</section></form><p>Three.</p></article>", "One, two.\nThree."),
        ("<article><p>One, two.<aside><p>never closed</article><p>", "One, two."),
        ("<article><p>One, two.<p hidden>gone<p>Three.</article>", "One, two.\nThree."),
        ("<article><h2>Links</h2><p>Text, that says, a lot.</p><ul><li><a href=x>Only a link</a></li><li>Short</li></ul></article>", "Links\nText, that says, a lot.\nOnly a link\nShort"),
        # no article element: the ratios find the section
        ("<div><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div><h1>Head</h1>" + BODY + "</div><div><a href=x>Imprint</a></div>", "Head\nFirst one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
        ("<table><tr><td><a href=a>Home</a></td><td>" + BODY + "</td></tr></table>", "First one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
        # a page that is suspect as a whole
        ("<div class='comment-page'>" + BODY + "</div>", "First one, with & a mark. And more of it.\nSecond one, which is longer; it says a lot."),
    ],
)
def test_more_pages(page, text):
    assert main_text(page) == text


def test_ratios_decide():
    page = "<body><div class=ad>Buy this, now.</div><article>" + BODY + "</article></body>"
    assert "Buy" not in main_text(page) and "Buy" in main_text(page, share=0.0)


@pytest.mark.parametrize("unit", ["<div>x ", "<p>x<nav>", "<b>x", "</div>x", "<a \"'>", "<!-- ", "<nav><div>x", "<div class=ad>x ", "<li>x</ul>", "&amp", "<td>x"])
def test_time_grows_with_length(unit):
    page = unit * 50_000
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 4  # a second or so; a quadratic step takes minutes


def pages_of(n):
    """Pages in other frames than those of the test tables, and their texts."""
    r = random.Random(n)
    prose = lambda k: " ".join(r.choice(["some", "words,", "of", "text.", "It", "says;", "more", "&amp;", "é"]) for _ in range(k))
    for _ in range(n):
        blocks = [("h1", prose(5)), *((r.choice(["p", "p", "p", "h2", "blockquote", "li"]), prose(r.randint(15, 80))) for _ in range(r.randint(3, 12)))]
        inner = "".join(f"<{t}>{x}</{t}>" + r.choice(["", "<script>x<y</script>", "<div class='ad box'>Buy, now.</div>", "<!-- z -->", "<aside>Side, note.</aside>"]) for t, x in blocks)
        frame = r.choice(["<article>%s</article>", "<main>%s</main>", "<div id=x1>%s</div>", "<table><tr><td>%s</td></tr></table>", "<body><article>%s</article></body>"])
        page = "<html><nav><a href=/>Home</a></nav><div><a href=a>A</a> <a href=b>B</a></div>" + frame % inner + "<section id=comments><p>Nice, text.</p></section><footer>&copy; all</footer></html>"
        yield page, "\n".join(unescape(x) for _, x in blocks)


def test_other_frames():
    for page, text in pages_of(200):
        assert main_text(page) == text, page


def test_query_equals_plain_reading(spark):
    """The registered query on the test pages against a plain cut of their article element."""
    from sievemill.llm.queries import queries

    cut = re.compile(r"</?(?:p|h1|ul|li|div)\b[^>]*>")
    want = {}
    for i, page in duckdb.sql(f"select page_id, html from '{MIDDLE}/pages.parquet'").fetchall():
        inner = re.search("<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
        lines = (" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in cut.split(inner))
        want[i] = "\n".join(x for x in lines if x)
    got = queries()["op2_html_extraction"](spark, MIDDLE).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
