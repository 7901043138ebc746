from sievemill.config import Scraping
from sievemill.functions import html_dom
from sievemill.operators import pages

PAGE = """<html><head><title>Fallback | Help Center</title><meta property="og:description" content="og"><meta name="description" content="meta"></head>
<body><nav><a href="/articles/9-nav">Nav</a></nav><article><header><h1>Lost</h1></header><h1>Title | Help Center more</h1><p>Intro <b>bold</b></p><h2>First</h2><p>One.</p><p>Mixed <i>x</i></p>
<ul><li>Item<li>Next</ul><p><span>Twice</span></p><h3></h3><p>dropped</p><h4>Table</h4><table><tr><td>A<td>B</table><img src=x><iframe src="https://www.youtube.com/e"></iframe>
<a href="javascript:go()">act</a> <a href="/articles/1-a?x=1">One</a><a href="/articles/1-a?x=1">One</a><a href="/articles/2-b">Two</a><a href="https://help.example.com/articles/me">Me</a><script>1</script></article></body>"""


def test_article():
    a = html_dom.article(PAGE, {"url": "https://help.example.com/articles/me"}, "https://help.example.com", "Help Center")
    assert a["title"] == "Title" and a["description"] == "meta"
    assert a["metadata"]["has_images"] and a["metadata"]["has_tables"] and a["metadata"]["has_video"]
    assert [(s["heading"], s["level"], s["content"]) for s in a["content"]["sections"]] == [("Title | Help Center more", 1, ""), ("First", 2, "One. Item Next Twice Twice"), ("Table", 4, "A B")]
    assert "Lost" not in a["content"]["plain_text"] and "1" not in a["content"]["plain_text"].split()
    # a link with a query is stored without it, so the same link is found anew
    assert [r["url"] for r in a["related_articles"]] == ["https://help.example.com/articles/9-nav", "https://help.example.com/articles/1-a", "https://help.example.com/articles/1-a", "https://help.example.com/articles/2-b"]
    assert "## First" in a["content"]["markdown"] and "* Item" in a["content"]["markdown"] and "**bold**" in a["content"]["markdown"]


def test_bodies():
    read = lambda page: html_dom.article(page, {"url": "u", "title": "t"}, "o", "S")
    assert read("<div class='x article-body'>a</div><p>b")["content"]["plain_text"] == "a"
    assert read("<main>m</main>z")["content"]["plain_text"] == "m"
    assert read("loose <b>text")["content"]["plain_text"] == "loose text"
    assert read("")["title"] == "t"


def test_links_keep_the_first(spark):
    html = '<a href="/collections/1-a-b?x">x</a><a href="/collections/1-other">y</a><a href="collections/2-c">no</a><a href="https://h/collections/3-c#t">z</a>'
    df = spark.createDataFrame([("u", 0, html, "C", "7")], "url string, ord long, html string, collection string, collection_id string")
    got = {(r.id, r.slug, r.name, r.url) for r in pages.collections(df, Scraping(collection_names={"c": "See"})).collect()}
    assert got == {("1", "a-b", "A B", "https://help.example.com/collections/1-a-b"), ("3", "c", "See", "https://h/collections/3-c#t")}
    again = df.withColumn("html", __import__("pyspark").sql.functions.lit('<a href="/articles/5-x"> Tit <b>le</b></a><a href="/articles/5-y">late</a>'))
    assert [(r.id, r.title, r.collection) for r in pages.article_refs(again).collect()] == [("5", "Title", "C")]


def test_articles_of_pages(spark):
    rows = [("1", "u1", "", "C", "7", 0, PAGE), ("2", "u2", "", "C", "7", 1, None)]
    df = spark.createDataFrame(rows, "id string, url string, title string, collection string, collection_id string, ord long, html string")
    got = pages.articles(df).collect()
    assert [(r.article_id, r.title, r.error, len(r.content.sections)) for r in got] == [("1", "Title", None, 3)]
    assert "[act](javascript" not in got[0].content.markdown and "act" in got[0].content.markdown


def test_sections_by_window_equal_the_walk(spark):
    blocks = [("d", i, t, x) for i, (t, x) in enumerate([("p", "before"), ("h1", "A"), ("p", "one"), ("li", "two"), ("h2", ""), ("p", "gone"), ("h3", "B")])]
    got = pages.sessionised_sections(spark.createDataFrame(blocks, "doc string, pos int, tag string, text string")).orderBy("section").collect()
    assert [(r.heading, r.level, r.content) for r in got] == [("A", 1, "one two"), ("B", 3, "")]


def test_pages_are_read_in_small_slices(spark, monkeypatch):
    """Python holds what it makes of a few pages, not of a whole batch; rows and their order stay."""
    import pyarrow as pa

    from sievemill.functions import batches

    batch = pa.record_batch({"k": list(range(2500)), "html": ["x" * 3000] * 2499 + ["y" * 3_000_000]})
    parts = list(batches.slices(batch))
    assert [k for p in parts for k in p["k"].to_pylist()] == list(range(2500))
    assert all(p.num_rows == 1 or p.num_rows <= batches.ROWS and p.nbytes <= batches.BYTES for p in parts) and len(parts) > 7
    sent = []
    steps = batches.sliced(lambda p: sent.append(p.num_rows) or p)(iter([batch]))
    next(steps)
    assert sum(sent) <= batches.ROWS  # the first slice is sent on before the next is taken
    rows = [(str(i), "u", "", "C", "7", i, f"<h1>T{i}</h1>" if i % 7 else None) for i in range(2100)]
    df = spark.createDataFrame(rows, "id string, url string, title string, collection string, collection_id string, ord long, html string").coalesce(1)
    got = pages.articles(df).select("article_id", "title").collect()
    assert [(r.article_id, r.title) for r in got] == [(str(i), f"T{i}") for i in range(2100) if i % 7]
