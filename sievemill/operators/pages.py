"""Help pages to link tables and articles."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.config import Scraping
from sievemill.functions import batches, html_dom, text
from sievemill.operators.dedup import keep_first


def page_links(pages: DataFrame, kind: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_url, page_ord, pos, href, text): links into /collections/ or /articles/, in document order."""

    def run(p: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*(p[c].to_pylist() for c in ("url", "ord", "html")), strict=True)
        rows = [(u, o, k, h, t) for u, o, page in columns for k, (h, t) in enumerate(html_dom.links(html_dom.parse(page or ""), kind))]
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(arrays, names=["page_url", "page_ord", "pos", "href", "text"])

    return pages.select(F.col(url_col).alias("url"), "ord", F.col(html_col).alias("html")).mapInArrow(batches.sliced(run), "page_url string, page_ord long, pos int, href string, text string")


def collections(pages: DataFrame, scraping: Scraping = Scraping()) -> DataFrame:
    """Collections linked from pages; of one id the first link counts."""
    found = page_links(pages, "collections").filter(text.is_link("href", "collections")).withColumn("full", text.absolute("href", scraping.origin))
    parts = found.withColumns({"id": text.url_part("full", "collections", "id"), "slug": text.url_part("full", "collections", "slug"), "ord": F.struct("page_ord", "pos")}).filter("id != ''")
    kept = keep_first(parts, "id")
    return kept.select("id", "slug", text.slug_name("slug", scraping.collection_names).alias("name"), text.strip_query("full").alias("url"), "ord")


def article_refs(pages: DataFrame, scraping: Scraping = Scraping()) -> DataFrame:
    """Articles linked from collection pages (with collection and collection_id), the first of each id across all."""
    found = page_links(pages, "articles").withColumn("full", text.absolute("href", scraping.origin))
    parts = found.withColumns({"id": text.url_part("full", "articles", "id"), "slug": text.url_part("full", "articles", "slug"), "ord": F.struct("page_ord", "pos")}).filter("id != ''")
    kept = keep_first(parts, "id")
    about = pages.select(F.col("ord").alias("page_ord"), "collection", "collection_id")
    return kept.join(about, "page_ord").select("id", "slug", F.col("text").alias("title"), text.strip_query("full").alias("url"), "collection", "collection_id", "ord")


def articles(pages: DataFrame, scraping: Scraping = Scraping(), vendor_classes: tuple[str, ...] = ()) -> DataFrame:
    """Articles of fetched pages (id, url, title, collection, collection_id, html, ord) with `error` where reading failed.

    Pages that were not fetched (null html) give no row.
    """
    origin, site = scraping.origin, scraping.site_name

    def run(p: pa.RecordBatch) -> pa.RecordBatch:
        docs, errors = [], []
        for html, url, title in zip(*(p[c].to_pylist() for c in ("html", "url", "title")), strict=True):
            try:
                docs.append(json.dumps(html_dom.article(html, {"url": url, "title": title or ""}, origin, site, vendor_classes)))
                errors.append(None)
            except Exception as e:  # a page that cannot be read is reported, the others go on
                docs.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        kept = ["id", "url", "collection", "collection_id", "ord"]
        return pa.RecordBatch.from_arrays([*(p[c] for c in kept), pa.array(docs, pa.string()), pa.array(errors, pa.string())], names=[*kept, "doc", "error"])

    ids = "id string, url string, collection string, collection_id string, ord long"
    source = pages.filter("html is not null").select("id", "url", "title", "collection", "collection_id", "ord", "html")
    read = source.mapInArrow(batches.sliced(run), f"{ids}, doc string, error string")
    parsed = read.withColumn("a", F.from_json("doc", schemas.ARTICLE_BODY))
    content = F.struct(F.col("a.content.raw_html"), text.clean_markdown("a.content.markdown").alias("markdown"), F.col("a.content.plain_text"), F.col("a.content.sections"))
    return parsed.select(F.col("id").alias("article_id"), "url", F.col("a.title"), F.col("a.description"), "collection", "collection_id", content.alias("content"), F.col("a.related_articles"), F.col("a.metadata"), "ord", "error")


def sessionised_sections(blocks: DataFrame) -> DataFrame:
    """Sections by a window: blocks (doc, pos, tag, text) in order; each heading heads the blocks up to the next one."""
    order = Window.partitionBy("doc").orderBy("pos")
    number = F.sum(F.col("tag").isin(*html_dom.HEADINGS).cast("int")).over(order)
    rows = blocks.withColumn("section", number).filter("section > 0")
    texts = F.array_sort(F.collect_list(F.when(~F.col("tag").isin(*html_dom.HEADINGS) & (F.col("text") != ""), F.struct("pos", "text"))))
    head = F.min_by("text", "pos")
    out = rows.groupBy("doc", "section").agg(head.alias("heading"), F.min_by("tag", "pos").alias("tag"), F.array_join(F.transform(texts, lambda t: t["text"]), " ").alias("content"))
    return out.filter("heading != ''").select("doc", "section", "heading", F.substring("tag", 2, 1).cast("int").alias("level"), "content")
