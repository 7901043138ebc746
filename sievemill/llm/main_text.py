"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags and texts, tolerant of missing end tags. Text falls into blocks at block
elements; each block has a root-to-leaf tag path. Elements that hold no article text by their kind (scripts,
menus, headers, footers, asides, forms and the like, by tag or role, or hidden) are left out while reading, and so
are inline elements that a class or id names as adverts and the like. A block element so named stays, but marks its
paths as suspect.

Per path, text length without link text and punctuation are summed over its blocks and divided by their number.
The two ratios are smoothed along the page and fused by their geometric mean, lowered by the path's share of link
text; a suspect path's value is divided by SUSPECT. Paths whose fused ratio reaches a share of the page's largest are content paths, and their blocks content nodes.
The smallest section around all content nodes, widened to the article or main element around it, is the article.
In it, content nodes are kept, and all other blocks whose path is not suspect and whose section is mostly content or
an article: headings, short items and the like, links or not. So adverts, notices and comments beside or inside
the article go because their ratio is low, and a page that is suspect as a whole still gives its text.

Null or empty html, and pages without text, give an empty text. White space within a block becomes one space,
blocks are joined by one newline, character references are decoded. Null ids and urls and repeated rows need no
special case; of equal ratios none is preferred, as paths are chosen by a threshold. Paths are numbers in a tree, so
time and memory grow with a page's length at whatever depth. Columns of any names may stand beside the three
that are read, and are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.workers import lean

#: Element names by their part in a page.
RAW = frozenset("script style textarea title noscript iframe noframes template xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SECTIONS = frozenset("body article main section div td center".split())
BLOCKS = SECTIONS | frozenset("html head h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption address details summary fieldset hgroup header footer nav aside form menu dialog".split())
KINDS = frozenset("head nav header footer aside form menu dialog button select option label svg canvas audio video object math".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sidebar menu nav navbar navigation footer header masthead comment comments disqus respond reply replies"
    " cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription share sharing social related recommended promo promotion sponsor sponsored breadcrumb breadcrumbs pagination pager widget toolbar signup login".split()
)
#: Elements that a start tag ends if they are open and nearest.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: How many times less the ratio of a suspect path counts.
SUSPECT = 100.0
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""(?:"[^"]*"|'[^']*'|[^'">])*+""")
#: One attribute after the other, each with its whole value, so that no word of a value counts as a name.
_ATTR = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？؟]")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}


@dataclass
class Block:
    path: int
    section: int
    text: str
    linked: int  # characters inside links
    marks: int  # punctuation


@dataclass
class Page:
    """Blocks in page order; paths and sections are trees, in which parents have smaller numbers. Number 0 is the page."""

    blocks: list[Block] = field(default_factory=list)
    suspect: list[bool] = field(default_factory=lambda: [False])  # by path
    sections: list[str] = field(default_factory=lambda: [""])  # tags
    around: list[int] = field(default_factory=lambda: [0])  # parents of sections


def _judged(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is left out by its kind; whether its class or id is suspect."""
    out, suspect = tag in KINDS, False
    for name, value in _ATTR.findall(attributes):
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in ROLES:
            out = True
        if name in ("class", "id") and tag not in ("body", "html", "article", "main") and any(w.lower() in NAMES for w in _WORD.findall(value)):
            suspect = True
    return out, suspect


def _tags(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before it, tag, whether it closes, attributes), in order; the last one has no tag. Comments end texts without a tag."""
    at, n, text_from = 0, len(page), 0
    patience = 4 * n  # characters to look for closing quotes in vain
    while (low := page.find("<", at)) >= 0:
        if page.startswith("<!--", low) or page.startswith("<![CDATA[", low):
            mark = "-->" if page[low + 2] == "-" else "]]>"
            high = page.find(mark, low + 4)
            high = n if high < 0 else high + 3
            yield page[text_from:low], "", False, ""
            at = text_from = high
            continue
        m = None
        if page.startswith(("<!", "<?"), low):
            name_end, closing, tag = low + 2, False, ""
        elif m := _NAME.match(page, low + 1):
            name_end, closing, tag = m.end(), bool(m[1]), m[2].lower()
        else:
            at = low + 1
            continue
        high = -1
        if m and patience > 0:
            end = _QUOTED.match(page, name_end).end()
            if end < n and page[end] == ">":
                high = end
            else:
                patience -= end - name_end
        if high < 0:  # quotes that do not end, or none to look at
            high = page.find(">", name_end)
            high = n if high < 0 else high
        attributes = page[name_end:high]
        yield page[text_from:low], tag, closing, attributes
        at = text_from = min(n, high + 1)
        if tag in RAW and not closing and not attributes.endswith("/"):
            end = _RAW_END[tag].search(page, at)
            at = text_from = end.end() if end else n
    yield page[text_from:], "", False, ""


def read_page(page: str) -> Page:
    out = Page()
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, int]] = []  # open block elements: tag, path, innermost section
    open_: Counter[str] = Counter()
    skip: list[str] = []  # open elements from the one that is left out on
    inside: Counter[str] = Counter()  # of them
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, path, section = stack[-1] if stack else ("", 0, 0)
                out.blocks.append(Block(path, section, text, min(linked, len(text)), len(_PUNCTUATION.findall(text))))
            parts.clear()
        linked = 0

    def end_skip() -> None:
        skip.clear()
        inside.clear()

    for text, tag, closing, attributes in _tags(page):
        if text and not skip:
            parts.append(text)
            linked += len(text) if in_link else 0
        if not tag or tag in RAW:
            continue
        single = tag in VOID or attributes.endswith("/")
        if skip:
            if closing:
                if inside[tag]:
                    while (top := skip.pop()) != tag:
                        inside[top] -= 1
                    inside[tag] -= 1
                    continue
                if not (open_[tag] and tag in SECTIONS):
                    continue
                end_skip()  # an element around the one left out ends: so does that
            elif tag == "body" and skip[0] == "head" or len(skip) == 1 and tag in BLOCKS and skip[0] in ENDS.get(tag, {"p"}):
                end_skip()  # this tag ends the one left out
            else:
                if not single:
                    skip.append(tag)
                    inside[tag] += 1
                continue
        if closing:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS and open_[tag]:
                flush()
                while (top := stack.pop()[0]) != tag:
                    open_[top] -= 1
                open_[tag] -= 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            in_link = True
        left_out, suspect = _judged(tag, attributes)
        if not single and (left_out or suspect and tag not in BLOCKS):
            if tag in BLOCKS:
                flush()
            if tag == "a":
                in_link = False
            skip.append(tag)
            inside[tag] += 1
            continue
        if tag == "hr":
            flush()
        if tag in VOID or tag not in BLOCKS:
            continue
        flush()
        in_link = False
        if stack and stack[-1][0] in ENDS.get(tag, {"p", "h1", "h2", "h3", "h4", "h5", "h6"}) and (tag in ENDS or stack[-1][0] == "p" or tag[0] == "h" and tag[1:].isdigit()):
            open_[stack.pop()[0]] -= 1
        _, parent, section = stack[-1] if stack else ("", 0, 0)
        path = paths.setdefault((parent, tag + "!" * suspect), len(out.suspect))
        if path == len(out.suspect):
            out.suspect.append(suspect or out.suspect[parent])
        if tag in SECTIONS:
            out.sections.append(tag)
            out.around.append(section)
            section = len(out.sections) - 1
        stack.append((tag, path, section))
        open_[tag] += 1
    flush()
    return out


def _smooth(values: np.ndarray, radius: int = 2) -> np.ndarray:
    total, weights = np.zeros(len(values)), np.zeros(len(values))
    for d in range(-radius, radius + 1):
        w = math.exp(-(d * d) / 2)
        to, of = slice(max(0, -d), len(values) - max(0, d)), slice(max(0, d), len(values) - max(0, -d))
        total[to] += w * values[of]
        weights[to] += w
    return total / weights


def path_ratios(page: Page) -> np.ndarray:
    """The fused ratio of each path; 0 for paths without blocks."""
    n, path = len(page.suspect), np.array([b.path for b in page.blocks])
    size, linked, marks = (np.array([v(b) for b in page.blocks], float) for v in (lambda b: len(b.text), lambda b: b.linked, lambda b: b.marks))
    blocks = np.maximum(np.bincount(path, minlength=n), 1)
    length = np.bincount(path, size - linked, n) / blocks
    points = 1 + np.bincount(path, marks * (1 - linked / size), n) / blocks
    fused = np.sqrt(_smooth(length[path]) * _smooth(points[path]))
    links = np.bincount(path, linked, n) / np.maximum(np.bincount(path, size, n), 1)
    return np.bincount(path, fused, n) / blocks * (1 - links) / np.where(page.suspect, SUSPECT, 1.0)


def main_text(page: str | None, share: float = 0.1) -> str:
    """share: of the page's largest fused ratio that content paths reach."""
    if not page:
        return ""
    read = read_page(page)
    if not read.blocks:
        return ""
    ratio = path_ratios(read)
    content = [ratio[b.path] >= share * ratio.max() for b in read.blocks]
    # characters of all blocks, and of content nodes, in each section; sections come after those around them
    held = np.zeros((len(read.sections), 2))
    for b, c in zip(read.blocks, content, strict=True):
        held[b.section] += len(b.text), len(b.text) * c
    held = held.tolist()
    for k in range(len(held) - 1, 0, -1):
        up = held[read.around[k]]
        up[0] += held[k][0]
        up[1] += held[k][1]
    article = max(k for k in range(len(held)) if held[k][1] == held[0][1])  # the last is the innermost
    for wanted in ("article", "main"):
        k = article
        while k and read.sections[k] != wanted:
            k = read.around[k]
        if k:
            article = k
            break
    within = [False] * len(held)
    for k in range(len(held)):
        within[k] = k == article or k > 0 and within[read.around[k]]
    mostly = [k == article or 2 * c > n or read.sections[k] == "article" for k, (n, c) in enumerate(held)]
    return "\n".join(b.text for b, c in zip(read.blocks, content, strict=True) if within[b.section] and (c or mostly[b.section] and not read.suspect[b.path]))


@lean
def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py()) for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the id, the url, text string and n_chars long (code points)."""
    pages = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = pages.mapInArrow(_extract, "id long, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
