"""URL filter: fixed rules first, then association rules mined from labelled URLs by FP-growth.

Fixed rules name a host (and all its subdomains) and a start of the path; the longest that fits decides. For the
other URLs, FP-growth mines combinations of URL tokens from labelled pages. Combinations become rules
whose confidence is well above the share of blocked pages (by a factor, and by standard errors), with the support
asked for, and that reach the factor on held-out labels too. A rule that holds a smaller rule of no lower
confidence is pruned, level by level of sizes. All tokens of a labelled URL are mined, however many. Tokens that stand
in the same pages are one before mining, and a combination is not grown by a token that leaves it as many pages that
are not blocked: the result could be no rule, so nothing is lost, and copies of long URLs do not blow up. Long URLs that
differ at random in many tokens, blocked ones and others alike, still have very many combinations, and all are grown.
Rules are found by an inverted index: each stands under its rarest token, URLs are joined by token, and the rule's
other tokens are checked. A URL that fits any rule is blocked.

Tokens are host parts (h:), words of the path (p:) and names of query parameters (q:); numbers are one token
each. A null url, or one without ://, has an empty host and path, no tokens, and is allowed. Null ids and
repeated rows are judged like any other row. Pages labelled several times count as blocked if any label
says so. Very long URLs are read whole; ties among rules (a URL fits several) give the highest confidence. Without
labels, or if no rule passes, all that no fixed rule fits is allowed. Columns of any names may stand beside those
that are read, and are left out. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (verdict, host, start of the path).
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Rules: share and number of labelled pages behind one, factor and standard errors above the base rate.
SUPPORT, LEAST, LIFT, DEVIATIONS = 0.0002, 5, 1.3, 2.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SET = "tokens array<string>, n long, blocked long"
_SETS = pa.schema([("tokens", pa.list_(pa.string())), ("n", pa.int64()), ("blocked", pa.int64())])
#: Combinations that a task sends at a time.
_BATCH = 4096


def host_of(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: str | Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, sorted."""
    url = F.col(url) if isinstance(url, str) else url
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    number = lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("#")).otherwise(w)
    words = lambda text, cut, mark: F.transform(F.filter(F.split(text, cut), lambda w: w != ""), lambda w: F.concat(F.lit(mark), number(w)))
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    names = F.transform(F.filter(names, lambda w: w != ""), lambda w: F.concat(F.lit("q:"), w))
    return F.array_sort(F.array_distinct(F.concat(words(host, r"[.\-:@]+", "h:"), words(F.lower(path), "[^a-z0-9]+", "p:"), names)))


def _merged(rows: DataFrame) -> DataFrame:
    """(name, n, hits, misses) of tokens worth mining: those that stand in the same rows are one, by the smallest one's name, and those of all rows are left out.

    rows: (tokens, hits, misses, key), distinct tokens, key a 128-bit name. Exact, as no minimal rule holds two tokens of the same rows, or one of all.
    """
    held = rows.select(F.explode("tokens").alias("token"), "hits", "misses", "key.*").groupBy("token")
    sums = [F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("a"), F.expr("bit_xor(b)").alias("b"), F.sum("hits").alias("hits"), F.sum("misses").alias("misses")]
    total = rows.count()
    return held.agg(*sums).filter(F.col("n") < total).groupBy("n", "a", "b", "hits", "misses").agg(F.min("token").alias("name")).select("name", "n", "hits", "misses")


def _grown(paths: list[tuple[tuple[str, ...], int, int]], suffix: tuple[str, ...], least: int) -> Iterator[tuple[tuple[str, ...], int, int]]:
    """(tokens, hits, misses) of the combinations that extend `suffix`, by FP-growth.

    paths: (tokens, hits, misses) of the rows that hold the suffix, tokens in one order for all. With as many misses as
    the suffix, a larger combination has no higher confidence than without the token, and so has all that holds it.
    """
    misses = sum(path[2] for path in paths)
    counts: dict[str, list[int]] = {}
    for tokens, hit, missed in paths:
        for token in tokens:
            count = counts.setdefault(token, [0, 0])
            count[0] += hit
            count[1] += missed
    counts = {token: c for token, c in counts.items() if c[0] >= least and c[1] < misses}
    if not counts:
        return
    # the FP-tree: nodes [token, parent, hits, misses], and the nodes of each token
    nodes, below, heads = [["", 0, 0, 0]], {}, {token: [] for token in counts}
    for tokens, hit, missed in paths:
        at = 0
        for token in tokens:
            if token in counts:
                child = below.get((at, token))
                if child is None:
                    child = below[at, token] = len(nodes)
                    nodes.append([token, at, 0, 0])
                    heads[token].append(child)
                at = child
                nodes[at][2] += hit
                nodes[at][3] += missed
    below.clear()
    for token, (hit, missed) in counts.items():
        grown = (*suffix, token)
        yield grown, hit, missed
        if missed:
            inside = []
            for node in heads[token]:
                path, at = [], nodes[node][1]
                while at:
                    path.append(nodes[at][0])
                    at = nodes[at][1]
                inside.append((tuple(reversed(path)), nodes[node][2], nodes[node][3]))
            yield from _grown(inside, grown, least)


def _growth(least: int):
    """applyInArrow over the rows of a token, (token, tokens before it, hits, misses): the combinations of the token with them."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, known = [], {}
        for batch in batches:
            for tokens, hit, missed in zip(batch["before"], batch["hits"].to_pylist(), batch["misses"].to_pylist(), strict=True):
                paths.append((tuple(known.setdefault(t, t) for t in tokens.as_py()), hit, missed))
        sets = []
        for tokens, hit, missed in _grown(paths, (key[0].as_py(),), least):
            sets.append({"tokens": sorted(tokens), "n": hit + missed, "blocked": hit})
            if len(sets) == _BATCH:
                yield pa.RecordBatch.from_pylist(sets, _SETS)
                sets = []
        yield pa.RecordBatch.from_pylist(sets, _SETS)

    return run


def itemsets(labelled: DataFrame, least: int) -> DataFrame:
    """(tokens, n long, blocked long): combinations of tokens that stand together in `least` blocked rows or more, all that can hold a minimal rule.

    labelled: (tokens array<string>, blocked boolean). Of the tokens of the same rows only one is used. With a combination all its parts are given.
    Tokens that only blocked rows hold are rules by themselves or none, and part of no larger one.
    """
    key = F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b")).alias("key")
    hits = F.coalesce(F.col("blocked").cast("long"), F.lit(0))
    rows = labelled.groupBy("tokens").agg(F.sum(hits).alias("hits"), F.sum(1 - hits).alias("misses")).withColumn("key", key)
    names = _merged(rows).filter(F.col("hits") >= least).checkpoint()
    single = names.select(F.array("name").alias("tokens"), (F.col("hits") + F.col("misses")).alias("n"), F.col("hits").alias("blocked"))
    held = rows.select("key", "hits", "misses", F.explode("tokens").alias("name")).join(names.filter("misses > 0").select("name", "n"), "name")
    held = held.groupBy("key", "hits", "misses").agg(F.sort_array(F.collect_list(F.struct(-F.col("n"), F.col("name").alias("name"))))["name"].alias("names"))
    held = held.groupBy("names").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    before = held.select("names", "hits", "misses", F.posexplode("names").alias("at", "token")).select("token", F.expr("slice(names, 1, at)").alias("before"), "hits", "misses")
    before = before.groupBy("token", "before").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    return single.union(before.groupBy("token").applyInArrow(_growth(least), _SET)).checkpoint()


def _smallest(sets: DataFrame) -> DataFrame:
    """The rules (tokens, confidence) among itemsets (tokens, confidence, rule) that hold no smaller rule of the same or a higher confidence.

    Level by level: the best rule inside an itemset is one of those of its subsets without one token, or one of them.
    """
    out, best, size = None, None, 1
    while True:
        level = sets.filter(F.size("tokens") == size)
        if best is not None:
            smaller = level.select("tokens", F.explode("tokens").alias("token")).select("tokens", F.array_remove("tokens", F.col("token")).alias("part"))
            inside = smaller.join(best, "part").groupBy("tokens").agg(F.max("best").alias("inside"))
            level = level.join(inside, "tokens", "left")
        else:
            level = level.withColumn("inside", F.lit(None).cast("double"))
        level = level.checkpoint()
        rules = level.filter("rule and (inside is null or inside < confidence)").select("tokens", "confidence")
        out = rules if out is None else out.union(rules)
        if level.isEmpty():
            return out
        # greatest skips nulls
        best = level.select(F.col("tokens").alias("part"), F.greatest("inside", F.when(F.col("rule"), F.col("confidence"))).alias("best"))
        size += 1


def mine(labelled: DataFrame, support: float = SUPPORT, least: int = LEAST, lift: float = LIFT, deviations: float = DEVIATIONS, checked: DataFrame | None = None) -> DataFrame:
    """(tokens array<string>, confidence double) of rules from labelled (tokens array<string>, blocked boolean).

    support: share of the labelled URLs that hold a rule's tokens and are blocked; least: their number. A rule's
    confidence is `lift` times the share of blocked URLs or more, and `deviations` standard errors above it.
    checked: further labelled rows, on which rules must reach the lift too.
    """
    labelled = labelled.select("tokens", "blocked").checkpoint()
    total, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0))).first()
    empty = labelled.sparkSession.createDataFrame([], "tokens array<string>, confidence double")
    if not blocked:
        return empty
    base = blocked / total
    found = itemsets(labelled, max(least, math.ceil(support * total))).withColumn("confidence", F.col("blocked") / F.col("n"))
    error = F.sqrt(F.lit(base * (1 - base)) / F.col("n"))
    found = found.withColumn("rule", (F.col("confidence") >= lift * base) & (F.col("confidence") >= base + deviations * error))
    rules = _smallest(found)
    if checked is not None:
        rules = rules.checkpoint()
        seen = measured(rules, checked)
        rules = rules.join(seen.filter(F.col("blocked") >= lift * F.col("base") * F.col("n")).select("tokens"), "tokens", "left_semi")
    return rules.checkpoint()


def measured(rules: DataFrame, checked: DataFrame) -> DataFrame:
    """(tokens, n, blocked, base): the checked (tokens, blocked) rows that each rule fits, and the share of blocked ones among all."""
    base = checked.agg(F.avg(F.col("blocked").cast("double"))).first()[0]
    rows = checked.groupBy("tokens").agg(F.count("*").alias("n"), F.sum(F.col("blocked").cast("long")).alias("blocked"))
    fits = fitting(rows, rules)
    return fits.groupBy(F.col("rule").alias("tokens")).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).withColumn("base", F.lit(base))


def fitting(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (tokens, ...) with each rule that fits them, by inverted index: rules stand under their rarest token."""
    held = rows.withColumn("token", F.explode("tokens"))
    count = held.groupBy("token").agg(F.count("*").alias("in"))
    rarest = F.min(F.struct(F.coalesce("in", F.lit(0)), F.col("token"))).alias("rarest")
    index = rules.select(F.col("tokens").alias("rule"), "confidence", F.explode("tokens").alias("token")).join(count, "token", "left")
    index = index.groupBy("rule", "confidence").agg(rarest).select("rule", "confidence", F.col("rarest.token").alias("token"))
    return held.join(index, "token").filter(F.size(F.array_except("rule", "tokens")) == 0).drop("token")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url, tokens), distinct -> (url, confidence of the best rule that fits)."""
    return fitting(urls.select("url", "tokens"), rules).groupBy("url").agg(F.max("confidence").alias("confidence"))


def fixed_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text (host and path) and verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def held_out(row_id: str) -> Column:
    """Whether a labelled page only checks rules: crc32 of its id is divisible by 5."""
    return F.crc32(F.col(row_id).cast("string").cast("binary")) % 5 == 0


def learn(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", **limits) -> tuple[DataFrame, DataFrame]:
    """The rules (tokens, confidence) mined from pages that are not held out, and the held-out (tokens, blocked) that checked them."""
    url = F.col("url")
    with_tokens = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", tokens_of(url, host_of(url), path_of(url)).alias("tokens"))
    known = labels.filter("id is not null and blocked is not null").groupBy("id").agg(F.max("blocked").alias("blocked"))
    labelled = with_tokens.filter("size(tokens) > 0").join(known, "id").select("id", "tokens", "blocked").checkpoint()
    checked = labelled.filter(held_out("id")).select("tokens", "blocked")
    return mine(labelled.filter(~held_out("id")), checked=checked, **limits), checked


def filter_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, **limits) -> DataFrame:
    """One row per page: the id, host, path, rule, verdict, and confidence of the best mined rule that fits (null: none). labels: (id, blocked boolean)."""
    url = F.col("url")
    mined, _ = learn(pages, labels, id_col, url_col, **limits)
    parsed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host_of(url), "path": path_of(url)})
    open_urls = parsed.select("url", tokens_of(url, F.col("host"), F.col("path")).alias("tokens")).filter("size(tokens) > 0").distinct()
    hit = matches(open_urls, mined).select(F.col("url").alias("hit"), "confidence")
    rule, verdict = fixed_verdict(F.col("host"), F.col("path"), rules)
    judged = parsed.join(hit, F.col("url") == F.col("hit"), "left")
    method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "confidence")


def op6_url_filters(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), labels)
