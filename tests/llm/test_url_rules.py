import itertools
import math
import random
import time

from pyspark.sql import functions as F

from sievemill.llm import url_rules

PAGES = "page_id long, url string, host string, tokens string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "clash", "clash") for i, u in urls], PAGES)


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


URLS = ["http://A.example.COM/en/7x?q=1", "https://b.com/en/", "x.com/en/", None, "", "://", "ftp://h#x/y", "http://com/en/a", "http://notcom/en/", "http://x.net/de/8", "http://example.net/de/8", "http://s.example.net/de/81#f", "http://É.org/es/ü?", "a://b://c/d", "http://h?x=/en/", "http://x.org/ES/", "http://a.com\n/en/z"]


def test_hosts_paths_and_rules(spark):
    none = spark.createDataFrame([], "id long, blocked boolean")
    got = {r.page_id: r for r in url_rules.filter_urls(pages(spark, enumerate(URLS)), none).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = brute(url)
        fits = [(len(h + p), what, h + p) for what, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, what, rule = max(fits, default=(0, "allow", None))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, what), url


def test_fixed_rules_say_what_the_contract_says(spark):
    """Each rule's word, written out, also where a mined rule would say the opposite."""
    want = {
        "http://com/en/": ("com/en/", "block"), "http://a.com/en/7": ("com/en/", "block"), "http://a.example.com/en/7x": ("example.com/en/7", "allow"), "http://example.com/en/8": ("com/en/", "block"),
        "http://net/de/": ("net/de/", "allow"), "http://x.net/de/8": ("net/de/", "allow"), "http://example.net/de/81": ("example.net/de/8", "block"), "http://example.net/de/7": ("net/de/", "allow"),
        "http://x.org/es/1": ("org/es/", "block"), "http://x.org/de/1": (None, "allow"),
    }
    none = spark.createDataFrame([], "id long, blocked boolean")
    got = url_rules.filter_urls(pages(spark, enumerate(want)), none).collect()
    assert {url: (r.rule, r.verdict) for r, url in ((r, list(want)[r.page_id]) for r in got)} == want
    urls = [(i, f"http://x{i}.net/de/{'trap' if i % 4 == 0 else 'other'}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 4 == 0) for i, _ in urls], "id long, blocked boolean")
    got = url_rules.filter_urls(pages(spark, [*urls, (999, "http://y.info/trap")]), labels).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "allow" for i, _ in urls} | {999: "block"}


def _labelled(spark):
    urls = [(i, f"http://{'spam-farm' if i % 3 == 0 else 'good'}.site{i % 7}.info/{'buy' if i % 2 else 'read'}/{i}") for i in range(300)]
    blocked = [(i, "spam" in u and "buy" in u) for i, u in urls]
    return urls, pages(spark, urls), spark.createDataFrame(blocked, "id long, blocked boolean")


def test_mined_rules_match_by_index(spark):
    urls, df, labels = _labelled(spark)
    got = url_rules.filter_urls(df.union(pages(spark, [(999, "http://spam-farm.x.info/buy/now"), (None, "http://spam-farm.y.info/buy"), (5, None)])), labels, lift=4.0)
    verdict = {(r.page_id): r.verdict for r in got.collect()}
    assert all(verdict[i] == ("block" if "spam" in u and "buy" in u else "allow") for i, u in urls if i != 5)
    assert verdict[999] == "block" and verdict[None] == "block"
    rules, _ = url_rules.learn(df, labels, lift=4.0)
    mined = [set(r.tokens) for r in rules.collect()]
    assert mined and not any(a < b for a in mined for b in mined)
    tokens = df.select("url", url_rules.tokens_of("url", url_rules.host_of("url"), url_rules.path_of("url")).alias("tokens")).distinct()
    want = {r.url for r in tokens.collect() if any(m <= set(r.tokens) for m in mined)}
    assert {r.url for r in url_rules.matches(tokens, rules).collect()} == want


def brute_rules(rows, least, lift, deviations):
    """Smallest rules of (tokens, blocked) rows: one token of those in the same rows, none of those in all rows."""
    base = sum(b for _, b in rows) / len(rows)
    places = {}
    for t in {t for ts, _ in rows for t in ts}:
        places.setdefault(frozenset(i for i, (ts, _) in enumerate(rows) if t in ts), []).append(t)
    tokens = sorted(min(ts) for at, ts in places.items() if len(at) < len(rows))
    rules = {}
    for k in range(1, len(tokens) + 1):
        for part in itertools.combinations(tokens, k):
            fits = [b for ts, b in rows if set(part) <= set(ts)]
            if sum(fits) >= least:
                confidence = sum(fits) / len(fits)
                if confidence >= lift * base and confidence >= base + deviations * math.sqrt(base * (1 - base) / len(fits)):
                    rules[part] = confidence
    return {r: c for r, c in rules.items() if not any(set(s) < set(r) and d >= c for s, d in rules.items())}


def test_rules_equal_brute_force(spark):
    for seed in range(3):
        r = random.Random(seed)
        rows = []
        for _ in range(120):
            tokens = {f"t{r.randint(0, 4)}", f"u{r.randint(0, 2)}", "all"} | ({"v", "w"} if r.random() < 0.4 else set())
            rows.append((sorted(tokens), r.random() < (0.8 if {"t1", "v"} <= tokens else 0.5 if "u2" in tokens else 0.15)))
        rules = url_rules.mine(spark.createDataFrame(rows * 2, "tokens array<string>, blocked boolean"), least=6, lift=1.3, deviations=1.0)
        want = brute_rules(rows * 2, 6, 1.3, 1.0)
        assert {tuple(x.tokens): round(x.confidence, 9) for x in rules.collect()} == {k: round(c, 9) for k, c in want.items()} and want
        # held-out rows prune, and are counted as they are
        checked = [(["t1", "v"], True), (["t1", "v", "w"], False), (["u2"], False), (["t0"], False), (["t0"], False)]
        held = spark.createDataFrame(checked, "tokens array<string>, blocked boolean")
        pruned = url_rules.mine(spark.createDataFrame(rows * 2, "tokens array<string>, blocked boolean"), least=6, lift=1.3, deviations=1.0, checked=held)

        def passes(rule):
            fits = [b for ts, b in checked if set(rule) <= set(ts)]
            return bool(fits) and sum(fits) >= 1.3 * 0.2 * len(fits)

        assert {tuple(x.tokens) for x in pruned.collect()} == {k for k in want if passes(k)}


def test_rules_of_tokens_rarer_than_many_others(spark):
    """Rules of the rarest tokens of rows with fourteen others, by brute force."""
    r = random.Random(7)
    rows = []
    for i in range(160):
        rare = {"rare"} if i % 4 == 0 else set()
        rare |= {"seldom"} if i % 8 in (0, 3) else set()
        tokens = {t for t in (f"n{k:02}" for k in range(14)) if r.random() < 0.85} | rare
        rows.append((sorted(tokens), r.random() < (0.95 if len(rare) == 2 else 0.15)))
    least = 15
    rules = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), least=least, lift=1.3, deviations=1.0)
    want = brute_rules(rows, least, 1.3, 1.0)
    assert {tuple(x.tokens): round(x.confidence, 9) for x in rules.collect()} == {k: round(c, 9) for k, c in want.items()}
    assert ("rare", "seldom") in want


def test_a_rare_token_of_long_urls_blocks(spark):
    r = random.Random(3)
    urls = []
    for i in range(150):
        words = [f"n{k}" for k in range(20) if r.random() < 0.95 or k == i % 20]
        urls.append((i, f"http://site.info/{'/'.join(words)}{'/trap' if i % 5 == 0 else ''}"))
    labels = spark.createDataFrame([(i, i % 5 == 0) for i, _ in urls], "id long, blocked boolean")
    got = {x.page_id: x.verdict for x in url_rules.filter_urls(pages(spark, [*urls, (999, "http://other.org/trap")]), labels, least=20).collect()}
    assert got[999] == "block" and all(got[i] == "block" for i, _ in urls if i % 5 == 0)


def test_near_copies_of_long_urls_on_both_sides(spark):
    """Blocked near copies of which each lacks another token, and a whole copy that is not blocked."""
    every = [f"y{i:02}" for i in range(40)]
    rows = [([t for t in every if t != f"y{k:02}"], True) for k in range(30)] + [(every, False)] * 3 + [([f"z{i % 9}"], False) for i in range(60)]
    began = time.time()
    rules = {tuple(x.tokens): x.confidence for x in url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()}
    assert time.time() - began < 120
    # any further token takes away blocked rows only
    assert set(rules) == {(t,) for t in every[:31]}


def test_rules_of_the_test_tables(spark):
    """The query's rules on a whole table, each judged by hand."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    table = spark.read.parquet(f"{folder}/pages.parquet")
    rules, checked = url_rules.learn(table, labels)
    rules = {tuple(r.tokens): r.confidence for r in rules.collect()}
    assert rules
    tokens = table.select(F.col("page_id").alias("id"), url_rules.tokens_of("url", url_rules.host_of("url"), url_rules.path_of("url")).alias("tokens"))
    known = [(set(r.tokens), r.blocked) for r in tokens.join(labels, "id").filter(~url_rules.held_out("id")).collect()]
    base = sum(b for _, b in known) / len(known)
    for rule, confidence in rules.items():
        fits = [b for ts, b in known if set(rule) <= ts]
        assert abs(sum(fits) / len(fits) - confidence) < 1e-9 and confidence >= url_rules.LIFT * base and sum(fits) >= url_rules.LEAST
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.op6_url_filters(spark, folder).collect()}
    for r in tokens.collect():
        if got[r.id][0] is None:
            assert (got[r.id][1] == "block") == any(set(rule) <= set(r.tokens) for rule in rules)


def test_long_and_repeated_urls_do_not_blow_up(spark):
    r = random.Random(1)
    spam = [f"http://{'-'.join(f's{i}' for i in range(40))}.net/a/{'/'.join(f'x{i}' for i in range(200))}"] * 25
    near = ["http://" + "-".join(f"y{i}" for i in range(40) if i != k) + ".net/b" for k in range(25)]
    rest = [f"http://site{r.randint(0, 9)}.net/c/{i}" for i in range(100)]
    urls = [*enumerate([*spam, *near, *rest, "http://h.net/" + "z/" * 100_000])]
    labels = spark.createDataFrame([(i, i < 50) for i, _ in urls], "id long, blocked boolean")
    began = time.time()
    got = {x.page_id: x.verdict for x in url_rules.filter_urls(pages(spark, urls), labels).collect()}
    assert time.time() - began < 120
    assert all(got[i] == "block" for i in range(50)) and all(got[i] == "allow" for i in range(50, 150))


def test_tokens(spark):
    url = F.lit("http://A-b.c.com:80/Foo_1/foo/12?x=1&&y#z")
    got = spark.range(1).select(url_rules.tokens_of(url, url_rules.host_of(url), url_rules.path_of(url)).alias("t")).first()["t"]
    assert got == sorted(["h:a", "h:b", "h:c", "h:com", "h:#", "p:foo", "p:#", "q:x", "q:y"])


def test_empty(spark):
    assert url_rules.filter_urls(pages(spark, []), spark.createDataFrame([], "id long, blocked boolean")).count() == 0
