import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievemill.llm import boosting, quality
from tests.llm.helpers import MIDDLE, docs


def test_trees_learn_an_interaction():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95


def test_flat_walk_equals_a_walk_node_by_node():
    r = np.random.default_rng(2)
    x, y = r.normal(size=(400, 3)), (r.random(400) < 0.5).astype(float)
    t = boosting.fit(x, y, rounds=5, depth=3)
    for row, score in zip(x[:50], t.score(x[:50]), strict=True):
        total = t.base
        for k in range(len(t.leaf)):
            node = 0
            while node < t.feature.shape[1]:
                node = 2 * node + 1 + int(row[t.feature[k, node]] > t.threshold[k, node])
            total += t.leaf[k, node - t.feature.shape[1]]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def brute_fit(x, y, rounds, depth, rate, ridge, least, bins):
    """Trees as lists (feature, threshold, leaf) by trying every cut of every node's rows, one by one."""
    cuts = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1]))) for j in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = np.log(share / (1 - share))
    margin, trees = [base] * len(y), []
    for _ in range(rounds):
        p = [1 / (1 + np.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p]
        nodes, feature, threshold = {0: list(range(len(y)))}, [], []
        for node in range((1 << depth) - 1):
            rows, best = nodes[node], (1e-6, 0, np.inf)
            for j in range(x.shape[1]):
                for cut in cuts[j]:
                    left = [i for i in rows if x[i, j] <= cut]
                    right = [i for i in rows if x[i, j] > cut]
                    if len(left) >= least and len(right) >= least:
                        score = lambda part: sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + ridge)
                        gain = score(left) + score(right) - score(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, j, cut)
            feature.append(best[1]), threshold.append(best[2])
            nodes[2 * node + 1] = [i for i in rows if x[i, best[1]] <= best[2]]
            nodes[2 * node + 2] = [i for i in rows if x[i, best[1]] > best[2]]
        leaf = []
        for node in range((1 << depth) - 1, (2 << depth) - 1):
            rows = nodes[node]
            leaf.append(-rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge))
            for i in rows:
                margin[i] += leaf[-1]
        trees.append((feature, threshold, leaf))
    return base, trees


@pytest.mark.parametrize("seed", range(4))
def test_fit_equals_brute_force(seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(90, 3))
    x[:, 2] = np.round(x[:, 2])  # ties in a feature
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * r.normal(size=90) > 0).astype(float)
    base, trees = brute_fit(x, y, rounds=4, depth=3, rate=0.2, ridge=1.5, least=4, bins=boosting.BINS)
    got = boosting.fit(x, y, rounds=4, depth=3, rate=0.2, ridge=1.5, least=4)
    assert got.base == pytest.approx(base)
    for k, (feature, threshold, leaf) in enumerate(trees):
        assert got.feature[k].tolist() == feature and got.threshold[k].tolist() == pytest.approx(threshold) and got.leaf[k].tolist() == pytest.approx(leaf)


def brute_statistics(text):
    """The features of one text, one by one."""
    data = text.encode()
    if not data:
        return [0.0] * len(quality.FEATURES)
    cut = re.compile(rb"[^\x20\x09-\x0D]+")
    words, lines = cut.findall(data), [x for x in data.split(b"\n") if x]
    kinds = [0] * 9
    for b in data:
        c = bytes([b])
        kinds[0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 4 if c == b"\n" else 3 if c in b" \t\r\x0b\x0c" else 5 if c in b".?:;" else 6 if c in b",'-\"()" else 8 if b >= 128 else 7] += 1
    share = [n / len(data) for n in Counter(data).values()]
    out = [k / len(data) for k in kinds] + [data.count(bytes([m])) / len(data) for m in quality._MARKS] + [np.log1p(len(data))]
    entropy = -sum(p * np.log2(p) for p in share)
    if not words:
        return [*out, *[0.0] * 14, entropy]
    n, size = len(words), [len(w) for w in words]
    pairs = list(zip(words, words[1:], strict=False))
    ends = set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.?:;,'-\"()") | set(range(128, 256))
    return [
        *out, np.log1p(n), np.mean(size), np.std(size), max(size), len(set(words)) / n, max(Counter(words).values()) / n, sum(a == b for a, b in pairs) / max(n - 1, 1),
        len(set(pairs)) / (n - 1) if n > 1 else 1, sum(w[:1].isupper() for w in words) / n, sum(w[-1] not in ends for w in words) / n, sum(s <= 3 for s in size) / n,
        np.log1p(len(lines)), len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1), entropy,
    ]


def test_statistics_equal_brute_force(spark, sf_dir):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["", " ", "a", "\n\n", "A b c\nA b c\n", "é" * 1000, "x " * 5000, "a b a b a! #%", "\x00\x7f", "one\ttwo\x0bthree"]
    assert quality.statistics(pa.array(texts)) == pytest.approx(np.array([brute_statistics(t) for t in texts]), abs=1e-9)


def test_rows_of_repeated_ids_stay_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    df = docs(spark, [(i % 40, "good words here. " * (i % 7 + 1) if i % 2 else "### bad" * (i % 5 + 1)) for i in range(4000)])
    seen = []
    fit = boosting.fit

    def counting(x, y):
        seen.append(len(y))
        return fit(x, y)

    quality.boosting.fit = counting
    try:
        quality.fit(df, labels, sample=50)
    finally:
        quality.boosting.fit = fit
    assert seen == [50]


def test_degenerate_labels():
    none = np.zeros((0, 2))
    assert boosting.fit(none, np.zeros(0)).score(np.ones((1, 2))).tolist() == [0.5]
    assert boosting.fit(np.ones((9, 2)), np.ones(9)).score(np.ones((1, 2)))[0] > 0.9


def test_statistics_of_odd_texts():
    x = quality.statistics(pa.array(["", " ", "a", "\n\n", "A b c\nA b c\n", "é" * 1000, "x " * 50_000]))
    assert np.isfinite(x).all() and not x[0].any()
    assert x[6][quality.FEATURES.index("adjacent")] == 1 and x[4][quality.FEATURES.index("distinct_lines")] == 0.5


def test_held_out_accuracy_on_the_tables(spark):
    sf_dir = MIDDLE  # the smallest tables have 68 labels to learn from
    d, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.op1_quality_classifier(spark, sf_dir)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == d.count()
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)


def test_edges(spark):
    df = docs(spark, [(1, None), (None, "text"), (2, "")])
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.with_scores(df, quality.fit(df, no_labels)).collect()
    assert [r.score for r in got] == [0.5] * 3
    assert quality.with_scores(docs(spark, []), quality.fit(df, no_labels)).count() == 0
    with pytest.raises(ValueError):
        quality.with_scores(df.withColumn("score", F.lit(1)), quality.fit(df, no_labels))
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    assert quality.fit(df, labels).base > 0  # a half counts as 1
