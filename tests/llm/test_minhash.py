import random
import time

import numpy as np
import pytest

from sievemill.llm import minhash_dedup
from sievemill.llm.components import components
from tests.llm.helpers import Union, docs, words


def brute(rows, k, threshold=80):
    sets, union = {}, Union()
    for i, t in rows:
        w = words(t, lower=True)
        union.find(i)
        sets[i, t] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    ids = list(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                union.join(i[0], j[0])
    return sorted((i, len(sets[i, t]), union.find(i), union.find(i) == i) for i, t in rows)


def variants(r, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(["the", "of", str(r.random())])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,seed", [(2, 1), (2, 2), (5, 3)])
def test_equals_brute_force(spark, k, seed):
    r = random.Random(seed)
    texts = ["", None, "one", "ONE", "one two", "two one", " \n"]
    for size, n, edits in ((40, 30, 6), (120, 40, 16), (300, 25, 30)):
        texts += variants(r, [f"w{r.randint(0, 60)}" for _ in range(size)], n, edits)
    texts += texts[10:20]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(docs(spark, rows), shingle=k).collect())
    assert got == brute(rows, k)


def test_small_blocks_find_the_same(spark, monkeypatch):
    r = random.Random(9)
    rows = list(enumerate(variants(r, [f"w{i}" for i in range(100)], 60, 14)))
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", 500)
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(docs(spark, rows), shingle=2).collect())
    assert got == brute(rows, 2)


def result(df, k, **how):
    return sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(df, shingle=k, **how).collect())


@pytest.mark.parametrize("threshold", [50, 95])
def test_other_thresholds(spark, threshold):
    r = random.Random(threshold)
    rows = list(enumerate(variants(r, [f"w{i}" for i in range(80)], 40, 40) + variants(r, [f"v{i}" for i in range(80)], 30, 10) + ["a b c", "a b c"]))
    assert result(docs(spark, rows), 2, threshold=threshold) == brute(rows, 2, threshold)


def test_bands_follow_from_the_threshold():
    assert minhash_dedup.banding(80) == (40, 6)
    for t in range(1, 101):
        bands, n = minhash_dedup.banding(t)
        assert (1 - (t / 100) ** n) ** bands <= minhash_dedup.MISS and (n == 1 or bands * n <= minhash_dedup.COORDINATES)
    with pytest.raises(ValueError):
        minhash_dedup.banding(0)


def test_open_buckets_of_any_size(spark, monkeypatch):
    """Documents of one family that share bands and are not all similar: large components, small ones and strays in blocks of a few sets."""
    r = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    rows = variants(r, base, 60, 3) + variants(r, base, 60, 30) + variants(r, base[:100] + [f"x{i}" for i in range(15)], 30, 2) + [" ".join(base[: 120 - i]) for i in range(0, 60, 3)]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    for size in (300, 2000):
        monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", size)
        assert result(docs(spark, rows), 2) == brute(rows, 2)


def test_ids_with_several_texts(spark):
    r = random.Random(4)
    rows = [(i, t) for i, t in enumerate(variants(r, [f"w{i}" for i in range(80)], 30, 14))]
    rows += [(i % 5, t) for i, t in enumerate(variants(r, [f"v{i}" for i in range(80)], 20, 8))] + [(3, None), (40, None), (40, ""), (41, "v1 v2"), (41, None), (2, rows[2][1]), (2, rows[2][1])]
    assert result(docs(spark, rows), 2) == brute(rows, 2)


def test_repeats_do_not_multiply(spark):
    r = random.Random(5)
    one = [f"w{i}" for i in range(60)]
    two = one[:57] + ["x"] + one[58:]
    rest = [(i + 10, t) for i, t in enumerate(variants(r, one, 6, 20))]

    def seconds(n):
        rows = spark.range(n).selectExpr("explode(array(1L, 2L)) as doc_id").selectExpr("doc_id", f"if(doc_id = 1, '{' '.join(one)}', '{' '.join(two)}') as text").union(spark.createDataFrame(rest, "doc_id long, text string"))
        began = time.time()
        got = minhash_dedup.near_duplicates(rows, shingle=2).groupBy("doc_id", "component_id").count().collect()
        assert {(x["doc_id"], x["component_id"]): x["count"] for x in got if x["doc_id"] < 3} == {(1, 1): n, (2, 1): n}
        return time.time() - began

    seconds(1)
    few = seconds(2)
    assert seconds(10_000) < 2 * few + 5


def test_null_and_repeated_ids(spark):
    t = "a b c d e f g"
    got = sorted(((x.doc_id, x.component_id, x.kept) for x in minhash_dedup.near_duplicates(docs(spark, [(5, t), (5, t), (7, t), (None, t), (9, "z")]), shingle=2).collect()), key=str)
    assert got == [(5, 5, True), (5, 5, True), (7, 5, False), (9, 9, True), (None, None, True)]
    assert minhash_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_signature_coordinates_estimate_similarity():
    r = np.random.default_rng(1)
    both, one, two = (r.integers(1 << 63, size=n, dtype=np.uint64) for n in (800, 100, 100))
    keys = minhash_dedup.signature_keys(np.concatenate([both, one, both, two]), np.array([0, 900, 1800]), 400, 1)
    assert abs((keys[0] == keys[1]).mean() - 0.8) < 0.08


def test_components(spark):
    edges = [(i + 1, i) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)] + [(200, 201), (202, 201), (202, 100)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: union.find(n) for n in union.parent}


def test_very_long_text(spark):
    r = random.Random(6)
    w = [str(r.randint(0, 10**9)) for _ in range(300_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:290_000])), (3, " ".join(w[:200_000])), (4, "x" * 2_000_000)]
    assert [(i, c) for i, _, c, _ in result(docs(spark, rows), 5)] == [(1, 1), (2, 1), (3, 3), (4, 4)]
