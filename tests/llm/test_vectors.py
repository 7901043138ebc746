import numpy as np
import pytest

from sievemill.llm import ann, embedding_dedup
from tests.llm.helpers import Union

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string"
ODD = [(901, None), (902, [0.0] * 8), (903, [float("nan")] + [1.0] * 7), (904, [float("inf")] + [1.0] * 7), (905, [None] + [1.0] * 7), (906, []), (None, [1.0] * 8)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], SCHEMA)


def vectors(seed, n, dim=8, groups=6, spread=0.12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dim))
    x = (centres[r.integers(groups, size=n)] + spread * r.normal(size=(n, dim)) * r.random((n, 1)) * 2).astype(np.float32)
    return x


@pytest.mark.parametrize("tile", [4096, 20])
def test_near_duplicates_equal_brute_force(spark, tile):
    x = vectors(1, 150)
    x[100:130] = x[7]
    x[130:135] = 2 * x[7]
    rows = [(i + 1, x[i].tolist()) for i in range(len(x))] + ODD
    y = x.astype(float)
    cosine = (y @ y.T) / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)
    union, links = Union(), (cosine >= 0.95).sum(1) - 1
    for i, j in zip(*np.nonzero(cosine >= 0.95), strict=True):
        union.join(int(i) + 1, int(j) + 1)
    want = sorted([(i + 1, int(links[i]), union.find(i + 1), union.find(i + 1) == i + 1) for i in range(len(x))] + [(i, 0, i, True) for i, _ in ODD if i])
    got = [tuple(r) for r in embedding_dedup.near_duplicate_vectors(frame(spark, rows), tile=tile).collect()]
    assert (None, 0, None, True) in got
    assert sorted(g for g in got if g[0] is not None) == want


def test_quantisation_bound_holds():
    r = np.random.default_rng(3)
    u = r.normal(size=(300, 2000))
    u /= np.linalg.norm(u, axis=1)[:, None]
    q, s, e = embedding_dedup.quantise(u)
    approx = (q.astype(float) @ q.T) * s[:, None] * s
    assert (np.abs(u @ u.T - approx) <= e[:, None] + e + e[:, None] * e).all()
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(u @ u.T >= 0.05)), strict=True))
    sure, may = set(), set()
    for i, j, certain in embedding_dedup.undecided((q, s, e), (q, s, e), 0.05):
        sure |= set(zip(i[certain].tolist(), j[certain].tolist(), strict=True))
        may |= set(zip(i[~certain].tolist(), j[~certain].tolist(), strict=True))
    assert sure and may - want and sure <= want <= sure | may


def brute_links(x, threshold=0.95):
    """(links, component) by row number."""
    y = x.astype(float)
    y /= np.abs(y).max(1)[:, None]
    cosine = (y @ y.T) / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)
    union = Union()
    for i, j in zip(*np.nonzero(cosine >= threshold), strict=True):
        union.join(int(i), int(j))
    return [((cosine[i] >= threshold).sum() - 1, union.find(i)) for i in range(len(x))]


@pytest.mark.parametrize("tile", [1000, 60])
def test_pairs_near_the_threshold_and_extreme_lengths(spark, tile):
    """Groups whose cosines lie around the threshold, so that many pairs are undecided; vectors of several lengths, tiny and huge."""
    rows, want = [], {}
    for dim, n in ((8, 200), (64, 150), (1500, 40), (1, 5)):
        r = np.random.default_rng(dim)
        base = r.normal(size=(3, dim))
        x = base[r.integers(3, size=n)] + 0.16 * r.normal(size=(n, dim))
        x = (x * 10.0 ** r.integers(-15, 15, size=(n, 1))).astype(np.float32)
        first = len(rows)
        rows += [(first + i, x[i].tolist()) for i in range(n)]
        want |= {first + i: (int(links), first + int(c)) for i, (links, c) in enumerate(brute_links(x))}
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicate_vectors(frame(spark, rows), tile=tile).collect()}
    assert got == want and max(n for n, _ in got.values()) > 10


def test_tiles_stay_bounded_and_few():
    t = embedding_dedup.tiles_of
    assert t(100, 64, 1000) == 1 and t(1, 1, 1) == 1 and t(50_000, 64, 24) == 7
    for n in (10**6, 10**8):
        assert n / t(n, 64, 4000) <= embedding_dedup.TILE_ROWS and t(n, 64, 24) == -(-n // embedding_dedup.TILE_ROWS)
    assert 10**6 / t(10**6, 4096, 24) * 4096 <= embedding_dedup.TILE_BYTES


def test_repeated_ids_with_several_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, b), (5, a), (6, a), (7, b), (8, [0.0, 0.0, 1.0]), (None, a), (None, None)]
    got = sorted(((str(r.vec_id), r.n_links, str(r.component_id)) for r in embedding_dedup.near_duplicate_vectors(frame(spark, rows)).collect()))
    assert got == [("5", 1, "5")] * 3 + [("6", 1, "5"), ("7", 1, "5"), ("8", 0, "8"), ("None", 0, "None"), ("None", 0, "None")]


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicate_vectors(frame(spark, [])).count() == 0
    assert ann.search(frame(spark, [])).count() == 0 and ann.search(frame(spark, ODD)).count() == 0
    got = embedding_dedup.near_duplicate_vectors(frame(spark, [(1, [1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 0, 2), (2, 0, 2), (3, 1, 1)]


def test_search_equals_brute_force_where_all_parts_are_read(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "QUERIES", 3)
    x = vectors(5, 400)
    x[50:80] = x[9]
    rows = [(i * 10, x[i].tolist()) for i in range(len(x))] + ODD
    got = ann.search(frame(spark, rows), recall=2.0)  # more than any number of parts gives: all are read
    want = []
    for q in range(0, 400, 10):
        d = np.sqrt(((x[q].astype(float) - x.astype(float)) ** 2).sum(1))
        order = sorted((d[j], j * 10) for j in range(400) if j != q)[:10]
        want += [(q * 10, k + 1, j, s) for k, (s, j) in enumerate(order)]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())
    assert [f[:3] for f in found] == [w[:3] for w in sorted(want)]
    assert [f[3] for f in found] == pytest.approx([w[3] for w in sorted(want)], abs=1e-12)


@pytest.mark.parametrize("n,k", [(70, 10), (400, 60)])
def test_each_query_gets_k_rows_or_all(spark, n, k):
    x = vectors(3, n, groups=16, spread=0.01)
    got = ann.search(frame(spark, [(i, x[i].tolist()) for i in range(n)]), k=k, every=1, recall=0.0).groupBy("query_id").count().collect()
    assert sorted((r["query_id"], r["count"]) for r in got) == [(i, min(k, n - 1)) for i in range(n)]


def test_recall_of_routing(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {(r.query_id, r.vec_id) for r in ann.op9_approximate_nearest_neighbours(spark, sf_dir).collect()}
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        near = ids[np.lexsort((ids, d))[:10]]
        total += len(near)
        hit += sum((int(ids[q]), int(j)) in got for j in near)
    assert hit >= 0.9 * total


def test_parts_are_balanced_and_cut_few_edges():
    x = vectors(7, 800, groups=8, spread=0.05).astype(float)
    graph = ann.nearest(x, x, 8, own=True)
    label = ann.balanced_parts(x, graph, 8)
    assert np.bincount(label).tolist() == [100] * 8
    cut = (label[graph] != label[:, None]).mean()
    shuffled = np.random.default_rng(1).permutation(label)
    assert cut < 0.6 * (shuffled[graph] != shuffled[:, None]).mean()


def nearest_by_hand(rows, every, k=10):
    """(query, rank, id, distance) of rows (id, vector) of any lengths."""
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        asks = [np.array(v, np.float32).astype(float) for i, v in rows if i == q]
        found = sorted((float(np.sqrt(((a - np.array(v, np.float32)) ** 2).sum())), i) for a in asks for i, v in rows if i != q and len(v) == len(a))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(found[:k])]
    return out


def test_every_length_is_searched(spark, monkeypatch):
    monkeypatch.setattr(ann, "FITTED_LEAST", 100)
    rows = []
    for dim, n in ((8, 300), (3, 200), (5, 12), (2, 1), (900, 15)):
        x = vectors(dim, n, dim=dim)
        rows += [(10 * (len(rows) + i), x[i].tolist()) for i in range(n)]
    rows.append((7, rows[0][1]))
    got = sorted(map(tuple, ann.search(frame(spark, rows), recall=2.0).collect()))
    want = nearest_by_hand(rows, 100)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)


def test_repeated_queries_ask_once(spark):
    x = vectors(4, 30)
    rows = [(i, x[i].tolist()) for i in range(30)]
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.search(frame(spark, rows + [rows[0], rows[0], rows[5]])).collect()]
    want = nearest_by_hand(rows + [rows[5]], 100)
    assert sorted(got) == [w[:3] for w in want]


def test_few_parts_are_read_where_vectors_cluster():
    r = np.random.default_rng(2)
    centres = r.normal(size=(300, 64))
    x = centres[r.integers(300, size=12_000)] + 0.1 * r.normal(size=(12_000, 64))
    for parts in (16, 32):
        router = ann.fit(x[:4096], 10, parts, epochs=25)
        assert router.probes <= 0.3 * parts and router.recall >= 0.95
        home, asks = router.best(x, 1)[:, 0], np.arange(0, 12_000, 120)
        order = router.best(x[asks], router.probes)
        hit = [np.isin(home[near], order[q]).mean() for q, near in enumerate(ann.nearest(x[asks], x, 11))]
        assert np.mean(hit) >= 0.9


def test_parts_grow_with_the_table():
    assert ann.parts_for(0) == (16, 8192) and ann.parts_for(65_536) == (16, 8192)
    assert ann.parts_for(10**6) == (256, 32_768) and ann.parts_for(10**9) == (512, 65_536)
