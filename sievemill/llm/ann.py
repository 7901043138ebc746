"""Nearest neighbours by learned partitions of a neighbour graph.

On a bounded sample of vectors, the graph of each vector's nearest others is cut into equal parts by recursive
bisection (a median cut, then swaps that lower the number of cut edges). A small network with one hidden layer
learns which parts hold a vector's neighbours. It then indexes every vector (its most probable part) and routes
each query to its most probable parts, whose vectors are ranked by exact distance. The number of parts that
queries visit is the smallest that reaches `recall` on sample vectors the network did not learn from. Parts and
sample grow with the table, up to PARTS and SAMPLE.

Parts are searched in blocks of bounded size, each query's best of a block are merged, so that a part of any
size, or many copies of one vector, are only more blocks. A vector is sent once per QUERIES visits of its part.

A query is compared with vectors of its own length; the FITTED most frequent lengths have an index of their own,
vectors of all other lengths are searched in full. Vectors that are null, zero, or hold null or non-finite
components, and rows with a null id, take no part. Repeated rows are candidates like any other; as queries, rows of
one id and vector ask once, an id with several vectors asks with each, and the best k of all its answers are
returned. A query never finds rows of its own id. Ties in distance go to the smaller id. Very long vectors make smaller blocks. Columns of any
names may stand beside the two that are read, and are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.vectors import load, matrix
from sievemill.llm.workers import lean, lean_group

#: Vectors that an index is fitted on, at least (if there are so many) and at most; parts likewise; vectors of a part, about.
SAMPLE, PARTS, PART = (8192, 65_536), (16, 512), 4096
#: Vector lengths with an index, at most, and vectors of such a length, at least.
FITTED, FITTED_LEAST = 4, 256
#: Vectors and queries of a block, and bytes of the vectors of either, at most. Distances that are held at once, about.
BLOCK, QUERIES, BLOCK_BYTES, DISTANCES = 32_768, 32_768, 1 << 25, 1 << 21


def nearest(x: np.ndarray, y: np.ndarray, k: int, own: bool = False) -> np.ndarray:
    """For each row of x the indices of its k nearest rows of y; own: x is y, and a row is not its own neighbour."""
    out = []
    norm = (y * y).sum(1)
    for at in range(0, len(x), 128):
        d = norm[None, :] - 2 * (x[at : at + 128] @ y.T)
        if own:
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, min(k, d.shape[1] - 1), axis=1)[:, :k].copy())  # a view would keep the whole block
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part number for each vector; parts (a power of two) differ in size by one at most a level."""
    label = np.zeros(len(x), np.int64)
    n, k = graph.shape
    one, two = np.repeat(np.arange(n), k), graph.ravel()
    while label.max(initial=0) + 1 < parts:
        nxt = np.zeros(n, np.int64)
        for p in range(int(label.max()) + 1):
            mine = np.flatnonzero(label == p)
            centred = x[mine] - x[mine].mean(0)
            direction = np.linalg.svd(centred, full_matrices=False)[2][0] if len(mine) > 1 else np.zeros(x.shape[1])
            side = np.zeros(len(mine), bool)
            side[np.argsort(centred @ direction, kind="stable")[len(mine) // 2 :]] = True
            place = np.full(n, -1)
            place[mine] = np.arange(len(mine))
            inside = (label[one] == p) & (label[two] == p)
            a, b = place[one[inside]], place[two[inside]]
            for _ in range(rounds):
                across = np.where(side[a] != side[b], 1, -1)
                gain = np.bincount(a, across, len(mine)) + np.bincount(b, across, len(mine))
                left, right = np.flatnonzero(~side), np.flatnonzero(side)
                left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
                m = min(len(left), len(right))
                good = int((gain[left[:m]] + gain[right[:m]] > 0).sum())
                swap = max(1, good // 2) if good else 0
                if not swap:
                    break
                side[left[:swap]], side[right[:swap]] = True, False
            nxt[mine] = 2 * p + side
        label = nxt
    return label


@dataclass
class Router:
    """A network with one hidden layer from a vector to the parts' probabilities."""

    shift: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    parts: int
    probes: int
    recall: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.shift) / self.scale) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def best(self, x: np.ndarray, m: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :m]


#: With fewer held-out vectors recall is not measured well, and all parts are read.
HELD_LEAST = 30


def fit(x: np.ndarray, k: int = 10, parts: int = 16, hidden: int = 128, epochs: int = 40, recall: float = 0.95, seed: int = 7) -> Router:
    """Fits the partition and the network on a sample, and finds how many parts to visit."""
    rng = np.random.default_rng(seed)
    n = len(x)
    while parts > 1 and n < 4 * parts:
        parts //= 2
    shift = x.mean(0) if n else np.zeros(x.shape[1])
    scale = float(np.sqrt(((x - shift) ** 2).mean()) or 1.0) if n else 1.0
    r = Router(shift, scale, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.1, (hidden, parts)), np.zeros(parts), parts, parts, 1.0)
    if parts == 1:
        return r
    graph = nearest(x, x, min(k, n - 1), own=True)
    label = balanced_parts(x, graph, parts)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1 / graph.shape[1])
    target = 0.7 * target + 0.3 * np.eye(parts)[label]
    held = rng.random(n) < 0.125
    train = np.flatnonzero(~held)
    z = (x - shift) / scale
    weights = [r.w1, r.b1, r.w2, r.b2]
    m1, m2, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-4
        rng.shuffle(train)
        for at in range(0, len(train), 256):
            b = train[at : at + 256]
            h = np.maximum(z[b] @ r.w1 + r.b1, 0)
            o = h @ r.w2 + r.b2
            p = np.exp(o - o.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - target[b]) / len(b)
            dh = (d @ r.w2.T) * (h > 0)
            t += 1
            for w, g, a, v in zip(weights, [z[b].T @ dh + 1e-4 * r.w1, dh.sum(0), h.T @ d + 1e-4 * r.w2, d.sum(0)], m1, m2, strict=True):
                a += 0.1 * (g - a)
                v += 0.001 * (g * g - v)
                w -= rate * (a / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    # as in a search: the network itself places the vectors
    ask = np.flatnonzero(held)
    order = r.best(x[ask], parts)
    home = r.best(x, 1)[:, 0]
    rank = np.argsort(order, axis=1)
    needed = rank[np.arange(len(ask))[:, None], home[graph[ask]]]
    for m in range(1, parts + 1):
        got = float((needed < m).mean()) if len(ask) else 1.0
        if len(ask) >= HELD_LEAST and got >= recall or m == parts:
            r.probes, r.recall = m, got
            break
    return r


def _top(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        query, rows = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(query) and len(rows):
            q, x = matrix(query.column("v")), matrix(rows.column("v"))
            qid, vid = query.column("id").to_numpy(), rows.column("id").to_numpy()
            norm = (x * x).sum(1)
            step = max(1, DISTANCES // len(x))
            for at in range(0, len(q), step):
                part = q[at : at + step]
                own = (part * part).sum(1)
                d = own[:, None] + norm[None, :] - 2 * (part @ x.T)
                d[qid[at : at + step][:, None] == vid[None, :]] = np.inf
                m = min(k, d.shape[1])
                kth = np.partition(d, m - 1, axis=1)[:, m - 1]
                slack = 1e-9 * (own + norm.max())  # the product form is only a filter; it errs by far less
                i, j = np.nonzero((d <= (kth + slack)[:, None]) & (d < np.inf))
                # of very many equal candidates of a query the smallest ids are enough
                i, j = _fewest(i, j, d, vid, k)
                score = np.sqrt(((part[i] - x[j]) ** 2).sum(1))
                order = np.lexsort((vid[j], score, i))
                i, j, score = i[order], j[order], score[order]
                first = np.searchsorted(i, i)
                best = np.arange(len(i)) - first < k
                out["query_id"].append(qid[at : at + step][i[best]]), out["vec_id"].append(vid[j[best]]), out["score"].append(score[best])
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({c: np.concatenate(v) if v else np.zeros(0, kinds[c]) for c, v in out.items()})

    return lean_group(run)


def _fewest(i: np.ndarray, j: np.ndarray, d: np.ndarray, vid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a query's candidates with one and the same product-form distance, the k with the smallest ids."""
    order = np.lexsort((vid[j], d[i, j], i))
    i, j = i[order], j[order]
    near = d[i, j]
    new = np.append(True, (i[1:] != i[:-1]) | (near[1:] != near[:-1])) if len(i) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    place = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
    return i[place < k], j[place < k]


def parts_for(n: int) -> tuple[int, int]:
    """Parts (a power of two) and sample size for a table of n vectors."""
    parts = PARTS[0]
    while parts < PARTS[1] and parts * PART < n:
        parts *= 2
    return parts, min(SAMPLE[1], max(SAMPLE[0], 128 * parts))


def learn(rows: DataFrame, k: int = 10, recall: float = 0.95, sample: int | None = None, parts: int | None = None) -> dict[int, Router]:
    """An index for each of the most frequent vector lengths of rows (id, v, dim)."""
    lengths = rows.groupBy("dim").agg(F.count("*").alias("n")).filter(F.col("n") >= FITTED_LEAST).orderBy(F.desc("n"), "dim").limit(FITTED).collect()
    routers = {}
    for dim, n in map(tuple, lengths):
        wanted_parts, size = parts_for(n)
        size = sample or size
        # by hash, a fifth more than wanted, so that only they are sorted
        hashed, share = F.xxhash64("id", "v"), min(1.0, 1.2 * size / n + 100 / n)
        some = rows.filter((F.col("dim") == dim) & (F.pmod(hashed, F.lit(1 << 32)) < int(share * (1 << 32))))
        chosen = some.orderBy(hashed, "id").limit(size).select("id", "v").toArrow()
        order = np.argsort(chosen.column("id").to_numpy(), kind="stable")
        routers[dim] = fit(matrix(chosen.column("v"))[order], k, parts or wanted_parts, recall=recall)
    return routers


def _by_length(batch: pa.RecordBatch, visit):
    """Rows of a batch by vector length: their indices and visit(length, matrix, rows)."""
    dim = batch.column("dim").to_numpy()
    for d in np.unique(dim):
        at = np.flatnonzero(dim == d)
        yield at, visit(int(d), matrix(batch.column("v").take(pa.array(at))), at)


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, sample: int | None = None, parts: int | None = None, recall: float = 0.95) -> DataFrame:
    """The k nearest found for each row whose id is divisible by `every`: query_id, rank from 1, vec_id, score.

    sample, parts: of an index; by the table's size if not given.
    """
    rows = load(df, id_col, vector_col).filter("id is not null and v is not null")
    routers = learn(rows, k, recall, sample, parts)

    def place(batches):
        """The most probable part of each vector; 0 where its length has no index."""
        for batch in batches:
            part = np.zeros(len(batch), np.int32)
            for at, got in _by_length(batch, lambda d, x, _: routers[d].best(x, 1)[:, 0] if d in routers else 0):
                part[at] = got
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", "v", "dim")), pa.array(part)], ["id", "v", "dim", "part"])

    placed = rows.mapInArrow(lean(place), "id long, v array<double>, dim int, part int")
    counted = placed.groupBy("dim", "part").agg(F.count("*").alias("n")).checkpoint()  # one row a part and length
    sizes = {(r["dim"], r["part"]): r["n"] for r in counted.filter(F.col("dim").isin(list(routers))).collect()}  # FITTED * PARTS at most
    size = {d: np.array([sizes.get((d, p), 0) for p in range(r.parts)]) for d, r in routers.items()}

    def parts_of(d: int, x: np.ndarray, copies: np.ndarray) -> list[np.ndarray]:
        """The parts of queries: those that recall asks for, and the next ones until k candidates besides rows of the same id are sure."""
        if d not in routers:
            return [np.zeros(1, np.int32)] * len(x)
        r = routers[d]
        order = r.best(x, r.parts).astype(np.int32)
        enough = size[d][order].cumsum(1) >= k + copies[:, None]
        n = np.maximum(np.where(enough.any(1), enough.argmax(1) + 1, r.parts), r.probes)
        return [o[:m] for o, m in zip(order, n, strict=True)]

    def visit(batches):
        for batch in batches:
            copies, out = batch.column("copies").to_numpy(), [None] * len(batch)
            for at, got in _by_length(batch, lambda d, x, at, copies=copies: parts_of(d, x, copies[at])):
                for i, ps in zip(at, got, strict=True):
                    out[i] = ps
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", "v", "dim")), pa.array(out, pa.list_(pa.int32()))], ["id", "v", "dim", "parts"])

    asked = rows.filter(F.col("id") % every == 0)
    copies = asked.groupBy("id").agg(F.count("*").alias("copies"))
    asked = asked.dropDuplicates(["id", "v"])
    most = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest("dim", F.lit(1)))))
    routed = asked.join(copies, "id").select("id", "v", "dim", "copies").mapInArrow(lean(visit), "id long, v array<double>, dim int, parts array<int>").checkpoint()
    visits = routed.select("dim", F.explode("parts").alias("part")).groupBy("dim", "part").agg(F.count("*").alias("queries"))
    # parts that no query visits are left out; the others are sent once per QUERIES visits
    blocks = counted.join(visits, ["dim", "part"]).select(
        "dim", "part", F.ceil(F.col("n") / F.least(F.lit(BLOCK), most)).cast("int").alias("blocks"), F.ceil(F.col("queries") / F.least(F.lit(QUERIES), most)).cast("int").alias("turns")
    )
    blocks = blocks.checkpoint()
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = lambda n: F.pmod(F.xxhash64("id", "v"), n).cast("int")
    columns = ["dim", "part", "block", "turn", "id", "v", "asks"]
    data = placed.join(blocks, ["dim", "part"]).withColumns({"block": dealt(F.col("blocks")), "turn": numbers(F.col("turns")), "asks": F.lit(False)})
    queries = routed.select("id", "v", "dim", F.explode("parts").alias("part")).join(blocks, ["dim", "part"])
    queries = queries.withColumns({"turn": dealt(F.col("turns")), "block": numbers(F.col("blocks")), "asks": F.lit(True)})
    found = data.select(*columns).union(queries.select(*columns)).groupBy("dim", "part", "block", "turn").applyInArrow(_top(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_approximate_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
