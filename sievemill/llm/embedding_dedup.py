"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors form a class that is compared once. Unit vectors u of classes are quantised to s*q with q in int8, and
the norm e of the rest u - s*q is kept. For two vectors

    |u.v - s_u s_v (q_u.q_v)| <= e_u + e_v + e_u e_v

Classes are dealt by hash into tiles, whose number grows so that tiles stay bounded in rows and bytes; each pair of
tiles is one group, to which only q, s and e are sent. The integer products of a pair are one matrix product,
block by block (in float32, exact while they stay below 2**24; longer vectors are multiplied in slices). A pair whose
lower bound is above the threshold is a link, one whose upper bound is below is none. Classes with a pair in between
are sent to their group once more with their original vectors, and just those pairs are computed in double precision.
A group returns one row per class: how many vectors it links to, and one edge of the group's spanning
stars. So no group sends pairs, however many link.

Every pair of tiles is multiplied: work grows with the square of the number of distinct vectors, and a vector is
sent to as many groups as there are tiles (TILE_ROWS rows each).

Vectors that are null, zero, or hold null or non-finite components, and rows with a null id, link with
nothing. Only vectors of one length are compared. Rows that repeat id and vector count once as partners. Ties need
no choice but the smallest id. Very long vectors make smaller tiles. Columns of any names may stand beside the two
that are read, and are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.components import components
from sievemill.llm.vectors import load, matrix
from sievemill.llm.workers import lean, lean_group

#: Classes in a tile, at most and at least (if tasks can be had by smaller tiles), and bytes of their int8 values, at most.
TILE_ROWS, LEAST_ROWS, TILE_BYTES = 65_536, 2048, 1 << 24
#: Products of a block that are held at once, about.
BLOCK = 1 << 21
_SLICE = 1024  # components whose products of int8 stay below 2**24


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales and the norms of what they leave, of unit vectors."""
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    rest = np.sqrt(((u - q * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
    return q, scale, rest


def undecided(x: tuple, y: tuple, threshold: float):
    """Index pairs (i of x, j of y) that may reach the threshold, in parts, and whether each surely does. x, y: q, s, e."""
    (qx, sx, ex), (qy, sy, ey) = x, y
    if not len(qx) or not len(qy):
        return
    qy32 = qy.astype(np.float32)
    step = max(16, BLOCK // len(qy))
    for at in range(0, len(qx), step):
        part = slice(at, at + step)
        q = qx[part].astype(np.float32)
        if q.shape[1] <= _SLICE:
            products = q @ qy32.T
        else:
            products = sum((q[:, k : k + _SLICE] @ qy32[:, k : k + _SLICE].T).astype(np.float64) for k in range(0, q.shape[1], _SLICE))
        e, f = ex[part].max(), ey.max()
        least = (threshold - e - f - e * f) / (sx[part].max() * sy.max())
        if least <= 0:
            i, j = np.nonzero(np.ones(products.shape, bool))
        else:
            i, j = np.divmod(np.flatnonzero(products.ravel() >= least * (1 - 1e-6)), products.shape[1])
        near = products[i, j].astype(np.float64)
        i += at
        near *= sx[i] * sy[j]
        error = ex[i] + ey[j] + ex[i] * ey[j] + 1e-9  # and what double precision rounds
        may = near + error >= threshold
        i, j, sure = i[may], j[may], (near - error >= threshold)[may]
        if len(i):
            yield i, j, sure


def exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs in double precision."""
    out = np.empty(len(i))
    # squares of extreme values would overflow or vanish; all others stay as they are
    x, y = (z / np.where((top > 1e100) | (top < 1e-100), top, 1.0)[:, None] for z, top in ((x, np.abs(x).max(1)), (y, np.abs(y).max(1))))
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    for k in range(0, len(i), 1 << 15):
        a, b = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
        out[k : k + (1 << 15)] = (x[a] * y[b]).sum(1) / (nx[a] * ny[b])
    return out


def _roots(n: int, u: np.ndarray, v: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Hooks edges into parent (smallest index first) and flattens it."""
    while True:
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            return parent
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with int8 values, scale and error in place of the vector."""
    for batch in batches:
        dim = batch.column("dim").to_numpy()
        for d in np.unique(dim):  # one length, nearly always
            part = batch.filter(pa.array(dim == d))
            x = matrix(part.column("v"))
            # scaled first, so that squares neither overflow nor vanish
            x = x / np.abs(x).max(1)[:, None]
            q, s, e = quantise(x / np.sqrt((x * x).sum(1))[:, None])
            names = ["class", "rep", "size", "dim"]
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array([r.tobytes() for r in q], pa.binary()), pa.array(s), pa.array(e)], [*names, "q", "s", "e"])


def _compare(threshold: float, second: bool):
    """Links of a group's classes; first pass: sure ones, and which classes have undecided pairs; second: the undecided ones by their original vectors."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("rep").to_numpy(), kind="stable")  # roots are then the smallest ids
        table = table.take(pa.array(order)).combine_chunks()
        tile, size, rep, s, e = (table.column(c).to_numpy() for c in ("tile", "size", "rep", "s", "e"))
        values = table.column("q").combine_chunks()
        q = np.frombuffer(b"".join(values.to_pylist()), np.int8).reshape(len(rep), -1)
        v = matrix(table.column("v")) if second else None
        one, two = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == two)
        links, parent, open_ = np.zeros(len(rep), np.int64), np.arange(len(rep)), np.zeros(len(rep), bool)
        for i, j, sure in undecided((q[left], s[left], e[left]), (q[right], s[right], e[right]), threshold):
            a, b = left[i], right[j]
            if one == two:
                a, b, sure = a[a < b], b[a < b], sure[a < b]
            if second:
                a, b = a[~sure], b[~sure]
                hit = exact(v, v, a, b) >= threshold
                a, b = a[hit], b[hit]
            else:
                open_[a[~sure]] = open_[b[~sure]] = True
                a, b = a[sure], b[sure]
            links += np.bincount(a, size[b], len(rep)).astype(np.int64) + np.bincount(b, size[a], len(rep)).astype(np.int64)
            parent = _roots(len(rep), a, b, parent)
        got = np.flatnonzero((links > 0) | open_)
        row = table.select(["class", "tile"]).take(pa.array(got))
        return pa.table({"class": row.column("class"), "one": np.full(len(got), one, np.int32), "two": np.full(len(got), two, np.int32), "tile": row.column("tile"), "rep": rep[got], "links": links[got], "root": rep[parent[got]], "open": open_[got]})

    return lean_group(run)


_FOUND = "class long, one int, two int, tile int, rep long, links long, root long, open boolean"


def tiles_of(n: int, dim: int, tasks: int, most: int = TILE_ROWS) -> int:
    """Tiles for n classes of a length: few, as each class is sent to every pair with its tile, but enough for the tasks."""
    most = max(1, min(most, TILE_BYTES // max(1, dim)))
    wanted = min(math.ceil(math.sqrt(2 * tasks)), math.ceil(n / LEAST_ROWS))
    return max(1, wanted, math.ceil(n / most))


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, tile: int = TILE_ROWS) -> DataFrame:
    """One row per input row: the id, n_links long, component_id long, kept boolean. tile: classes in a tile, at most."""
    rows = load(df, id_col, vector_col)
    known = rows.filter("id is not null and v is not null")
    classes = known.groupBy("v", "dim").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("size"))
    classes = classes.withColumn("class", F.xxhash64("v", "rep", "dim")).checkpoint()
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    counts = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row a vector length
    tiles = F.lit(1)
    for dim, n in counts.items():
        if (t := tiles_of(n, dim, tasks, tile)) > 1:
            tiles = F.when(F.col("dim") == dim, t).otherwise(tiles)
    dealt = classes.mapInArrow(lean(_quantised), "class long, rep long, size long, dim int, q binary, s double, e double")
    dealt = dealt.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("class"), "tiles").cast("int"))
    other = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t.cast("int")))
    columns = ["dim", "one", "two", "tile", "class", "rep", "size", "q", "s", "e"]
    groups = dealt.withColumn("other", other).withColumns({"one": F.least("tile", "other"), "two": F.greatest("tile", "other")}).select(*columns)
    first = groups.groupBy("dim", "one", "two").applyInArrow(_compare(threshold, False), _FOUND).checkpoint()
    asked = first.filter("open").select("class", "rep", "one", "two", "tile").join(dealt.select("class", "rep", "size", "dim", "q", "s", "e"), ["class", "rep"])
    asked = asked.join(classes.select("class", "rep", "v"), ["class", "rep"])
    second = asked.select(*columns, "v").groupBy("dim", "one", "two").applyInArrow(_compare(threshold, True), _FOUND)
    found = first.union(second).filter("links > 0").checkpoint()
    component = components(found, "rep", "root").withColumnRenamed("node", "rep")
    links = found.groupBy("class", "rep").agg(F.sum("links").alias("links"))
    whole = classes.join(links, ["class", "rep"], "left").join(component, "rep", "left")
    whole = whole.select(F.col("v").alias("key"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    judged = known.join(whole, F.col("v") == F.col("key")).select("id", F.col("n").cast("long").alias("n_links"), F.col("c").alias("component_id"))
    alone = rows.filter("id is null or v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = judged.union(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


def op4_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
