"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct shingles of `shingle` words (a-z for A-Z); with fewer words the whole
sequence is one shingle; without words the set is empty and links with nothing.

1. One pass hashes the shingles. A first permutation scatters them over 2**32 places; a second one, read
   after shifting the places circularly by 0, 1, 2, ..., gives each signature coordinate as a minimum.
   Bands of them make keys; their number and rows follow from the threshold, so that a pair just at it
   misses all bands with probability MISS at most (at 80: 40 bands of 6). Groups usually share many more pairs.
2. Equal sets (128-bit fingerprint of all hashes) become one class, represented by one row of its smallest id,
   before anything is joined. Copies are linked with similarity 1 and never paired; repeated rows are collapsed.
3. Each bucket's members are first compared with its smallest id. Buckets that then hold one component are
   done, as a pair inside one component cannot change the result. The others are dealt into blocks of bounded
   size, by component where one fills a block, and by size of set; every two blocks of a bucket that hold more than
   one component and sets of sizes that can be similar form a group. In it, members of different
   components are compared, each pair in the first band that it shares only; a group returns at most one link
   for each member. Sets come without the shingles that no other open document holds. Nothing is capped.
4. Pairs are confirmed on full sets: 100 * |A & B| >= threshold * |A | B|.

Null ids take part as documents of their own, linked with nothing. Rows that share an id are one node: they
are linked to what any of their texts links to. Ties (equal sets, equal ids) need no choice but the smallest id.
Texts of any length are read whole, one at a time if they are long. Columns of any names may stand beside the
two that are read, and are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.llm import textbytes as tb
from sievemill.llm.components import components, splittable
from sievemill.llm.session import tidy
from sievemill.llm.workers import lean, lean_group

#: Shingles of a block of bucket members, about.
BLOCK_SHINGLES = 1_500_000
#: Signature coordinates, about, and the probability that a pair just at the threshold shares no band, at most.
COORDINATES, MISS = 256, 6e-6

_U32 = np.uint32


def banding(threshold: int) -> tuple[int, int]:
    """Bands and their rows for a threshold in per cent: as many rows as the coordinates allow."""
    if not 0 < threshold <= 100:
        raise ValueError("threshold must be 1 to 100 per cent")
    best = (1, 1)
    for rows in range(1, 17):
        hit = (threshold / 100) ** rows
        bands = math.ceil(math.log(MISS) / math.log1p(-hit)) if hit < 1 else 1
        if rows == 1 or bands * rows <= COORDINATES:
            best = (bands, rows)
    return best


def shingle_sets(c: tb.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row, one after the other, and the rows' limits in them."""
    h = c.hashes()
    size = np.diff(c.row_ptr)
    grams = tb.mix64(tb.ngram_hashes(h, k)) if len(h) else h
    out, limits = [], np.zeros(c.rows + 1, np.int64)
    for row in range(c.rows):
        low, n = c.row_ptr[row], size[row]
        if n >= k:
            g = np.sort(grams[low : low + n - k + 1])
            g = g[np.append(True, g[1:] != g[:-1])]
        elif n:
            g = tb.mix64(tb.ngram_hashes(h[low : low + n], int(n))[:1] + tb.U64(n))
        else:
            g = h[:0]
        out.append(g)
        limits[row + 1] = limits[row] + len(g)
    return (np.concatenate(out) if out else h[:0]), limits


def signature_keys(sets: np.ndarray, limits: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys (rows of sets x bands, int64) of non-empty sets."""
    place = (tb.mix64(sets) >> tb.U64(32)).astype(_U32)  # the first permutation
    place *= _U32(0x85EBCA6B)
    at = limits[:-1]
    keys = np.zeros((len(at), bands), tb.U64)
    a, b = np.empty_like(place), np.empty_like(place)
    for k in range(bands * rows):
        # the second permutation at (place + k) modulo 2**32; its first factor is applied already
        np.add(place, _U32(k * 0x85EBCA6B & 0xFFFFFFFF), out=a)
        np.right_shift(a, 15, out=b)
        np.bitwise_xor(a, b, out=a)
        np.multiply(a, _U32(0xC2B2AE35), out=a)
        np.right_shift(a, 13, out=b)
        np.bitwise_xor(a, b, out=a)
        np.multiply(a, _U32(0x27D4EB2F), out=a)
        least = np.minimum.reduceat(a, at)
        band = k // rows
        keys[:, band] = keys[:, band] * tb.U64(0xD6E8FEB86659FD93) + least + tb.U64(band + 1)
    return tb.mix64(keys).view(np.int64)


def _signatures(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_shingles, prints, keys = [], [], []
            for c in tb.chunks(batch.column("text"), tb.SPACE, lower=True):
                sets, limits = shingle_sets(c, k)
                size = np.diff(limits)
                n_shingles.append(size)
                marks = [_print(sets[a:b]) if b > a else None for a, b in zip(limits[:-1], limits[1:], strict=True)]
                prints += marks
                first = {m: i for i, m in reversed(list(enumerate(marks))) if m is not None}  # equal sets are signed once
                rows_of = np.fromiter(first.values(), np.int64, len(first))
                mine: list = [None] * c.rows
                if len(rows_of):
                    rows_of.sort()
                    part = np.concatenate([sets[limits[i] : limits[i + 1]] for i in rows_of])
                    got = signature_keys(part, np.append(0, np.cumsum(size[rows_of])), bands, rows)
                    for i, row in enumerate(rows_of):
                        mine[row] = got[i]
                keys += [None if m is None else mine[first[m]] for m in marks]
            n = np.concatenate(n_shingles) if n_shingles else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n.astype(np.int64)), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "print", "keys"])

    return lean(run)


def _print(members: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(members, digest_size=16).digest()


def _full_sets(k: int):
    """Full sets; of rows whose id stands in several rows also the set's print."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            several = batch.column("several").to_pylist()
            got, prints = [], []
            for c in tb.chunks(batch.column("text"), tb.SPACE, lower=True):
                sets, limits = shingle_sets(c, k)
                for row, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                    got.append(sets[a:b].tobytes())
                    prints.append(_print(sets[a:b]) if several[c.first_row + row] else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.binary()), pa.array(got, pa.binary())], ["id", "print", "members"])

    return lean(run)


@lean
def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shingle of a set with the set's id and mark."""
    for batch in batches:
        sets = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column("members")]
        at, total = 0, 0
        for i, x in enumerate([*sets, None]):
            if x is not None:
                total += len(x)
            if total and (x is None or total > 1 << 18):
                part = sets[at : i + 1]
                of = pa.array(np.repeat(np.arange(at, at + len(part)), [len(y) for y in part]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)), batch.column("id").take(of), batch.column("m").take(of)], ["shingle", "id", "m"])
                at, total = i + 1, 0


def _confirm(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch.column("one"), batch.column("two"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), tb.U64) for v in (a, b))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep[i] = 100 * both >= threshold * (len(x) + len(y) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return lean(run)


@lean
def _without_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets without the shingles that no other open document holds."""
    for batch in batches:
        got = []
        for v, own in zip(batch.column("members"), batch.column("own"), strict=True):
            x = np.frombuffer(v.as_buffer(), np.int64)
            got.append((x if own.values is None else x[~np.isin(x, own.values.to_numpy(zero_copy_only=False))]).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("m"), batch.column("keys"), pa.array(got, pa.binary())], ["id", "m", "keys", "members"])


def _compare(threshold: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        band_key, first, second = (k.as_py() for k in key)
        block, ids, n, component = (table.column(c).to_numpy() for c in ("block", "id", "n", "component"))
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(ids), -1)
        sets = [np.frombuffer(v.as_buffer(), np.int64) for v in table.column("members")]
        size = np.array([len(x) for x in sets])
        start = np.cumsum(size) - size
        names, dense = np.unique(np.concatenate(sets), return_inverse=True)
        band = int((keys[0] == band_key).argmax())
        parent = {int(c): int(c) for c in component}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        now = component.copy()
        held = np.zeros(len(names) + 1, bool)
        low, high = np.flatnonzero(block == first), np.flatnonzero(block == second)
        a, b = [], []
        for k, i in enumerate(low):
            other = high if first != second else low[k + 1 :]
            other = other[now[other] != now[i]]
            common = np.minimum(size[other], size[i])
            other = other[100 * common >= threshold * (n[other] + n[i] - common)]
            other = other[(keys[other] == keys[i]).argmax(1) == band]
            if not len(other):
                continue
            mine = dense[start[i] : start[i] + size[i]]
            held[mine] = True
            m = size[other]
            at = np.arange(m.sum()) + np.repeat(start[other] - (np.cumsum(m) - m), m)
            both = np.add.reduceat(np.append(held[dense[at]], False).astype(np.int64), np.cumsum(m) - m) * (m > 0)
            held[mine] = False
            for j in other[100 * both >= threshold * (n[other] + n[i] - both)]:
                x, y = root(int(component[i])), root(int(component[j]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    now[now == max(x, y)] = min(x, y)
                    a.append(int(ids[i])), b.append(int(ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return lean_group(run)


def _marked(rows: DataFrame, several: DataFrame | None) -> DataFrame:
    """Rows (id, ...) with `several` boolean: whether the id stands in several rows."""
    if several is None:
        return rows.withColumn("several", F.lit(False))
    return rows.join(several.select("id", F.lit(True).alias("several")), "id", "left").withColumn("several", F.coalesce("several", F.lit(False)))


def _mark(several: Column) -> Column:
    """What tells the sets of one id apart; 0 for an id with one row."""
    return F.when(several, F.xxhash64("print")).otherwise(F.lit(0).cast("long"))


def _blocks(rows: DataFrame, threshold: int) -> DataFrame:
    """Rows (key, id, m, n, component) of open buckets with their block: 0 in buckets that fit into one.

    In larger ones a component that fills half a block has blocks of its own, and the others share some; both are
    dealt by size of set first, so that sets that cannot be similar seldom meet. All by combined sums.
    """
    size = F.floor(F.log("n") / math.log(max(1.05, 100 / threshold))).cast("int")
    rows = rows.withColumn("size", size).checkpoint()
    columns = ["key", "id", "m", "n", "component"]
    parts = rows.groupBy("key", "component", "size").agg(F.sum("n").alias("n")).checkpoint()
    # tables of their own, so that Spark can split joins on a hot key
    large = parts.groupBy("key").agg(F.sum("n").alias("all")).filter(F.col("all") > BLOCK_SHINGLES).select("key").checkpoint()
    if large.isEmpty():
        return rows.select(*columns, F.lit(0).cast("long").alias("block"))
    owners = parts.groupBy("key", "component").agg(F.sum("n").alias("all")).filter(F.col("all") > BLOCK_SHINGLES / 2).select("key", "component", F.lit(True).alias("own")).checkpoint()
    placed = rows.join(large, "key", "left_semi").join(owners, ["key", "component"], "left").withColumn("of", F.when(F.col("own"), F.col("component")))
    dealt = parts.join(large, "key", "left_semi").join(owners, ["key", "component"], "left").withColumn("of", F.when(F.col("own"), F.col("component")))
    dealt = dealt.groupBy("key", "of", "size").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("parts")).withColumnsRenamed({"key": "key_2", "of": "of_2", "size": "size_2"}).checkpoint()
    placed = placed.join(dealt, (F.col("key") == F.col("key_2")) & F.col("of").eqNullSafe(F.col("of_2")) & (F.col("size") == F.col("size_2")))
    # blocks of one number would only be one larger block
    block = F.xxhash64("of", "size", F.pmod(F.xxhash64("id", "m"), "parts"))
    return rows.join(large, "key", "left_anti").select(*columns, F.lit(0).cast("long").alias("block")).union(placed.select(*columns, block.alias("block")))


#: What tells a set from all others: its smallest id, and a mark.
_NODE = ["id", "m"]


def _classes(known: DataFrame, several: DataFrame | None) -> DataFrame:
    """(print, one, last): each set with one row of its smallest id (id, m, n, keys), and its largest id."""
    marked = _marked(known, several).select("print", "id", "n", "keys", _mark(F.col("several")).alias("m"))
    return marked.groupBy("print").agg(F.min(F.struct("id", "m", "n", "keys")).alias("one"), F.max("id").alias("last")).checkpoint()


def _members(rep: DataFrame) -> DataFrame:
    """(key, id, m, n, lead): sets in buckets with sets of other ids, and the bucket's first set."""
    buckets = rep.select(*_NODE, "n", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min(F.struct(*_NODE, "n")).alias("lead"), F.max("id").alias("last")).filter("lead.id < last").select("key", "lead")
    return buckets.join(splittable(shared, "key"), "key").checkpoint()


def _sets(docs: DataFrame, members: DataFrame, several: DataFrame | None, shingle: int) -> DataFrame:
    """(id, m, members): full sets of bucket members, one row each."""
    ids = members.select(*_NODE).distinct()
    found = _marked(docs.join(ids.select("id").distinct(), "id", "left_semi"), several).mapInArrow(_full_sets(shingle), "id long, print binary, members binary").filter("length(members) > 0")
    if several is None:
        return found.select("id", F.lit(0).cast("long").alias("m"), "members").checkpoint()
    found = found.select("id", _mark(F.col("print").isNotNull()).alias("m"), "members").checkpoint()
    again = found.filter("m != 0").groupBy(*_NODE).agg(F.first("members").alias("members")).join(ids, _NODE, "left_semi")
    return found.filter("m = 0").union(again).checkpoint()


def _led_links(members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b): ids of buckets' first sets and of members similar to them."""
    led = members.filter("id != lead.id").filter(F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * threshold)
    pairs = led.select(F.col("lead.id").alias("a"), F.col("lead.m").alias("am"), F.col("id").alias("b"), F.col("m").alias("bm")).distinct()
    first = sets.select(F.col("id").alias("a"), F.col("m").alias("am"), F.col("members").alias("one"))
    second = sets.select(F.col("id").alias("b"), F.col("m").alias("bm"), F.col("members").alias("two"))
    return pairs.join(first, ["a", "am"]).join(second, ["b", "bm"]).select("a", "b", "one", "two").mapInArrow(_confirm(threshold), "a long, b long").checkpoint()


def _open_buckets(members: DataFrame, links: DataFrame, threshold: int) -> DataFrame:
    """Members of buckets that hold several components of the links so far, in blocks."""
    label = components(links, "a", "b", rounds=2).select(F.col("node").alias("id"), F.col("component").alias("linked"))
    placed = members.join(label, "id", "left").select("key", *_NODE, "n", F.coalesce("linked", "id").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    return _blocks(placed.join(splittable(split, "key"), "key").distinct(), threshold).checkpoint()


def _open_links(blocks: DataFrame, sets: DataFrame, rep: DataFrame, threshold: int) -> DataFrame:
    """(a, b): links found by comparing the blocks of open buckets."""
    open_sets = sets.join(blocks.select(*_NODE).distinct(), _NODE, "left_semi")
    owned = open_sets.mapInArrow(_shingles, "shingle long, id long, m long").groupBy("shingle").agg(F.min(F.struct(*_NODE)).alias("node"), F.count("*").alias("sets")).filter("sets = 1")
    owned = owned.groupBy("node.id", "node.m").agg(F.collect_list("shingle").alias("own"))  # no more than the set itself
    reduced = open_sets.join(owned, _NODE, "left").join(rep.select(*_NODE, "keys"), _NODE).mapInArrow(_without_own, "id long, m long, keys array<long>, members binary")
    spans = blocks.groupBy("key", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
    left, right = (spans.select("key", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "low", "high", "least", "most"))) for k in (1, 2))
    block_pairs = left.join(right, "key").filter("block_1 <= block_2 and not (low_1 = high_1 and low_2 = high_2 and low_1 = low_2)")
    block_pairs = block_pairs.filter(f"100 * most_1 >= {threshold} * least_2 and 100 * most_2 >= {threshold} * least_1")
    block_pairs = block_pairs.select("key", F.col("block_1").alias("first"), F.col("block_2").alias("second"), F.explode(F.array_distinct(F.array("block_1", "block_2"))).alias("block"))
    groups = blocks.join(block_pairs, ["key", "block"]).join(reduced, _NODE).select("key", "first", "second", "block", "id", "n", "component", "keys", "members")
    return groups.groupBy("key", "first", "second").applyInArrow(_compare(threshold), "a long, b long").checkpoint()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: int = 80) -> DataFrame:
    """One row per input row: the id, n_shingles long, component_id long, kept boolean.

    threshold: per cent of Jaccard similarity from which documents are linked.
    """
    bands, rows = banding(threshold)
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = docs.mapInArrow(_signatures(shingle, bands, rows), "id long, n long, print binary, keys array<long>").checkpoint()
    known = signed.filter("id is not null and print is not null")
    several = known.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").select("id").checkpoint()
    several = None if several.isEmpty() else several
    # each phase ends with a table of its own, and the shuffles before it are deleted
    classes = _classes(known, several)
    rep = classes.select("one.*")
    members = _members(rep)
    tidy(spark)
    sets = _sets(docs, members, several, shingle)
    tidy(spark)
    links = _led_links(members, sets, threshold)
    tidy(spark)
    blocks = _open_buckets(members, links, threshold)
    tidy(spark)
    links = links.union(_open_links(blocks, sets, rep, threshold))
    tidy(spark)
    copies = known.select("id", "print").join(classes.filter("one.id != last").select("print", F.col("one.id").alias("rep")), "print").filter("id != rep").select("id", "rep").distinct()
    edges = copies.select(F.col("id").alias("a"), F.col("rep").alias("b")).union(links)
    component = components(edges, "a", "b").withColumnRenamed("node", "id")
    out = signed.join(component, "id", "left")
    group = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), group.alias("component_id"), group.eqNullSafe(F.col("id")).alias("kept"))


def op7_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=2)
