"""Removal of repeated word windows across a corpus, by seed and extend.

A window is `window` consecutive words of one document. Every word covered by a window whose word
sequence also starts earlier (smaller id, or same document and earlier start) is removed.

Seeds are winnowed anchors: of the word 8-grams inside a window, the rightmost with the smallest hash. The
choice depends on the window's words alone, so equal windows choose the same anchor at the same offset.
Consecutive windows with one anchor form a run, the anchor extended left and right as far as it is the
choice. Runs are joined by anchor:

* a run whose whole content occurred earlier is a repeat in full (the inside of any long repeat);
* the first run of each content is compared further only if its anchor has other contents too. These are
  the edges of maximal repeats: their windows are extended word for word, as 128-bit window hashes, and
  the first place of each window is kept.

* anchors that head very many runs of a sample (a passage in many documents, with other words around it each time)
  are hot: their runs are compared window by window from the start, each under its own hash, so that no single
  key gathers them. The sample, which grows with the corpus, decides on the route only; either route finds the
  same repeats.

The union of all is exactly the set of repeated windows; its maximal intervals are the removed spans.

Null texts have no words. Rows that repeat an id with the same text are one document and get the same
result; rows with one id and different texts are different documents, told apart and ordered by 128 bits of
the text's hash. Rows with a null id are told apart likewise, and sort first. Ties cannot occur: places differ in
document or start. Texts of any length are read whole, one at a time if they are long. An empty table gives an
empty result. Extra columns, whatever their names, are left out unless they are carried.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.llm import textbytes as tb
from sievemill.llm.components import splittable
from sievemill.llm.session import tidy
from sievemill.llm.workers import lean

ANCHOR_WORDS = 8
#: An anchor is hot if it heads so many runs of a sample: of one document in so many, within limits.
HOT_LEAST, HOT_EVERY, HOT_SAMPLE = 50, 50, (10_000, 500_000)
_SECOND_BASE = 0xA24BAED4963EE407
_RUNS = "id long, x long, y long, h long, r long, s int, m int"
_WINDOWS = "id long, x long, y long, w1 long, w2 long, s int, seen boolean"


def _rightmost_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """For each place the index of the smallest of `width` values from there on, the rightmost of equals."""
    at, value, span = np.arange(len(key)), key, 1

    def join(by: int) -> None:
        nonlocal at, value
        v, a = value[by:], at[by:]
        right = v <= value[: len(v)]
        value, at = np.where(right, v, value[: len(v)]), np.where(right, a, at[: len(a)])

    while span * 2 <= width:
        join(span)
        span *= 2
    if span < width:
        join(width - span)
    return at


def _window_starts(c: tb.Chunk, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The words at which a window starts, and each word's row."""
    rows = c.word_rows()
    fits = np.arange(len(rows)) + window <= c.row_ptr[1:][rows]
    return np.flatnonzero(fits), rows


def _first_of(keys: list[np.ndarray], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which entries come after the first place, by order, of those with equal keys; which only repeat that place (equal rows)."""
    if not len(keys[0]):
        return np.zeros(0, bool), np.zeros(0, bool)
    by = np.lexsort([*order[::-1], *keys[::-1]])
    same = np.ones(len(by) - 1, bool)
    for k in keys:
        same &= k[by][1:] == k[by][:-1]
    same = np.append(False, same)
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
    moved = np.zeros(len(by), bool)
    for o in order:
        moved |= o[by] != o[by][first]
    later, again = np.zeros(len(by), bool), np.zeros(len(by), bool)
    later[by], again[by] = same & moved, same & ~moved
    return later, again


def _ids(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """The columns that name a document, and values to sort documents by (null ids first)."""
    names = batch.select(["id", "x", "y"])
    ids = batch.column("id")
    return names, [ids.is_valid().to_numpy(zero_copy_only=False), *(names.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("id", "x", "y"))]


def _named(names: pa.RecordBatch, row: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The names of documents, by row, with further columns."""
    return pa.RecordBatch.from_arrays([*names.take(pa.array(row)).columns, *map(pa.array, columns.values())], [*names.schema.names, *columns])


def _apart(row: np.ndarray, values: list[np.ndarray], s: np.ndarray) -> np.ndarray:
    """A key of its own, nearly, for each place."""
    return tb.mix64((values[1][row] * 31 + values[2][row] + s).view(tb.U64)).view(np.int64)


def _chosen(c: tb.Chunk, window: int):
    """Word hashes, anchor hashes, window starts, their rows, and the anchor that each window chooses."""
    starts, rows = _window_starts(c, window)
    if not len(starts):
        return None
    h = c.hashes()
    anchors = tb.mix64(tb.ngram_hashes(h, ANCHOR_WORDS))
    return h, anchors, starts, rows, _rightmost_minimum(anchors, window - ANCHOR_WORDS + 1)[starts]


def _anchors(window: int):
    """The anchors of each batch with their numbers of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in tb.chunks(batch.column("text"), tb.SPACE):
                if (got := _chosen(c, window)) is None:
                    continue
                _, anchors, _, _, chosen = got
                new = np.append(True, chosen[1:] != chosen[:-1])
                h, n = np.unique(anchors[chosen[new]].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])

    return lean(run)


def hot_anchors(docs: DataFrame, window: int) -> np.ndarray:
    """Anchors with a large share of the runs of a bounded sample, sorted. They only decide where runs are compared."""
    total = docs.count()
    if not total:
        return np.zeros(0, np.int64)
    wanted = min(max(total // HOT_EVERY, HOT_SAMPLE[0]), HOT_SAMPLE[1])
    counted = docs.sample(min(1.0, wanted / total), seed=1).select("text").mapInArrow(_anchors(window), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    # at most the sample's runs divided by HOT_LEAST
    return np.sort(np.array([r["h"] for r in counted.filter(F.col("n") >= HOT_LEAST).select("h").collect()], np.int64))


def _runs(window: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values = _ids(batch)
            got, n_runs = [], 0
            for c in tb.chunks(batch.column("text"), tb.SPACE):
                if (found := _chosen(c, window)) is None:
                    continue
                words, anchors, starts, rows, chosen = found
                w = tb.mix64(tb.ngram_hashes(words, window))
                first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
                m = np.diff(np.append(first, len(starts)))
                s, h = starts[first], anchors[chosen[first]].view(np.int64)
                # the first and the last window of a run hold all its words between them
                r = tb.mix64(w[s] * tb.U64(0x9FB21C651E98DF25) + w[s + m - 1] + m.astype(tb.U64)).view(np.int64)
                number = n_runs + np.arange(len(s))
                single = np.isin(h, hot) if len(hot) else np.zeros(len(s), bool)
                if single.any():
                    # runs of a hot anchor are compared window by window, each under its own hash
                    n = np.where(single, m, 1)
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    s, h, r, m, number, single = (np.repeat(v, n) for v in (s, h, r, m, number, single))
                    s = s + np.where(single, step, 0)
                    h = np.where(single, w[s].view(np.int64), h)
                    r = np.where(single, tb.mix64(tb.ngram_hashes(words, window, _SECOND_BASE)[s]).view(np.int64), r)
                    m = np.where(single, 1, m)
                n_runs += len(first)
                row = rows[s]
                got.append((c.first_row + row, h, r, (s - c.row_ptr[row]).astype(np.int32), m.astype(np.int32), np.where(single, number, -1)))
            if not got:
                continue
            row, h, r, s, m, number = map(np.concatenate, zip(*got, strict=True))
            # Repeats inside the batch are settled here, so that a hot content sends one row a batch; the others go to keys of their own
            later, again = _first_of([h, r], [*(v[row] for v in values), s])
            # neighbouring repeated windows of one run go as one row
            joined = np.append(False, later[1:] & later[:-1] & (number[1:] >= 0) & (number[1:] == number[:-1]))
            lead = np.flatnonzero(~joined)
            m = np.where(later, -np.add.reduceat(m, lead)[np.cumsum(~joined) - 1], m).astype(np.int32)
            lead = lead[~again[lead]]  # an equal row's places are those of the first
            m = m[lead]
            row, h, r, s, later = row[lead], h[lead], r[lead], s[lead], later[lead]
            h = np.where(later, _apart(row, values, s), h)
            yield _named(names, row, {"h": h, "r": r, "s": s, "m": m})

    return lean(run)


def _windows(window: int):
    """Hashes of the windows of runs; spans: array of start * 32 + windows * 2 + (1 if only to be compared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values = _ids(batch)
            spans = batch.column("spans")
            flat = spans.flatten().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            asked = (flat & 1).astype(bool)
            flat, of = flat[asked], of[asked]
            begin, count = flat >> 5, (flat >> 1) & 15
            got = []
            for c in tb.chunks(batch.column("text"), tb.SPACE):
                mine = (of >= c.first_row) & (of < c.first_row + c.rows)
                if not mine.any():
                    continue
                h = c.hashes()
                row, n = of[mine] - c.first_row, count[mine]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row, s = np.repeat(row, n), np.repeat(begin[mine], n) + step
                at = c.row_ptr[row] + s
                one, two = (tb.mix64(tb.ngram_hashes(h, window, b)[at]).view(np.int64) for b in (0xD6E8FEB86659FD93, _SECOND_BASE))
                got.append((c.first_row + row, one, two, s.astype(np.int32)))
            if not got:
                continue
            row, one, two, s = map(np.concatenate, zip(*got, strict=True))
            seen, again = _first_of([one, two], [*(v[row] for v in values), s])
            row, one, two, s, seen = (v[~again] for v in (row, one, two, s, seen))
            one = np.where(seen, _apart(row, values, s), one)
            yield _named(names, row, {"w1": one, "w2": two, "s": s, "seen": seen})

    return lean(run)


def _cut(window: int, one_space: bool):
    """Drops the covered words; each goes with the separators after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone_at, gone_of = [], []
            for name, shift in (("spans", 5), ("late", 0)):
                lists = batch.column(name)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                if shift:
                    sure = (flat & 1) == 0
                    flat, of = flat[sure], of[sure]
                    gone_at.append(np.stack([flat >> 5, (flat >> 5) + ((flat >> 1) & 15) - 1 + window], 1))
                else:
                    gone_at.append(np.stack([flat, flat + window], 1))
                gone_of.append(of)
            at, of = np.concatenate(gone_at), np.concatenate(gone_of)
            n_words, n_removed, kept = [], [], []
            for c in tb.chunks(batch.column("text"), tb.SPACE):
                words = len(c.starts)
                delta = np.zeros(words + 1, np.int64)
                mine = (of >= c.first_row) & (of < c.first_row + c.rows)
                base = c.row_ptr[of[mine] - c.first_row]
                np.add.at(delta, base + at[mine, 0], 1)
                np.add.at(delta, base + at[mine, 1], -1)
                keep = np.cumsum(delta[:-1]) <= 0
                rows = c.word_rows()
                n_words.append(np.diff(c.row_ptr))
                n_removed.append(np.bincount(rows[~keep], minlength=c.rows))
                buf = c.buf
                if one_space:
                    buf = np.where(tb.SPACE[buf], np.uint8(0x20), buf)
                    mark = np.zeros(len(buf) + 1, np.int8)
                    mark[c.starts[keep]] += 1
                    mark[c.ends[keep]] -= 1
                    take = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
                    k = np.flatnonzero(keep)
                    between = k[:-1][rows[k[:-1]] == rows[k[1:]]]  # kept words with another kept one after them
                    take[c.ends[between]] = True
                else:
                    until = np.append(c.starts[1:], len(buf))
                    until = np.minimum(until, c.offsets[rows + 1])
                    mark = np.zeros(len(buf) + 1, np.int8)
                    np.add.at(mark, c.starts[~keep], 1)
                    np.add.at(mark, until[~keep], -1)
                    take = np.cumsum(mark[:-1], dtype=np.int8) == 0
                ends = np.concatenate([[0], np.cumsum(take)])[c.offsets]
                kept.append((buf[take], ends))
            size = np.cumsum([0, *(len(b) for b, _ in kept)])
            limits = np.concatenate([e[:-1] + o for (_, e), o in zip(kept, size, strict=False)] + [size[-1:]]) if kept else np.zeros(1)
            data = np.concatenate([b for b, _ in kept]) if kept else np.zeros(0, np.uint8)
            text = pa.Array.from_buffers(pa.large_string(), len(batch), [None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())
            number = lambda xs: pa.array(np.concatenate(xs).astype(np.int64) if xs else [], pa.int64())
            rest = [n for n in batch.schema.names if n.startswith("carried ")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), number(n_words), number(n_removed), text, *map(batch.column, rest)], ["id", "n_words", "n_removed", "kept", *rest])

    return lean(run)


def _marks(text: Column) -> tuple[Column, Column]:
    """128 bits that name a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(0x5BD1E995), F.length(text), text)


def told_apart(whole: DataFrame) -> DataFrame:
    """(id, text, ...) with x and y long: both 0 where an id has one text only, else marks of the text."""
    x, y = _marks(F.col("text"))
    marks = whole.filter("id is not null").select("id", F.struct(x.alias("x"), y.alias("y")).alias("mark"))
    several = marks.groupBy("id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low != high").select(F.col("id").alias("i"), F.lit(True).alias("several")).checkpoint()
    own = F.col("id").isNull()
    if not several.isEmpty():
        # rows with a null id go by their text, so that no task gathers them
        whole = whole.withColumn("at", F.coalesce("id", x)).join(several, F.col("at") == F.col("i"), "left")
        own = own | F.coalesce("several", F.lit(False))
        whole = whole.drop("at", "i")
    return whole.withColumns({"x": F.when(own, x).otherwise(F.lit(0).cast("long")), "y": F.when(own, y).otherwise(F.lit(0).cast("long"))}).drop("several")


def _spans(whole: DataFrame, window: int) -> DataFrame:
    """(id, x, y, spans, edge): runs of each document that are repeats in full, or edges to be compared window by window."""
    runs = whole.select("id", "x", "y", "text").mapInArrow(_runs(window, hot_anchors(whole, window)), _RUNS)
    anchor = Window.partitionBy("h")
    content = Window.partitionBy("h", "r").orderBy(F.asc_nulls_first("id"), "x", "y", "s")
    flagged = (
        runs.withColumns({"n": F.dense_rank().over(content)})  # equal rows are one place
        .withColumns({"low": F.min("r").over(anchor), "high": F.max("r").over(anchor)})
        .withColumn("repeated", (F.col("m") < 0) | (F.col("n") > 1))
        .filter(F.col("repeated") | (F.col("low") < F.col("high")))
    )
    code = F.col("s").cast("long") * 32 + F.abs("m") * 2 + F.when(F.col("repeated"), 0).otherwise(1)
    return flagged.groupBy("id", "x", "y").agg(F.collect_set(code).alias("spans"), F.max(~F.col("repeated")).alias("edge")).checkpoint()


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, one_space: bool = True, carry: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """One row per input row: the id, n_words long, n_removed long, kept string, carried columns.

    one_space: kept words joined by one space; else the original separators stay between kept words.
    window: 9 to 22 words, so that a run holds 15 windows at most.
    carry: further columns to return as they are. prefix: of the names of n_words, n_removed and kept.
    """
    if not ANCHOR_WORDS < window <= ANCHOR_WORDS + 14:
        raise ValueError(f"window must be {ANCHOR_WORDS + 1} to {ANCHOR_WORDS + 14} words")
    carried = [F.col(c).alias(f"carried {i}") for i, c in enumerate(carry)]
    whole = told_apart(df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carried))
    spans = _spans(whole, window)
    tidy(df.sparkSession)  # of the runs, which are more than all that follows
    # Both joins take all columns of the texts' side, so that Spark shuffles it once and reads that exchange twice
    names = whole.columns

    def of_document(table: DataFrame, k: int) -> tuple[DataFrame, Column]:
        """The table with its document's columns renamed, and the condition that joins it."""
        on = {c: f"{c} of {k}" for c in ("id", "x", "y")}
        same = F.col("id").eqNullSafe(F.col(on["id"])) & (F.col("x") == F.col(on["x"])) & (F.col("y") == F.col(on["y"]))
        return table.withColumnsRenamed(on), same

    edges, same = of_document(spans.filter("edge").drop("edge"), 1)
    windows = whole.join(edges, same).select(*names, "spans").mapInArrow(_windows(window), _WINDOWS)
    place = Window.partitionBy("w1", "w2").orderBy(F.asc_nulls_first("id"), "x", "y", "s")
    late = windows.withColumn("n", F.dense_rank().over(place)).filter("seen or n > 1").groupBy("id", "x", "y").agg(F.collect_set(F.col("s").cast("long")).alias("late"))
    late = splittable(late, "id", "x", "y")
    (spans, same), (late, same_late) = of_document(spans.drop("edge"), 2), of_document(late, 3)
    joined = whole.join(spans, same, "left").join(late, same_late, "left").select(*names, "spans", "late")
    kept = [T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    schema = T.StructType([*kept, *(f for f in whole.schema.fields if f.name.startswith("carried "))])
    out = joined.mapInArrow(_cut(window, one_space), schema)
    own = [F.col(c).alias(prefix + c) for c in ("n_words", "n_removed", "kept") if prefix + c not in carry]
    return out.select(F.col("id").alias(id_col), *own, *(F.col(f"carried {i}").alias(c) for i, c in enumerate(carry)))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
