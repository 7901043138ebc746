"""Document quality: histogram gradient-boosted trees over statistics of the whole text.

The statistics are counts over the text's bytes, words and lines; ids, labels, languages and sources are never
read as inputs. The trees are fitted on the driver on at most `sample` labelled rows, taken in the order of a
hash of id and text; every document is scored, in one pass and without a shuffle.

Null texts count as empty and get a score like any other. Rows with a null id are scored; they are not held
out. Where an id has several labels, their mean decides (a half counts as 1); where it has several rows, each is a
labelled row. Equal rows get equal scores. Texts of any length are counted whole. Without labels every score is
0.5. An empty table gives an empty result. Further columns, whatever their names, pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.llm import boosting
from sievemill.llm import textbytes as tb
from sievemill.llm.workers import lean

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 20_000
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
_CLASSES = ["upper", "lower", "digit", "space", "newline", "stop", "comma", "mark", "high"]
_MARKS = b"!#$%&*|"
_WORDS = ["log_bytes", "log_words", "mean_length", "deviation", "longest", "distinct", "top_word", "adjacent", "distinct_pairs", "capital", "odd_end", "short", "lines", "distinct_lines", "words_line", "entropy"]
FEATURES = _CLASSES + [f"mark_{chr(m)}" for m in _MARKS] + _WORDS


def _class_of_bytes() -> np.ndarray:
    kind = np.full(256, _CLASSES.index("mark"))
    kind[0x41:0x5B], kind[0x61:0x7B], kind[0x30:0x3A] = 0, 1, 2
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], kind[0x0A] = 3, 4
    kind[[ord(c) for c in ".?:;"]], kind[[ord(c) for c in ",'-\"()"]] = 5, 6
    kind[0x80:] = 8
    return kind


_KIND = _class_of_bytes()
_UPPER = _KIND == 0
_ENDS_WELL = np.isin(_KIND, (0, 1, 2, 5, 6, 8))


def _sorted_runs(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of n rows: how many different hashes it has, and how often the most frequent one stands there."""
    most = np.zeros(n)
    if not len(values):
        return np.zeros(n), most
    bits = n.bit_length()  # the row takes the place of a hash's last bits
    key = np.sort(rows.astype(np.uint64) << tb.U64(64 - bits) | values >> tb.U64(bits))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    of = (key[first] >> tb.U64(64 - bits)).astype(np.int64)
    size = np.diff(np.append(first, len(key)))
    start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    most[of[start]] = np.maximum.reduceat(size, start)
    return np.bincount(of, minlength=n).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    out = np.zeros((len(column), len(FEATURES)))
    for c in tb.chunks(column, tb.SPACE):
        n, size = c.rows, np.diff(c.offsets).astype(float)
        if not size.any():
            continue
        lines = tb.tokenize(c.buf, c.offsets, NEWLINE)
        counts = np.bincount(np.repeat(np.arange(n) * 256, np.diff(c.offsets)) + c.buf, minlength=n * 256).reshape(n, 256)
        part, some = np.maximum(size, 1), size > 0
        share = counts / part[:, None]
        kinds = np.stack([counts[:, _KIND == k].sum(1) for k in range(9)], 1) / part[:, None]
        entropy = -(share * np.log2(share, out=np.zeros_like(share), where=share > 0)).sum(1)
        h, rows = c.hashes(), c.word_rows()
        length = (c.ends - c.starts).astype(float)
        words = np.bincount(rows, minlength=n).astype(float)
        at_least = np.maximum(words, 1)
        per_word = lambda x: np.bincount(rows, x, n) / at_least
        mean, longest = per_word(length), np.zeros(n)
        if len(h):
            start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            longest[rows[start]] = np.maximum.reduceat(length, start)
        deviation = np.sqrt(per_word((length - mean[rows]) ** 2))
        distinct, top = _sorted_runs(h, rows, n)
        if len(h):
            two = rows[1:] == rows[:-1]
            same = np.bincount(rows[1:][two], h[1:][two] == h[:-1][two], n)
            pairs, _ = _sorted_runs(tb.mix64(tb.ngram_hashes(h, 2))[:-1][two], rows[:-1][two], n)
            capital, odd = per_word(_UPPER[c.buf[c.starts]]), per_word(~_ENDS_WELL[c.buf[c.ends - 1]])
        else:
            same = pairs = capital = odd = np.zeros(n)
        joints = np.maximum(words - 1, 1)
        line_rows = lines.word_rows()
        n_lines = np.bincount(line_rows, minlength=n).astype(float)
        different, _ = _sorted_runs(lines.hashes(), line_rows, n)
        per_line = np.maximum(n_lines, 1)
        rest = [
            np.log1p(size), np.log1p(words), mean, deviation, longest, distinct / at_least, top / at_least, same / joints, np.where(words > 1, pairs / joints, 1),
            capital, odd, per_word(length <= 3), np.log1p(n_lines), different / per_line, words / per_line, entropy,
        ]
        rest[1:15] = [np.where(words > 0, x, 0) for x in rest[1:15]]
        got = np.concatenate([kinds, share[:, list(_MARKS)], np.stack(rest, 1)], 1)
        out[c.first_row : c.first_row + n] = np.where(some[:, None], got, 0)
    return out


def held_out(doc_id: str | Column) -> Column:
    """Whether crc32 of the id's digits is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> boosting.Trees:
    """Trees from labelled rows that are not held out, at most `sample` of them."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label")).filter("id is not null and label is not null")
    known = known.filter(~held_out("id")).groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)  # bounded, and so small enough to broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), pa.array(list(statistics(batch.column("text"))), pa.list_(pa.float64()))], ["h", "label", "x"])

    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = docs.join(F.broadcast(known), "id").select(F.xxhash64("id", "text").alias("h"), "text", "label").mapInArrow(lean(run), "h long, label int, x array<double>")
    rows = rows.orderBy("h").limit(sample).toArrow()  # ids may repeat
    y = rows.column("label").to_numpy().astype(float)
    x = np.array(rows.column("x").to_pylist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort([*x.T, y])  # the same rows give the same trees in whatever order they arrive
    return boosting.fit(x[order], y[order])


def with_scores(df: DataFrame, trees: boosting.Trees, text_col: str = "text", score_col: str = "score", keep_text: bool = True) -> DataFrame:
    """The table with a score double (0 to 1); keep_text=False leaves the text out of it."""
    if score_col in df.columns:
        raise ValueError(f"the table has a column {score_col}")
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = trees.score(statistics(batch.column(text_col).fill_null("")))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(score)], [*(f.name for f in kept), score_col])

    return df.mapInArrow(lean(run), T.StructType([*kept, T.StructField(score_col, T.DoubleType())]))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    trees = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    scored = with_scores(keyed, trees, keep_text=False)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
