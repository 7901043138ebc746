"""The corpus pipeline: documents in, encoded and mixed training texts out.

Each stage takes all rows that the one before kept, and is written as Parquet and read again before the next
one. Stages 1 to 4 return the columns of documents.

Nulls in any column, empty and very long texts, ties, repeated rows, empty tables and further columns of any names
are handled as each stage's operator says; further columns go along through the stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.llm import minhash_dedup, mixing, quality, sentencepiece_codec, substring_dedup
from sievemill.llm.names import unused
from sievemill.llm.session import with_checkpoints
from sievemill.session import checkpoint_folder

#: Documents with a lower quality score go.
QUALITY = 0.3
#: Shingle words and per cent of similarity from which documents are near duplicates.
SHINGLE, SIMILARITY = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    with_checkpoints(spark)
    trees = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs.columns, "score of quality")
    return quality.with_scores(docs, trees, score_col=score).filter(F.col(score) >= QUALITY).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates; rows that repeat its id stay."""
    with_checkpoints(spark)
    groups = minhash_dedup.near_duplicates(docs, shingle=SHINGLE, threshold=SIMILARITY)
    gone = groups.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows; a text that loses nothing stays as it is, one that loses all, or is null, is empty."""
    with_checkpoints(spark)
    prefix = unused(docs.columns, "cut ")
    cut = substring_dedup.substring_dedup(docs, one_space=False, carry=[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")], prefix=prefix)
    new = {"text": F.col(f"{prefix}kept"), "n_chars": F.length(f"{prefix}kept").cast("long")}
    return cut.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the mixed order: by ranges of the mix's key, sorted within."""
    with_checkpoints(spark)
    prefix = unused(docs.columns, "mix ")
    mixed = mixing.mix(docs, repetition=mixing.REPETITION, prefix=prefix)
    return mixed.repartitionByRange(f"{prefix}key").sortWithinPartitions(f"{prefix}key").select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, one row per row."""
    import public_tokenizers

    with_checkpoints(spark)
    return sentencepiece_codec.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece", encoding_stage),
]

#: SQL cannot express the classifier or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; what lies between them goes to a new folder in the shared checkpoint folder."""
    base = checkpoint_folder(with_checkpoints(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
