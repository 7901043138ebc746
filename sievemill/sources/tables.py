"""The driver's tables as inputs of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The types that stand in for a generated question's type, by turn.
TYPES = ["factual", "procedural", "eligibility", "edge_case", "comparative", "troubleshooting", "consequence"]


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns that the assistant answers next; the article is the document with the conversation's id."""
    turns = table(spark, sf_dir, "conversations")
    following = Window.partitionBy("conv_id").orderBy("turn")
    pairs = turns.withColumns({"next_role": F.lead("role").over(following), "answer": F.lead("text").over(following)}).filter("role = 'user' and next_role = 'assistant'")
    about = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("lang").alias("collection"))
    kind = F.element_at(F.array(*map(F.lit, TYPES)), (F.pmod(F.col("turn"), F.lit(len(TYPES))) + 1).cast("int"))
    return pairs.join(about, "conv_id").select(
        F.concat_ws("_q", F.col("conv_id"), F.col("turn")).alias("qa_id"),
        F.col("conv_id").cast("string").alias("article_id"),
        F.col("text").alias("question"),
        kind.alias("question_type"),
        "answer",
        "collection",
        F.concat(F.lit("Article "), F.col("conv_id")).alias("article_title"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"),
    )


def qa_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pairs: the first line asks, the whole text answers."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("qa_id"), F.col("doc_id").cast("string").alias("article_id"), F.substring_index("text", "\n", 1).alias("question"),
        F.lit("factual").alias("question_type"), F.col("text").alias("answer"), F.col("source").alias("collection"), F.col("lang").alias("article_title"), F.col("doc_id").alias("ord"),
    )


def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: article_id, plain_text, title, collection, markdown, ord."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("article_id"), F.col("text").alias("plain_text"), F.col("lang").alias("title"), F.col("source").alias("collection"), F.col("text").alias("markdown"), F.col("doc_id").alias("ord"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, messages (role, content) in order of turns."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def session_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as messages, assistant turns as their completions, and a clear or a switch of the prompt every few turns."""
    c = table(spark, sf_dir, "conversations")
    cmd = F.when((F.col("role") == "user") & (F.pmod("turn", F.lit(5)) == 2), "clear").when((F.col("role") == "user") & (F.pmod("turn", F.lit(7)) == 4), "system").when(F.col("role") == "user", "message").otherwise("completion")
    key = F.element_at(F.array(F.lit("seller"), F.lit("unknown"), F.lit("buyer")), (F.pmod("conv_id", F.lit(3)) + 1).cast("int"))
    return c.select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").alias("seq"), cmd.alias("cmd"), F.when(cmd == "system", key).otherwise(F.col("text")).alias("arg"))
