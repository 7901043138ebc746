"""The joins between articles, questions, results and work items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.config import Config
from sievemill.functions import text
from sievemill.operators.dedup import last_wins


def work_items(questions: DataFrame, articles: DataFrame) -> DataFrame:
    """Questions of known articles, numbered in their article, with what their prompt needs.

    questions: article_id, questions (array), ord. articles: article_id, title, collection, markdown, ord; of equal
    ids the last counts. Question groups without an article are left out.
    """
    base = last_wins(articles.select("article_id", "title", "collection", "markdown", "ord"), "article_id").drop("ord")
    each = questions.select("article_id", F.col("ord").alias("group_ord"), F.posexplode("questions").alias("pos", "q"))
    out = each.join(base, "article_id").select(
        F.concat_ws("_q", "article_id", "pos").alias("qa_id"),
        "article_id",
        F.col("q.question").alias("question"),
        F.coalesce(F.col("q.type"), F.lit("unknown")).alias("question_type"),
        "title",
        "collection",
        "markdown",
        F.struct("group_ord", "pos").alias("ord"),
    )
    return out


def with_article(rows: DataFrame, articles: DataFrame, key: str = "article_id") -> DataFrame:
    """Left join on the article's id; rows without one get an empty title and collection."""
    base = last_wins(articles.select(F.col("article_id").alias(key), "title", "collection", "ord"), key).drop("ord")
    return rows.join(base, key, "left").withColumns({"title": F.coalesce("title", F.lit("")), "collection": F.coalesce("collection", F.lit(""))})


def not_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those done; ids are never null."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def answered(results: DataFrame, items: DataFrame) -> DataFrame:
    """Results without an error, with their work items; results of unknown ids are left out."""
    good = results.filter(F.coalesce("error", F.lit("")).isin("", "null", "false")).select(F.col("custom_id").alias("qa_id"), F.col("content"))
    return items.join(good, "qa_id")


def merge_resumed(done: DataFrame, new: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Rows done before come first, in their order, then the new ones."""
    mark = lambda d, turn: d.withColumn(ord_col, F.struct(F.lit(turn).alias("run"), F.col(ord_col).alias("at")))
    return mark(done, 0).unionByName(mark(new, 1))


def prompt_key(collection: str | Column, config: Config) -> Column:
    c = F.col(collection) if isinstance(collection, str) else collection
    return F.coalesce(text.lookup(c, config.collection_prompt_mapping), F.lit("default"))


def system_prompt(collection: str | Column, config: Config) -> Column:
    """Collection to key to text; an unknown collection and an unknown key both fall back to `default`."""
    return F.coalesce(text.lookup(prompt_key(collection, config), config.system_prompts), F.lit(config.system_prompts["default"]))
