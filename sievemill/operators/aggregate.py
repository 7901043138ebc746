"""Counts, averages, rates and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame, key: Column, name: str = "name", ord_col: str = "ord") -> DataFrame:
    """Rows of each key with the order of its first one: name, examples, first_ord."""
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("examples"), F.min(ord_col).alias("first_ord"))


def by_count(counted: DataFrame) -> DataFrame:
    """Largest first; equal counts in the order in which they were first seen."""
    return counted.orderBy(F.desc("examples"), "first_ord")


def averages(df: DataFrame, answer: str = "answer", article: str = "article_id") -> DataFrame:
    """One row: examples, articles, examples an article and mean answer length; 0 where there is nothing to divide by."""
    n, articles = F.count("*"), F.count_distinct(article)
    return df.agg(
        n.alias("total_examples"),
        articles.alias("source_articles"),
        F.when(articles > 0, n / articles).otherwise(0.0).alias("avg_questions_per_article"),
        F.when(n > 0, F.sum(F.length(F.coalesce(answer, F.lit("")))) / n).otherwise(0.0).alias("avg_answer_length"),
    )


def pass_rate(passed: Column, failed: Column) -> Column:
    """1 where nothing was checked."""
    return F.when(passed + failed > 0, passed / (passed + failed)).otherwise(1.0)


def request_counts(results: DataFrame) -> DataFrame:
    bad = F.coalesce("error", F.lit("")) != ""
    return results.agg(F.count("*").alias("total"), F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failed"))


def fold_fragments(fragments: DataFrame, key: str = "session_id", seq: str = "seq", content: str = "content") -> DataFrame:
    """Concatenates each key's fragments in order; null contents count as nothing."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(seq), F.col(content))))
    return fragments.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p[content]), "").alias("response"))


def recommendations(rate: float, exact: int, near: int) -> list[str]:
    """The report's advice; the rate is compared as it is, not rounded."""
    out = []
    if rate < 0.95:
        out.append(f"Grounding pass rate is {rate:.1%}. Review flagged examples.")
    if exact + near > 10:
        out.append("High duplicate count. Consider reviewing question generation prompts.")
    return out or ["All checks passed. Dataset is ready for fine-tuning."]
