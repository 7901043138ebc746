"""The three batch plans: pages to articles, articles to pairs, pairs to a validated training set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.config import Config
from sievemill.operators import aggregate, dedup, formatting, generate, joins, sampling, validate


@dataclass
class Validated:
    pairs: DataFrame  # that stay
    report: dict[str, Any]


def articles_to_pairs(articles: DataFrame, provider: generate.Provider, config: Config = Config(), limit_articles: int | None = None, limit_pairs: int | None = None, done: DataFrame | None = None) -> DataFrame:
    """Questions and answers in direct mode. Limits come before rows that are done are left out, which come first."""
    flat = articles.select("article_id", "title", "collection", "description", F.col("content.markdown").alias("markdown"), "ord")
    questions = generate.generate_questions(sampling.head(flat, limit_articles), provider, config)
    items = sampling.head(joins.work_items(questions, flat), limit_pairs)
    if done is None:
        return generate.generate_answers(items, provider, config)
    new = generate.generate_answers(joins.not_done(items, done, "qa_id"), provider, config)
    return joins.merge_resumed(done, new)


def grounding(pairs: DataFrame, articles: DataFrame, rate: float, seed: str = "1") -> DataFrame:
    """The sample with `issues`: null for a row without an article."""
    sample = sampling.fixed_sample(pairs.select("qa_id", "article_id", "answer", "ord"), rate, seed=seed)
    texts = dedup.last_wins(articles.select("article_id", "plain_text", "ord"), "article_id").drop("ord")
    return sample.join(texts, "article_id", "left").withColumn("issues", F.when(F.col("plain_text").isNotNull(), validate.grounding_issues("answer", "plain_text"))).drop("plain_text")


def validated_pairs(pairs: DataFrame, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Rows that stay after dedup and the length check, and the dedup's counts. All rows of an id that fails go."""
    kept, stats = dedup.deduplicate(pairs, config.validation.similarity_threshold)
    failed = pairs.filter(validate.length_error(config.validation).isNotNull()).select("qa_id").distinct()
    return kept.join(failed, "qa_id", "left_anti"), stats


def metadata(pairs: DataFrame, output_file: str, now: datetime) -> dict[str, Any]:
    """The dataset's description, before validation."""
    filled = pairs.withColumns({"collection": F.coalesce("collection", F.lit("")), "question_type": F.coalesce("question_type", F.lit("unknown"))})
    avg = aggregate.averages(filled).first()
    by_name = aggregate.by_count(aggregate.counts(filled, F.col("collection"))).collect()  # one row a collection
    types = aggregate.counts(filled, F.col("question_type")).orderBy("first_ord").collect()  # one row a type
    return {
        "generated_at": now.isoformat(),
        "total_examples": avg["total_examples"],
        "source_articles": avg["source_articles"],
        "avg_questions_per_article": avg["avg_questions_per_article"],
        "collections_covered": [{"name": r["name"], "examples": r["examples"]} for r in by_name],
        "question_type_distribution": {r["name"]: r["examples"] for r in types},
        "avg_answer_length_chars": round(avg["avg_answer_length"], 1),
        "output_file": output_file,
        "validation_passed": None,
    }


def validate_set(pairs: DataFrame, articles: DataFrame, lines: DataFrame, now: datetime, config: Config = Config(), seed: str = "1") -> Validated:
    """The quality stage. lines: the formatted examples (value). Line and grounding checks are reported; only copies
    and lengths remove rows."""
    line_counts = validate.pass_counts(validate.line_errors(lines), F.col("error")).first()
    length_counts = validate.pass_counts(pairs, validate.length_error(config.validation)).first()
    checked = grounding(pairs, articles, config.validation.semantic_sample_rate, seed).persist()
    size = F.size("issues")
    counted = checked.agg(F.count("*").alias("n"), F.count_if(size == 0).alias("passed"), F.count_if(size > 0).alias("failed")).first()
    issues = [{"qa_id": r["qa_id"], "issues": list(r["issues"])} for r in checked.filter(size > 0).orderBy(sampling.sample_order("qa_id", seed), "ord").select("qa_id", "issues").limit(10).collect()]
    checked.unpersist()
    kept, stats = validated_pairs(pairs, config)
    s = stats.first()
    total = counted["passed"] + counted["failed"]
    rate = counted["passed"] / total if total else 1.0
    both = {"passed": line_counts["passed"], "failed": line_counts["failed"]}
    report = {
        "validation_timestamp": now.isoformat(),
        "total_examples_generated": s["original_count"],
        "examples_after_validation": kept.count(),
        "removal_reasons": {"duplicate_exact": s["exact_duplicates_removed"], "duplicate_near": s["near_duplicates_removed"], "content_length_invalid": length_counts["failed"]},
        "automated_checks": {"json_validity": both, "schema_compliance": dict(both), "content_length": {"passed": length_counts["passed"], "failed": length_counts["failed"]}},
        "semantic_checks_sample": {"sample_size": counted["n"], "grounding_pass_rate": round(rate, 3), "grounding_issues": issues},
        "recommendations": aggregate.recommendations(rate, s["exact_duplicates_removed"], s["near_duplicates_removed"]),
        "validation_passed": rate >= 0.95,
    }
    return Validated(kept, report)


def training_set(pairs: DataFrame, config: Config = Config()) -> DataFrame:
    """Pairs that stay, as message structs: qa_id, messages, ord."""
    kept, _ = validated_pairs(pairs, config)
    return kept.select("qa_id", formatting.messages(config).alias("messages"), "ord")
