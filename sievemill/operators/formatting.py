"""Training examples and batch requests as structs and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.config import Config
from sievemill.functions import json_text
from sievemill.operators.joins import system_prompt


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(config: Config, collection: str = "collection", question: str = "question", answer: str = "answer") -> Column:
    """System prompt of the collection, question, answer."""
    return F.array(message("system", system_prompt(F.coalesce(collection, F.lit("")), config)), message("user", F.col(question)), message("assistant", F.col(answer)))


def example_lines(pairs: DataFrame, config: Config, python_style: bool = True) -> DataFrame:
    """(value, ord): one JSON object a line. python_style: spaces after separators, non-ASCII escaped."""
    body = F.struct(messages(config).alias("messages"))
    return pairs.select((json_text.dumps(body) if python_style else F.to_json(body)).alias("value"), "ord")


def batch_request(custom_id: Column, prompt: Column, model: str, temperature: Column | None = None, max_tokens: Column | None = None) -> Column:
    """The request struct; temperature 0.7 and 1000 tokens unless given."""
    return F.struct(
        custom_id.alias("custom_id"),
        F.lit("POST").alias("method"),
        F.lit("/v1/chat/completions").alias("url"),
        F.struct(
            F.lit(model).alias("model"),
            F.array(message("user", prompt)).alias("messages"),
            F.coalesce(temperature if temperature is not None else F.lit(None).cast("double"), F.lit(0.7)).cast("double").alias("temperature"),
            F.coalesce(max_tokens if max_tokens is not None else F.lit(None).cast("int"), F.lit(1000)).cast("int").alias("max_tokens"),
        ).alias("body"),
    )
