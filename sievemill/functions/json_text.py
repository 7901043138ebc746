"""JSON as Python's json module reads and writes it; Arrow-batched, for what Spark's own parser judges differently."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROLES = ("system", "user", "assistant")


def example_error(line: str | None) -> str | None:
    """Why a line is no training example: syntax, messages, count, then role and content of each; null if it is one."""
    try:
        data = json.loads(line if line is not None else "")
    except ValueError as e:
        return f"Invalid JSON: {e}"
    messages = data.get("messages") if isinstance(data, dict) else None
    if not isinstance(data, dict) or "messages" not in data:
        return "Missing 'messages' field"
    if not isinstance(messages, list) or len(messages) != len(_ROLES):
        return "Messages should be a list of 3 items (system, user, assistant)"
    for i, (message, role) in enumerate(zip(messages, _ROLES, strict=True)):
        message = message if isinstance(message, dict) else {}
        if message.get("role") != role:
            return f"Message {i} should have role '{role}', got '{message.get('role')}'"
        if not message.get("content"):
            return f"Message {i} has empty content"
    return None


def parse_questions(response: str | None) -> list[dict[str, str | None]]:
    """Question objects of a model's answer: of its first code fence, between the outer brackets, else of the whole text."""
    text = (response or "").strip()
    fence = "```json" if "```json" in text else "```"
    if m := re.search(re.escape(fence) + r"\s*(.*?)\s*```", text, re.DOTALL):
        text = m[1]
    low, high = text.find("["), text.rfind("]")
    for part in ([text[low : high + 1]] if low >= 0 and high >= 0 else []) + [text]:
        try:
            got = json.loads(part)
        except ValueError:
            continue
        if not isinstance(got, list):
            return []
        return [{k: _text(q.get(k)) for k in ("question", "type", "key_info_needed")} for q in got if isinstance(q, dict) and q.get("question") is not None]
    return []


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


@F.pandas_udf(T.StringType())
def example_error_of(line: pd.Series) -> pd.Series:
    return line.map(example_error)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("question", "type", "key_info_needed")])))
def questions_of(response: pd.Series) -> pd.Series:
    return response.map(parse_questions)


@F.pandas_udf(T.StringType())
def _spaced(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else json.dumps(json.loads(s)))


def dumps(struct: Column) -> Column:
    """JSON with a space after separators and non-ASCII escaped. Fields that are null are left out, as to_json does."""
    return _spaced(F.to_json(struct))
