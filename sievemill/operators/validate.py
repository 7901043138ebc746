"""Row checks: lengths, question format, grounding, training-line structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.config import Validation
from sievemill.functions import json_text, text

#: Phrases that mark an answer as not taken from its article, in the order of the report.
MARKERS = [
    "I don't have information",
    "I cannot find",
    "not mentioned in",
    "According to the article",
    "based on the document",
    "the article states",
    "as mentioned in the article",
]
#: Openings of a question.
OPENERS = ["how", "what", "when", "where", "why", "who", "can", "do", "does", "is", "are", "will", "should"]
#: Numbers that need no source.
SMALL_COUNTS = ["1", "2", "3", "4", "5"]


def length_error(limits: Validation = Validation(), question: str = "question", answer: str = "answer") -> Column:
    """The first length rule that a pair breaks, or null; lengths in code points, of the texts as they are."""
    q, a = F.length(question), F.length(answer)
    said = lambda what, n, sign, bound: F.concat(F.lit(f"{what}: "), n.cast("string"), F.lit(f" {sign} {bound}"))
    return (
        F.when(q < limits.min_question_chars, said("Question too short", q, "<", limits.min_question_chars))
        .when(q > limits.max_question_chars, said("Question too long", q, ">", limits.max_question_chars))
        .when(a < limits.min_answer_chars, said("Answer too short", a, "<", limits.min_answer_chars))
        .when(a > limits.max_answer_chars, said("Answer too long", a, ">", limits.max_answer_chars))
    )


def grounding_issues(answer: str | Column, article: str | Column) -> Column:
    """Numbers of the answer that the article lacks (sorted), then the marker phrases that it holds."""
    answer = F.col(answer) if isinstance(answer, str) else answer
    missing = F.array_except(F.array_except(text.numbers(answer), text.numbers(article)), F.array(*map(F.lit, SMALL_COUNTS)))
    lower = F.lower(answer)
    marks = F.filter(F.array(*(F.when(lower.contains(m.lower()), F.lit(f"marker: {m}")) for m in MARKERS)), lambda x: x.isNotNull())
    return F.concat(F.array_sort(missing), marks)


def question_error(question: str | Column) -> Column:
    """Empty, or long without a question mark or a known opening; null if well-formed."""
    q = text.strip(question)
    opens = F.lit(False)
    for w in OPENERS:
        opens = opens | F.lower(q).startswith(w)
    return F.when(q == "", "Empty question").when(~q.endswith("?") & ~opens & (F.length(q) > 30), "Long question should end with '?'")


def message_error(messages: str | Column) -> Column:
    """Count, roles and content of an array of (role, content) structs, in the order of the strict check of lines."""
    m = F.col(messages) if isinstance(messages, str) else messages
    out = F.when(m.isNull(), "Missing 'messages' field").when(F.size(m) != 3, "Messages should be a list of 3 items (system, user, assistant)")
    for i, role in enumerate(("system", "user", "assistant")):
        at = F.try_element_at(m, F.lit(i + 1))
        got = F.coalesce(at["role"], F.lit("None"))
        out = out.when(got != role, F.concat(F.lit(f"Message {i} should have role '{role}', got '"), got, F.lit("'")))
        out = out.when(F.coalesce(at["content"], F.lit("")) == "", f"Message {i} has empty content")
    return out


def line_errors(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Adds `error` to JSON lines: the strict check, syntax included."""
    return lines.withColumn("error", json_text.example_error_of(line_col))


def pass_counts(df: DataFrame, error: Column, passed: str = "passed", failed: str = "failed") -> DataFrame:
    """One row: rows without and with an error."""
    return df.agg(F.count_if(error.isNull()).alias(passed), F.count_if(error.isNotNull()).alias(failed))
