"""Questions and answers from a text model behind a provider; offline, a deterministic stub."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.config import Config, Finetuning, Service
from sievemill.functions import batches, json_text, text
from sievemill.operators import formatting, joins
from sievemill.sources import files

QUESTION_TEMPLATE = """Write four questions that a reader of this help page could ask. Each must be answerable from the page alone.
Mix question types, and ask at least once about a number, limit or exception that the page states.

Title: {title}
Collection: {collection}
Description: {description}

{content}

Return a JSON array only:
[
  {{"question": "...", "type": "factual|procedural|eligibility|edge_case|comparative|troubleshooting|consequence", "key_info_needed": "..."}}
]
"""
ANSWER_TEMPLATE = """Answer the question from this help page alone: first the answer itself, then what is needed to act on it.
Keep the page's numbers and terms. Do not mention the page.

Title: {title}
Collection: {collection}

{content}

Question: {question}

Return the answer only.
"""


class Provider(Protocol):
    """A text model. complete may raise; it is tried again."""

    def complete(self, prompt: str, temperature: float, max_tokens: int) -> str: ...


class StubProvider:
    """Answers that depend on the prompt alone: a question array if JSON is asked for, else its last words."""

    def complete(self, prompt: str, temperature: float, max_tokens: int) -> str:
        mark = hashlib.md5(prompt.encode()).hexdigest()[:6]
        if "JSON array" in prompt:
            kinds = ("factual", "procedural", "eligibility", "consequence")
            return json.dumps([{"question": f"What does {mark} say about point {i}?", "type": k, "key_info_needed": mark} for i, k in enumerate(kinds)])
        return f"It is covered by {mark}. " + " ".join(prompt.split()[-30:-4])


def complete(provider: Provider, prompt: str, temperature: float = 0.7, max_tokens: int = 1000, service: Service = Service(), sleep: Callable[[float], None] = time.sleep) -> str | None:
    """One completion, or null after the last try; the delay doubles from try to try."""
    for attempt in range(service.max_retries):
        try:
            return provider.complete(prompt, temperature, max_tokens)
        except Exception:
            if attempt < service.max_retries - 1:
                sleep(service.retry_delay_seconds * 2**attempt)
    return None


def completions(prompts: DataFrame, provider: Provider, temperature: float, max_tokens: int, service: Service = Service()) -> DataFrame:
    """Adds `response` to a table with `prompt`, with one provider a partition."""
    schema = prompts.schema.simpleString()[len("struct<") : -1]

    def run(p: pa.RecordBatch) -> pa.RecordBatch:
        got = [complete(provider, x, temperature, max_tokens, service) for x in p["prompt"].to_pylist()]
        return pa.RecordBatch.from_arrays([*p.columns, pa.array(got, pa.string())], names=[*p.schema.names, "response"])

    return prompts.mapInArrow(batches.sliced(run), f"{schema}, response string")


class BatchService(Protocol):
    """A service that works off files of requests."""

    def upload(self, lines_path: str) -> str: ...
    def submit(self, file_id: str, description: str) -> str: ...
    def status(self, batch_id: str) -> dict[str, Any]: ...
    def result_path(self, output_file_id: str) -> str: ...  # of result lines, which Spark reads


def wait_for_batch(service: BatchService, batch_id: str, settings: Service = Service(), clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> dict[str, Any]:
    """Polls to a final state: completed, failed, expired, cancelled, or timeout."""
    began = clock()
    while True:
        now = service.status(batch_id)
        if now["status"] == "completed":
            return {k: now.get(k) for k in ("status", "output_file_id", "request_counts")}
        if now["status"] in ("failed", "expired", "cancelled"):
            return {"status": now["status"], "error": now.get("errors")}
        if clock() - began > settings.max_wait_hours * 3600:
            return {"status": "timeout"}
        sleep(settings.batch_check_interval_seconds)


class StubBatchService:
    """A batch service in a folder: results are made when a batch is submitted."""

    def __init__(self, folder: str, provider: Provider | None = None):
        self.folder, self.provider = folder, provider or StubProvider()

    def upload(self, lines_path: str) -> str:
        return lines_path

    def submit(self, file_id: str, description: str) -> str:
        out = os.path.join(self.folder, "results.jsonl")
        parts = [os.path.join(file_id, f) for f in sorted(os.listdir(file_id)) if f.startswith("part-")] if os.path.isdir(file_id) else [file_id]
        with open(out, "w", encoding="utf-8") as w:
            for part in parts:
                with open(part, encoding="utf-8") as f:
                    for r in map(json.loads, filter(str.strip, f)):
                        b = r["body"]
                        content = self.provider.complete(b["messages"][0]["content"], b["temperature"], b["max_tokens"])
                        print(json.dumps({"custom_id": r["custom_id"], "error": None, "response": {"body": {"choices": [{"message": {"content": content}}]}}}), file=w)
        return out

    def status(self, batch_id: str) -> dict[str, Any]:
        with open(batch_id, encoding="utf-8") as f:
            n = sum(1 for _ in f)
        return {"status": "completed", "output_file_id": batch_id, "request_counts": {"total": n, "completed": n, "failed": 0}}

    def result_path(self, output_file_id: str) -> str:
        return output_file_id


def run_batch(requests: DataFrame, lines_path: str, service: BatchService, description: str = "batch", settings: Service = Service(), **clocks: Any) -> DataFrame:
    """Requests (value, ord) to results (custom_id, error, content, ord); none unless the batch completes."""
    spark = requests.sparkSession
    files.write_lines(requests, lines_path)
    state = wait_for_batch(service, service.submit(service.upload(lines_path), description), settings, **clocks)
    if state["status"] != "completed":
        return files.batch_results(spark.createDataFrame([], "value string, ord long"))
    return files.batch_results(files.read_lines(spark, service.result_path(state["output_file_id"])))


def question_prompt(config: Config = Config(), template: str = QUESTION_TEMPLATE) -> Column:
    """The prompt of an article with title, collection, description and markdown."""
    content = F.substring(F.col("markdown"), 1, config.generation.content_chars)
    return text.fill(template, title=F.col("title"), collection=F.col("collection"), description=F.coalesce("description", F.lit("")), content=content)


def answer_prompt(config: Config = Config(), template: str = ANSWER_TEMPLATE) -> Column:
    content = F.substring(F.col("markdown"), 1, config.generation.content_chars)
    return text.fill(template, title=F.col("title"), collection=F.col("collection"), content=content, question=F.col("question"))


def requests(rows: DataFrame, id_col: str, prompt: Column, config: Config, temperature: float, max_tokens: int) -> DataFrame:
    """(value, ord): request lines."""
    body = formatting.batch_request(F.col(id_col), prompt, config.service.model, F.lit(temperature), F.lit(max_tokens))
    return rows.select(F.to_json(body).alias("value"), "ord")


def questions_from(responses: DataFrame, batch: bool) -> DataFrame:
    """(article_id, ..., questions): batch mode drops articles without questions; the direct one drops empty responses only."""
    parsed = responses.filter(F.coalesce("response", F.lit("")) != "" if not batch else F.col("response").isNotNull()).withColumn("questions", json_text.questions_of("response"))
    return parsed.filter(F.size("questions") > 0) if batch else parsed


def generate_questions(articles: DataFrame, provider: Provider, config: Config = Config()) -> DataFrame:
    """Direct mode: article_id, title, collection, questions, ord."""
    g = config.generation
    asked = articles.select("article_id", "title", "collection", "ord", question_prompt(config).alias("prompt"))
    return questions_from(completions(asked, provider, g.temperature_questions, g.max_tokens_questions, config.service), batch=False).select("article_id", "title", "collection", "questions", "ord")


def generate_answers(items: DataFrame, provider: Provider, config: Config = Config()) -> DataFrame:
    """Direct mode: question/answer pairs of work items; empty responses are dropped, others stripped."""
    g = config.generation
    asked = items.withColumn("prompt", answer_prompt(config)).drop("markdown")
    got = completions(asked, provider, g.temperature_answers, g.max_tokens_answers, config.service).filter(F.coalesce("response", F.lit("")) != "")
    return qa_rows(got, text.strip("response"))


def qa_rows(items: DataFrame, answer: Column) -> DataFrame:
    return items.select("qa_id", "article_id", "question", "question_type", answer.alias("answer"), "collection", F.col("title").alias("article_title"), "ord")


def answers_from_batch(results: DataFrame, items: DataFrame) -> DataFrame:
    """Batch mode: pairs in the order of the work items; an empty answer stays."""
    return qa_rows(joins.answered(results, items), text.strip("content"))


def finetune_request(config: Finetuning, file_id: str) -> dict[str, Any]:
    """The job's parameters, without hyperparameters that are left to the service."""
    own = config.explicit_hyperparameters()
    return {"training_file": file_id, "model": config.base_model, "suffix": config.suffix} | ({"hyperparameters": own} if own else {})


def finetune_ready(training_path: str) -> bool:
    return os.path.exists(training_path)


class TuningService(Protocol):
    """A service that tunes a model on an uploaded file."""

    def upload(self, path: str) -> str: ...
    def file_status(self, file_id: str) -> str: ...
    def create(self, request: dict[str, Any]) -> str: ...
    def job_status(self, job_id: str) -> str: ...


class StubTuningService:
    """Takes any file and job, and is done at once."""

    def upload(self, path: str) -> str:
        return f"file-{hashlib.md5(path.encode()).hexdigest()[:8]}"

    def file_status(self, file_id: str) -> str:
        return "processed"

    def create(self, request: dict[str, Any]) -> str:
        return f"job-{request['training_file']}"

    def job_status(self, job_id: str) -> str:
        return "succeeded"


def wait_for_file(status: Callable[[], str], interval: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Polls an uploaded file; whether it was processed, and not refused."""
    while (now := status()) not in ("processed", "error"):
        sleep(interval)
    return now == "processed"


def wait_for_job(status: Callable[[], str], interval: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Polls a tuning job to succeeded, failed or cancelled."""
    while (now := status()) not in ("succeeded", "failed", "cancelled"):
        sleep(interval)
    return now
