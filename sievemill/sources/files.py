"""Readers and writers of the pipeline's files. Every dataset read has `ord`, the place of a row in its file."""

from __future__ import annotations

import json
import os
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill import schemas


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array of objects; the array is split in the order of the file."""
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.posexplode(F.from_json("value", f"array<struct<{schema}>>")).alias("ord", "row"))
    return rows.select("row.*", F.col("ord").cast("long").alias("ord"))


def read_json_map(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """A file that holds one JSON object of objects: key, the value's fields, and the order of the file."""
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.posexplode(F.from_json("value", f"map<string, {value_schema}>")).alias("ord", "key", "row"))
    return rows.select("key", "row.*", F.col("ord").cast("long").alias("ord"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line, for datasets of any size: a file is read by many tasks, which an array is not."""
    return read_lines(spark, path).filter("trim(value) != ''").select(F.from_json("value", schema).alias("row"), "ord").select("row.*", "ord")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    return read_json_map(spark, path, schemas.QUESTIONS.split("map<string, ", 1)[1][:-1])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text, so that bad lines stay to be judged; ord is the place in the file."""
    return spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord"))


def batch_results(lines: DataFrame) -> DataFrame:
    """custom_id, error, content of a batch's result lines; empty lines are skipped, an error leaves no content."""
    v = lines.filter(F.col("value") != "").select(
        F.get_json_object("value", "$.custom_id").alias("custom_id"),
        F.get_json_object("value", "$.error").alias("error"),
        F.get_json_object("value", "$.response.body.choices[0].message.content").alias("content"),
        *(["ord"] if "ord" in lines.columns else []),
    )
    truthy = ~F.coalesce("error", F.lit("")).isin("", "null", "false", "0", "{}", "[]")
    return v.withColumns({"error": F.when(truthy, F.col("error")), "content": F.when(~truthy, F.col("content"))})


def sse_contents(text: DataFrame, column: str = "value") -> DataFrame:
    """What a client shows of event-stream text: contents of `data: ` lines in order, and `Error: ...` for errors. Lines
    that hold no JSON, and the incomplete last line, are ignored."""
    lines = text.select(F.posexplode(F.slice(F.split(column, "\n"), 1, F.greatest(F.size(F.split(column, "\n")) - 1, F.lit(0)))).alias("pos", "line")).filter(F.col("line").startswith("data: "))
    data = F.from_json(F.expr("substring(line, 7)"), "content string, error string")
    parsed = lines.select("pos", data.alias("d"))
    shown = F.when(F.coalesce("d.content", F.lit("")) != "", F.col("d.content"))
    failed = F.when(F.coalesce("d.error", F.lit("")) != "", F.concat(F.lit("Error: "), F.col("d.error")))
    return parsed.select("pos", F.concat_ws("", shown, failed).alias("shown")).filter("shown != ''")


def write_json(path: str, value: Any) -> None:
    """A report: pretty, parents made."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2)


def write_lines(lines: DataFrame, path: str, one_file: bool = False) -> None:
    """The values in order, one a line, in sorted part files. one_file=True has one task write them, for small outputs."""
    ordered = lines.orderBy("ord").select("value")
    (ordered.coalesce(1) if one_file else ordered).write.mode("overwrite").text(path)


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_checkpoint(path: str) -> dict[str, Any]:
    """A progress file, or an empty map if there is none."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def save_checkpoint(path: str, phase: str, now: datetime, **counters: Any) -> None:
    write_json(path, {"phase": phase, "last_updated": now.isoformat(), **counters})


def resumable(checkpoint: dict[str, Any], phase: str) -> bool:
    """Only a run that was interrupted in this phase goes on; a completed one starts anew."""
    return checkpoint.get("phase") == phase


def read_template(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
