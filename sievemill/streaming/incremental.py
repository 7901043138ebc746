"""Stages over files that arrive, and work items in batches: what is done is remembered on disk."""

from __future__ import annotations

import glob
import math
import os
import shutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Batches of a run, at most: with more items, batches grow.
MOST_BATCHES = 1000


def run_available(spark: SparkSession, source: str, schema: str | StructType, target: str, checkpoint: str, stage: Callable[[DataFrame], DataFrame], files_a_batch: int = 1000, after: Callable[[int], None] | None = None) -> int:
    """Applies a stage to the Parquet files that came since the last run and appends its rows. Returns the batches run.

    after: called with the number of each batch once its rows are written.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{target}/batch={number:08d}")  # a batch run twice replaces its rows
        done.append(number)
        if after:
            after(number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


class Progress:
    """Results of a phase, batch by batch, in a folder. Each run leaves its items, its stream's checkpoint and its results there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def clear(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)

    def rows(self) -> DataFrame | None:
        """Rows of all batches that were written whole, with the number of their `run`; null if there are none."""
        whole = sorted(glob.glob(f"{glob.escape(self.folder)}/run=*/results/batch=*/_SUCCESS"))
        if not whole:
            return None
        runs: dict[int, list[str]] = {}
        for path in map(os.path.dirname, whole):
            runs.setdefault(int(path[len(self.folder) :].split("run=")[1].split("/")[0]), []).append(path)
        out = None
        for run, paths in runs.items():
            part = self.spark.read.parquet(*paths).withColumn("run", F.lit(run))
            out = part if out is None else out.unionByName(part)
        return out

    def run(self, items: DataFrame, stage: Callable[[DataFrame], DataFrame], every: int | None, after: Callable[[int], None] | None = None) -> int:
        """Writes the items in order, `every` to a file (more if there are very many; all in one batch if it is null), and works the files off."""
        number = 1 + max([0, *(int(p.rsplit("=", 1)[1]) for p in glob.glob(f"{glob.escape(self.folder)}/run=*"))])
        base = f"{self.folder}/run={number}"
        ordered = items.orderBy("ord")
        if every:
            size = max(every, math.ceil(items.count() / MOST_BATCHES))
            ordered.write.option("maxRecordsPerFile", size).parquet(f"{base}/items")
        else:
            ordered.write.parquet(f"{base}/items")
        return run_available(self.spark, f"{base}/items", items.schema, f"{base}/results", f"{base}/checkpoint", stage, 1 if every else 1 << 30, after)
