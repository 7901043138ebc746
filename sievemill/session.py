"""Ships this package to the executors of a session."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package to the Python path of the executors' workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="sievemill-"), "sievemill.zip")  # the driver serves it to the executors
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("sievemill", os.path.relpath(full, root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def with_checkpoint_dir(spark: SparkSession) -> SparkSession:
    """Takes the shared folder of spark.checkpoint.dir; only where none is set (local runs), one of this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if where is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            where = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(where)
    return spark


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this name in the shared checkpoint folder."""
    return f"{with_checkpoint_dir(spark).sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The table, worked out once and kept in the shared checkpoint folder: for tables that are read several times."""
    with_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
