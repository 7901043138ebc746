"""Session settings that the operators read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sievemill.session import ship, with_checkpoint_dir

#: Bytes of an Arrow batch: what a worker holds at once of a partition of any size.
BATCH_BYTES = "4m"
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def tidy(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of tables that nothing refers to any more. It does so when the driver's JVM
    collects garbage, which may be long after, while the disks of executors fill."""
    spark.sparkContext._jvm.System.gc()


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """Takes the shared folder of spark.checkpoint.dir; only where none is set (local runs), one of this machine.
    Also bounds the bytes of Arrow batches, unless the application or the session sets them."""
    ship(spark)
    if spark.conf.getAll.get(_SETTING) is None:  # not chosen by the user, for the application or for the session
        spark.conf.set(_SETTING, BATCH_BYTES)
    return with_checkpoint_dir(spark)
