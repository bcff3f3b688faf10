"""Session settings that depend on the size of the input."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

GIB = 1024**3


def shuffle_partitions(input_bytes: int, cores: int, bytes_per_task: int = 2 * GIB) -> int:
    """Reduce tasks for an input: about ``bytes_per_task`` each, one per core at least.

    The clean table is the only large shuffle and carries about as much as the
    input, so 100 TB make some 47,000 tasks. Many more would cost the driver
    more for the sizes of all blocks (maps times reducers) than the tasks gain;
    aggregations larger than their memory spill. Adaptive execution merges the
    tasks that turn out small.
    """
    return max(math.ceil(input_bytes / bytes_per_task), cores)


def size_session(spark: SparkSession, input_bytes: int) -> None:
    """Set what the input size decides: shuffle partitions and scan splits."""
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
    # A hundred thousand scan tasks are enough; more only load the driver.
    split = min(max(128 * 1024**2, math.ceil(input_bytes / 100_000)), GIB)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def working_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it.

    Where none is named, a local session gets a temporary one; on a cluster that
    is an error, as the executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidyledger-")
