"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own, which goes when the process ends:
    executors on other machines could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="rowmill-")
        atexit.register(shutil.rmtree, _local_scratch[context.applicationId], ignore_errors=True)
    return _local_scratch[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not when the driver next happens to collect garbage.

    Spark's cleaner removes them once the plans that made them are collected. That takes two collections with time between
    them: the first one frees what holds the plans. Useful after a step is materialized.
    """
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and continue from the file.

    Later fits read only the columns they need, and a lost executor costs a re-read instead of a
    re-run of everything upstream. Without ``compression`` the session's codec holds.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
