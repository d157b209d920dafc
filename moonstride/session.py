"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# what one task of a shuffle should read; adaptive execution merges smaller ones
SHUFFLE_BYTES_PER_TASK = 128 * 1024 * 1024


def shuffle_tasks(data_bytes: int) -> int:
    """Initial number of shuffle partitions for this much data."""
    return max(-(-data_bytes // SHUFFLE_BYTES_PER_TASK), 200)


def build_session(
    app: str = "moonstride", master: str | None = None, data_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the library expects; ``conf`` overrides them.

    ``data_bytes`` is the size of the largest table, from which the number of shuffle
    partitions follows. Dots in keyword names are written as ``__``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if data_bytes is None else {"spark.sql.shuffle.partitions": str(shuffle_tasks(data_bytes))}
    settings = DEFAULTS | sized | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="moonstride-", dir="/tmp")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a fresh folder in /tmp.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/moonstride/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the scan of it.

    This cuts the lineage (a lost executor re-reads files, it does not recompute) and
    gives the next plan real file sizes, so Catalyst broadcasts a small result under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a large one.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(staged: DataFrame) -> None:
    """Delete what ``stage`` wrote for ``staged``; later reads of it fail."""
    spark = staged.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
