"""Session settings and the shared folder for tables that must outlive an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASES: dict[str, str] = {}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; `conf` adds or replaces settings.

    Nothing here sizes the cluster: executors, memory and `spark.sql.shuffle.partitions` come
    from the submit command or from `conf`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder (`spark.checkpoint.dir`).

    Only a local session may fall back to a temporary folder of this machine; on a cluster the
    executors could not see it, so a missing setting is an error there.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL_BASES.setdefault(context.applicationId, "")
        if not base:
            base = _LOCAL_BASES[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/millrace/{context.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Remove everything this application made below `work_dir`. Call it when its results are read;
    the temporary folder of a local session also goes when the process ends."""
    folder = work_dir(spark, "").rsplit("/", 1)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def set_copies(spark: SparkSession, copies: int) -> None:
    """Job-wide default number of parallel instances for everything that shuffles."""
    spark.conf.set("spark.sql.shuffle.partitions", str(copies))
