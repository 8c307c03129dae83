"""Session-level helpers: reading tables, and cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where this driver's intermediate tables lie, below the shared folder.
_RUN = f"sparvane-{uuid.uuid4().hex[:12]}"
#: Applications whose folder is deleted when the driver ends.
_TO_CLEAR: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test or production table; every reader below goes through here."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the session's ``spark.checkpoint.dir``; only where that is unset and all runs in one process,
    as in tests, a local folder is made and recorded in the session, so later calls agree. On a cluster
    that would be another disk for every executor, so there it is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("sparvane.scratch.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="sparvane-")
        spark.conf.set("sparvane.scratch.dir", at)
    if spark.sparkContext.applicationId not in _TO_CLEAR:
        _TO_CLEAR.add(spark.sparkContext.applicationId)
        atexit.register(_clear_at_exit, spark)
    return f"{at.rstrip('/')}/{_RUN}"


def _clear_at_exit(spark: SparkSession) -> None:
    """What this driver has written for itself goes with it, if the session is still there."""
    try:
        clear_scratch(spark)
    except Exception:
        pass  # the session was stopped before; its folder stays for the caller to delete


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a reader of it.

    It cuts lineage so that a lost executor costs only the tasks that read the files, computes
    what several branches use once, and gives the planner a file size: joins against the result
    are broadcast only if that size is under the session's threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` has written, once nothing reads it any more."""
    jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for at in {name.rpartition("/")[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(at))
        path.getFileSystem(conf).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of queries that have ended deleted now; else they stay until the driver happens to collect its garbage."""
    spark.sparkContext._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> None:
    """Delete this driver's intermediate tables; results that still read them end with them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
