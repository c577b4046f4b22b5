"""Where intermediate tables go."""

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """A new folder below the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; a temporary folder of this machine is used then, and deleted when
    the process ends.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):  # not a local cluster of several processes
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loanlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    return f"{root.rstrip('/')}/loanlake-{uuid.uuid4().hex}"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended, which it does once the driver has collected its garbage.

    Left to itself, a driver with little to collect keeps them for half an hour. Spark's listeners hold the last event, and
    with it the query that has ended, until there is another: hence the short job.
    """
    gc.collect()
    spark.range(1).collect()
    spark._jvm.System.gc()


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
