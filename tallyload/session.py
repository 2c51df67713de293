"""Session settings and the shared scratch area.

Staged files, ledgers and targets written by the example plans live below the
folder named by ``spark.checkpoint.dir`` (a shared file system on a cluster).
A private folder is chosen only when the session names none, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # files of reliable checkpoints go once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tallyload") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLYLOAD_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, choosing one only when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tallyload-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyload/{purpose}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    # a local folder in the plain form, as announced paths are written
    return re.sub("^file:/+", "/", path)
