"""Session helpers for tests, the bench and command-line runs.

Library code never creates a session: it takes the caller's.  The helper
below is for local runs only; on a cluster the submitter's configuration
(``spark.checkpoint.dir`` on shared storage, shuffle partitions sized to
the data) is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "aisle") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g")
               .config("spark.scheduler.mode", "FAIR"))  # concurrent query streams share slots
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Where it is unset, a session
    whose executors are threads of the driver (master ``local``) gets a
    folder of its own, or the one that AISLE_SCRATCH names; any other session
    has no folder that all its machines share, and that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="aisle-ckpt-", dir=os.environ.get("AISLE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root
