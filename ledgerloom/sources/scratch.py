"""Where jobs may keep intermediate files."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one the cluster names.

    Only a single-machine session may fall back to a local temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{shared.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
