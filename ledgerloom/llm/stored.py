"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name below `spark.checkpoint.dir`.

    Where the session names none, a single-machine application gets a folder of its own; no setting changes.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="ledgerloom-llm-")
        root = _LOCAL[context.applicationId]
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(table: DataFrame) -> DataFrame:
    """The table written once and read back, so that later steps neither repeat it nor depend on it."""
    spark, place = table.sparkSession, shared_folder(table.sparkSession)
    table.write.parquet(place)
    return spark.read.schema(table.schema).parquet(place)


def discard(table: DataFrame) -> None:
    """Delete a table that `stored` gave and that no later step reads."""
    jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("llm-"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once the driver collects garbage."""
    spark.sparkContext._jvm.System.gc()


def package_on_workers(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for sessions without it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _SENT.add(context.applicationId)


_SENT: set[str] = set()
_LOCAL: dict[str, str] = {}
