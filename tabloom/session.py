"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tabloom", **conf: str) -> SparkSession:
    """A session with the library's settings. A master is set only when the caller names one, so that a submitted job keeps its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master is not None and master.startswith("local"):
        settings["spark.sql.shuffle.partitions"] = "8"
        settings["spark.driver.memory"] = "8g"
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A local session without that setting gets one temporary folder, kept in the
    session under the same key. A cluster session without it is refused: a folder
    that only one machine sees would lose data with the executor.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    own = spark.conf.get("tabloom.work.dir", None)
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("tabloom.work.dir", own)
    return own


#: Folders that this process has named, so that ``clean_up`` can remove them.
_NAMED: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _NAMED.append(path)
    return path


def clean_up(spark: SparkSession, keep: int = 0) -> int:
    """Remove the intermediate tables named so far, but for the last ``keep``; results that still read them must be
    written before. Returns how many there were."""
    gone = _NAMED[: len(_NAMED) - keep]
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _NAMED[: len(gone)]
    return len(gone)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the intermediate tables named inside the block when it ends, but for the paths put into the list that it gives."""
    start, kept = len(_NAMED), []
    try:
        yield kept
    finally:
        own = _NAMED[start:]
        for path in own:
            if path not in kept:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _NAMED[start:] = kept


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut the lineage by writing the rows to the shared folder as parquet.

    A lost executor costs a re-read, never a recomputation, and later readers still
    prune columns.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
