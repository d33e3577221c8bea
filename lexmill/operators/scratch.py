"""Intermediate results in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_SETTINGS = {
    # What a plan has shuffled goes as soon as it has run, not when the driver happens to collect its garbage.
    "drop_shuffles": "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
    # What opening a file counts as, in bytes that could be read meanwhile.
    "open_cost": "spark.sql.files.openCostInBytes",
    # Rows that reach Python together.
    "batch": "spark.sql.execution.arrow.maxRecordsPerBatch",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only a session on one machine (tests, local runs) may leave it unset and gets a
    folder of its own; on a cluster that is an error, since executors would write to
    their own disks and later reads would miss rows.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet; ``drop_scratch`` removes it."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialized(df: DataFrame) -> DataFrame:
    """Write the rows once as a Parquet table in the shared folder and read them back.

    Later passes then read only the columns they need instead of repeating the
    work, and a lost executor costs no recomputation.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Plans that run in the meantime have these settings, named as below ``_SETTINGS``; then the former ones hold again."""
    names = {_SETTINGS[k]: v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_folders() -> int:
    """How many folders this process has in the shared folder."""
    return len(_written)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Remove what this process has put in the shared folder; returns the number of folders.

    The first ``since`` folders and the last ``keep`` stay.  Call it when no result that
    was built on the others is needed any more.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for name in _written[since:len(_written) - keep]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        removed += bool(path.getFileSystem(conf).delete(path, True))
        _written.remove(name)
    return removed
