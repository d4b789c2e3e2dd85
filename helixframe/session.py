"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Folders of the tables materialized so far, a list for each ``scratch`` within another.
_made: list[list[str]] = [[]]


def get_session(app: str = "helixframe", cores: str = "*") -> SparkSession:
    """A local session with the settings the test-suite and bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("HELIX_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HELIX_DRIVER_MEM", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` as the cluster names it.

    Only where it is unset on a local master a temporary folder is made and
    set, so that ``checkpoint()`` and written tables use the same place; a
    cluster must name one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if named is None and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    target = named or tempfile.mkdtemp(prefix="helixframe-")
    sc.setCheckpointDir(target)
    return target


def materialize(df: DataFrame, name: str = "t", lasting: bool = False) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet in the shared folder and rereading it.

    A ``lasting`` table outlives the innermost ``scratch``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made[-2 if lasting and len(_made) > 1 else -1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables materialized within; only for work whose results are written by then."""
    _made.append([])
    try:
        yield
    finally:
        release(spark, _made.pop())


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes materialized tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Rows a shuffle's task is meant to hold, and the bytes up to which small ones are joined to one.
TASK_ROWS, TASK_BYTES = 1 << 19, "8m"


@contextmanager
def wide(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, shuffles have a task for every ``TASK_ROWS`` of ``rows``, so that a task's share doesn't grow with the table.

    It holds for tables written within, not for those read later: use it with ``materialize``.
    """
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    if rows > TASK_ROWS * int(before[0]):
        spark.conf.set(names[0], str(-(-rows // TASK_ROWS)))
    spark.conf.set(names[1], TASK_BYTES)
    try:
        yield
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
