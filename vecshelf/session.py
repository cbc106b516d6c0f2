"""Session helpers: a session for tests and benches, and durable intermediate results."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "vecshelf", **conf) -> SparkSession:
    """A local session for tests and benches. On a cluster the caller brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which `spark.checkpoint.dir` names.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="vecshelf-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def durable(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read on from there; `by` names a column to lay it out by.

    Used where several jobs read a result, or must see the same rows. A written table survives the
    loss of executors, cuts the lineage, and later jobs read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vecshelf-{uuid.uuid4().hex}"
    for folders in _owners:
        folders.append(path)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_owners: list[list[str]] = []


@contextlib.contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Delete what `durable` writes within this block when it ends.

    Put the whole run in it, the writing of its results included: frames made inside cannot be read
    after it.
    """
    folders: list[str] = []
    _owners.append(folders)
    try:
        yield
    finally:
        _owners[:] = [held for held in _owners if held is not folders]
        jvm = spark.sparkContext._jvm
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame) -> DataFrame:
    """Share out the rows of a small scan over all cores before heavy work on each row.

    A scan with as many splits as cores, as any large one has, is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if _splits(scan) < cores else scan


def _splits(scan: DataFrame) -> int:
    return scan.rdd.getNumPartitions()
