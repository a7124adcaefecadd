"""Session helpers: the shared scratch folder and one-off materialisation."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local-mode session may lack the setting (tests, a laptop); it then gets a folder of its own, once. A
    cluster without the setting is refused, because a machine-local folder would not be seen by other executors.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkmart-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


# folders of the runs in progress, the innermost last
_scopes: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, inside the folder of the run in progress if there is one."""
    folder = _scopes[-1] if _scopes else f"{shared_dir(spark)}/checkmart"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A run whose stored intermediate results are deleted at its end; nothing may read them afterwards."""
    folder = scratch_path(spark, "run")
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` computed once into the shared folder and read back.

    Cuts lineage, survives the loss of executors, and lets several consumers prune columns of one result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
