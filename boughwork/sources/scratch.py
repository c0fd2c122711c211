"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session whose master is local may go without that setting; it then gets a
    temporary folder, which is also made the checkpoint folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        folder = current.get() if current.isDefined() else None
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends
    at files that survive the loss of any executor, and the work is done once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of settled tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
