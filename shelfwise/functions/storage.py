"""Cut lineage through the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="shelfwise-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder for a written table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Write a columnar table to the shared folder and scan it from there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``write_and_read`` or ``materialise`` made and nothing will read again."""
    for table in tables:
        path = getattr(table, "_written_to", None)
        if path is not None:
            jvm = table.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            conf = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
            folder.getFileSystem(conf).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later stages survive a lost executor.

    A written table cuts the plan completely. A checkpoint keeps the constraints the optimizer
    derived for the old plan, and in a loop of joins these double every round.
    """
    return write_and_read(df, "step")


def materialise_alone(df: DataFrame) -> DataFrame:
    """The same; shuffle files of the step are deleted once it is written.

    Without the setting Spark deletes them when the driver's garbage is collected, maybe long after.
    """
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return materialise(df)
    finally:
        spark.conf.set(name, before)
