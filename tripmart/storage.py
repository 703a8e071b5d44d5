"""The folder for checkpoints."""

from __future__ import annotations

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> None:
    """Use ``folder``, else the one the session names, else one under its shared warehouse.

    A folder named later replaces one that was set before; the same folder stays,
    with what it holds. Spark makes a folder of its own below the one set here.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if current is not None:
            return
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.checkpoints"
    parent = context._jvm.org.apache.hadoop.fs.Path(named)
    parent = parent.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(parent)
    set_to = None if current is None else context._jvm.org.apache.hadoop.fs.Path(current)
    if set_to is None or set_to.getParent().toString() != parent.toString():
        context.setCheckpointDir(named)
