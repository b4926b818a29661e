"""Where intermediate tables and files go: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.  Where that is unset a folder is chosen here, on a single machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = f"file://{tempfile.gettempdir()}/terrapanel-shared"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, compression: str = "snappy", row_group: int | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: the lineage ends there.  ``row_group`` is the most rows of
    a row group, for rows that are large."""
    path = shared_dir(df.sparkSession, name)
    out = df.write if row_group is None else df.write.option("parquet.block.row.count.limit", row_group)
    out.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what :func:`table` wrote, once nothing that is still to run reads it; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "shared_path", None)
        if path:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to as many tasks as the session shuffles to, before work that is much for each row: a small file is one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def partitions(spark: SparkSession, total: int, each: int) -> int:
    """Partitions for ``total`` units of work with ``each`` per task, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each))
