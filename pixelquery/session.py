"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a single-process session that names no folder (a laptop) gets a local one; a cluster must
    name one, ``local-cluster`` included.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="pixelquery-")
        root = _local_root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/pixelquery/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Iterative operators call this once per round.  The table outlives lost executors, and reading it
    back gives the optimizer true sizes for choosing the next join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` returned.

    Only for tables of which nothing is read any more: what was made from them must be stored itself.
    """
    for table in tables:
        spark = table.sparkSession
        jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if not re.search(r"/pixelquery/[^/]+-[0-9a-f]{32}$", folder):
                raise ValueError(f"not an intermediate table: {folder}")
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(settings).delete(path, True)
