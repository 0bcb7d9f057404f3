"""Tables in the folder that driver and executors share: they cut lineage and outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset on a local master."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='tielens-')}"
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tielens-{tag}-{uuid.uuid4().hex}"


def landed(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes the files of a ``landed`` table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._landed_at)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
