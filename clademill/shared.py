"""Tables in the folder that driver and executors share.

Cutting lineage with a written table survives lost executors: every later read comes from
shared storage, never from one executor's disk.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        path = tempfile.mkdtemp(prefix="clademill-")
        atexit.register(shutil.rmtree, path, True)
        _own[sc.applicationId] = path
    return _own[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write df once as the table name of the session's catalog, dealt to buckets by keys and sorted by them, and read it back.

    Joins and aggregates by keys (or more columns) then move no row of it, in this session or a later one. path: a new folder in the shared one by default.
    """
    spark = df.sparkSession
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path or fresh_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def drop_saved(df: DataFrame) -> None:
    """Delete the files behind a frame that saved() returned, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)
