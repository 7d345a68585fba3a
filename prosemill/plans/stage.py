"""Stage tables: a result that several later steps read is written once, in the folder the cluster shares."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


#: Folders of local sessions that name none, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.  Where it is unset: with a local master a temporary folder of the application;
    with any other master an error, as a folder of the driver's machine would lose what executors write to theirs."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        application = spark.sparkContext.applicationId
        if application not in _OWN:
            _OWN[application] = "file://" + tempfile.mkdtemp(prefix="prosemill-")
        folder = _OWN[application]
    return folder.rstrip("/")


def stage_root(spark: SparkSession) -> str:
    """The folder of this application's stage tables."""
    return f"{shared_dir(spark)}/prosemill/{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):  # noqa: ANN201
    """(file system, path) of the JVM."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def staged(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """df, written once as Parquet and read back: a cut in the lineage that survives lost executors."""
    path = f"{stage_root(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Deletes what staged() wrote, once nothing reads it any more."""
    files, path = hadoop_path(df.sparkSession, df._stored_path)
    files.delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Deletes all stage tables of this application; call it when no result that reads them is needed any more."""
    files, path = hadoop_path(spark, stage_root(spark))
    files.delete(path, True)


def signature(inputs: DataFrame, *parts: object) -> str:
    """Of the files that `inputs` reads, by path, length and time of change, and of anything else that settles a result."""
    spark = inputs.sparkSession
    seen = []
    for name in sorted(inputs.inputFiles()):
        files, path = hadoop_path(spark, name)
        status = files.getFileStatus(path)
        seen.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps([seen, *map(repr, parts)]).encode()).hexdigest()[:20]


def resumed(spark: SparkSession, folder: str, tag: str, sign: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table `tag` of a work folder: read if a run of the same signature finished it, else made and written; tables of
    `tag` with other signatures are cleared."""
    files, path = hadoop_path(spark, f"{folder}/{tag}-{sign}")
    if not files.exists(hadoop_path(spark, f"{path}/_SUCCESS")[1]):
        top = hadoop_path(spark, folder)[1]
        for old in files.listStatus(top) if files.exists(top) else []:
            if old.getPath().getName().rpartition("-")[0] == tag:
                files.delete(old.getPath(), True)
        make().write.parquet(f"{folder}/{tag}-{sign}")
    return spark.read.parquet(f"{folder}/{tag}-{sign}")
