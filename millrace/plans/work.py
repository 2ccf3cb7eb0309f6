"""Intermediate tables in the folder that all executors share.

A table that is read more than once, or that ends a round of an iteration, is written as Parquet
below ``spark.checkpoint.dir``. Lineage ends there, so a lost executor costs a re-read and not a
re-run, and unlike a cached block the data has no home on one machine.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for a local master without that setting."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _own[sc.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once and read back from the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table from ``written`` that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/millrace/" in f:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
