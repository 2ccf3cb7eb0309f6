"""Session defaults: adaptive execution, UTC, Arrow."""

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    for k in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        os.environ.setdefault(k, "1")  # one thread a Python worker; Spark is the parallelism
    builder = SparkSession.builder.master(master).appName("millrace")
    for k, v in (DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": "8g"} | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
