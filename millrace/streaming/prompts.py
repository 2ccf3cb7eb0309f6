"""Answering prompts as they arrive."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.prompts import answered


def answer_stream(spark: SparkSession, source: str, schema: StructType | str, responses: str, checkpoint: str, client: Callable[[str, int], str]) -> StreamingQuery:
    """Watch a folder of prompt files; each batch asks what has no response yet and appends.

    A batch that is retried after a failure asks again only what its first try did not write.
    """
    incoming = spark.readStream.schema(schema).json(source)

    def batch(df: DataFrame, _: int) -> None:
        try:
            done = spark.read.parquet(responses).select("idx")
        except Exception as e:  # no response has been written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = df.select("idx").where("false")
        answered(df, done, client).write.mode("append").parquet(responses)

    return incoming.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
