"""Names that keep the batches of different checkpoints apart."""

import uuid

from pyspark.sql import SparkSession


def sink_token(spark: SparkSession, checkpoint: str) -> str:
    """A name kept beside the checkpoint, so that batch numbers of two checkpoints that
    feed one table never meet."""
    folder = f"{checkpoint.rstrip('/')}/sink_token"
    fresh = spark.createDataFrame([(uuid.uuid4().hex,)], "token string")
    fresh.coalesce(1).write.mode("ignore").parquet(folder)
    return spark.read.schema("token string").parquet(folder).first().token
