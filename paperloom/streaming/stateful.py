"""Incremental runs that remember recent keys in Structured Streaming state."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from paperloom.operators.merge import stage, write_batch
from paperloom.streaming.ledger import sink_token

_SEEN = "__seen_at"


def _floor_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/arrivals"


def latest_arrival(spark: SparkSession, checkpoint: str) -> datetime | None:
    """The latest arrival time of all finished runs; None before the first one."""
    try:
        rows = spark.read.schema("seen_at timestamp").parquet(_floor_path(checkpoint))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.agg(F.max("seen_at")).first()[0]


def run_stateful(
    stream: DataFrame,
    target: str,
    schema: str,
    checkpoint: str,
    arrived: str,
    key: str = "pmid",
    horizon: str = "2 days",
) -> list[list[str]]:
    """Insert what has arrived since the last run, one row per key, then stop.

    Keys that came within the last ``horizon`` of arrival time are held as streaming state and
    dropped there, so drops that overlap are settled without reading the main table; state older
    than that is given up, which bounds it. Keys the state does not know go to the indexed merge,
    which opens only the batches that may hold one of them: an old key that comes again is still
    not inserted twice. For each micro-batch the names of the opened batches are returned.

    ``arrived`` is a time that grows from run to run, such as the landing day. A row stamped
    earlier than rows of a finished run counts as arriving with them, so none is late and none is
    lost; for that a run takes all that is there as one batch (no ``maxFilesPerTrigger``). NULL
    keys match nothing and are all inserted. Which of several rows of one key in one run stays is
    not defined.
    """
    spark, columns = stream.sparkSession, T.StructType.fromDDL(schema).fieldNames()
    floor = latest_arrival(spark, checkpoint)
    seen = F.col(arrived).cast("timestamp")
    if floor is not None:
        seen = F.greatest(seen, F.lit(floor))
    stamped = stream.withColumn(_SEEN, seen)
    known = stamped.where(F.col(key).isNotNull() & F.col(_SEEN).isNotNull())
    fresh = known.withWatermark(_SEEN, horizon).dropDuplicatesWithinWatermark([key])
    # What has no key or no time has nothing to be remembered by; the merge settles it.
    rest = stamped.where(F.col(key).isNull() | F.col(_SEEN).isNull())
    token, opened, latest = sink_token(spark, checkpoint), [], []
    staging = f"{checkpoint.rstrip('/')}/staging"
    order = [c for c in columns if c != key]

    def insert(batch: DataFrame, number: int) -> None:
        staged = stage(batch.select(*columns, _SEEN), staging)
        latest.append(staged.agg(F.max(_SEEN)).first()[0])
        opened.append(write_batch(staged.select(*columns), target, schema, f"{token}-{number}", key, order))

    query = (
        fresh.unionByName(rest).writeStream.foreachBatch(insert)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    times = [t for t in [floor, *latest] if t is not None]
    if times:
        reached = spark.createDataFrame([(max(times),)], "seen_at timestamp")
        reached.coalesce(1).write.mode("append").parquet(_floor_path(checkpoint))
    return opened
