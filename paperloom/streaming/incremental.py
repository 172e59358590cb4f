"""Incremental insert-only runs as a Structured Streaming job."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paperloom.operators.merge import read_table, stage, write_batch
from paperloom.streaming.ledger import sink_token

#: The table without the batch column; the same for every writer.
read_main = read_table


def incremental_sink(
    target: str,
    schema: str,
    token: str,
    key: str,
    dedupe_by: Sequence[str] | None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    staging: str | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that inserts unseen keys.

    ``prepare`` gets the raw batch and its number, and may put rows aside. A transformed batch
    is staged first: the merge reads it more than once, and a model must score it only once.

    Each micro-batch owns one partition folder and overwrites it. A batch that is run
    again after a failure ignores its own folder and writes the same rows once more.
    """
    columns = T.StructType.fromDDL(schema).fieldNames()

    def insert(batch: DataFrame, number: int) -> None:
        rows = prepare(batch, number) if prepare else batch
        if transform:
            rows = stage(transform(rows).select(*columns), staging, schema)
        write_batch(rows, target, schema, f"{token}-{number}", key, dedupe_by)

    return insert


def run_incremental(
    stream: DataFrame,
    target: str,
    schema: str,
    checkpoint: str,
    key: str = "pmid",
    dedupe_by: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> None:
    """Process everything that has arrived since the last run, then stop.

    By default each micro-batch keeps one row per key, the largest by all its columns.
    """
    spark = stream.sparkSession
    order = list(dedupe_by or [c for c in T.StructType.fromDDL(schema).fieldNames() if c != key])
    token = sink_token(spark, checkpoint)
    staging = f"{checkpoint.rstrip('/')}/staging"
    sink = incremental_sink(target, schema, token, key, order, transform, staging, prepare)
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
