"""Row labels for tables without a key, and assignment by them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.operators.lookup import attach
from paperloom.session import work_folder

LABEL = "row_label"
_RANGE_BITS = 33


def with_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The rows, written once, with labels 0, 1, ... that every later read agrees on.

    A partition's first label is the number of rows in the partitions before it: one row per
    partition is put in order, never the rows themselves.
    """
    spark, folder = df.sparkSession, work_folder(df.sparkSession, "labels")
    df.drop(label).withColumn("__id", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder).withColumn("__part", F.shiftright("__id", _RANGE_BITS))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__id").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1))
    labelled = stored.join(F.broadcast(starts), "__part").withColumn(label, F.col("__start") + place)
    return labelled.drop("__id", "__part", "__start")


def assign_by_label(table: DataFrame, values: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """Columns of a subset of the rows written back to all of them by their labels; the rest is NULL.

    Whatever the ids are, missing or repeated, each row gets its own values. ``values`` holds each
    label at most once.
    """
    own = values.select(label, *columns)
    return attach(table.drop(*columns), own, label)
