"""Runs of failing records in record order, from summaries of ranges that can be merged.

The rows are sorted into ranges and numbered. A chunk of consecutive numbers is summed up by its
length, the failing rows at its beginning and its end, and its longest run; two neighbours give
one such summary, so a whole table is summed up in a tree and no task sees all rows in order.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.operators.quality import TooManyFailures
from paperloom.session import work_folder

#: Rows of a chunk and children of a node of the tree, as powers of two.
CHUNK_BITS = 13
FAN_BITS = 8
#: The numbers of one range start at a multiple of this power of two.
RANGE_BITS = 33
SUMMARY = ("length", "prefix", "suffix", "longest")


def numbered(rows: DataFrame, order: Sequence[str], failed: Column) -> DataFrame:
    """(order columns, failed, __id): ids grow in order, and by one inside a range. Written once."""
    folder = work_folder(rows.sparkSession, "runs")
    flagged = rows.select(*order, F.coalesce(failed, F.lit(False)).alias("failed"))
    flagged.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _chunks(ids: DataFrame) -> DataFrame:
    """One summary per chunk of consecutive rows."""
    chunk = F.shiftright("__id", CHUNK_BITS).alias("chunk")
    whole = ids.groupBy(chunk).agg(
        F.count("*").alias("length"),
        F.min("__id").alias("start"),
        F.max("__id").alias("stop"),
        F.min(F.when(~F.col("failed"), F.col("__id"))).alias("first_sound"),
        F.max(F.when(~F.col("failed"), F.col("__id"))).alias("last_sound"),
    )
    # Between two sound rows of a chunk lies one run, perhaps an empty one.
    before = F.lag("__id").over(Window.partitionBy("chunk").orderBy("__id"))
    sound = ids.where(~F.col("failed")).select(chunk, "__id")
    inner = sound.withColumn("gap", F.col("__id") - before - 1).groupBy("chunk").agg(F.max("gap").alias("inner"))
    prefix = F.coalesce(F.col("first_sound") - F.col("start"), F.col("length"))
    suffix = F.coalesce(F.col("stop") - F.col("last_sound"), F.col("length"))
    joined = whole.join(inner, "chunk", "left").withColumns({"prefix": prefix, "suffix": suffix})
    longest = F.greatest("prefix", "suffix", F.coalesce("inner", F.lit(0)))
    return joined.withColumn("longest", longest)


def merged(left: Column, right: Column) -> Column:
    """The summary of two neighbouring ranges."""
    meeting = left["suffix"] + right["prefix"]
    return F.struct(
        (left["length"] + right["length"]).alias("length"),
        F.when(left["prefix"] == left["length"], left["length"] + right["prefix"]).otherwise(left["prefix"]).alias("prefix"),
        F.when(right["suffix"] == right["length"], right["length"] + left["suffix"]).otherwise(right["suffix"]).alias("suffix"),
        F.greatest(left["longest"], right["longest"], meeting).alias("longest"),
    )


def run_summary(ids: DataFrame) -> dict[str, int]:
    """Length, failing rows at the beginning and at the end, and the longest run of all numbered rows."""
    level = _chunks(ids).select("chunk", F.struct(*SUMMARY).alias("part"))
    folder, step = work_folder(ids.sparkSession, "run_tree"), 0
    nothing = F.struct(*[F.lit(0).cast("long").alias(n) for n in SUMMARY])
    while True:
        path = f"{folder}/level={step}"
        level.write.parquet(path)
        level = ids.sparkSession.read.parquet(path)
        low, high = level.agg(F.min("chunk"), F.max("chunk")).first()
        if low is None:
            return dict.fromkeys(SUMMARY, 0)
        if low == high:
            return level.first().part.asDict()
        # A node's children are neighbours, at most one for each of its places.
        parts = F.array_sort(F.collect_list(F.struct("chunk", "part")))
        nodes = level.groupBy(F.shiftright("chunk", FAN_BITS).alias("chunk")).agg(parts.alias("parts"))
        level = nodes.select("chunk", F.aggregate("parts", nothing, lambda a, x: merged(a, x["part"])).alias("part"))
        step += 1


def failure_runs(ids: DataFrame, order: Sequence[str], min_length: int) -> DataFrame:
    """The maximal runs of at least ``min_length`` failing rows: (first, last, length), order columns as structs.

    A failing row belongs to the last sound row before it. That row is looked for in the chunk,
    then among the chunk summaries of its range, then among the ranges.
    """
    chunk = F.shiftright("__id", CHUNK_BITS)
    chunks = _chunks(ids).select("chunk", F.shiftright("chunk", RANGE_BITS - CHUNK_BITS).alias("range"), "last_sound")
    folder = work_folder(ids.sparkSession, "run_chunks")
    chunks.write.parquet(folder)
    chunks = ids.sparkSession.read.parquet(folder)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of the sort.
    ranges = chunks.groupBy("range").agg(F.max("last_sound").alias("last"))
    ranges = ranges.select("range", F.max("last").over(earlier).alias("carried"))
    inside = Window.partitionBy("range").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    own = chunks.withColumn("near", F.max("last_sound").over(inside)).join(ranges, "range")
    known = own.select(F.col("chunk").alias("__chunk"), F.coalesce("near", "carried", F.lit(-1)).alias("__carried"))
    here = Window.partitionBy("__chunk").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(~F.col("failed"), F.col("__id"))).over(here)
    placed = ids.withColumn("__chunk", chunk).withColumn("__last", last).where("failed").join(known, "__chunk")
    runs = placed.groupBy(F.coalesce("__last", "__carried").alias("__after")).agg(
        F.min(F.struct("__id", *order)).alias("first"), F.max(F.struct("__id", *order)).alias("last"), F.count("*").alias("length")
    )
    return runs.where(F.col("length") >= min_length).select("first", "last", "length")


def consecutive_gate(rows: DataFrame, order: Sequence[str], failed: Column, stop_after: int) -> dict[str, int]:
    """Stop when ``stop_after`` rows or more fail one after the other; returns the summary."""
    summary = run_summary(numbered(rows, order, failed))
    if summary["longest"] >= stop_after:
        raise TooManyFailures(f"{summary['longest']} rows failed one after the other, {stop_after} stop a run")
    return summary
