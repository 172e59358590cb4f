from datetime import date

import pytest
from pyspark.sql import functions as F

from paperloom.operators import merge
from paperloom.streaming import handoff, incremental

ROW = "pmid bigint, n int"


def drop(spark, folder, values):
    spark.createDataFrame(values, ROW).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **options):
    stream = spark.readStream.schema(ROW).parquet(f"{tmp_path}/in")
    incremental.run_incremental(stream, f"{tmp_path}/out", ROW, f"{tmp_path}/check", **options)
    return sorted(map(tuple, incremental.read_main(spark, f"{tmp_path}/out", ROW).collect()))


def test_increments_equal_one_batch(spark, tmp_path):
    drops = [[(1, 1), (2, 1)], [(2, 5), (3, 1)], [(3, 9), (4, 1), (4, 2)]]
    for values in drops:
        drop(spark, f"{tmp_path}/in", values)
        got = run(spark, tmp_path)
    assert got == [(1, 1), (2, 1), (3, 1), (4, 2)]
    assert run(spark, tmp_path) == got
    keys = spark.createDataFrame(sum(drops, []), ROW)
    empty = spark.createDataFrame([], ROW)
    batch = merge.insert_new(keys, empty, dedupe_by=["n"])
    assert {r.pmid for r in batch.collect()} == {k for k, _ in got}


def test_repeated_batch_leaves_the_same_table(spark, tmp_path):
    out = f"{tmp_path}/out"
    sink = incremental.incremental_sink(out, ROW, "t", "pmid", ["n"])
    first = spark.createDataFrame([(1, 1), (2, 1)], ROW)
    second = spark.createDataFrame([(2, 7), (3, 7)], ROW)
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        sink(batch, number)
    got = sorted(map(tuple, incremental.read_main(spark, out, ROW).collect()))
    assert got == [(1, 1), (2, 1), (3, 7)]


def test_a_new_checkpoint_keeps_the_rows_of_the_old_one(spark, tmp_path):
    drop(spark, f"{tmp_path}/in", [(1, 1)])
    run(spark, tmp_path)
    drop(spark, f"{tmp_path}/in", [(2, 1)])
    stream = spark.readStream.schema(ROW).parquet(f"{tmp_path}/in")
    incremental.run_incremental(stream, f"{tmp_path}/out", ROW, f"{tmp_path}/check2")
    got = sorted(map(tuple, incremental.read_main(spark, f"{tmp_path}/out", ROW).collect()))
    assert got == [(1, 1), (2, 1)]


def test_transformed_batches_are_staged(spark, tmp_path):
    drop(spark, f"{tmp_path}/in", [(1, 1), (2, 2)])
    got = run(spark, tmp_path, transform=lambda b: b.withColumn("n", (F.col("n") * 10).cast("int")))
    assert got == [(1, 10), (2, 20)]


def test_batch_loads_and_streaming_runs_see_each_other(spark, tmp_path):
    out = f"{tmp_path}/out"
    merge.append_new(spark.createDataFrame([(1, 1), (2, 1)], ROW), out, ROW)
    drop(spark, f"{tmp_path}/in", [(2, 5), (3, 5)])
    assert run(spark, tmp_path) == [(1, 1), (2, 1), (3, 5)]
    merge.append_new(spark.createDataFrame([(3, 9), (4, 9)], ROW), out, ROW)
    assert run(spark, tmp_path) == [(1, 1), (2, 1), (3, 5), (4, 9)]


FULL = "pmid bigint, title string, day date, score double, terms array<string>"
MESSAGES = [
    (1, "ünï 'x' \"y\"", date(2024, 2, 29), 0.1, ["a", None, "ß"]),
    (2, None, None, None, None),
    (3, "", date(1900, 1, 1), 1e300, []),
]


def test_handoff_is_lossless(spark):
    frame = spark.createDataFrame(MESSAGES, FULL)
    back = handoff.decode_rows(handoff.encode_rows(frame), FULL)
    assert back.where(F.col(handoff.CORRUPT).isNotNull()).count() == 0
    assert sorted(map(tuple, back.drop(handoff.CORRUPT).collect())) == MESSAGES


@pytest.mark.parametrize("message", ["???", "bm90IGpzb24=", "/w==", "eyJwbWlkIjoieCJ9"])
def test_unreadable_messages_are_kept_aside(spark, message):
    good = handoff.encode_rows(spark.createDataFrame(MESSAGES[:1], FULL))
    mixed = good.union(spark.createDataFrame([(message,)], "data string"))
    rows = handoff.decode_rows(mixed, FULL).collect()
    assert sorted(r[handoff.CORRUPT] is None for r in rows) == [False, True]


def test_published_messages_feed_the_second_stage(spark, tmp_path):
    frame = spark.createDataFrame(MESSAGES, FULL)
    handoff.publish(frame, f"{tmp_path}/topic")
    handoff.publish(frame.where("pmid = 1"), f"{tmp_path}/topic")
    stream = handoff.read_messages(spark, f"{tmp_path}/topic", FULL)
    incremental.run_incremental(stream, f"{tmp_path}/main", FULL, f"{tmp_path}/check")
    rows = incremental.read_main(spark, f"{tmp_path}/main", FULL).collect()
    assert sorted(map(tuple, rows)) == MESSAGES


