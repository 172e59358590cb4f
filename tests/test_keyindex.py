import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from paperloom.operators import keyindex, merge

ROW = "pmid bigint, n int"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def frame(spark, keys, n=0):
    return spark.createDataFrame([(k, n) for k in keys], ROW)


def test_only_batches_that_may_hold_a_key_are_opened(spark, tmp_path):
    path = str(tmp_path / "main")
    for start in range(0, 50_000, 5_000):
        merge.append_new(frame(spark, range(start, start + 5_000, 2)), path, ROW, batch=f"b{start:05d}")
    write = lambda keys, name: merge.write_batch(frame(spark, keys, 1), path, ROW, name)
    assert write([60_000, 70_001], "above") == []
    assert write([10_000, 10_001], "one") == ["b10000"]
    # In range but in no batch: odd numbers are met by the filters, not by the ranges.
    opened = [write([k], f"odd{k}") for k in (20_003, 33_331, 41_117, 5_555)]
    assert sum(map(len, opened)) <= 1
    assert write([0, 49_998, 20_003], "both") == ["b00000", "b45000", "odd20003"]
    assert write([None, None], "none") == []
    found = merge.read_table(spark, path, ROW)
    assert found.where("n = 1 and pmid % 2 = 0").collect() == [(60_000, 1)]
    assert found.where("pmid is null").count() == 2
    assert found.groupBy("pmid").count().where("count > 1 and pmid is not null").count() == 0


def test_batches_overlapping_in_any_way_equal_the_plain_merge(spark, tmp_path):
    draw, path, plain = random.Random(4), str(tmp_path / "main"), spark.createDataFrame([], ROW)
    for number in range(6):
        keys = [draw.choice([None, *range(400)]) for _ in range(120)]
        batch = frame(spark, keys, number)
        plain = merge.stage(plain.union(merge.insert_new(batch, plain)), str(tmp_path / f"plain{number}"))
        merge.append_new(batch, path, ROW)
    assert rows(merge.read_table(spark, path, ROW)) == rows(plain)


def test_no_key_is_ever_missed(spark, monkeypatch):
    """Many segments: every key of a batch is found by its own filter."""
    monkeypatch.setattr(keyindex, "SEGMENT_KEYS", 64)
    keys = spark.range(0, 9_000, 3).withColumnRenamed("id", "pmid")
    index = keyindex.key_filters(keys, "pmid").withColumn("batch", F.lit("b"))
    assert index.count() == 64
    for small in (True, False):
        for some in (keys.where("pmid % 1000 = 0"), keys.where("pmid = 8997")):
            assert keyindex.batches_holding(some, index, "pmid", small) == ["b"]
    single = [keyindex.batches_holding(keys.sparkSession.createDataFrame([(k,)], "pmid long"), index, "pmid") for k in (0, 4500, 8997)]
    assert single == [["b"]] * 3


@pytest.mark.parametrize(("kind", "values", "other"), [("string", ["a", "ü", "z"], "q"), ("date", [date(2001, 1, 1), date(2003, 1, 1)], date(2002, 1, 1)), ("int", [-5, 7], 3)])
def test_keys_of_other_types(spark, tmp_path, kind, values, other):
    path, schema = str(tmp_path / "main"), f"pmid {kind}, n int"
    merge.append_new(spark.createDataFrame([(v, 0) for v in values], schema), path, schema, batch="first")
    batch = spark.createDataFrame([(values[0], 1), (other, 1)], schema)
    assert merge.write_batch(batch, path, schema, "second") == ["first"]
    assert sorted(r.n for r in merge.read_table(spark, path, schema).collect()) == [0] * len(values) + [1]


def test_a_table_without_an_index_is_opened_until_it_is_read(spark, tmp_path):
    path = str(tmp_path / "main")
    frame(spark, [1, 2]).write.parquet(f"{path}/batch=old")
    frame(spark, [8]).write.parquet(f"{path}/batch=older")
    assert merge.write_batch(frame(spark, [2, 3], 1), path, ROW, "a") == ["old", "older"]
    merge.index_batches(spark, path, ROW)
    assert merge.write_batch(frame(spark, [2, 9], 2), path, ROW, "b") == ["old"]
    assert rows(merge.read_table(spark, path, ROW)) == [(1, 0), (2, 0), (3, 1), (8, 0), (9, 2)]


def test_a_run_that_failed_before_its_data_hides_nothing(spark, tmp_path):
    path = str(tmp_path / "main")
    merge.append_new(frame(spark, [1]), path, ROW, batch="a")
    keyindex.open_batch(spark, path, "lost", "bigint")
    assert merge.write_batch(frame(spark, [1, 2], 1), path, ROW, "b") == ["a", "lost"]
    # One that failed after its data and before its filters is opened by every merge.
    frame(spark, [5]).write.parquet(f"{path}/batch=lost")
    assert merge.write_batch(frame(spark, [5, 6], 2), path, ROW, "c") == ["lost"]
    assert rows(merge.read_table(spark, path, ROW)) == [(1, 0), (2, 1), (5, 0), (6, 2)]


def test_the_merge_lists_no_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "main")
    merge.append_new(frame(spark, [1]), path, ROW)
    monkeypatch.setattr(merge, "read_batches", lambda *a: pytest.fail("the whole table was listed"))
    merge.append_new(frame(spark, [1, 2], 1), path, ROW)
    merge.append_new(frame(spark, []), path, ROW)
    monkeypatch.undo()
    assert rows(merge.read_table(spark, path, ROW)) == [(1, 0), (2, 1)]


def test_only_the_keys_are_moved_for_the_filters(spark):
    keys = spark.range(0, 9_000, 3).withColumnRenamed("id", "pmid")
    shown = keyindex.key_filters(keys, "pmid", 4)._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange hashpartitioning") == 1
    assert all(len(r.words) == keyindex.WORDS for r in keyindex.key_filters(keys, "pmid", 4).collect())


def test_rows_that_no_batch_can_hold_are_not_compared(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "main")
    monkeypatch.setattr(merge, "insert_new", lambda *a, **k: pytest.fail("rows were compared with nothing"))
    merge.append_new(frame(spark, [1, 1, None, None]), path, ROW)
    merge.append_new(frame(spark, [7, 7, None], 1), path, ROW, dedupe_by=["n"])
    assert rows(merge.read_table(spark, path, ROW)) == sorted([(1, 0), (1, 0), (None, 0), (None, 0), (7, 1), (None, 1)], key=str)
