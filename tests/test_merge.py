import random

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators import merge, quality

ROW = "pmid bigint, n int"


def rows(frame):
    return sorted(frame.collect(), key=lambda r: (r.pmid is None, r.pmid or 0, r.n))


def test_insert_only(spark):
    source = spark.createDataFrame([(1, 9), (2, 1), (2, 2), (None, 3), (None, 3)], ROW)
    target = spark.createDataFrame([(1, 0), (1, 5), (None, 0)], ROW)
    assert rows(merge.insert_new(source, target)) == [(2, 1), (2, 2), (None, 3), (None, 3)]
    single = merge.insert_new(source, target, dedupe_by=["n"])
    assert rows(single) == [(2, 2), (None, 3), (None, 3)]


def test_merge_twice_changes_nothing(spark):
    pick = random.Random(5)
    source = spark.createDataFrame([(pick.randrange(50), i) for i in range(200)], ROW)
    target = spark.createDataFrame([(i, -1) for i in range(0, 50, 3)], ROW)
    once = target.union(merge.insert_new(source, target))
    assert once.count() == target.count() + source.where("pmid % 3 <> 0").count()
    assert merge.insert_new(source, once).count() == 0


def test_append_new_creates_then_extends_the_table(spark, tmp_path):
    path = str(tmp_path / "main")
    merge.append_new(spark.createDataFrame([(1, 1), (2, 1)], ROW), path, ROW)
    merge.append_new(spark.createDataFrame([(2, 2), (3, 2)], ROW), path, ROW)
    assert rows(merge.read_table(spark, path, ROW)) == [(1, 1), (2, 1), (3, 2)]


def test_a_repeated_batch_leaves_the_table_as_it_is(spark, tmp_path):
    path, batch = str(tmp_path / "main"), spark.createDataFrame([(1, 1), (None, 2)], ROW)
    name = merge.append_new(batch, path, ROW)
    merge.append_new(spark.createDataFrame([(1, 7), (5, 7)], ROW), path, ROW)
    assert merge.append_new(batch, path, ROW, batch=name) == name
    assert rows(merge.read_table(spark, path, ROW)) == [(1, 1), (5, 7), (None, 2)]


def test_files_of_another_layout_are_refused(spark, tmp_path):
    path = str(tmp_path / "main")
    spark.createDataFrame([(1, 1)], ROW).write.parquet(path)
    with pytest.raises(ValueError, match="outside its batch folders"):
        merge.append_new(spark.createDataFrame([(2, 1)], ROW), path, ROW)
    with pytest.raises(ValueError, match="outside its batch folders"):
        merge.read_table(spark, path, ROW)


def test_stage_keeps_the_last_batch_and_checks_the_schema(spark, tmp_path):
    path = str(tmp_path / "stage")
    merge.stage(spark.createDataFrame([(1, 1)], ROW), path, ROW)
    assert rows(merge.stage(spark.createDataFrame([(2, 2)], ROW), path, ROW)) == [(2, 2)]
    with pytest.raises(ValueError):
        merge.stage(spark.createDataFrame([(2, 2)], "pmid bigint, n bigint"), path, ROW)


def test_main_layout(spark):
    columns = [
        F.array(F.lit("Mice"), F.lit("O'x")).alias(name) if name in ("mesh_terms", "author_affils")
        else F.lit(None).cast(kind).alias(name)
        for name, kind in reversed(schemas.MAIN_TYPES.items())
    ]
    frame = spark.range(1).select(F.lit("t").alias("feature"), *columns)
    out = merge.to_main_layout(frame)
    assert out.dtypes == list(schemas.MAIN_TYPES.items())
    assert len(out.columns) == 84
    row = out.first()
    assert row.mesh_terms == "['Mice', \"O'x\"]"
    assert row.author_affils == ["Mice", "O'x"]


def test_gate_stops_a_bad_batch(spark, tmp_path):
    frame = spark.range(10).select(F.when(F.col("id") < 3, F.lit("bad")).alias("problem"))
    watched, seen = quality.observed(frame, "batch", quality.failure_metrics("problem"))
    watched.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"row_count": 10, "failed_count": 3}
    quality.gate(seen, max_ratio=0.3)
    with pytest.raises(quality.TooManyFailures):
        quality.gate(seen, max_ratio=0.2)
    with pytest.raises(quality.TooManyFailures):
        quality.gate(seen, max_ratio=1.0, max_failed=2)


def test_empty_affiliation_list_is_a_problem(spark):
    frame = spark.createDataFrame(
        [(1, [], None), (1, ["a"], ["X"]), (0, [], None), (None, [], None), (1, None, [None])],
        "include int, affils array<string>, countries array<string>",
    )
    problem = quality.country_problem(F.col("include") == 1, F.col("affils"), F.col("countries"))
    found = [r[0] for r in frame.select(problem).collect()]
    assert found == ["empty affiliation list", None, None, None, None]


def test_a_counted_small_batch_never_shuffles_the_table(spark, tmp_path):
    spark.range(100000).withColumn("n", F.lit(1)).withColumnRenamed("id", "pmid").write.parquet(
        str(tmp_path / "main")
    )
    target = spark.read.parquet(str(tmp_path / "main"))
    source = spark.createDataFrame([(5, 1), (200000, 1)], ROW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = merge.insert_new(source, target, batch_rows=source.count())
        shown = fresh._jdf.queryExecution().toString()
        assert rows(fresh) == [(200000, 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [pmid" in shown and "LeftSemi, BuildRight" in shown
    assert merge.countable(source, "pmid") == 2
    assert merge.countable(source.select(F.lit("x").alias("pmid")), "pmid") is None
