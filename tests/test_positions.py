from pyspark.sql import functions as F

from paperloom.operators import positions


def test_labels_are_dense_and_stay(spark):
    rows = positions.with_labels(spark.range(1000).repartition(7).withColumn(positions.LABEL, F.lit("x")))
    found = {r.id: r.row_label for r in rows.collect()}
    assert sorted(found.values()) == list(range(1000))
    assert {r.id: r.row_label for r in rows.orderBy("id").collect()} == found
    assert positions.with_labels(spark.range(0)).count() == 0


def test_values_go_back_to_their_own_rows(spark):
    frame = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (1, "d"), (2, None)], "pmid int, text string").repartition(3)
    rows = positions.with_labels(frame.withColumn("score", F.lit(9)))
    scores = rows.where("text IS NOT NULL").withColumn("score", F.upper("text"))
    back = positions.assign_by_label(rows, scores, ["score"])
    assert sorted(((r.pmid, r.text, r.score) for r in back.collect()), key=str) == sorted(
        [(None, "a", "A"), (None, "b", "B"), (1, "c", "C"), (1, "d", "D"), (2, None, None)], key=str
    )
