from datetime import datetime


from paperloom.operators import merge
from paperloom.streaming import stateful

ROW = "pmid bigint, n int, at timestamp"


class Feed:
    def __init__(self, spark, place):
        self.spark, self.place = spark, place

    def drop(self, *values):
        rows = [(k, n, datetime(2024, 1, d)) if d else (k, n, None) for k, n, d in values]
        self.spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{self.place}/in")
        return self.run()

    def run(self):
        stream = self.spark.readStream.schema(ROW).parquet(f"{self.place}/in")
        opened = stateful.run_stateful(stream, f"{self.place}/out", ROW, f"{self.place}/check", "at", horizon="2 days")
        found = merge.read_table(self.spark, f"{self.place}/out", ROW).select("pmid", "n")
        return sorted(map(tuple, found.collect()), key=str), sum(opened, [])


def test_overlapping_drops_open_no_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.drop((1, 1, 1), (2, 1, 1)) == ([(1, 1), (2, 1)], [])
    # Restarted: the state still knows key 2.
    assert feed.drop((2, 5, 2), (3, 5, 2)) == ([(1, 1), (2, 1), (3, 5)], [])
    assert feed.run() == ([(1, 1), (2, 1), (3, 5)], [])


def test_a_key_the_state_gave_up_is_found_by_the_index(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.drop((1, 1, 1), (2, 1, 1))
    feed.drop((3, 1, 9), (4, 1, 9))
    found, opened = feed.drop((1, 7, 20), (5, 7, 20))
    assert found == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 7)]
    assert len(opened) == 1


def test_a_late_key_is_not_lost(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.drop((1, 1, 20))
    found, _ = feed.drop((6, 2, 1), (1, 2, 1), (7, 2, 21))
    assert found == [(1, 1), (6, 2), (7, 2)]
    # It counts as having arrived with the latest rows, so its key is held like theirs.
    assert feed.drop((6, 3, 20), (8, 3, 21)) == ([(1, 1), (6, 2), (7, 2), (8, 3)], [])


def test_rows_without_key_or_time(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    found, _ = feed.drop((None, 1, 1), (None, 1, 1), (1, 1, None), (2, 1, 1))
    assert found == [(1, 1), (2, 1), (None, 1), (None, 1)]
    found, _ = feed.drop((None, 2, 2), (1, 2, None), (2, 2, None))
    assert found == [(1, 1), (2, 1), (None, 1), (None, 1), (None, 2)]


def test_state_and_not_the_table_settles_repeats(spark, tmp_path):
    stream = spark.readStream.schema(ROW).parquet(str(tmp_path))
    fresh = stream.withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["pmid"])
    assert "DeduplicateWithinWatermark" in fresh._jdf.queryExecution().logical().toString()
    assert stateful.latest_arrival(spark, str(tmp_path / "none")) is None
