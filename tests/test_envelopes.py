from datetime import date

import pytest

from paperloom.plans.catalog import QUERIES
from paperloom.sources import articles
from paperloom.streaming import handoff


def test_old_and_new_fields_are_decoded_together(spark):
    old = spark.createDataFrame([(1, date(2020, 1, 2), "a'b")], "pmid int, day date, title string")
    new = spark.createDataFrame([(2, [1.5, None], ("x", None)), (None, None, None)], "pmid int, scores array<double>, who struct<name:string,age:int>")
    sent = handoff.encode_described(old).union(handoff.encode_described(new))
    bad = spark.createDataFrame([("???",), ("bm90IGpzb24=",), ("e30=",), (None,)], "data string")
    rows = handoff.decode_described(sent.union(bad))
    assert rows.columns[:3] == ["pmid", "day", "title"] and set(rows.columns[3:]) == {"scores", "who", handoff.CORRUPT}
    found = sorted(((r.pmid, r.day, r.title, r.scores, r.who, r[handoff.CORRUPT]) for r in rows.collect()), key=str)
    assert found == sorted(
        [(1, date(2020, 1, 2), "a'b", None, None, None), (2, None, None, [1.5, None], ("x", None), None), (None, None, None, None, None, None)]
        + [(None, None, None, None, None, c) for c in ("???", "bm90IGpzb24=", "e30=", None)],
        key=str,
    )


def test_a_field_with_two_types_is_read_as_text(spark):
    sent = handoff.encode_described(spark.createDataFrame([(1,)], "n int")).union(
        handoff.encode_described(spark.createDataFrame([("x",)], "n string"))
    )
    assert sorted(r.n for r in handoff.decode_described(sent).collect()) == ["1", "x"]


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("rows", [[(1, date(2024, 3, 1)), (2, None), (3, date(2024, 5, 6))], [(1, None)], []])
def test_mark_comes_from_the_footers(spark, tmp_path, rows, parts):
    """With three files one of them has no date, so that the column itself must be read."""
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "pmid int, day date").repartition(parts).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    latest = max((d for _, d in rows if d), default=date(1900, 1, 1))
    assert articles.mark_from_footers(spark, path, "day") == (latest, len(rows))
    shown = articles.footer_statistics(spark, path, "day")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(day), COUNT(*)]" in shown
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_statistics_query_asks_the_footers(spark, monkeypatch):
    asked = []
    plain = articles.footer_statistics
    monkeypatch.setattr(articles, "footer_statistics", lambda *a: asked.append(a[2]) or plain(*a))
    assert QUERIES["mark_from_statistics"](spark, "/root/testdata/sf0.001").first().row_count > 0
    assert asked == ["pubmed_date"]


def test_published_messages_are_compressed(spark, tmp_path):
    path = str(tmp_path / "messages")
    rows = spark.range(500).selectExpr("id", "cast(NULL AS string) AS a_field_without_a_value")
    handoff.publish(rows, path)
    files = list((tmp_path / "messages").glob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
    back = handoff.decode_rows(spark.read.text(path), "id long, a_field_without_a_value string", "value")
    assert sorted(r.id for r in back.where(f"{handoff.CORRUPT} IS NULL").collect()) == list(range(500))
