"""Plan shapes that must hold at any scale."""

import pytest
from conftest import SMALL

from paperloom.operators import merge, rollup
from paperloom.plans import tables
from paperloom.plans.catalog import QUERIES
from paperloom.plans.tables import table

SCORED_IN_PYTHON = {"score_binary_batches"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python_outside_scoring(spark, name):
    shown = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in shown
    assert "NestedLoopJoin" not in shown
    assert "BatchEvalPython" not in shown
    assert ("ArrowEvalPython" in shown) == (name in SCORED_IN_PYTHON)


def test_window_reaches_the_scan(spark):
    shown = plan(QUERIES["date_window"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in shown
    assert "LessThan(o_orderdate,1998-01-01" in shown
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in shown


def test_capped_search_sorts_only_the_top(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["capped_search"](spark, SMALL))


def test_each_term_is_counted_once_for_all_labels(spark):
    shown = QUERIES["score_multilabel"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert 16 <= shown.count("regexp_extract_all(") + shown.count("regexp_count(") <= 40


def test_country_names_need_no_shuffle(spark):
    shown = plan(QUERIES["extract_countries"](spark, SMALL))
    assert shown.count("hashpartitioning") == 0


@pytest.mark.parametrize("name", ["feature_text", "score_binary", "year_column", "xml_parse_scalars"])
def test_row_wise_queries_do_not_shuffle_by_key(spark, name):
    assert "hashpartitioning" not in plan(QUERIES[name](spark, SMALL))


def test_xml_text_is_parsed_once(spark):
    for name in ("quarantine_counts", "xml_dates"):
        shown = plan(QUERIES[name](spark, SMALL))
        assert "from_xml" not in "".join(
            line for line in shown.splitlines() if line.startswith("Condition")
        )


def test_lists_of_an_article_are_moved_once(spark):
    lines = table(spark, SMALL, "lineitem")
    shown = plan(rollup.ordered_entries(lines, "l_orderkey", tables.AUTHOR_ORDER, ["l_tax"]))
    assert shown.count("hashpartitioning(") == 1


def test_affiliations_are_written_behind_the_shuffle(spark):
    shown = tables.article_lines(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = next(i for i, line in enumerate(shown) if "collect_list" in line)
    assert any("Dept" in line for line in shown[: grouped + 1]) and not any("Dept" in line for line in shown[grouped + 1 :])


def test_names_of_institutions_are_looked_up_behind_the_shuffle(spark, tmp_path):
    shown = plan(tables.article_lines(spark, SMALL))
    moved = [part for part in shown.split("\n\n") if "Arguments: hashpartitioning(l_orderkey" in part]
    assert len(moved) == 1 and "p_name" in moved[0]
    assert "s_name" not in moved[0] and "country" not in moved[0]
    staged = merge.stage(spark.range(3), str(tmp_path / "staged"))
    assert all("zstd" in name for name in staged.inputFiles())


def test_lines_are_joined_once_for_all_names(spark):
    shown = plan(QUERIES["extract_names_large"](spark, SMALL))
    assert "lineitem.parquet" not in shown and "supplier.parquet" not in shown


def test_records_are_parsed_once_for_all_counts(spark):
    assert "from_xml" not in plan(QUERIES["quarantine_counts"](spark, SMALL))
