import corpus_pipeline
import __spark_entry__
import pytest
from compare import connect, differences
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm.queries import LLM_ORACLE, LLM_QUERIES


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, MEDIUM), connect(MEDIUM), LLM_ORACLE[name]) is None


def test_every_stage_acts_on_what_was_left(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, SMALL)
        rows = left.collect()
        if name != "packing":
            assert left.columns == docs.columns
            assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
        seen.append((name, rows))
        docs = spark.createDataFrame(rows, left.schema).repartition(3)
    kept = dict(seen)
    good = [labels[r.doc_id] for r in kept["quality"] if r.doc_id in labels]
    assert sum(good) >= 0.97 * len(good) and len(good) >= 0.97 * sum(labels.values())
    assert {r.doc_id for r in kept["lines"]} == {r.doc_id for r in kept["quality"]}
    assert all(r.n_chars == len(r.text) for r in kept["lines"])
    assert len({r.text for r in kept["near_duplicates"]}) == len(kept["near_duplicates"]) <= len(kept["lines"])
    assert not any(item in r.text for r in kept["decontamination"] for item in items)
    assert {r.doc_id for r in kept["packing"]} == {r.doc_id for r in kept["decontamination"]}


def test_run_writes_and_rereads_every_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


#: Names that some operator uses for a column of its own.
CLASHES = ["label", "score", "leaks", "n_lines", "n_dropped", "group_key", "length", "sequence_id", "offset", "row", "node", "rank"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_takes_any_rows(docs, spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "same text here."), (3, "same text here."), (4, "\n\n"), (5, "word " * 100_000)]
    clash = docs(rows).withColumns({n: F.lit("x") for n in CLASHES})
    left = stage(spark, clash, SMALL)
    assert left.columns == (["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] if name == "packing" else corpus_pipeline.COLUMNS)
    found = sorted((r.doc_id for r in left.collect()), key=str)
    if name == "quality":
        assert set(found) <= {1, 2, 3, 4, 5, None}
    elif name == "near_duplicates":
        assert found == [1, 3, 5, None]
    elif name == "packing":
        assert {i: found.count(i) for i in (1, 2, 3, 4, None)} == {1: 1, 2: 1, 3: 2, 4: 1, None: 2}
    else:
        assert found == sorted((i for i, _ in rows), key=str)
    assert stage(spark, docs([]), SMALL).count() == 0
