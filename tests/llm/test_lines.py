import pytest
from pyspark.sql import functions as F

from llm_rows import docs  # noqa: F401
from paperloom.llm import lines


def brute(rows, min_chars=40, min_docs=5):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(lines.BLANKS).translate(upper)
    holders = {}
    order = lambda i: -(2**63) if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(order(i))
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if keeper.get(key(x), order(i)) == order(i)]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


LONG = "This Sentence Is Certainly Longer Than Forty Characters ÄÖ"
ROWS = (
    [(i, f"{LONG}\nown line {i}\n\t {LONG.lower().replace('äö', 'ÄÖ')}  \n") for i in range(1, 8)]
    + [(20, None), (21, ""), (22, "\n\n"), (23, "short\n" * 50), (7, f"{LONG}\nrepeated id"), (None, f"{LONG}\nnobody"), (None, LONG)]
    + [(30 + i, "four holders only, which is not enough to drop it") for i in range(4)]
    + [(40, "short\n" + ("a line of forty characters that repeats itself\n" * 300)), (41, LONG.replace("Ä", "ä"))]
    + [(50 + i, "a line of forty characters that repeats itself\rx") for i in range(6)]
)


@pytest.mark.parametrize("batches", [1, 4])
def test_lines_equal_brute_force(docs, batches):
    found = lines.dedup_lines(docs(ROWS), batches=batches)
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_smaller_thresholds_and_clashing_columns(docs):
    rows = [(i, f"abc def\nrow {i}") for i in range(5)]
    frame = docs(rows).withColumns({"n_lines": F.lit("x"), "docs": F.lit(1), "keeper": F.lit(2), "top": F.lit(3)})
    found = lines.dedup_lines(frame, min_chars=5, min_docs=2)
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()) == brute(rows, 5, 2)
    assert {"docs", "keeper", "top"} <= set(found.columns)


def test_no_documents(docs):
    assert lines.dedup_lines(docs([])).count() == 0


def test_runs_are_levelled_and_name_the_first_holder(spark, tmp_path):
    runs = lines.LineRuns(spark, str(tmp_path), 2)
    for top in (9, 5, 3):
        runs.add(spark.createDataFrame([(1, 1, 1, top), (top, 0, 1, top)], "__h1 long, __h2 long, docs long, top long"))
    assert [len(level) for level in runs.levels] == [1, 1]
    got = {(r["__h1"], r["docs"], r["keeper"]) for r in runs.totals().collect()}
    assert got == {(1, 3, 9), (9, 1, 9), (5, 1, 5), (3, 1, 3)}
    runs.forget()


def test_plan_has_no_python(docs):
    plan = lines.dedup_lines(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
