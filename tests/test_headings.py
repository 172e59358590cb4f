import random

import pytest

from paperloom.operators import headings


def table(spark, edges):
    return spark.createDataFrame(edges, "child string, parent string")


def below(edges, top):
    found, todo = {top}, [top]
    while todo:
        for child, parent in edges:
            if parent == todo[0] and child not in found:
                found.add(child)
                todo.append(child)
        todo.pop(0)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_of_graphs_with_several_parents_and_circles(spark, seed):
    draw = random.Random(seed)
    edges = [(f"h{draw.randrange(20)}", f"h{draw.randrange(20)}") for _ in range(22)] + [("chain0", "h0")]
    edges += [(f"chain{i + 1}", f"chain{i}") for i in range(20)]
    pairs = {tuple(r) for r in headings.heading_closure(table(spark, edges)).collect()}
    for top in {h for e in edges for h in e}:
        assert {n for h, n in pairs if h == top} == below(edges, top)


def test_search_takes_all_narrower_headings(spark):
    edges = [("Mice", "Rodents"), ("Rats", "Rodents"), ("Rodents", "Animals"), ("Dogs", "Animals"), (None, "Animals"), ("x", None)]
    closure = headings.heading_closure(table(spark, edges))
    rows = [(1, ["MICE"]), (2, ["Dogs", "Rats"]), (3, ["Cats"]), (4, None), (5, []), (None, ["Mice"]), (6, [None, "rodents"]), (2, ["Cats"])]
    frame = spark.createDataFrame(rows, "pmid int, terms array<string>")

    def found(*wanted):
        narrower = headings.narrower_headings(closure, wanted)
        return sorted(r.pmid for r in headings.search_headings(frame, "pmid", "terms", narrower).collect())

    assert found("Rodents") == [1, 2, 2, 6]
    assert found("animals", "Cats", None) == [1, 2, 2, 3, 6]
    assert found("cats") == [2, 2, 3]
    assert found() == []
    assert headings.heading_closure(table(spark, edges[:0])).count() == 0
