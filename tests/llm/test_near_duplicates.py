import random

import numpy as np
import pytest
import xxhash

from llm_rows import docs  # noqa: F401
from paperloom.llm import simhash
from paperloom.llm.components import components, join_sets
from paperloom.session import stored


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    width = min(4, len(words))
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_sets(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (int(values[i]) ^ int(values[j])).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b", "a B c d e f g", "x " * 500, "é É Über straße a b c"])
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("same", [1, 2, 3])
def test_every_pair_within_the_radius_agrees_on_a_mask(same):
    draw = random.Random(3)
    masks = simhash.block_masks(4, same)
    for _ in range(500):
        flips = draw.sample(range(64), 4)
        assert any(not any(m >> f & 1 for f in flips) for m in masks)


@pytest.mark.parametrize("searches", [3, 4096])
def test_gray_index_links_what_brute_force_links(monkeypatch, searches):
    monkeypatch.setattr(simhash, "SEARCHES", searches)
    monkeypatch.setattr(simhash, "FRONTIER", 40)
    draw = random.Random(searches)
    centres = [draw.getrandbits(64) for _ in range(6)]
    values = sorted({c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for c in centres for _ in range(30)})
    values = np.array(values, dtype=np.uint64)
    values = values[np.argsort(simhash.gray_rank(values))]
    found = simhash.linked_sets(np.ones(len(values), dtype=int), values, 4)
    want = brute_sets(values, 4)
    assert [[i for i in range(len(values)) if found[i] == f] for f in found] == [[i for i in range(len(values)) if want[i] == w] for w in want]


def test_groups_do_not_mix():
    values = np.array([5, 5, 7], dtype=np.uint64)
    assert simhash.linked_sets(np.array([1, 2, 2]), values, 4).tolist() == [0, 1, 1]


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (2, 1)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {i: 1 for i in range(1, 21)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_all_kinds_of_rows(docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (3, base.upper().replace("W", "w")), (5, base + " tail"), (1, "quite another text of its own"), (2, None), (4, ""), (6, " \n "), (6, " \n "), (None, base), (None, "nobody knows me here at all")]
    frame = docs(rows).withColumnRenamed("lang", "component_id")
    found = [(r.doc_id, r.component_id, r.fingerprint) for r in simhash.near_duplicates(frame).collect()]
    assert len(found) == len(rows)
    by_text = {(i, f"{brute_fingerprint(t):016x}") for i, t in rows}
    assert {(i, f) for i, _, f in found} == by_text
    assert {i: c for i, c, _ in found if i} == {9: 3, 3: 3, 5: 3, 1: 1, 2: 2, 4: 2, 6: 2}
    assert sorted((c for i, c, _ in found if i is None), key=str) == [3, None]
    assert simhash.near_duplicates(docs([])).count() == 0


def test_one_document_of_each_group_stays(docs):
    text = " ".join(f"w{i}" for i in range(300))
    kept = simhash.one_of_each_group(docs([(4, text), (8, text), (2, "short"), (None, "alone")]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(4, text), (2, "short"), (None, "alone")], key=str)


def test_exactly_one_row_of_each_group_stays(docs):
    one, two, three = (" ".join(f"{c}{i}" for i in range(300)) for c in "abc")
    rows = [(1, one), (1, one), (7, one), (2, two), (2, three), (9, three), (None, "no id here"), (None, "no id here"), (None, "nor is there one at this place"), (None, one)]
    kept = simhash.one_of_each_group(docs(rows)).collect()
    want = [(1, one), (2, two), (2, three), (None, "no id here"), (None, "nor is there one at this place")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_stored_tables_are_read_with_the_schema_they_were_written_with(spark, tmp_path):
    frame = spark.range(5).selectExpr("id", "cast(id as string) as name")
    _, writing = jobs_of(spark, "write alone", lambda: frame.write.parquet(str(tmp_path / "a")))
    kept, both = jobs_of(spark, "write and read", lambda: stored(frame, str(tmp_path / "b")))
    assert both == writing and sorted(kept.collect()) == sorted(frame.collect())


def test_components_take_their_state_while_they_write(spark, tmp_path, monkeypatch):
    """One query for a step, and none beyond the first write where there are no edges."""
    written = []
    monkeypatch.setattr("paperloom.llm.components.stored", lambda frame, path: written.append(path) or stored(frame, path))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0 and len(written) == 1
    written.clear()
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (7, 7)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert len(written) >= 2


def test_stars_take_no_step_and_a_step_few_jobs(spark, monkeypatch):
    written = []
    monkeypatch.setattr("paperloom.llm.components.stored", lambda frame, path: written.append(path) or stored(frame, path))
    stars = spark.createDataFrame([(1, i) for i in range(2, 30)] + [(40, 41)], "a long, b long")
    found, jobs = jobs_of(spark, "stars", lambda: {r.node: r.root for r in components(stars).collect()})
    assert found == {i: 1 for i in range(1, 30)} | {40: 40, 41: 40} and len(written) == 1
    chain = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    _, more = jobs_of(spark, "chain", lambda: components(chain).collect())
    assert len(written) == 3 and more - jobs <= 9


def test_sets_are_joined_by_links_of_old_and_new_nodes(spark):
    draw = random.Random(5)
    for links in ([], [(3, 3)], [(draw.randrange(60), draw.randrange(60)) for _ in range(15)]):
        edges = [(draw.randrange(40), draw.randrange(40)) for _ in range(20)]
        frames = [spark.createDataFrame(e, "a long, b long") for e in (edges, links)]
        want = {r.node: r.root for r in components(frames[0].union(frames[1])).collect()}
        rows = join_sets(components(frames[0]), frames[1]).collect()
        assert {r.node: r.root for r in rows} == want and len(rows) == len(want)
