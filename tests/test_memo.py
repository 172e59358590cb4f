from paperloom.operators import memo
from paperloom.operators.places import Gazetteers, countries_of_texts

COUNTRIES = {"France": "France", "Peru": "Peru", "Papua New Guinea": "Papua New Guinea"}
TEXTS = ["Lab, Lyon", "Lab, Lima", "Oslo Unit", "Dept, Peru", "nowhere", "New Guinea", None, "", "Lyon"]


def cities(spark, *pairs):
    return spark.createDataFrame(pairs, "city string, address string")


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "affil string")


def kept(store):
    rows = store.table().collect()
    assert len({r.text for r in rows}) == len(rows)
    return {r.text: r.countries for r in rows}


def plain(spark, values, names):
    rows = countries_of_texts(texts(spark, {v for v in values if v is not None}), "affil", names).collect()
    return {r.affil: r.countries for r in rows}


def test_only_unseen_texts_are_resolved(spark, tmp_path):
    names = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, France"), ("Lima", "Lima, Peru")))
    store = memo.Resolutions(spark, str(tmp_path / "memo"))
    assert store.resolve(texts(spark, TEXTS[:4] * 3), "affil", names) == {"new": 4, "touched": 0}
    assert store.resolve(texts(spark, TEXTS), "affil", names) == {"new": 4, "touched": 0}
    assert store.resolve(texts(spark, TEXTS), "affil", names) == {"new": 0, "touched": 0}
    assert kept(store) == plain(spark, TEXTS, names)


def test_changed_names_redo_the_texts_that_hold_them(spark, tmp_path):
    first = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, France"), ("Lima", "Lima, Peru")))
    store = memo.Resolutions(spark, str(tmp_path / "memo"))
    store.resolve(texts(spark, TEXTS), "affil", first)
    # A city that comes, one that goes, one that moves.
    second = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, Peru"), ("Oslo", "Oslo, France")))
    assert store.resolve(texts(spark, TEXTS[:1]), "affil", second) == {"new": 0, "touched": 4}
    assert kept(store) == plain(spark, TEXTS, second)
    # A country that only an address names changes the texts of its cities.
    third = Gazetteers({"France": "France", "New Guinea": "Guinea"}, second.cities)
    assert store.resolve(texts(spark, []), "affil", third) == {"new": 0, "touched": 4}
    assert kept(store) == plain(spark, TEXTS, third)


def test_rows_get_their_kept_countries(spark, tmp_path):
    names = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, France")))
    store = memo.Resolutions(spark, str(tmp_path / "memo"))
    rows = store.countries(texts(spark, ["Lyon", "Lyon", None, "x"]), "affil", names).collect()
    assert sorted(((r.affil, r.countries) for r in rows), key=str) == sorted(
        [("Lyon", ["France"]), ("Lyon", ["France"]), (None, None), ("x", [None])], key=str
    )


def test_a_run_that_stopped_before_its_end_leaves_the_last_version(spark, tmp_path):
    names = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, France")))
    store = memo.Resolutions(spark, str(tmp_path / "memo"))
    store.resolve(texts(spark, ["Lyon"]), "affil", names)
    spark.createDataFrame([("Lyon", ["half"])], memo._MEMO).write.parquet(f"{tmp_path}/memo/version=1/texts")
    assert kept(store) == {"Lyon": ["France"]}
    moved = Gazetteers(COUNTRIES, cities(spark, ("Lyon", "Lyon, Peru")))
    assert store.resolve(texts(spark, ["Lyon"]), "affil", moved) == {"new": 0, "touched": 1}
    assert kept(store) == {"Lyon": ["Peru"]}
