"""Names found in spite of misspellings: a symmetric-deletion index and the exact distance behind it.

Two texts within ``d`` edits have a common form after at most ``d`` characters are deleted from
each. All such forms of the names are a table; a text's own forms are joined to it on equality
and the edit distance decides. Case and accents are folded first. Distances are tried from 0 up,
and only what has no name yet goes on, so a text that is right costs one lookup.
"""

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import work_folder

#: Edits that are forgiven.
DISTANCE = 2
#: Forms meant for one task; short rows become very many forms, whose number Spark cannot know.
TASK_FORMS = 500_000
_LATIN = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
_PLAIN = {c: unicodedata.normalize("NFD", c)[0].lower() for c in _LATIN}
_ACCENTED = "".join(c for c, base in _PLAIN.items() if base.isascii() and base.isalpha())
_BASES = "".join(_PLAIN[c] for c in _ACCENTED)


def folded(text: Column) -> Column:
    """Lower case, Latin letters without accents, white space as single spaces, none at the ends."""
    plain = F.lower(F.translate(text, _ACCENTED, _BASES))
    return F.btrim(F.regexp_replace(plain, "\\s+", " "))


def deletions(text: Column, most: int) -> Column:
    """The text and every form of it with up to ``most`` characters deleted, each once."""

    def shorter(form: Column) -> Column:
        places = F.when(F.char_length(form) > 0, F.sequence(F.lit(1), F.char_length(form)))
        without = F.transform(places, lambda i: F.concat(F.substr(form, F.lit(1), i - 1), F.substr(form, i + 1)))
        return F.coalesce(without, F.array().cast("array<string>"))

    level, forms = F.array(text), F.array(text)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        forms = F.concat(forms, level)
    return F.array_distinct(forms)


def _form_count(rows: DataFrame, column: str, most: int) -> int:
    """How many forms the rows have at most."""
    length = F.char_length(column).cast("double")
    level = total = F.lit(1.0)
    for deleted in range(most):
        level = level * F.greatest(length - deleted, F.lit(0.0)) / (deleted + 1)
        total = total + level
    return int(rows.agg(F.sum(total)).first()[0] or 0)


def _forms(rows: DataFrame, column: str, most: int, tasks: int) -> DataFrame:
    """(column, __form), made in ``tasks`` tasks and dealt by form to as many."""
    dealt = rows.repartition(tasks, column)
    return dealt.select(column, F.explode(deletions(F.col(column), most)).alias("__form")).repartition(tasks, "__form")


def nearest_names(texts: DataFrame, text: str, names: DataFrame, name: str, distance: int = DISTANCE) -> DataFrame:
    """(text, name, distance, ties) for each distinct text that has a name within ``distance`` edits.

    The nearest name wins, among equally near ones the first by code point; ``ties`` is how many
    names are as near. Distances are those of the folded texts, so case and accents cost nothing.
    NULL texts and names find nothing. Texts without such a name are absent.

    Both sides are reduced to distinct folded texts before forms are made of them; each distance
    is one equality join of short forms, and its result is written before the next one. A task
    gets at most about ``TASK_FORMS`` forms, however many there are.
    """
    spark, folder = texts.sparkSession, work_folder(texts.sparkSession, "spelling")
    asked = texts.select(F.col(text).alias("text"), folded(F.col(text)).alias("__text")).where("text IS NOT NULL").distinct()
    asked.write.parquet(f"{folder}/texts")
    asked = spark.read.parquet(f"{folder}/texts")
    known = names.select(F.col(name).alias("name"), folded(F.col(name)).alias("__name")).where("name IS NOT NULL").distinct()
    known.write.parquet(f"{folder}/names")
    known = spark.read.parquet(f"{folder}/names")
    spelled = known.select("__name").distinct()
    open_texts, found = asked.select("__text").distinct(), []
    for edits in range(distance + 1):
        count = _form_count(open_texts, "__text", edits) + _form_count(spelled, "__name", edits)
        tasks = max(1, -(-count // TASK_FORMS))
        pairs = _forms(open_texts, "__text", edits, tasks).join(_forms(spelled, "__name", edits, tasks).hint("merge"), "__form")
        pairs = pairs.select("__text", "__name").distinct()
        near = pairs.where(F.levenshtein("__text", "__name", edits) == edits)
        near.withColumn("distance", F.lit(edits)).write.parquet(f"{folder}/edits={edits}")
        hits = spark.read.parquet(f"{folder}/edits={edits}")
        found.append(hits)
        open_texts = open_texts.join(hits.select("__text").distinct(), "__text", "left_anti")
    every = found[0]
    for hits in found[1:]:
        every = every.unionByName(hits)
    named = every.join(known, "__name").groupBy("__text").agg(
        F.min("name").alias("name"), F.first("distance").alias("distance"), F.count("*").alias("ties")
    )
    return asked.join(named, "__text").select(F.col("text").alias(text), "name", "distance", "ties")
