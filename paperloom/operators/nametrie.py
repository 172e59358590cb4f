"""Names of any number found in texts by walking a trie that is a table.

Every prefix of a name is a row: what stands before, the next word and whether a name ends there.
Texts are walked one level at a time: the words at the live places are joined to the children of
the nodes reached, and a place is dropped at its first mismatch. No pattern is made of the names
and no runs of words are made ahead, so work follows the matches, not the number of names or
their lengths.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import WORD
from paperloom.operators.lookup import BROADCAST_BYTES, NULL_SALTS, attach, salt_of, sieve
from paperloom.operators.merge import stage
from paperloom.session import work_folder

ATOM = f"[{WORD}]+|[^{WORD}]"
#: What an edge takes in memory beside its path, and after how many levels live places are written.
EDGE_BYTES, LEVELS = 64, 6


def atoms(text: Column) -> Column:
    """The text cut into whole words and single other characters."""
    return F.regexp_extract_all(text, F.lit(ATOM), F.lit(0))


def name_trie(names: DataFrame, name: str) -> DataFrame:
    """(depth, before, word, is_name), one row per edge; empty and NULL names have none."""
    cut = names.select(atoms(F.col(name)).alias("atoms")).where(F.size("atoms") > 0).distinct()
    steps = F.transform(
        "atoms",
        lambda word, i: F.struct(
            i.alias("depth"),
            F.array_join(F.slice("atoms", F.lit(1), i), "").alias("before"),
            word.alias("word"),
            (i + 1 == F.size("atoms")).alias("is_name"),
        ),
    )
    edges = cut.select(F.inline(steps))
    return edges.groupBy("depth", "before", "word").agg(F.max("is_name").alias("is_name"))


def _mentions(own: DataFrame, names: DataFrame, name: str, limit_bytes: int, folder: str) -> DataFrame | None:
    """(id, mentions) of the numbered texts ``own``, (id, text), that mention a name; None without names."""
    spark = own.sparkSession
    name_trie(names, name).write.partitionBy("depth").parquet(f"{folder}/edges")
    edges = spark.read.schema("before string, word string, is_name boolean, depth int").parquet(f"{folder}/edges")
    paths = edges.select("depth", F.concat("before", "word").alias("path"), "is_name")
    room = F.sum(F.octet_length("path") + F.lit(EDGE_BYTES))
    sizes = {r["depth"]: r["room"] for r in paths.groupBy("depth").agg(room.alias("room")).collect()}
    if not sizes:
        return None
    depths = max(sizes)

    # Nearly all places are left out before anything is made of them; beside the others stand the words some name could still need.
    begins = sieve(edges.where("depth = 0"), "word")
    cut = own.select("id", atoms(F.col("text")).alias("atoms"))
    places = cut.select("id", "atoms", F.posexplode("atoms").alias("start", "path")).where(begins(F.col("path")))
    live = places.select(
        "id", "start", "path", F.slice("atoms", F.col("start") + 2, F.lit(depths)).alias("rest"),
        F.lit(0).alias("length"), F.lit(None).cast("string").alias("name"),
    )
    for depth in range(depths + 1):
        level = paths.where(F.col("depth") == depth).select("path", "is_name")
        if sizes[depth] <= limit_bytes:
            met = live.join(F.broadcast(level), "path", "left")
        else:
            met = attach(live, level, "path")
        live = met.select(
            "id", "start",
            F.when(F.col("is_name").isNotNull(), F.concat("path", F.get("rest", F.lit(0)))).alias("path"),
            F.slice("rest", F.lit(2), F.lit(depths)).alias("rest"),
            F.when(F.col("is_name"), F.lit(depth + 1)).otherwise(F.col("length")).alias("length"),
            F.when(F.col("is_name"), F.col("path")).otherwise(F.col("name")).alias("name"),
        ).where("path IS NOT NULL OR name IS NOT NULL")
        if depth % LEVELS == LEVELS - 1:
            live = stage(live, f"{folder}/level={depth}")
    hits = live.where("name IS NOT NULL").select("id", "start", "length", "name")
    ordered = F.array_sort(F.collect_list(F.struct("start", (-F.col("length")).alias("order"), "name")))
    per_text = hits.groupBy("id").agg(ordered.alias("hits"))

    def keep(state: Column, hit: Column) -> Column:
        taken = F.struct((hit["start"] - hit["order"]).alias("next"), F.concat(state["kept"], F.array(hit["name"])).alias("kept"))
        return F.when(hit["start"] >= state["next"], taken).otherwise(state)

    begin = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("kept"))
    return per_text.select("id", F.aggregate("hits", begin, keep)["kept"].alias("mentions"))


def find_names(texts: DataFrame, text: str, names: DataFrame, name: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(text, mentions) for each distinct text that mentions a name, in order of their places.

    Names are matched as whole words, case counts. The leftmost match wins, at one place the
    longest, and matches do not overlap. NULL texts have no matches.

    The trie is written and each level measured; the edges of a small one are broadcast, those of
    a larger one joined by a shuffle on the path. Live places carry the path they ask for, the few
    words still to be compared and the longest name that ended so far; a place is given up when it
    is off the trie and no name has ended. What is live is written once every ``LEVELS`` levels.
    """
    folder = work_folder(texts.sparkSession, "trie")
    own = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    own = stage(own.withColumn("id", F.monotonically_increasing_id()), f"{folder}/texts")
    found = _mentions(own, names, name, limit_bytes, folder)
    if found is None:
        return texts.select(text, F.array().cast("array<string>").alias("mentions")).limit(0)
    return own.select("id", F.col("text").alias(text)).join(found, "id").drop("id")


def with_names(
    rows: DataFrame, text: str, names: DataFrame, name: str, into: str = "mentions", limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every row without its ``text``, but with the mentions ``find_names`` gives for it; NULL where it has none.

    Rows are moved once with their text, which gives rows of equal texts one number, and written
    with it; the first row of a text keeps it. From there on only numbers are moved. Rows of one
    text pass one task, as a stream; those without a text are spread.
    """
    folder = work_folder(rows.sparkSession, "trie")
    others = [c for c in rows.columns if c != text]
    salt = F.when(F.col(text).isNull(), salt_of(others, NULL_SALTS)).otherwise(F.lit(0))
    dealt = rows.withColumn("__salt", salt).repartition(text, "__salt").withColumn("__row", F.monotonically_increasing_id())
    number = F.min("__row").over(Window.partitionBy(text, "__salt").orderBy("__row"))
    numbered = dealt.withColumn("__id", number).withColumn("__text", F.when(F.col("__id") == F.col("__row"), F.col(text)))
    numbered = stage(numbered.select("__id", "__text", *others), f"{folder}/rows")
    own = numbered.where("__text IS NOT NULL").select(F.col("__id").alias("id"), F.col("__text").alias("text"))
    found = _mentions(own, names, name, limit_bytes, folder)
    if found is None:
        return numbered.select(*others, F.lit(None).cast("array<string>").alias(into))
    found = found.withColumnsRenamed({"id": "__id", "mentions": into})
    return numbered.join(found, "__id", "left").select(*others, into)
