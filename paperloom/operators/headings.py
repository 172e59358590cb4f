"""Searches for subject headings that include all narrower ones."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import work_folder


def heading_closure(tree: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(heading, narrower): every heading with itself and all headings below it.

    The tree, or any graph of headings with several parents or even circles, is closed by
    doubling: each round joins the pairs with themselves, so a tree of depth d takes about log d
    rounds, each written to the shared folder. Headings are compared in lower case; NULL has none.
    """
    spark, folder = tree.sparkSession, work_folder(tree.sparkSession, "headings")
    edges = tree.select(F.lower(parent).alias("heading"), F.lower(child).alias("narrower")).where(
        "heading IS NOT NULL AND narrower IS NOT NULL"
    )
    alone = tree.select(F.explode(F.array(F.lower(parent), F.lower(child))).alias("heading")).where("heading IS NOT NULL")
    pairs = edges.union(alone.select("heading", F.col("heading").alias("narrower"))).distinct()
    size, step = -1, 0
    while True:
        path = f"{folder}/step={step}"
        pairs.write.parquet(path)
        pairs = spark.read.parquet(path)
        count = pairs.count()
        if count == size:
            return pairs
        size, step = count, step + 1
        upper = pairs.select("heading", F.col("narrower").alias("middle"))
        lower = pairs.select(F.col("heading").alias("middle"), "narrower")
        pairs = upper.join(lower, "middle").select("heading", "narrower").distinct()


def narrower_headings(closure: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """(narrower): the wanted headings and all below them; one that the tree does not hold stays as it is."""
    terms = sorted({w.lower() for w in wanted if w})
    spark = closure.sparkSession
    named = spark.createDataFrame([(t,) for t in terms], "narrower string")
    return closure.where(F.col("heading").isin(terms)).select("narrower").union(named).distinct()


def search_headings(df: DataFrame, key: str, headings: str, narrower: DataFrame) -> DataFrame:
    """Rows with a heading among ``narrower``, by an equality join on the heading.

    Only keys and headings are joined; the rows come back by a semi-join. Rows without a key are
    not found, as there is nothing to know them by.
    """
    held = df.select(key, F.explode(headings).alias("narrower")).withColumn("narrower", F.lower("narrower"))
    hits = held.join(narrower, "narrower", "left_semi").select(key).distinct()
    return df.join(hits, key, "left_semi")
