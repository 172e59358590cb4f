"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import counted, stored, work_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest neighbour; rows may repeat.

    An edge's ``v`` is its smaller end, so the least of a node and its neighbours is the least ``v`` of its edges.
    """
    ends = edges.select(F.explode(F.array("u", "v")).alias("node"), "v")
    least = ends.groupBy("node").agg(F.min("v").alias("least")).withColumnRenamed("node", "v")
    return edges.join(least, "v").select("u", F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    tied = edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return tied.where("u > v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one edge and is no edge's ``v``, so that ``v`` is its root."""
    child, root = F.struct("u", F.lit(1).alias("up")), F.struct(F.col("v").alias("u"), F.lit(0).alias("up"))
    ends = edges.select(F.explode(F.array(child, root)).alias("end")).select("end.*")
    nodes = ends.groupBy("u").agg(F.max("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return nodes.where("up = 1 and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; ``root`` is the smallest node reachable.

    ``edges`` has two columns of one ordered type without NULL. Loops are ignored. Every step
    is written to the shared folder, which cuts the lineage; only a count of the edges and whether
    they are stars reach the driver. Stars take no step. A node's neighbours are only ever
    aggregated, never collected.
    """
    folder = work_folder(edges.sparkSession, "components")
    left, right = edges.columns
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    first, count = counted(pairs.where("u > v").distinct())
    current, step = stored(first, f"{folder}/step=0"), 0
    while count() and not _are_stars(current):
        step += 1
        current = stored(_small_star(_large_star(current)), f"{folder}/step={step}")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.union(roots)


def join_sets(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of the components ``sets`` after ``links``, pairs (a, b) of any nodes, are added.

    Only the links' own roots are put into components anew; a node that is in neither has no row.
    """
    folder = work_folder(sets.sparkSession, "joined")
    a = sets.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = sets.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    between = links.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    joined = components(between.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    joined = stored(joined.select(F.col("node").alias("root"), F.col("root").alias("new")), f"{folder}/joined")
    moved = sets.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    added = joined.select(F.col("root").alias("node"), F.col("new").alias("root")).join(sets, "node", "left_anti")
    return moved.union(added)
