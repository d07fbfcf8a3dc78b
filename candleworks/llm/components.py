"""Connected components of an edge table, by alternating star contractions.

Every round rewrites the edges so that nodes point at smaller and smaller nodes of their
component; it ends when nothing changes, after about log(n) rounds. No round gathers the
neighbours of a node: the smallest neighbour is an aggregate with map-side combine, and
the join back on a hot node can be split. Each round's edges are written to the shared
work folder, so a lost executor costs one round, not the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.session import staged


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _smaller_to_smallest(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges run from a to b < a."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges but the roots; root is its least node."""
    edges = staged(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges = staged(_smaller_to_smallest(_to_smallest(edges)), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def least_of_class(marked: DataFrame, key, row: str) -> DataFrame:
    """(class, best) for each value of key; best sorts the rows: smallest id, then the text's
    hash, then the row number. Rows without an id come last."""
    order = F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("hash"), F.col(row).alias("row")
    )
    return marked.groupBy(key.alias("class")).agg(F.min(order).alias("best"))


def one_row_per_group(marked: DataFrame, classes: DataFrame, roots: DataFrame, row: str) -> DataFrame:
    """The rows of marked that are the best of their component. classes: node, best."""
    rooted = classes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "best")
    best = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    return marked.join(best, row, "left_semi")
