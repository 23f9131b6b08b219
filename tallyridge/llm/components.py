"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyridge.llm.tables import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root itself left out; the root is the component's smallest.

    Alternates large-star and small-star steps until the edges stop changing: a logarithmic number of rounds, each of
    grouped minima and equi-joins (a node with very many neighbours is combined before the shuffle, and its join is
    split). Each round is written to the shared folder, so lineage stays short. Loops and repeated edges do no harm.
    """
    now, last = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = staged(small.select("e.a", "e.b").where("a <> b").distinct())
