"""Connected components, and rules that go through each component in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.sources.staging import staged


def compressed(parents: DataFrame) -> DataFrame:
    """id, parent with every pointer followed to its end. A round follows a pointer's pointer, so a chain halves."""
    parents = staged(parents.select("id", "parent"), "parents")
    while True:
        up = parents.select(F.col("id").alias("parent"), F.col("parent").alias("further"))
        jumped = staged(parents.join(up, "parent", "left").select("id", F.coalesce("further", "parent").alias("parent"), F.coalesce(F.col("further") != F.col("parent"), F.lit(False)).alias("moved")), "parents")
        if jumped.where("moved").isEmpty():
            return parents
        parents = jumped.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """id, root of every end of edges(a, b): the least id that it is connected with. In a round every tree hooks onto the least
    root next to it and pointers are followed to their ends, so trees at least halve in number, and a chain takes one
    round and the logarithm of its length in jumps."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    state = staged(both.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id")), "roots")
    while True:
        ends = both.join(state.select(F.col("id").alias("b"), F.col("root").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"))
        hooks = ends.join(state.withColumnRenamed("id", "a"), "a").groupBy(F.col("root").alias("id")).agg(F.min("other").alias("parent")).where("parent < id")
        hooks = staged(hooks, "hooks")
        if hooks.isEmpty():
            return state
        ends = compressed(hooks).withColumnsRenamed({"id": "root", "parent": "top"})
        state = staged(state.join(ends, "root", "left").select("id", F.coalesce("top", "root").alias("root")), "roots")
