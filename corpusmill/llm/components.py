"""Connected components of a link table, as DataFrame joins.

Each round orders the nodes anew by a hash salted with the round's number, maps
a node to the first of itself and its neighbours and rewrites the links through
that map. No numbering of the nodes can make long runs of ever smaller
neighbours, so a constant share of the linked nodes is expected to go each round,
the rounds to grow with the logarithm of the largest component, and the links to
shrink with each. At the end a component takes its smallest node's name. Every round's map is written to the
checkpoint folder. A node with very many links is one key of a partially
aggregated minimum and of a join that Spark splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of each linked node's component.
    Nodes without a link to another are absent. ``links`` may repeat and hold
    loops; null ends are ignored."""
    rest = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    maps: list[DataFrame] = []
    while not rest.isEmpty():
        both = rest.unionAll(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        salt = F.lit(len(maps))
        own = F.struct(F.xxhash64("node", salt).alias("h"), F.col("node").alias("v"))
        first = F.min(F.struct(F.xxhash64("b", salt).alias("h"), F.col("b").alias("v")))
        step = both.groupBy(F.col("a").alias("node")).agg(first.alias("first")) \
                   .select("node", F.least(own, F.col("first"))["v"].alias("to"))
        maps.append(cut(step, "component-map"))
        step = maps[-1]
        rest = cut(
            rest.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links")
    if not maps:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[0].select("node", F.col("to").alias("component"))
    for step in maps[1:]:
        out = out.join(step.select(F.col("node").alias("component"), "to"), "component", "left") \
                 .select("node", F.coalesce("to", "component").alias("component"))
    out = cut(out, "component-ends")
    names = out.groupBy("component").agg(F.min("node").alias("name"))
    return out.join(names, "component").select("node", F.col("name").alias("component"))
