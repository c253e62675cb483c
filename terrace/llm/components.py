"""Connected components of a graph given by its links.

Large-star and small-star rounds alternate until all links are stars: each round hangs
neighbours on the smallest node they know.  A round is an aggregate, a join and a
``distinct`` over written tables, so a lost executor costs no more than a round's tasks.
Links that are stars, as given or after a round, take no further round.  Only one number per
round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import materialize


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select(F.col("u").alias("of"), F.least("u", "least").alias("least"))
    return both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, hang on the smallest of them."""
    least = _least(links).select(F.col("u").alias("of"), "least")
    moved = links.join(least, F.col("u") == F.col("of")).where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select(F.col("of").alias("u"), F.col("least").alias("v")))


def _tangled(links: DataFrame) -> int:
    """How many nodes hang on several others, or hang on one and have others hang on them."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return counted.where("up > 1 or (up > 0 and down > 0)").count()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``links`` (two columns of one ordered type).

    ``component`` is the smallest node that can be reached.  Links to oneself and links
    with a null end say nothing and are left out.
    """
    a, b = links.columns
    current = materialize(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    while _tangled(current):
        hung = _large_star(current).where("u <> v").distinct()
        current = materialize(_small_star(hung).where("u <> v").distinct())
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
