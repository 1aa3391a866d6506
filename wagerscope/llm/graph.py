"""Connected components by alternating stars over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerscope.llm.common import stored
from wagerscope.session import work_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the ``u, v`` links; root is the smallest node reachable.

    Each round is written to the shared folder, so a lost executor costs at most
    one round.  Only three numbers per round reach the driver.  Self links and
    repeated links are ignored; no links give no rows.
    """
    spark, folder = edges.sparkSession, work_folder(edges.sparkSession)

    def settle(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        kept = stored(df.filter("u <> v").distinct(), folder, name)
        mark = F.xxhash64("u", "v")
        sums = kept.agg(
            F.count("*"), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(mark, 32))
        ).first()
        return kept, tuple(sums)

    current, state = settle(edges.select("u", "v"), "links")
    turn = 0
    while state[0]:
        turn += 1
        changed, new = settle(_small_star(_large_star(current)), f"round{turn}")
        done = new == state
        current, state = changed, new
        if done:
            break
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
