"""Mixing sources to target weights by systematic sampling.

A source's target is its share of all words by weight, at most ``max_repeat``
times its own words.  Every document of a source expects target / words copies.
Documents are put in order of size, expected copies are summed along that order
from one random offset per source, and a document is emitted once for every whole
number its interval crosses.  As neighbours in that order are alike in size, the
words taken stay close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wagerscope.llm.common import WORD, prefix_sums, row_keys, stored, table, whole


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the source and the seed only."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0


def targets(sized: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """``source, source_size, target``: one row per source of ``sized`` (``source, size``).

    Sources in code-point order, null last, take the weights in turn.  The words
    of all sources are shared by weight; what a source has no room for (its words
    times ``max_repeat``) is shared again among those with room.  With sources in
    order of room per weight, the full ones come first, and the others get what
    is left in proportion to their weight.  The windows hold one row per source.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(cycle, (turn % len(weights)) + 1))
    room = F.col("source_size") * max_repeat
    ordered = W.orderBy(room / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    ranked = weighed.select(
        "*",
        F.row_number().over(ordered).alias("place"),
        (F.sum("source_size").over(everything) - F.coalesce(
            F.sum(room).over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("left"),
        F.sum("weight").over(ordered.rowsBetween(0, W.unboundedFollowing)).alias("weight_left"),
    )
    # full: its room is not above its share of what the fuller ones leave
    full = room * F.col("weight_left") <= F.col("left") * F.col("weight")
    first = F.min(F.when(~full, F.struct("place", "left", "weight_left"))).over(everything)
    return ranked.withColumns({"full": full, "first": first}).select(
        "source",
        "source_size",
        F.when(F.col("full"), room.cast("double"))
        .otherwise(F.col("weight") * F.col("first.left") / F.col("first.weight_left"))
        .alias("target"),
    )


def copies(sized: DataFrame, weights: tuple[int, ...], max_repeat: int, seed: int) -> DataFrame:
    """``sized`` (``source, size, n`` and columns that order equal sizes) with totals and copies.

    ``n`` counts equal rows; ``first`` is how many rows of the source lie before
    them.  Row j of them is emitted ``crossed(first + j)`` times.
    """
    wanted = targets(sized.select("source", (F.col("size") * F.col("n")).alias("size")), weights, max_repeat)
    order = [c for c in sized.columns if c not in ("source", "size", "n")]
    placed = prefix_sums(sized, ["source"], ["size", *order], "n", "first")
    named = wanted.withColumnRenamed("source", "_source")
    return placed.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _crossed(rank: Column, rows: Column | int, seed: int) -> Column:
    """Whole numbers crossed by the expected copies of ``rows`` documents from place ``rank`` on."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _offset(F.col("source"), seed)
    return (F.floor(rate * (rank + rows) + offset) - F.floor(rate * rank + offset)).cast("long")


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 42
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    Size counts the words of the text; null and blank texts have none and take
    none.  A null source is a source of its own.  Equal rows (id, source and size)
    are placed one after the other.  A source without words gets target 0.  Reruns
    agree.  Other columns are ignored; an empty table gives no rows.
    """
    sized = stored(
        docs.select("doc_id", "source", words(F.col("text")).alias("size"))
        .groupBy("source", "size", "doc_id")
        .agg(F.count("*").alias("n"))
    )
    placed = copies(sized, weights, max_repeat, seed)
    rows = placed.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.withColumn("copies", _crossed(F.col("first") + F.col("j") - 1, 1, seed)).select(
        "doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emitted(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 42
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows are matched by their content; equal rows are carried once until their
    copies are made, so a row repeated without end is not gathered in one task.
    """
    k1, k2 = row_keys(docs.columns)
    keys = [k1.alias("_k1"), k2.alias("_k2")]
    sized = stored(
        docs.select(*keys, "source", "doc_id", words(F.col("text")).alias("size"))
        .groupBy("source", "size", "doc_id", "_k1", "_k2")
        .agg(F.count("*").alias("n"))
    )
    placed = copies(sized, weights, max_repeat, seed)
    times = placed.select("_k1", "_k2", _crossed(F.col("first"), F.col("n"), seed).alias("_times")).filter("_times > 0")
    once = docs.select(whole(docs.columns), *keys).dropDuplicates(["_k1", "_k2"])
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_copy")
    return once.join(times, ["_k1", "_k2"]).select("_row", repeated).select("_row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, sum(size) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s
), r AS (
  SELECT *, source_size * 3 AS room FROM w
), k AS (
  SELECT *, row_number() OVER o AS place,
    (SELECT sum(source_size) FROM s) - coalesce(sum(room) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM r WINDOW o AS (ORDER BY room / weight, source NULLS LAST)
), f AS (
  SELECT place AS p, remaining AS l, weight_left AS wl FROM k WHERE NOT room * weight_left <= remaining * weight
  ORDER BY place LIMIT 1
), t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN room * weight_left <= remaining * weight THEN CAST(room AS DOUBLE)
      ELSE CAST(weight * (SELECT l FROM f) AS DOUBLE) / CAST((SELECT wl FROM f) AS DOUBLE) END AS target,
    CAST(CAST('0x' || substr(md5('42:' || coalesce('s' || source, 'n')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM k
), n AS (
  SELECT doc_id, source, size,
    row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS i FROM d
), x AS (
  SELECT n.doc_id, n.size, n.i, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(floor(rate * i + u) - floor(rate * (i - 1) + u) AS BIGINT) * size AS taken FROM x
"""
