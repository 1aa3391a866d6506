"""What the corpus operators share: reading tables, shared-folder tables, row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from wagerscope.session import work_folder

#: White space of the contracts: space and \t \n \v \f \r.  A word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, folder: str | None = None, name: str = "table") -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage without depending on any executor's memory or disk.
    """
    path = f"{folder or work_folder(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the named columns: a 128-bit key of the row's content."""
    cols = [F.col(f"`{c}`") for c in columns]
    flags = [c.isNull() for c in cols]
    return F.xxhash64(*cols, *flags), F.xxhash64(F.lit("second"), *flags, *cols)


def whole(columns: Sequence[str]) -> Column:
    """The row as one struct ``_row``, so that no name of the table meets an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows before it in its group.

    Rows are dealt by ranges of (group, order), so one group may hold any share
    of the rows; each range gets the totals of the ranges before it.  Order
    columns should make rows distinct: ties get one of their possible orders.
    """
    keys = [*group, *order]
    ranged = stored(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum(value).alias("_total"))
        .select(
            *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
            F.col("_range").alias("_r"),
            F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
        )
    )
    on = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = W.partitionBy("_range", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, on)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_range", "_r", "_total", "_before", "_inside", *[f"_g{i}" for i in range(len(group))])
    )
