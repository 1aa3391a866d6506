"""Exact quantiles by radix selection: no sort, no value ranges, no hot task.

Each value becomes an order-preserving 64-bit key (its unscaled decimal, sign
bit flipped, so unsigned order is value order).  The ranks a quantile needs are
found digit by digit, 16 bits at a time from the top: a pass counts the rows of
each group whose key starts with the prefix found so far, per next digit; the
counts are partial aggregates (a value held by a third of all rows is one count
per task before the shuffle), and a window over at most 65,536 digits per
target picks the digit holding the rank.  Four passes fix all 64 bits.  The
keys are stored once, so a pass reads only them, whatever joins ``df`` is made
of, and joins them with the small table of targets, which is stored too, so
Spark's size check can broadcast it.

Only exact numbers (integers and decimals) have such keys here; doubles use
``scans.exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wagerscope.session import work_folder

DIGIT = 16


def _top() -> Column:
    """The sign bit of a long."""
    return F.lit(-(1 << 63)).cast("long")


def _ushr(col: Column, bits: int) -> Column:
    return F.call_function("shiftrightunsigned", col, F.lit(bits))


def radix_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``by`` group, like ``scans.exact_quantiles``.

    Null values are left out; a group without values gives no row.  The rank of
    quantile ``p`` is ``p * (n - 1)``; the values at its floor and ceiling are
    found exactly and interpolated in doubles.
    """
    grouped = bool(by)
    by = list(by) or ["_all"]  # one constant group: joins stay equi-joins
    df = df if grouped else df.withColumn("_all", F.lit(0))
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        scale = kind.scale
        unscaled = (F.col(value) * F.lit(10**scale)).cast("long") if scale else F.col(value).cast("long")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        scale, unscaled = 0, F.col(value).cast("long")
    else:
        raise TypeError(f"radix keys need an exact number, not {kind.simpleString()}")
    folder = work_folder(df.sparkSession)
    keys = df.where(F.col(value).isNotNull()).select(*by, unscaled.bitwiseXOR(_top()).alias("_u"))
    keys = _stored(keys, folder, "keys")

    sizes = keys.groupBy(*by).agg(F.count("*").alias("_n"))
    ranks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1)
        ranks += [F.struct(F.lit(name).alias("q"), F.lit("lo").alias("side"), F.floor(at).cast("long").alias("r")),
                  F.struct(F.lit(name).alias("q"), F.lit("hi").alias("side"), F.ceil(at).cast("long").alias("r"))]
    targets = sizes.select(*by, "_n", F.inline(F.array(*ranks))).withColumns(
        {"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
    targets = _stored(targets, folder, "level0")
    on = [*by, "q", "side"]
    for level in range(64 // DIGIT):
        known = DIGIT * level
        digit = _ushr(F.col("_u"), 64 - known - DIGIT).bitwiseAND(F.lit((1 << DIGIT) - 1))
        match = F.lit(True) if known == 0 else (_ushr(F.col("_u"), 64 - known) == F.col("prefix"))
        counted = (
            keys.alias("k").join(targets.alias("t"), [F.col(f"k.{g}").eqNullSafe(F.col(f"t.{g}")) for g in by])
            .where(match)
            .groupBy(*[F.col(f"t.{g}").alias(g) for g in by], "q", "side", "r", "prefix", "below",
                     digit.alias("d"))
            .agg(F.count("*").alias("c"))
        )
        order = Window.partitionBy(*on).orderBy("d")
        before = F.coalesce(F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = counted.withColumn("_before", F.col("below") + before)
        chosen = placed.where((F.col("_before") <= F.col("r")) & (F.col("r") < F.col("_before") + F.col("c")))
        targets = _stored(
            chosen.select(*by, "q", "side", "r",
                          (F.call_function("shiftleft", F.col("prefix"), F.lit(DIGIT)) + F.col("d")).alias("prefix"),
                          F.col("_before").alias("below"),
                          F.lit(0).cast("long").alias("_n")),
            folder, f"level{level + 1}",
        )
    number = F.col("prefix").bitwiseXOR(_top())
    found = targets.select(*by, "q", "side",
                           (number.cast("double") / F.lit(10.0**scale)).alias("v"))
    weights = sizes.select(*by, *[
        (F.lit(float(p)) * (F.col("_n") - 1) - F.floor(F.lit(float(p)) * (F.col("_n") - 1))).alias(f"_w_{name}")
        for name, p in probs.items()])
    wide = found.groupBy(*by).pivot("q", list(probs)).agg(
        F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("lo"),
        F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("hi"))
    on = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in by]  # a null group is a group
    joined = wide.alias("a").join(weights.alias("b"), on).select(
        *[F.col(f"a.{g}").alias(g) for g in by], *[F.col(f"a.{n}_{s}") for n in probs for s in ("lo", "hi")],
        *[F.col(f"b._w_{n}") for n in probs])
    return joined.select(*(by if grouped else []), *[
        (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"_w_{n}")).alias(n) for n in probs])


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
