"""Ordered computations that never bring one key's rows into one task.

A plain window over a key sorts all of the key's rows in a single task.  The
helpers here cut each key's order into slices, work inside the slices in
parallel, and carry the state across slices over one summary row per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 3600
SLICE_BYTES = 4 << 20


def sliced(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` into slices of about ``SLICE_BYTES`` of the files it reads.

    Adaptive execution joins small partitions until they reach its advisory
    size, which is millions of narrow rows; aggregates and sorts over them take
    gigabytes.  Slices are not joined, so a task's memory stays the same
    however large the tables are.  Tables without files are left as they are.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for file in set(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    if not size:
        return df
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-size // SLICE_BYTES)), *cols)


def sums_and_distinct(
    folded: DataFrame, by: Sequence[str], sums: Sequence[str], distinct: Mapping[str, str]
) -> DataFrame:
    """Per ``by`` group: the sum of each of ``sums``, and ``distinct[name]``'s distinct values.

    Each row becomes one mark per distinct column, the first of which carries
    the sums.  Marks of one value are folded in slices and then counted, so no
    task holds all values of a group.
    """
    kinds = {f.name: f.dataType for f in folded.schema.fields}
    values = {name: f"_v{i}" for i, name in enumerate(distinct)}

    def only(c: str, mine: bool) -> Column:
        return F.col(c) if mine else F.lit(None).cast(kinds[c])

    marks = [
        F.struct(
            F.lit(i).alias("_mark"),
            *[only(distinct[n], n == name).alias(v) for n, v in values.items()],
            *[only(s, i == 0).alias(s) for s in sums],
        )
        for i, name in enumerate(distinct)
    ]
    keys = [*by, "_mark", *values.values()]
    cells = sliced(folded.select(*by, F.inline(F.array(*marks))), *keys).groupBy(*keys).agg(
        *[F.sum(s).alias(s) for s in sums]
    )
    return cells.groupBy(*by).agg(
        *[F.sum(s).alias(s) for s in sums], *[F.count(v).alias(n) for n, v in values.items()]
    )


def _before(*keys: str, order: list[Column]) -> Window:
    return (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )


def sessionize(
    tx: DataFrame,
    gap_seconds: int = 12 * 3600,
    player: str = "player_id",
    ts: str = "timestamp",
    out: str = "session_no",
) -> DataFrame:
    """Number each player's sessions from 1; a pause longer than the gap starts one.

    Two bets in the same slot of ``gap_seconds`` are never further apart than
    the gap, so sessions can only break between slots.  Breaks are therefore
    found on one row per (player, slot) and joined back; rows are never sorted.
    """
    slotted = tx.withColumn("_slot", F.floor(F.unix_timestamp(ts) / gap_seconds))
    slots = slotted.groupBy(player, "_slot").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    order = Window.partitionBy(player).orderBy("_slot")
    pause = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(order))
    starts = slots.withColumn(
        "_start", F.when(pause.isNull() | (pause > gap_seconds * 1_000_000), 1).otherwise(0)
    ).select(player, "_slot", F.sum("_start").over(order).alias(out))
    return slotted.join(starts, [player, "_slot"]).drop("_slot")


def ordered_state(
    tx: DataFrame,
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    runs: tuple[Column, str, str] | None = None,
    keys: Sequence[str] = ("player_id", "session_id"),
    order: Sequence[str] = ("timestamp", "transaction_id"),
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add what a row knows of its key's rows so far, in one pass over the rows.

    * ``sums[c]``: running sum of ``c``, this row included
    * ``previous[c]``: value of ``c`` on the row before
    * ``runs = (hit, misses, hits)``: lengths of the current run of misses and
      of hits, this row included

    Rows are sorted inside (key, slice of time) only.  One summary row per
    slice carries sums, last values and open runs into the slices after it.
    A run's length is the row's position minus that of the last opposite
    outcome, so only positions have to be carried.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    keys, slice_keys = list(keys), [*keys, "_slice"]
    w = Window.partitionBy(*slice_keys).orderBy(*order)
    to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = tx.withColumn("_slice", F.floor(F.unix_timestamp(order[0]) / slice_seconds))
    here = here.withColumn("_hit", runs[0] if runs else F.lit(None).cast("boolean"))
    position = F.row_number().over(w)
    hit_at = F.when(F.col("_hit"), F.col("_rn"))
    miss_at = F.when(~F.col("_hit"), F.col("_rn"))

    local = {f"_sum_{c}": F.sum(c).over(to_here) for c in sums}
    local |= {f"_prev_{c}": F.lag(c).over(w) for c in previous}
    if runs:
        local |= {"_hit_at": F.max(hit_at).over(to_here), "_miss_at": F.max(miss_at).over(to_here)}
    rows = here.withColumn("_rn", position).withColumns(local)

    # The summary reads only the columns it needs, and ranks rows only for runs.
    used = dict.fromkeys([*slice_keys, *order, "_hit", *sums, *previous])
    narrow = here.select(*used)
    ends = [F.sum(c).alias(f"_total_{c}") for c in sums]
    if previous:
        ends.append(F.max_by(F.struct(*previous), F.struct(*order)).alias("_last"))
    if runs:
        narrow = narrow.withColumn("_rn", position)
        ends += [
            F.max("_rn").alias("_n"),
            F.max(hit_at).alias("_hit_at"),
            F.max(miss_at).alias("_miss_at"),
        ]
    slices = narrow.groupBy(*slice_keys).agg(*ends)
    past = _before(*keys, order=[F.col("_slice")])
    carried = [F.sum(f"_total_{c}").over(past).alias(f"_carry_{c}") for c in sums]
    if previous:
        in_order = Window.partitionBy(*keys).orderBy("_slice")
        carried.append(F.lag("_last").over(in_order).alias("_carry_last"))
    if runs:
        slices = slices.withColumn("_base", F.coalesce(F.sum("_n").over(past), F.lit(0)))
        for side in ("hit", "miss"):
            last = F.max(F.col("_base") + F.col(f"_{side}_at")).over(past)
            open_run = F.col("_base") - F.coalesce(last, F.lit(0))
            carried.append(open_run.alias(f"_since_{side}"))
    joined = rows.join(slices.select(*slice_keys, *carried), slice_keys, "left")

    out = {}
    for c, name in sums.items():
        total = F.col(f"_sum_{c}") + F.coalesce(f"_carry_{c}", F.lit(0))
        out[name] = total.cast(tx.schema[c].dataType)
    for c, name in previous.items():
        out[name] = F.when(F.col("_rn") == 1, F.col("_carry_last")[c]).otherwise(
            F.col(f"_prev_{c}")
        )
    if runs:
        for side, name in (("hit", runs[1]), ("miss", runs[2])):
            since = 0 - F.coalesce(f"_since_{side}", F.lit(0))
            out[name] = (F.col("_rn") - F.coalesce(f"_{side}_at", since)).cast("int")
    kept = [F.col(c) for c in tx.columns if c not in out]
    return joined.select(*kept, *[c.alias(name) for name, c in out.items()])


def value_range(value: Column, bits: int = 7) -> Column:
    """A number that grows with ``value`` and is shared by values within about 1 %.

    Each power of two above ``|value| + 1`` is cut into ``2 ** bits`` equal
    parts, so even values of all sizes make only some thousand ranges.  It
    needs no look at the data, so it is the same wherever it is computed.
    """
    size = F.abs(value.cast("double")) + 1.0
    power = F.floor(F.log2(size))
    position = power + size / F.pow(F.lit(2.0), power) - 1.0
    return (F.signum(value.cast("double")) * F.floor(position * 2**bits)).cast("int")


def totals_before(
    cells: DataFrame,
    value: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    tie: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<m>_before`` (sum over the cells ordered earlier) and ``<m>_all`` for each measure.

    The global order is cut into value ranges.  Each range is summed on its own
    and shifted by the totals of the ranges before it, which are one row per
    range and ``by`` group.
    """
    by = list(by)
    ranged = cells.withColumn("_range", value_range(F.col(value)))
    groups = by or ["_one"]
    if not by:
        ranged = ranged.withColumn("_one", F.lit(1))
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = _before(*groups, "_range", order=[direction(value), *[F.col(c) for c in tie]])
    local = ranged.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_in") for m in measures]
    )
    earlier = _before(*groups, order=[direction("_range")])
    whole = Window.partitionBy(*groups)
    shifts = (
        ranged.groupBy(*groups, "_range")
        .agg(*[F.sum(m).alias(f"_{m}_sum") for m in measures])
        .select(
            *groups,
            "_range",
            *[
                F.coalesce(F.sum(f"_{m}_sum").over(earlier), F.lit(0)).alias(f"_{m}_shift")
                for m in measures
            ],
            *[F.sum(f"_{m}_sum").over(whole).alias(f"{m}_all") for m in measures],
        )
    )
    on = [F.col("a._range") == F.col("b._range")]
    on += [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in by]
    joined = local.alias("a").join(shifts.alias("b"), on)
    return joined.select(
        *[F.col(f"a.{c}").alias(c) for c in cells.columns],
        *[(F.col(f"_{m}_in") + F.col(f"_{m}_shift")).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_all") for m in measures],
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Interpolated quantiles of ``value``: one row, or one per ``by`` group.

    Equal values are counted first (``weight`` = how often a row counts); the
    ranks then come from running totals over the distinct values, so no task
    holds all values of a group.
    """
    by = list(by)
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("n"))
    ranked = totals_before(counts, value, ["n"], by=by)
    aggs = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("n_all") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            aggs.append(F.max(F.when(holds, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_{name}_w"))
    grouped = ranked.groupBy(*by).agg(*aggs)
    return grouped.select(
        *by,
        *[
            (
                F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_w")
            ).alias(n)
            for n in probs
        ],
    )
