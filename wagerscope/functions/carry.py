"""Carried ordered state: continue running balances, streaks and previous bets across loads.

``ordered_state`` needs every earlier row of a key.  When the log arrives in
loads (days appended to the dated store), the earlier rows are summed up in one
state row per key instead: its running total, its open losing and winning runs,
the values of its last row and that row's order.  A new load is sequenced on
its own rows, and the state of each key is added on:

* running sums: plus the carried total;
* runs: a run that reaches back to the first row of the load (its length is
  the row's position in the load) continues the carried open run of its kind;
* previous values: the load's first row of a key takes the carried last values.

The new state comes from the last row of each key in the load (a partial
aggregate, so a key with a third of all rows is combined map-side); keys
without new rows keep theirs.  A load must hold only rows after its key's
carried last row (a late day is reloaded with the days after it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerscope.functions import scans

_POS = "_position"


def sequenced(
    tx: DataFrame,
    state: DataFrame | None,
    sums: Mapping[str, str],
    previous: Mapping[str, str],
    runs: tuple[Column, str, str],
    keys: Sequence[str] = ("player_id", "session_id"),
    order: Sequence[str] = ("timestamp", "transaction_id"),
    slice_seconds: int = scans.SLICE_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, new_state)``: the load ``tx`` sequenced as if the earlier loads were there.

    ``state`` is what an earlier call returned (None before the first load).
    ``rows`` has the columns of ``tx`` and the named outputs, like
    ``scans.ordered_state``; ``new_state`` has one row per key seen so far.
    """
    keys, order = list(keys), list(order)
    _, misses, hits = runs
    local = scans.ordered_state(
        tx.withColumn("_one", F.lit(1).cast("long")),
        sums={**sums, "_one": _POS}, previous=previous, runs=runs, keys=keys, order=order,
        slice_seconds=slice_seconds,
    )
    if state is None:
        rows = local
    else:
        carried = state.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in state.columns if c not in keys])
        rows = local.join(carried, keys, "left")
        out = {}
        for c, name in sums.items():
            out[name] = (F.col(name) + F.coalesce(f"_c_{name}", F.lit(0))).cast(tx.schema[c].dataType)
        for name in (misses, hits):
            whole = F.col(name) == F.col(_POS)
            out[name] = F.when(whole, F.col(name) + F.coalesce(f"_c_{name}", F.lit(0))).otherwise(
                F.col(name)).cast("int")
        for name in previous.values():
            out[name] = F.when(F.col(_POS) == 1, F.col(f"_c_{name}")).otherwise(F.col(name))
        rows = rows.withColumns(out).drop(*[c for c in rows.columns if c.startswith("_c_")])
    rows = rows.drop("_one")
    last = F.max_by(
        F.struct(*[F.col(n) for n in sums.values()], F.col(misses), F.col(hits),
                 *[F.col(c).alias(n) for c, n in previous.items()],  # shown as ``n`` on the next row
                 *[F.col(o).alias(f"_last_{o}") for o in order]),
        F.struct(*order),
    )
    fresh = rows.groupBy(*keys).agg(last.alias("_s")).select(*keys, "_s.*")
    if state is not None:
        fresh = fresh.unionByName(state.join(fresh.select(*keys), keys, "left_anti"))
    return rows.drop(_POS), fresh

