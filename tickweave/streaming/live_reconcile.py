"""Live reconciliation: broker bars and landed bars compared as they arrive.

A stream-stream outer join on (instrument, bar time), both sides watermarked: a
pair comes out at once, a bar without a partner when the watermark passes its
time, and the state of passed bars is given up. Bars that come after that are
dropped by the join. They are not lost: both sides are stored, and
:func:`settle` compares again exactly the bars that the stream's result lacks
on some side (late ones, and those still waiting when it stopped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.operators.reconcile import reconcile_volume
from tickweave.streaming.live_bars import event_time

KEYS = ("instrument", "bar_start")
API, LANDED = "_api", "_s3"


def live_reconcile(api: DataFrame, landed: DataFrame, delay: str = "5 minutes", **kw) -> DataFrame:
    """Both bar streams compared, in append mode; columns as in :func:`reconcile_volume` with ``full_outer``.

    ``delay``: how far bars of one side may come behind the latest of either
    side before a partner is no longer waited for.
    """
    sides = [event_time(s, "bar_start").withWatermark("bar_start", delay) for s in (api, landed)]
    out = reconcile_volume(*sides, how="full_outer", **kw)
    for c in ("bar_start" + API, "bar_start" + LANDED):
        out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return out


def _same(keys, other) -> F.Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(other(k)))
    return cond


def unsettled(streamed: DataFrame, api: DataFrame, landed: DataFrame) -> DataFrame:
    """``instrument, bar_start`` (distinct) of stored bars that the streamed result lacks on their side."""
    out = None
    for side, suffix in ((api, API), (landed, LANDED)):
        seen = streamed.where(F.col("bar_start" + suffix).isNotNull()).select(
            *[F.col(k + suffix).alias(f"__{k}") for k in KEYS])
        lacking = side.select(*KEYS).join(seen, _same(KEYS, lambda k: f"__{k}"), "left_anti")
        out = lacking if out is None else out.unionByName(lacking)
    return out.distinct()


def settle(streamed: DataFrame, api: DataFrame, landed: DataFrame, **kw) -> DataFrame:
    """The full comparison: the streamed result, with unsettled bars compared again from the stored sides.

    ``api`` and ``landed`` are the stored bars of both sides, one per
    (instrument, bar time) and side. Equal to the batch comparison of all of
    them, whatever came late.
    """
    again = unsettled(streamed, api, landed).select(*[F.col(k).alias(f"__{k}") for k in KEYS])
    same = _same(KEYS, lambda k: f"__{k}")
    redone = reconcile_volume(api.join(again, same, "left_semi"), landed.join(again, same, "left_semi"), how="full_outer", **kw)
    keys = {k: F.coalesce(F.col(k + API), F.col(k + LANDED)) for k in KEYS}
    kept = streamed.withColumns(keys).join(again, same, "left_anti").drop(*KEYS)
    return kept.select(*redone.columns).unionByName(redone)
