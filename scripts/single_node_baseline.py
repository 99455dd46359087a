"""Single-process pandas timings of the two bar steps, on the same rows as the Spark queries of that name.

A single-node figure to set beside bench.py; nothing here is used by the
library. Prints one JSON line of seconds per step.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pandas as pd

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def bars(ticks: pd.DataFrame, width: str) -> pd.DataFrame:
    """Open, high, low, close, volume and number of ticks per instrument and time bucket; columns as in the tick view."""
    ticks = ticks.sort_values(["ts", *[c for c in ticks.columns if c.startswith("seq")]])
    groups = ticks.groupby(["instrument", ticks["ts"].dt.floor(width).rename("bar_start")], sort=False)
    return groups.agg(open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"),
                      volume=("qty", "sum"), ticks=("price", "size")).reset_index()


def event_ticks() -> pd.DataFrame:
    ev = pd.read_parquet(f"{SF}/events.parquet")
    qty = ev["props"].str.extract(r'"k":\s*(\d+)')[0].astype("Int64")
    return pd.DataFrame({"instrument": ev["event_type"], "ts": ev["ts"], "price": ev["value"], "qty": qty, "seq": ev["event_id"]})


def line_ticks() -> pd.DataFrame:
    li = pd.read_parquet(f"{SF}/lineitem.parquet")
    return pd.DataFrame({"instrument": li["l_partkey"], "ts": li["l_shipdate"], "price": li["l_extendedprice"],
                         "qty": li["l_quantity"], "seq1": li["l_orderkey"], "seq2": li["l_linenumber"],
                         "seq3": li["l_suppkey"], "seq4": li["l_extendedprice"]})


def main() -> None:
    out = {}
    for name, view, width in (("ohlcv_bars", event_ticks, "1h"), ("ohlcv_bars_daily", line_ticks, "1D")):
        t0 = time.perf_counter()
        bars(view(), width)
        out[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "pandas_single_process_seconds", "sf": SF, "steps": out}))


if __name__ == "__main__":
    sys.exit(main())
