"""Command line: list the registered queries, or run one and show its first rows.

    python -m tickweave                      # list queries with their SURVEY ids
    python -m tickweave ohlcv_bars /root/testdata/sf0.01 [--rows 20] [--explain]
"""

from __future__ import annotations

import argparse

from tickweave.plans.catalog import REGISTRY
import tickweave.plans  # noqa: F401  (fills the registry)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tickweave")
    ap.add_argument("query", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--explain", action="store_true")
    args = ap.parse_args(argv)
    if not args.query:
        for name, spec in REGISTRY.items():
            print(f"{name:28s} {' '.join(spec.ids)}")
        return 0
    from tickweave.session import build_session
    spark = build_session()
    df = REGISTRY[args.query].fn(spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
