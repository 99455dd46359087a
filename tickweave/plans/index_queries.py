"""Tables kept beside the landed data: latest state, search postings, compacted folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.functions.timeutil import from_epoch1980
from tickweave.operators import text_index
from tickweave.operators.decode import decode_checked, to_json_text, with_status
from tickweave.plans.catalog import REGISTRY, register
from tickweave.plans.io_queries import FEED1_KEYS
from tickweave.plans.reconcile_queries import MASTER_SQL, _master
from tickweave.schemas import TICK_FEED1
from tickweave.session import work_path
from tickweave.sinks import compaction
from tickweave.sources.messages import feed1_fields
from tickweave.sources.tables import event_orders, event_ticks, table
from tickweave.streaming import state_table
from tickweave.streaming.landing import land_checked, with_ingest_date
from tickweave.streaming.sources import file_stream

FILES = 6  # of the test feeds below; a micro-batch takes one or two


def _fed_in_files(spark, sf_dir, root, per_trigger):
    """The events in files that cut across time, as a stream of several micro-batches."""
    ev = table(spark, sf_dir, "events")
    ev.repartition(FILES, "event_id").write.parquet(f"{root}/bus")
    return file_stream(spark, f"{root}/bus", ev.schema, max_files_per_trigger=per_trigger)


@register("order_book_live", sql=REGISTRY["dealer_order_book"].sql, ids=("R1", "R2", "W3"))
def q_order_book_live(spark, sf_dir):
    """Current state of every order, kept in a bucketed table that a stream merges its micro-batches into."""
    root = work_path(spark, "order-book")
    orders = event_orders(_fed_in_files(spark, sf_dir, root, per_trigger=2))
    state_table.maintain(orders, root, f"{root}/checkpoint", ["appOrderID"], buckets=16).awaitTermination()
    return state_table.current(spark, root, orders, ["appOrderID"])


@register("quote_snapshot_live", sql=REGISTRY["quote_snapshot"].sql, ids=("Q1", "W3"))
def q_quote_snapshot_live(spark, sf_dir):
    """Latest tick per instrument, kept by a stream as micro-batches arrive in no order of time."""
    root = work_path(spark, "quotes")
    ticks = event_ticks(_fed_in_files(spark, sf_dir, root, per_trigger=2))
    state_table.maintain(ticks, root, f"{root}/checkpoint", ["instrument"], buckets=4).awaitTermination()
    return state_table.current(spark, root, ticks, ["instrument"])


NEEDLES = ["gizmo", "ROMO", "t 1", "PROMO", "no such part", "z"]  # the last one is under a trigram


@register("instrument_search_indexed", sql="\nUNION ALL\n".join(
    f"SELECT '{n}' AS needle, * FROM ({MASTER_SQL}) WHERE contains(lower(Name), '{n.lower()}') "
    f"OR contains(lower(DisplayName), '{n.lower()}')" for n in NEEDLES), ids=("L9",))
def q_instrument_search_indexed(spark, sf_dir):
    """Text searches on symbol or display name through stored trigram postings; candidates are read and tested."""
    index = text_index.build(_master(spark, sf_dir), work_path(spark, "search"), ["ExchangeSegment", "ExchangeInstrumentID"],
                             ["Name", "DisplayName"], buckets=8)
    out = None
    for n in NEEDLES:
        found = text_index.search(spark, index, n).select(F.lit(n).alias("needle"), "*")
        out = found if out is None else out.unionByName(found)
    return out


@register("landing_compacted", sql=REGISTRY["tick_landing_stream"].sql, ids=("K1", "K4", "U2", "X17"))
def q_landing_compacted(spark, sf_dir):
    """Feed-1 ticks landed by a stream in many small files: the first half compacted, the rest read beside it."""
    root = work_path(spark, "compacted")
    ev = table(spark, sf_dir, "events")
    for half in (0, 1):
        ev.where(F.col("event_id") % 2 == half).repartition(FILES // 2, "event_id").write.mode("append").parquet(f"{root}/bus")
        stream = file_stream(spark, f"{root}/bus", ev.schema, max_files_per_trigger=1)
        msgs = stream.select("event_id", to_json_text(*feed1_fields()).alias("value"))
        checked = decode_checked(msgs, "value", TICK_FEED1, required=FEED1_KEYS, keep=["event_id"])
        checked = with_ingest_date(checked, from_epoch1980("LastUpdateTime"))
        land_checked(checked, f"{root}/data", f"{root}/checkpoint", available_now=True).awaitTermination()
        schema = with_status(checked).schema
        if half == 0:
            compaction.compact(spark, f"{root}/data", f"{root}/packed", schema, ["status", "ingest_date"], target_bytes=1 << 20)
    rows = compaction.read_compacted(spark, f"{root}/data", f"{root}/packed", schema)
    return rows.where(F.col("status") == "clean").drop("_corrupt_record", "_reason", "status")
