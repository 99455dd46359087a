import contextlib
import io
import uuid

from pyspark.sql import functions as F

from conftest import SF001
from test_skew import conf
from tickweave.session import work_path
from tickweave.sinks.files import write_bucketed
from tickweave.sources.tables import table, trade_fills


def test_bucketed_tables_join_without_shuffle(spark):
    tag = uuid.uuid4().hex[:8]
    li = table(spark, SF001, "lineitem")
    od = table(spark, SF001, "orders")
    write_bucketed(li, f"li_{tag}", "l_orderkey", 8, work_path(spark, "li-bucketed"))
    write_bucketed(od, f"od_{tag}", "o_orderkey", 8, work_path(spark, "od-bucketed"))
    buf = io.StringIO()
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # as for sides too large to broadcast
        fills = trade_fills(spark.table(f"li_{tag}"), spark.table(f"od_{tag}"))
        with contextlib.redirect_stdout(buf):
            fills.explain()
    plan = buf.getvalue()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert fills.count() == trade_fills(li, od).count()
    assert fills.agg(F.sum("qty")).first()[0] == trade_fills(li, od).agg(F.sum("qty")).first()[0]
