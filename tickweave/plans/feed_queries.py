"""What happens to a feed over time: late ticks, lost and repeated offsets, changing subscriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickweave.operators import offsets, subscriptions
from tickweave.plans.bar_queries import _event_bar_sql
from tickweave.plans.catalog import register
from tickweave.plans.io_queries import broker_and_landed_bars, compare_sql
from tickweave.session import work_path
from tickweave.sources.tables import event_ticks, table
from tickweave.streaming import late
from tickweave.streaming.landing import land, with_ingest_date
from tickweave.streaming.live_bars import live_bars
from tickweave.streaming.live_reconcile import live_reconcile, settle
from tickweave.streaming.sources import file_stream

# How the test feed arrives: every 5th tick is held up for two days, every 7th comes again a day later;
# a delivery holds ten days of arrivals. Nothing downstream knows this, only the order of the deliveries.
_DELIVERIES = 3
_DELIVERED = f"""
SELECT event_id, ts, CAST(least(date_diff('day', DATE '2024-01-01', CAST(arrived AS DATE)) // 10, {_DELIVERIES - 1}) AS BIGINT) AS batch_id
FROM (SELECT *, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 2 DAY ELSE ts END AS arrived FROM events
      UNION ALL SELECT *, ts + INTERVAL 1 DAY AS arrived FROM events WHERE event_id % 7 = 0)"""


def _delivered(spark, sf_dir):
    """Ticks as they arrive, with the number of the delivery they come in."""
    ev = table(spark, sf_dir, "events")
    at = F.when(F.col("event_id") % 5 == 0, F.col("ts") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    again = ev.where(F.col("event_id") % 7 == 0).withColumn("at", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    days = F.datediff(F.to_date("at"), F.lit("2024-01-01").cast("date"))
    return (ev.withColumn("at", at).unionByName(again)
            .withColumn("delivery", F.least(F.floor(days / 10), F.lit(_DELIVERIES - 1))).drop("at"))


def _land_deliveries(spark, sf_dir, root):
    """The deliveries put on the bus one after another, each landed by a restarted stream; the landed table's schema."""
    deliveries = _delivered(spark, sf_dir)
    body = deliveries.drop("delivery")
    for d in range(_DELIVERIES):
        deliveries.where(F.col("delivery") == d).drop("delivery").write.mode("append").parquet(f"{root}/bus")
        stream = file_stream(spark, f"{root}/bus", body.schema)
        late.land_marking_late(stream, root, f"{root}/checkpoint", delay="5 minutes").awaitTermination()
    return late.landed_schema(body)


@register("late_ticks_landed", sql=f"""
WITH d AS ({_DELIVERED}),
m AS (SELECT batch_id, max(ts) AS latest FROM d GROUP BY batch_id)
SELECT event_id, ts, batch_id, coalesce(ts < (SELECT max(latest) FROM m WHERE m.batch_id < d.batch_id) - INTERVAL 5 MINUTE, false)
         AS late, strftime(ts, '%Y_%m_%d') AS ingest_date
FROM d
""", ids=("W1", "W3", "W5", "X14", "X15"))
def q_late_ticks_landed(spark, sf_dir):
    """Every delivered tick as landed: its batch, and whether it came behind the watermark of the batches before."""
    root = work_path(spark, "late-landed")
    schema = _land_deliveries(spark, sf_dir, root)
    return late.landed(spark, root, schema).select("event_id", "ts", "batch_id", "late", "ingest_date")


@register("late_ticks_corrected", sql=f"""
SELECT *, strftime(bar_start, '%Y_%m_%d') AS ingest_date FROM ({_event_bar_sql(3600)})
""", ids=("W1", "W2", "W5", "X14", "X15"))
def q_late_ticks_corrected(spark, sf_dir):
    """Hourly bars of a feed with late and repeated ticks: live bars of the on-time ticks, then a correction run
    over the days that detected late ticks touch and those with bars still open."""
    root = work_path(spark, "late-bars")
    schema = _land_deliveries(spark, sf_dir, root)
    stream = event_ticks(late.on_time_stream(spark, root, schema))
    bars = with_ingest_date(live_bars(stream, "1 hour", "5 minutes", dedupe_on=("instrument", "seq")), "bar_start")
    land(bars, f"{root}/live", f"{root}/live-checkpoint", available_now=True).awaitTermination()
    live = spark.read.schema(bars.schema).parquet(f"{root}/live")
    return late.correct(spark, root, schema, live, f"{root}/corrected", "1 hour",
                        ticks_view=lambda df: event_ticks(df).dropDuplicates(["instrument", "seq"]))


# How the numbered feed of the tests goes wrong: offsets 7 to 9 of every 50 are lost, every 40th comes twice at
# once, and the second delivery (from the 16th on) starts by replaying the 14th and 15th.
_NUMBERED_SQL = """
SELECT 'ticks' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS "offset", CASE WHEN day(ts) < 16 THEN 1 ELSE 2 END AS run
FROM events WHERE (event_id // 3) % 50 NOT IN (7, 8, 9)"""
_OFFSETS_SQL = f"""
WITH once AS ({_NUMBERED_SQL}),
d AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE "offset" % 40 = 5
      UNION ALL SELECT topic, partition, "offset", 2 FROM once JOIN events ON once."offset" = event_id // 3 AND once.partition = event_id % 3
                WHERE day(ts) IN (14, 15)),
present AS (SELECT DISTINCT topic, partition, "offset" FROM d),
gap AS (SELECT topic, partition, "offset" + 1 AS from_offset,
               lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") - 1 AS to_offset FROM present),
c AS (SELECT topic, partition, run, "offset", count(*) AS n FROM d GROUP BY ALL),
again AS (SELECT *, n + CAST(EXISTS (SELECT 1 FROM c b WHERE b.topic = c.topic AND b.partition = c.partition
                                       AND b."offset" = c."offset" AND b.run < c.run) AS INTEGER) - 1 AS extra FROM c),
island AS (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, partition, run ORDER BY "offset") AS g FROM again WHERE extra > 0)
SELECT topic, partition, 'missing' AS kind, CAST(NULL AS INTEGER) AS run, from_offset, to_offset, to_offset - from_offset + 1 AS n
FROM gap WHERE to_offset >= from_offset
UNION ALL
SELECT topic, partition, 'redelivered', CAST(run AS INTEGER), min("offset"), max("offset"), CAST(sum(extra) AS BIGINT)
FROM island GROUP BY topic, partition, run, g
"""


@register("offset_continuity", sql=_OFFSETS_SQL, ids=("S1", "S8", "X11", "X15"))
def q_offset_continuity(spark, sf_dir):
    """Ranges of offsets lost or delivered again, over two deliveries of a numbered feed with the state carried between."""
    root = work_path(spark, "offsets")
    ev = table(spark, sf_dir, "events")
    once = ev.select(F.lit("ticks").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
                     F.expr("event_id div 3").alias("offset"), F.dayofmonth("ts").alias("day"))
    once = once.where(~(F.col("offset") % 50).isin(7, 8, 9))
    run = F.when(F.col("day") < 16, F.lit(1)).otherwise(F.lit(2))
    fed = (once.withColumn("run", run).unionByName(once.where(F.col("offset") % 40 == 5).withColumn("run", run))
           .unionByName(once.where(F.col("day").isin(14, 15)).withColumn("run", F.lit(2))))
    state, reports = None, []
    for r in (1, 2):
        again, new = offsets.take(fed.where(F.col("run") == r), state, block=1000)
        new.write.parquet(f"{root}/state-{r}")
        state = spark.read.schema(new.schema).parquet(f"{root}/state-{r}")
        if r == 1:  # the next delivery replaces the state that this report is read with
            again.write.parquet(f"{root}/again-1")
            again = spark.read.schema(again.schema).parquet(f"{root}/again-1")
        reports.append(again.select("*", F.lit("redelivered").alias("kind"), F.lit(r).alias("run")))
    lost = offsets.missing(state).select("*", F.lit("missing").alias("kind"), F.lit(None).cast("int").alias("run"))
    return lost.unionByName(reports[0]).unionByName(reports[1])


_SUBSCRIBED_SQL = """
WITH s AS (SELECT user_id, ts, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until
           FROM events WHERE event_type IN ('signup', 'error') AND ts IS NOT NULL),
t AS (SELECT event_id, CAST(user_id % 2 + 1 AS INTEGER) AS segment, user_id AS instrument, ts, value AS price
      FROM events WHERE event_type IN ('view', 'click', 'purchase'))
"""


def _subscribed(spark, sf_dir):
    """Ticks, and the times during which their instruments are subscribed (signups subscribe, errors end it)."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 2 + 1).cast("int").alias("segment"), F.col("user_id").alias("instrument"), "ts",
        F.col("value").alias("price"), "event_type")
    held = subscriptions.intervals(ev.where(F.col("event_type").isin("signup", "error")), F.col("event_type") == "signup",
                                   seq="event_id")
    return ev.where(F.col("event_type").isin("view", "click", "purchase")).drop("event_type"), held


@register("subscription_over_time", sql=_SUBSCRIBED_SQL + """
SELECT t.* FROM t JOIN s ON t.instrument = s.user_id AND s.event_type = 'signup' AND t.ts >= s.ts
  AND (s.until IS NULL OR t.ts < s.until)
""", ids=("F3",))
def q_subscription_over_time(spark, sf_dir):
    """Ticks that came while their instrument was subscribed (subscribe and unsubscribe events as intervals)."""
    return subscriptions.during(*_subscribed(spark, sf_dir))


@register("unsubscription_over_time", sql=_SUBSCRIBED_SQL + """
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE t.instrument = s.user_id AND s.event_type = 'signup' AND t.ts >= s.ts
  AND (s.until IS NULL OR t.ts < s.until))
""", ids=("F4",))
def q_unsubscription_over_time(spark, sf_dir):
    """Ticks that came before their instrument was first subscribed or after it was given up."""
    return subscriptions.outside(*_subscribed(spark, sf_dir))


@register("live_reconciliation", sql=compare_sql("FULL OUTER"), ids=("J1", "J2", "W1", "W5", "X12"))
def q_live_reconciliation(spark, sf_dir):
    """Broker bars against landed bars as both arrive, some a delivery (ten days) late: pairs and one-sided bars from
    the watermarked stream-stream join, late and waiting ones settled from the stored sides."""
    root = work_path(spark, "live-compare")
    held_up = {"api": F.col("instrument") % 4 == 0, "s3": F.col("instrument") % 6 == 1}
    schemas = {}
    for name, bars in broker_and_landed_bars(spark, sf_dir, root).items():
        days = F.floor(F.datediff(F.to_date("bar_start"), F.lit("2024-01-01").cast("date")) / 10)
        number = F.least(days + held_up[name].cast("int"), F.lit(_DELIVERIES - 1))
        bars.withColumn("delivery", number).write.parquet(f"{root}/{name}-sent")
        schemas[name] = bars.schema
    for d in range(_DELIVERIES):
        for name in schemas:
            sent = spark.read.parquet(f"{root}/{name}-sent").where(F.col("delivery") == d).drop("delivery")
            sent.write.mode("append").parquet(f"{root}/{name}")
        out = live_reconcile(*[file_stream(spark, f"{root}/{name}", s) for name, s in schemas.items()], delay="5 minutes")
        land(out, f"{root}/compared", f"{root}/compared-checkpoint", partition_by=(), available_now=True).awaitTermination()
    streamed = spark.read.schema(out.schema).parquet(f"{root}/compared")
    return settle(streamed, *[spark.read.schema(s).parquet(f"{root}/{name}") for name, s in schemas.items()])
