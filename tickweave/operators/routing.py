"""Message routing and subscriptions.

Routing is a column (``topic``) computed per row, so one job writes every topic
(Kafka sink reads the ``topic`` column; file sinks ``partitionBy("topic")``).
Subscriptions are semi / anti joins against a request table of any size; Spark
broadcasts it when its own size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.schemas import FULL_MODE_KINDS, PARTIAL_MODE_KINDS


def topic_name(code: Column, mode: str) -> Column:
    """``message<code>_json_<mode>``."""
    return F.format_string("message%d_json_%s", code, F.lit(mode))


DEAD_LETTER = "message_dead_letter"


def route(df: DataFrame, code_col: str = "MessageCode", mode: str = "full") -> DataFrame:
    """Attach the topic; kinds not published in ``mode`` are not routed (the producer's rule).

    :func:`route_all` keeps them on a dead-letter topic.
    """
    kinds = FULL_MODE_KINDS if mode == "full" else PARTIAL_MODE_KINDS
    return df.where(F.col(code_col).isin(kinds)).withColumn("topic", topic_name(F.col(code_col), mode))


def route_all(df: DataFrame, code_col: str = "MessageCode", mode_col: str = "mode") -> DataFrame:
    """Attach the topic by kind and by each row's mode (``full`` / ``partial``); every row is kept.

    Kinds that the mode does not publish, unknown and NULL kinds and modes go to
    :data:`DEAD_LETTER`, so topic counts add up to the input.
    """
    code, mode = F.col(code_col), F.col(mode_col)
    known = (((mode == "full") & code.isin(FULL_MODE_KINDS))
             | ((mode == "partial") & code.isin(PARTIAL_MODE_KINDS)))
    topic = F.format_string("message%d_json_%s", code, mode)
    return df.withColumn("topic", F.when(known, topic).otherwise(F.lit(DEAD_LETTER)))


def subscribe(stream: DataFrame, subscriptions: DataFrame, keys) -> DataFrame:
    """Rows whose keys are in the subscription table (left semi join; broadcast if Spark finds it small)."""
    return stream.join(subscriptions, list(keys), "left_semi")


def unsubscribe(stream: DataFrame, withdrawn: DataFrame, keys) -> DataFrame:
    """Rows whose keys are not among the withdrawn pairs (left anti join)."""
    return stream.join(withdrawn, list(keys), "left_anti")


def request_table(spark, pairs, schema: str) -> DataFrame:
    """A request list as a DataFrame. A list of any size works; its own size decides how it is joined."""
    return spark.createDataFrame(list(pairs), schema)
