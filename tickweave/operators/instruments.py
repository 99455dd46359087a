"""Instrument master: ragged pipe text -> 23 named fields, futures repair, look-ups.

Look-ups are filters / distincts / semi-joins on the master, so Spark pushes
the predicates into the scan and runs them on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.schemas import MASTER_FIELDS


def parse_master_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split ``a|b|...`` lines into the 23 master fields by position.

    Short rows get NULL in their missing trailing fields (as a CSV reader with
    ``sep='|'`` and a 23-field schema does). Blank lines are skipped.
    """
    parts = F.split(F.col(col), r"\|")
    return (lines.where(F.trim(F.col(col)) != "")
            .select(*[F.get(parts, i).alias(n) for i, n in enumerate(MASTER_FIELDS)]))


def split_dump(dump: DataFrame, col: str = "value") -> DataFrame:
    """A dump held as one text per row with newline-separated records -> one record per row."""
    text = F.btrim(F.col(col), F.lit(" \t\r\n"))
    return dump.select(F.explode(F.split(text, "\n")).alias(col))


def repair_futures(master: DataFrame) -> DataFrame:
    """Futures rows (``Series`` contains ``FUT``) are two fields short: they lack
    strike and option type, so their last four fields sit two places left.

    All moves read the original values; a NULL ``Series`` counts as not futures.
    """
    fut = F.coalesce(F.col("Series").contains("FUT"), F.lit(False))
    moved = {
        "DetailedDescription": "PriceNumerator",
        "PriceDenominator": "DisplayName",
        "PriceNumerator": "OptionType",
        "DisplayName": "StrikePrice",
    }
    cols = []
    for n in MASTER_FIELDS:
        if n in moved:
            cols.append(F.when(fut, F.col(moved[n])).otherwise(F.col(n)).alias(n))
        elif n in ("StrikePrice", "OptionType"):
            cols.append(F.when(fut, F.lit(None).cast("string")).otherwise(F.col(n)).alias(n))
        else:
            cols.append(F.col(n))
    return master.select(*cols)


# ---- look-ups ------------------------------------------------------------------

def keep_instruments(master: DataFrame, ids) -> DataFrame:
    """Rows whose ExchangeInstrumentID is in ``ids``."""
    return master.where(F.col("ExchangeInstrumentID").isin([str(i) for i in ids]))


def series_of(master: DataFrame, segment: str) -> DataFrame:
    return master.where(F.col("ExchangeSegment") == segment).select("Series").distinct()


def equity(master: DataFrame, segment: str, series: str, symbol: str) -> DataFrame:
    return master.where((F.col("ExchangeSegment") == segment) & (F.col("Series") == series)
                        & (F.col("Name") == symbol))


def expiry_dates(master: DataFrame, segment: str, series: str, symbol: str) -> DataFrame:
    return (equity(master, segment, series, symbol).where(F.col("ContractExpiration").isNotNull())
            .select("ContractExpiration").distinct().orderBy("ContractExpiration"))


def future(master: DataFrame, segment: str, series: str, symbol: str, expiry: str) -> DataFrame:
    return equity(master, segment, series, symbol).where(F.col("ContractExpiration") == expiry)


def option(master: DataFrame, segment: str, series: str, symbol: str, expiry: str,
           option_type: str, strike: str) -> DataFrame:
    return future(master, segment, series, symbol, expiry).where(
        (F.col("OptionType") == option_type) & (F.col("StrikePrice") == strike))


def option_types(master: DataFrame, segment: str, series: str, symbol: str, expiry: str) -> DataFrame:
    return (future(master, segment, series, symbol, expiry).where(F.col("OptionType").isNotNull())
            .select("OptionType").distinct())


def index_list(master: DataFrame, segment: str) -> DataFrame:
    return (master.where((F.col("ExchangeSegment") == segment) & F.col("UnderlyingIndexName").isNotNull())
            .select("UnderlyingIndexName").distinct())


def search_by_ids(master: DataFrame, pairs: DataFrame) -> DataFrame:
    """Semi-join on a table of (ExchangeSegment, ExchangeInstrumentID) pairs.

    A list of any size works; Spark broadcasts it when it is small.
    """
    return master.join(pairs, ["ExchangeSegment", "ExchangeInstrumentID"], "left_semi")


def search_text(master: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring match on Name or DisplayName."""
    needle = text.lower()
    return master.where(F.lower(F.col("Name")).contains(needle)
                        | F.lower(F.col("DisplayName")).contains(needle))


def segments(master: DataFrame, names) -> DataFrame:
    return master.where(F.col("ExchangeSegment").isin(list(names)))


def land_master(master: DataFrame, path: str) -> str:
    """Store the repaired master as Parquet partitioned by segment.

    Look-ups filter on segment first, so reading the landed master prunes to
    one segment folder and pushes the other equality filters into the scan.
    """
    master.write.mode("overwrite").partitionBy("ExchangeSegment").parquet(path)
    return path


def read_master(spark, path: str) -> DataFrame:
    from tickweave.schemas import MASTER_TEXT
    return spark.read.schema(MASTER_TEXT).parquet(path).select(*MASTER_FIELDS)
