"""Fixed message schemas of the two tick feeds and their side tables.

Field names are fixed values that must equal the producers' payloads,
including the misspelt ``LastTradedQunatity`` of feed 1.
"""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _struct(fields):
    # Decoded JSON is nullable whatever the declaration says, so declare it so.
    return StructType([StructField(n, t, True) for n, t in fields])


# Feed 1, last-traded-price message (kind 1512).
TICK_FEED1 = _struct([
    ("MessageCode", IntegerType()), ("MessageVersion", IntegerType()),
    ("ApplicationType", IntegerType()), ("TokenID", IntegerType()),
    ("ExchangeSegment", IntegerType()), ("ExchangeInstrumentID", IntegerType()),
    ("BookType", IntegerType()), ("XMarketType", IntegerType()),
    ("LastTradedPrice", DoubleType()), ("LastTradedQunatity", IntegerType()),
    ("LastUpdateTime", LongType()),
])

# Feed 2 tick after pruning (times carried as text).
TICK_FEED2 = _struct([
    ("mode", StringType()), ("instrument_token", LongType()),
    ("last_price", DoubleType()), ("last_traded_quantity", IntegerType()),
    ("average_traded_price", DoubleType()), ("volume_traded", LongType()),
    ("total_buy_quantity", LongType()), ("total_sell_quantity", LongType()),
    ("change", DoubleType()), ("last_trade_time", StringType()),
    ("oi", LongType()), ("oi_day_high", LongType()), ("oi_day_low", LongType()),
    ("exchange_timestamp", StringType()),
])

_LEVEL = ArrayType(_struct([("quantity", LongType()), ("price", DoubleType()), ("orders", LongType())]))

# Feed 2 tick as the socket delivers it (before pruning).
TICK_FEED2_RAW = _struct([
    ("tradable", BooleanType()), ("mode", StringType()), ("instrument_token", LongType()),
    ("last_price", DoubleType()), ("last_traded_quantity", IntegerType()),
    ("average_traded_price", DoubleType()), ("volume_traded", LongType()),
    ("total_buy_quantity", LongType()), ("total_sell_quantity", LongType()),
    ("ohlc", _struct([("open", DoubleType()), ("high", DoubleType()), ("low", DoubleType()),
                      ("close", DoubleType())])),
    ("change", DoubleType()), ("last_trade_time", StringType()),
    ("oi", LongType()), ("oi_day_high", LongType()), ("oi_day_low", LongType()),
    ("exchange_timestamp", StringType()),
    ("depth", _struct([("buy", _LEVEL), ("sell", _LEVEL)])),
])

# Vendor candle message: t = "<segment>_<instrument>".
CANDLE = _struct([
    ("t", StringType()), ("o", DoubleType()), ("h", DoubleType()),
    ("l", DoubleType()), ("c", DoubleType()), ("bt", TimestampType()),
    ("bv", LongType()), ("pv", DoubleType()),
])

# Compact touchline; ai / bi = "size|price|orders".
TOUCHLINE = _struct([
    ("t", StringType()), ("ltp", DoubleType()), ("ltq", LongType()),
    ("tb", LongType()), ("ts", LongType()), ("v", LongType()),
    ("ap", DoubleType()), ("ltt", TimestampType()), ("lut", TimestampType()),
    ("pc", DoubleType()), ("o", DoubleType()), ("h", DoubleType()),
    ("l", DoubleType()), ("c", DoubleType()), ("vp", DoubleType()),
    ("ai", StringType()), ("bi", StringType()),
])

# Instrument master: 23 positional text fields (fixed values, in order).
# The two price-band fields carry a dot upstream; they are renamed here.
MASTER_FIELDS = [
    "ExchangeSegment", "ExchangeInstrumentID", "InstrumentType", "Name",
    "Description", "Series", "NameWithSeries", "InstrumentID",
    "PriceBandHigh", "PriceBandLow", "FreezeQty", "TickSize", "LotSize",
    "Multiplier", "UnderlyingInstrumentId", "UnderlyingIndexName",
    "ContractExpiration", "StrikePrice", "OptionType", "DisplayName",
    "PriceNumerator", "PriceDenominator", "DetailedDescription",
]
MASTER_TEXT = _struct([(n, StringType()) for n in MASTER_FIELDS])

# Message kinds of the market-data socket that are published in full mode
# and in partial mode: 1501 touchline, 1502 market depth, 1505 candle, 1507 market status
# (full only), 1510 open interest, 1512 last traded price, 1105 instrument property change.
FULL_MODE_KINDS = [1501, 1502, 1505, 1507, 1510, 1512, 1105]
PARTIAL_MODE_KINDS = [1501, 1502, 1505, 1510, 1512, 1105]

# Seconds between 1970-01-01 and 1980-01-01 (epoch of feed-1 LastUpdateTime).
EPOCH_1980_OFFSET = 315532800
