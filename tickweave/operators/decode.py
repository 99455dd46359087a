"""Payload decoding with a fixed schema, quarantine of bad rows, tick-list pruning.

All of it is column expressions (``from_json`` / ``get_json_object`` /
``regexp_replace``) evaluated in the JVM on every executor, with no Python in
the row path; it works the same on a batch DataFrame and on a stream. (The
JSON parser itself runs interpreted, outside whole-stage code generation.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tickweave.operators import literals

CORRUPT = "_corrupt_record"
REASON = "_reason"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_corrupt(schema: StructType) -> StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def bytes_to_text(value) -> Column:
    """Kafka ``value`` bytes -> UTF-8 text (``CAST(value AS STRING)``)."""
    return _c(value).cast("string")


def parse_json(text, schema: StructType) -> Column:
    """Permissive decode: a bad field becomes NULL, a bad row all NULL;
    either way the raw text lands in ``_corrupt_record``."""
    return F.from_json(_c(text), with_corrupt(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def unwrap_json_string(text) -> Column:
    """A JSON string holding JSON text (``"{\\"a\\":1}"``) -> the inner text; else unchanged."""
    t = _c(text)
    inner = F.get_json_object(F.concat(F.lit('{"x":'), t, F.lit("}")), "$.x")
    return F.when(F.ltrim(t).startswith('"'), inner).otherwise(t)


def wrap_json_string(text) -> Column:
    """Encode text as one JSON string literal (the producer's double encoding)."""
    arr = F.to_json(F.array(_c(text)))
    return F.substring(arr, F.lit(2), F.length(arr) - 2)


# Times in payload text keep microseconds (the JSON default writes milliseconds).
JSON_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                     "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_json_text(*cols) -> Column:
    """Serialise columns as one JSON object text (the bus payload)."""
    return F.to_json(F.struct(*cols), JSON_TIME_OPTIONS)


def decode(df: DataFrame, text, schema: StructType, keep=(), python_repr: bool = False,
           unwrap: bool = False) -> DataFrame:
    """Decode ``text`` with ``schema`` and flatten the fields next to ``keep``.

    python_repr -- payloads may be Python literals (``str(dict)``): read as JSON by
                   :mod:`tickweave.operators.literals`; other text is taken as it is
    unwrap      -- first unwrap a JSON-encoded string holding the payload
    Output: keep..., schema fields..., _corrupt_record (NULL when clean, else the payload).
    """
    t = _c(text)
    if unwrap:
        t = unwrap_json_string(t)
    if not python_repr:
        return df.select(*keep, parse_json(t, schema).alias("__d")).select(*keep, "__d.*")
    # A step each, so that no step's expression is computed more than once: one parse a row.
    rows = df.select(*keep, t.alias("__t"))
    rows = rows.select(*keep, "__t", literals.tokens(F.col("__t")).alias("__k"))
    rows = rows.select(*keep, "__t", literals.to_json(F.col("__t"), F.col("__k")).alias("__j"))
    rows = rows.select(*keep, "__t", parse_json("__j", schema).alias("__d"))
    fields = [f for f in with_corrupt(schema).fieldNames() if f != CORRUPT]
    return rows.select(*keep, *[F.col("__d")[f].alias(f) for f in fields],
                       F.when(F.col("__d")[CORRUPT].isNotNull(), F.col("__t")).alias(CORRUPT))


def decode_checked(df: DataFrame, text, schema: StructType, required=(), keep=(), **kw) -> DataFrame:
    """:func:`decode` plus a ``_reason`` column: ``malformed`` (corrupt text),
    ``null_key`` (a required field is NULL, e.g. a NULL payload), else NULL."""
    out = decode(df, text, schema, keep=keep, **kw)
    null_key = F.lit(False)
    for r in required:
        null_key = null_key | F.col(r).isNull()
    reason = (F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
              .when(null_key, F.lit("null_key")))
    return out.withColumn(REASON, reason)


STATUS = "status"
CLEAN, QUARANTINE = "clean", "quarantine"


def with_status(checked: DataFrame) -> DataFrame:
    """Add ``status``: ``clean`` or ``quarantine``, a partition column for one job that lands both."""
    return checked.withColumn(STATUS, F.when(F.col(REASON).isNull(), F.lit(CLEAN)).otherwise(F.lit(QUARANTINE)))


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the bookkeeping columns, quarantined rows).

    When both go to storage from one source, land them in one job partitioned
    by :func:`with_status`, so the payload is parsed once.
    """
    good = checked.where(F.col(REASON).isNull()).drop(CORRUPT, REASON)
    bad = checked.where(F.col(REASON).isNotNull())
    return good, bad


# ---- tick lists (feed 2 callbacks carry a list of ticks) -------------------

def explode_ticks(df: DataFrame, text, element_schema: StructType, keep=(),
                  first_only: bool = False) -> DataFrame:
    """Decode a JSON array of ticks and emit one row per tick (with ``pos``).

    ``first_only`` keeps only element 0, the producer's old rule; an empty or
    undecodable list yields no row (:func:`explode_ticks_checked` keeps it).
    """
    arr = F.from_json(_c(text), ArrayType(element_schema))
    if first_only:
        arr = F.slice(arr, 1, 1)
    return df.select(*keep, F.posexplode(arr).alias("pos", "__t")).select(*keep, "pos", "__t.*")


def explode_ticks_checked(df: DataFrame, text, element_schema: StructType, required=(), keep=(),
                          first_only: bool = False) -> DataFrame:
    """:func:`explode_ticks` that loses nothing: one row per tick, and one per list without any.

    ``_reason``: ``bad_list`` (NULL or not an array), ``empty_list``,
    ``malformed`` (a tick that does not decode; its text is in
    ``_corrupt_record``), ``null_key`` (a required field is NULL), else NULL.
    """
    arr = F.from_json(_c(text), ArrayType(StringType()))  # elements stay text, decoded one by one
    if first_only:
        arr = F.slice(arr, 1, 1)
    # A text that is not an array decodes to one NULL element or to NULL.
    bad = ~F.coalesce(F.ltrim(_c(text)).startswith("["), F.lit(False)) | arr.isNull()
    rows = (df.select(*keep, F.when(bad, F.lit("bad_list")).when(F.size(arr) == 0, F.lit("empty_list")).alias("__list"),
                      F.when(~bad, arr).alias("__arr"))
            .select(*keep, "__list", F.posexplode_outer("__arr").alias("pos", "__e"))
            .withColumn("__d", parse_json("__e", element_schema)))
    null_key = F.lit(False)
    for r in required:
        null_key = null_key | F.col("__d")[r].isNull()
    reason = (F.when(F.col("__list").isNotNull(), F.col("__list"))
              .when(F.col("__d")[CORRUPT].isNotNull(), F.lit("malformed"))
              .when(F.col("__e").isNull() | null_key, F.lit("null_key")))
    return rows.select(*keep, "pos", "__d.*", reason.alias(REASON))


def prune_tick(df: DataFrame, drop=("ohlc", "depth", "tradable"),
               time_fields=("last_trade_time", "exchange_timestamp")) -> DataFrame:
    """Producer-side pruning: mark ticks that carried depth, drop nested parts,
    and carry the time fields as text."""
    out = df.withColumn("has_depth", F.col("depth").isNotNull()) if "depth" in df.columns else df
    out = out.drop(*[c for c in drop if c in out.columns])
    for c in time_fields:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("string"))
    return out
