"""Python-literal payloads (``str(dict)``) as JSON text, by column expressions.

A quoted string is read as one token and stays what it is; only bare words
between strings (``None``, ``True``, ``False``, ``nan``, ``inf``) become JSON
literals. Escapes become JSON escapes. What has no exact JSON form is left as
it is, so that the decoder reports the row and quarantines its text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for escapes while strings are told apart. A Python repr never holds these raw.
_BACKSLASH, _SINGLE, _DOUBLE = "\x01", "\x02", "\x03"

# With escaped quotes out of the way, a string ends at the next quote of its kind.
_TOKEN = r"""'[^']*+'|"[^"]*+"|[^'"]++"""
_BARE = r"\b(?:None|True|False|nan|inf)\b"

# Cheap test for what may be a Python literal; rows without any of it are taken as they are.
_MAYBE = r"""'|\\x|\\U|""" + _BARE
# Escapes without an exact JSON form: unknown ones, and halves of surrogate pairs (a repr writes no pairs).
_NO_JSON = r"\\(?:[^nrtbfxuU]|$|u[dD][89a-fA-F]|x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4}))"


def tokens(text: Column) -> Column:
    """Strings (with their quotes) and the stretches between them; NULL where no Python literal can be.

    Concatenated they are the text again, unless a quote is not closed.
    """
    safe = F.replace(F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit("\\'"), F.lit(_SINGLE)),
                     F.lit('\\"'), F.lit(_DOUBLE))
    found = F.regexp_extract_all(safe, F.lit(_TOKEN), F.lit(0))
    fine = text.rlike(_MAYBE) & ~text.rlike("[\x01-\x03]")
    return F.when(fine & (F.length(F.array_join(found, "")) == F.length(safe)), found)


def _is_python(token: Column) -> Column:
    quoted = token.startswith('"')
    return (token.startswith("'") | (quoted & token.rlike(r"\\[xU]"))
            | (~quoted & token.rlike(_BARE)))


def _wide_escapes(body: Column) -> Column:
    """``\\UHHHHHHHH`` as one JSON escape or a pair of them; one that names no character stays (and is no JSON)."""

    def one(part: Column, i: Column) -> Column:
        point = F.conv(F.substring(part, 1, 8), 16, 10).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(point - 0x10000, 10)
        low = F.lit(0xDC00) + ((point - 0x10000).bitwiseAND(0x3FF))
        unit = lambda c: F.concat(F.lit("\\u"), F.lpad(F.hex(c.cast("bigint")), 4, "0"))
        single = (point < 0x10000) & ~point.between(0xD800, 0xDFFF)
        pair = point.between(0x10000, 0x10FFFF)
        known = part.rlike("^[0-9a-fA-F]{8}") & (single | pair)
        text = F.concat(F.when(pair, F.concat(unit(high), unit(low))).otherwise(unit(point)), F.substring(part, 9, 1 << 30))
        return F.when(i == 0, part).when(F.coalesce(known, F.lit(False)), text).otherwise(F.concat(F.lit("\\U"), part))

    return F.when(body.contains("\\U"), F.array_join(F.transform(F.split(body, r"\\U", -1), one), "")).otherwise(body)


def _string(token: Column) -> Column:
    """A quoted token as a JSON string."""
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    body = _wide_escapes(F.regexp_replace(body, r"\\x([0-9a-fA-F]{2})", r"\\u00$1"))
    for mark, text in (('"', '\\"'), (_BACKSLASH, "\\\\"), (_SINGLE, "'"), (_DOUBLE, '\\"')):
        body = F.replace(body, F.lit(mark), F.lit(text))
    return F.concat(F.lit('"'), body, F.lit('"'))


def _between(token: Column) -> Column:
    for name, json in (("None", "null"), ("True", "true"), ("False", "false"), ("nan", "NaN"), ("inf", "Infinity")):
        token = F.regexp_replace(token, rf"\b{name}\b", json)
    return token


def to_json(text: Column, found: Column) -> Column:
    """JSON text of a payload, given its :func:`tokens`.

    Text that is already JSON, and text that cannot be read as a Python literal
    (a quote not closed, an escape without an exact JSON form), comes back as
    it is; the latter is no JSON either.
    """
    quoted = lambda t: t.startswith("'") | t.startswith('"')
    exact = ~F.exists(found, lambda t: quoted(t) & t.rlike(_NO_JSON))
    json = F.array_join(F.transform(found, lambda t: F.when(quoted(t), _string(t)).otherwise(_between(t))), "")
    return (F.when(found.isNull() | ~F.exists(found, _is_python), text)
            .when(exact, json).otherwise(F.concat(F.lit("?"), text)))
