"""Casts of loosely typed text that yield NULL where the text does not fit.

Spark's own ``try_cast`` differs from the model's rules in a few forms, so a text must first have
the form of a number or time: ``'12.7'``, ``'1e3'``, ``'1_000'`` and ``'0x10'`` are integers here
(rounded), ``'12D'`` is none; ``'2024/1/2'`` and hour 24 are times, a bare year, ``'2024-01-02T03'``
and a padded ``' true '`` are nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_DIGITS = r"\d++(?:_\d++)*+"
_PLAIN = rf"\A\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
_DECIMAL = rf"{_PLAIN}\s*\z"
_NUMBER = rf"{_PLAIN}(?:[eE][+-]?{_DIGITS})?\s*\z"
_NO_NUMBER = r"(?i)\A\s*(?:[+-]?inf(?:inity)?|nan)\s*\z"
_USUAL_LONG = r"\A[+-]?\d{1,18}+\z"  # most numbers: always a BIGINT, and read without the longer patterns
_USUAL_DOUBLE = r"\A-?\d{1,18}+(?:\.\d{1,18}+)?\z"
_OTHER_BASE = r"(?i)\A\s*0(?:x([0-9a-f]+)|b([01]+))\s*\z"

# The usual form, which Spark reads as it is.
_USUAL_TIME = r"\A\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T](?:[01]?\d|2[0-3]):\d{1,2}:\d{1,2}(?:\.\d{1,9})?\s*)?\z"
# Year, month, day by one kind of separator; hour, minute, second, fraction; a zone is read over. Any other
# text fits the second half, which has no groups.
_ANY_TIME = (r"(?s)\A\s*(\d{1,6})([-/ \\])(\d{1,2})\2(\d{1,2})(?:(?:T| +)(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{0,6})\d*)?)?"
             r"(?:\s*(?:Z|UTC|[+-]\d{1,2}(?::?\d{2})?))?\s*)?\z|\A.+\z")
# Every number gets zeros in front, of which the needless ones go again; without groups no time is left.
_PADDED = "000$1-$3-$4 0$5:0$6:0$7.$80"
_NEEDLESS = r"\A0+(?=\d{4})|(?<=[ :])0(?=\d\d)"
_MIDNIGHT = r" 24:(0?0:0?0\.0+)\z"


def _number(c: Column, form: str) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(form), F.replace(text, F.lit("_"), F.lit("")))


def to_long(c: Column) -> Column:
    """Text to BIGINT, rounded half away from zero. Only numbers with an exponent pass through a
    double; the others keep all 64 bits."""
    text = c.cast("string")
    if_hex, if_bits = (F.regexp_extract(text, _OTHER_BASE, g) for g in (1, 2))
    other = F.when(text.rlike(_OTHER_BASE), F.coalesce(
        F.conv(F.nullif(if_hex, F.lit("")), 16, 10), F.conv(F.nullif(if_bits, F.lit("")), 2, 10))).try_cast("bigint")
    whole = _number(c, _DECIMAL)
    odd = F.coalesce(F.when(~F.contains(whole, F.lit(".")), whole.try_cast("bigint")),
                     F.round(whole.try_cast("decimal(38,17)")).try_cast("bigint"),
                     F.when(whole.isNull(), F.round(_number(c, _NUMBER).try_cast("double")).try_cast("bigint")), other)
    return F.when(text.rlike(_USUAL_LONG), text.try_cast("bigint")).otherwise(odd)


def to_double(c: Column) -> Column:
    text = c.cast("string")
    odd = F.coalesce(_number(c, _NUMBER), F.when(text.rlike(_NO_NUMBER), text))
    parsed = F.when(text.rlike(_USUAL_DOUBLE), text).otherwise(odd).try_cast("double")
    # The type is known when the query is planned: a number is not written as text and read again.
    return F.when(F.typeof(c) == "double", c.try_cast("double")).otherwise(parsed)


def to_flag(c: Column) -> Column:
    text = c.cast("string")
    return F.when(~text.rlike(r"\s"), text.try_cast("boolean"))


def to_timestamp(c: Column) -> Column:
    """Text (or a timestamp) to a zone-less timestamp.

    The usual form is cast as it is; any other is first brought to that form by one replacement. Hour 24 is
    the next day's midnight.
    """
    text = c.cast("string")
    form = F.regexp_replace(F.regexp_replace(text, _ANY_TIME, _PADDED), _NEEDLESS, "")
    odd = F.regexp_replace(form, _MIDNIGHT, " 00:$1").try_cast(T.TimestampNTZType()) + F.make_dt_interval(
        days=form.rlike(_MIDNIGHT).cast("int"))
    return F.when(text.rlike(_USUAL_TIME), text.try_cast(T.TimestampNTZType())).when(
        F.trim(text) == "epoch", F.lit("1970-01-01").cast(T.TimestampNTZType())).otherwise(odd)


def finite(c: Column) -> Column:
    """NaN is an absent measurement, not a number to bin."""
    return F.when(~F.isnan(c), c)


# The Unicode space separators.
SPACES = (" \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u202f\u205f\u3000")


def trim_spaces(c: Column) -> Column:
    """Trim every Unicode space separator, not just U+0020; tabs and newlines stay."""
    return F.trim(c, F.lit(SPACES))


# A string literal, kept by group 1, or white space between tokens.
_JSON_SPACE = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|\s+'


def compact_json(c: Column) -> Column:
    """Drop white space between the tokens of an object or list; other text stays as it is."""
    return F.when(c.rlike(r"\A\s*[{\[]"), F.regexp_replace(c, _JSON_SPACE, "$1")).otherwise(c)
