"""Scalar column expressions for log lines (all JVM-side, codegen friendly).

mask_message  IPv4 and user-id masking of the free-text message
parse_time    duration text such as ``28ms`` to a float32 number
float_text    Python-style text of a float32 value widened to double
compose_text  the model input text of one log line
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Masking patterns and their replacement tokens, applied in this order:
IP_PATTERN = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
IP_TOKEN = "[IP]"
USER_PATTERN = r"\bUser\d+\b"
USER_TOKEN = "[USER]"
# Text a missing message turns into before masking:
NULL_MESSAGE = "None"
# Unit suffix removed from a duration before it is read as a number:
TIME_SUFFIX = "ms"
# Layout of the model input text, with and without the duration:
TEXT_WITH_TIME = "LOGLEVEL={level} SERVICE={service} TIME={time} TEXT={message}"
TEXT_WITHOUT_TIME = "LOGLEVEL={level} SERVICE={service} TEXT={message}"

# Java regexes: (?U) gives Unicode \b and \d, as Python's re does on str.
_UNICODE = "(?U)"
# A decimal literal as Python's float() accepts it (underscores between
# digits, optional exponent), but no hex, no type suffix.
_NUM = r"[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?"
# Removing one trailing "ms" and then reading the rest with float() (which
# ignores surrounding whitespace) accepts exactly: spaces, a literal, spaces,
# and at most one "ms" at the very end.  \z, since Java's $ also matches
# before a final newline.
# Whitespace float() ignores: ASCII space, \t \n \v \f \r, and the
# non-ASCII Unicode spaces (but not \x1c-\x1f).
_WS = r"[\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_TIME = r"^" + _WS + r"*(" + _NUM + r")" + _WS + r"*(?:ms)?\z"
_NAN = r"(?i)^" + _WS + r"*[+-]?nan" + _WS + r"*(?:ms)?\z"
_INF = r"(?i)^" + _WS + r"*\+?(-?inf(?:inity)?)" + _WS + r"*(?:ms)?\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_message(message) -> Column:
    """Replace IPv4-looking numbers by ``[IP]``, then ``User<n>`` by ``[USER]``.

    A null message becomes the text ``None`` first, so it is never dropped
    later as missing.
    """
    text = F.coalesce(_col(message).cast("string"), F.lit(NULL_MESSAGE))
    masked = F.regexp_replace(F.regexp_replace(text, _UNICODE + IP_PATTERN, IP_TOKEN),
                              _UNICODE + USER_PATTERN, USER_TOKEN)
    # Both patterns need a digit; most messages have none and skip both passes.
    return F.when(text.rlike(_UNICODE + r"\d"), masked).otherwise(text)


def parse_time_double(time_taken) -> Column:
    """Duration text to double with Python ``float()`` rules; bad input -> 0.0.

    One anchored extraction reads the literal; the NaN / infinity patterns
    are only tried when it finds none.
    """
    t = _col(time_taken).cast("string")
    num = F.regexp_extract(t, _TIME, 1)
    value = (
        F.when(num != "", F.regexp_replace(num, "_", "").try_cast("double"))
        .when(t.rlike(_NAN), F.lit(float("nan")))
        .when(t.rlike(_INF), F.regexp_extract(t, _INF, 1).try_cast("double"))
    )
    return F.coalesce(value, F.lit(0.0))


def time_is_nan(time_taken) -> Column:
    """True exactly when ``parse_time`` gives NaN (null text is not NaN)."""
    return F.coalesce(_col(time_taken).cast("string").rlike(_NAN), F.lit(False))


def parse_time(time_taken) -> Column:
    """``TimeVal``: the parsed duration stored as float32."""
    return parse_time_double(time_taken).cast("float")


def float_text(value) -> Column:
    """Text of a float32 value widened to double, as Python's ``str`` gives it.

    Spark prints the same shortest digits as Python but switches to Java's
    E-notation outside [1e-3, 1e7), where Python stays positional within
    [1e-4, 1e16).  In that band the Java text is read back as a decimal
    and printed plainly.  Above (and below) it both use scientific form;
    there Java 17 sometimes prints one or two digits more than needed, so
    the mantissa is cut (integer half-up) while the shorter text still reads
    back as the same double.  Kept small so whole-stage codegen applies.
    """
    v = _col(value).cast("double")
    s = v.cast("string")
    exp = F.substring_index(s, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(s, "E", 1), r"[-.]", ""), "0+$", "")

    def cut(k):
        num = digits.try_cast("decimal(20,0)")
        r = F.floor((num + F.lit(5 * 10 ** (k - 1))) / F.lit(10 ** k)).cast("string")
        back = F.concat(r.substr(F.lit(1), F.lit(1)), F.lit("."), r.substr(F.lit(2), F.lit(40)),
                        F.lit("0E"), exp.cast("string")).try_cast("double")
        ok = (F.length(digits) > k) & (F.length(r) == F.length(digits) - k) & (back == F.abs(v))
        return F.when(ok, F.regexp_replace(r, "0+$", ""))

    short = F.coalesce(cut(2), cut(1), digits)
    sci = F.concat(
        F.when(v < 0, F.lit("-")).otherwise(F.lit("")), short.substr(F.lit(1), F.lit(1)),
        F.when(F.length(short) > 1, F.concat(F.lit("."), short.substr(F.lit(2), F.lit(40))))
        .otherwise(F.lit("")),
        F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"))
    plain = F.regexp_replace(F.regexp_replace(s.try_cast("decimal(38,20)").cast("string"), "0+$", ""),
                             r"\.$", ".0")
    return (
        F.when(s == "Infinity", F.lit("inf"))
        .when(s == "-Infinity", F.lit("-inf"))
        .when(s == "NaN", F.lit("nan"))
        .when(~s.contains("E"), s)
        .when((exp >= 16) | (exp < -4), sci)
        .otherwise(plain)
    )


def compose_text(level, service, message, time_value=None) -> Column:
    """Model input text of a log line; ``time_value`` is the float32 TimeVal.

    Built as one ``concat`` from the fixed layout above (the literal parts
    and the fields in template order).
    """
    fields = {"level": _col(level), "service": _col(service), "message": _col(message)}
    template = TEXT_WITHOUT_TIME
    if time_value is not None:
        fields["time"] = float_text(time_value)
        template = TEXT_WITH_TIME
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(fields[name])
    return F.concat(*parts)
