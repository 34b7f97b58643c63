"""Column functions for text-first tables.

Landing tables hold nothing but text, and the rules for reading that text are
forgiving: a number is the longest leading whole number, a bad date is NULL,
patterns ignore ASCII case. Spark's own casts are stricter (ANSI mode raises),
so each rule is spelled out here once, from built-in expressions only.
"""

from __future__ import annotations

import decimal
import re
import string

from pyspark.sql import Column, functions as F

# 25 digits after the leading zeros are more than 64 bits hold and fit a decimal
_LEADING_WHOLE_NUMBER = r"^\s*([+-]?0*\d{1,25})"
_DATE_AND_MAYBE_TIME = (
    r"^\d{4}-\d{2}-\d{2}([ T]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?)?\z"
)
_LONG_MAX = decimal.Decimal(2**63 - 1)
_LONG_MIN = decimal.Decimal(-(2**63))


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _read_odd_number(c: Column) -> Column:
    digits = F.regexp_extract(c, _LEADING_WHOLE_NUMBER, 1).try_cast("decimal(38,0)")
    known = F.coalesce(digits, F.lit(decimal.Decimal(0)))
    within = F.least(F.greatest(known, F.lit(_LONG_MIN)), F.lit(_LONG_MAX))
    return within.cast("bigint")


def _read_whole_number(c: Column) -> Column:
    # Plain numbers, with decimals or not, are done by the first cast. The few
    # other texts are read in a lambda: spelled out in place for every column,
    # their code would push the generated method beyond the size that the JVM
    # compiles, and the whole load would run interpreted.
    plain = F.substring_index(c, ".", 1).try_cast("bigint")
    odd = F.get(F.transform(F.array(c), _read_odd_number), F.lit(0))
    return F.coalesce(plain, odd)


def whole_number(c: str | Column) -> Column:
    """Text to bigint by its longest leading whole number.

    ``'3.0'`` is 3, ``'12ab'`` is 12, ``''`` and ``'ab'`` are 0, NULL stays
    NULL, and a number beyond 64 bits stops at the limit. Never raises.
    """
    c = as_column(c)
    return F.when(c == "", F.lit(0).cast("bigint")).when(
        c.isNotNull(), _read_whole_number(c)
    )


def whole_number_or_null(c: str | Column) -> Column:
    """As :func:`whole_number`, but a blank is NULL rather than 0."""
    c = as_column(c)
    return F.when(c != "", _read_whole_number(c))


def text_length(c: str | Column) -> Column:
    return F.length(as_column(c)).cast("bigint")


def is_blank(c: str | Column) -> Column:
    """True only for ``''``; NULL is not blank, and the answer is never NULL."""
    return as_column(c).eqNullSafe(F.lit(""))


def like_ignoring_case(c: str | Column, pattern: str) -> Column:
    """LIKE that ignores the case of A-Z only and knows no escape character."""
    folded = F.translate(
        as_column(c), string.ascii_uppercase, string.ascii_lowercase
    )
    lowered = "".join(ch.lower() if ch in string.ascii_uppercase else ch for ch in pattern)
    return folded.like(lowered.replace("\\", "\\\\"))


def glob_regex(pattern: str) -> str:
    """The regular expression of a GLOB pattern (``*``, ``?``, ``[...]``)."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\")
            out.append(f"[{body}]")
            i = close + 1
            continue
        out.append({"*": ".*", "?": "."}.get(ch) or re.escape(ch))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def matches_glob(c: str | Column, pattern: str) -> Column:
    """GLOB: case matters, and the whole text has to match."""
    return as_column(c).rlike(glob_regex(pattern))


def read_timestamp(c: str | Column) -> Column:
    """ISO text to a zone-free timestamp in whole seconds, NULL when invalid."""
    c = as_column(c)
    to_the_second = F.substring(c, 1, 19)
    return F.when(c.rlike(_DATE_AND_MAYBE_TIME), to_the_second.try_cast("timestamp_ntz"))


def read_date(c: str | Column) -> Column:
    """ISO text (a time part is allowed) to a date, NULL when invalid.

    Only zero-padded dates that exist in the calendar count as valid.
    """
    c = as_column(c)
    day = F.substring(c, 1, 10)
    return F.when(c.rlike(_DATE_AND_MAYBE_TIME), day.try_cast("date"))


def day_first_to_iso(c: str | Column) -> Column:
    """``DD/MM/YYYY`` rearranged to ``YYYY-MM-DD``; other text is left alone."""
    c = as_column(c)
    rearranged = F.concat_ws(
        "-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2)
    )
    return F.when(c.contains("/"), rearranged).otherwise(c)


def rounded(c: str | Column, digits: int = 0) -> Column:
    """Half away from zero, as a double."""
    return F.round(as_column(c).cast("double"), digits)


def ratio(a: str | Column, b: str | Column) -> Column:
    """Real division in which division by zero is NULL."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def is_true(c: Column) -> Column:
    """A condition in which unknown counts as false."""
    return F.coalesce(c, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def local_now(zone: str) -> Column:
    """The wall clock of ``zone`` as a zone-free timestamp."""
    return F.convert_timezone(None, F.lit(zone), F.localtimestamp())
