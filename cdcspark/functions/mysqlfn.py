"""Meanings of source-dialect functions as column expressions (no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Date format tokens and their Spark patterns.
TOKENS = {"Y": "yyyy", "y": "yy", "m": "MM", "c": "M", "d": "dd", "e": "d", "H": "HH", "h": "hh", "I": "hh", "i": "mm", "s": "ss", "S": "ss", "f": "SSSSSS", "p": "a", "b": "MMM", "M": "MMMM", "W": "EEEE", "a": "E", "j": "DDD", "T": "HH:mm:ss", "r": "hh:mm:ss a", "%": "%"}
UNITS = ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")


def pattern(fmt: str) -> str:
    """Spark pattern of a ``%`` format; letters outside tokens are quoted, unknown tokens refused."""
    out = []
    for tok, text in re.findall(r"%(.)|([^%]+)", fmt, re.S):
        if tok and tok not in TOKENS:
            raise ValueError(f"unknown date token %{tok}")
        out.append(TOKENS[tok] if tok else re.sub(r"[A-Za-z]+", lambda m: f"'{m[0]}'", text.replace("'", "''")))
    return "".join(out)


def date_format(d: Column, fmt: str) -> Column:
    return F.date_format(d, pattern(fmt))


def str_to_date(s: Column, fmt: str) -> Column:
    """Malformed text gives null."""
    return F.try_to_timestamp(s, F.lit(pattern(fmt)))


def date_add(d: Column, n: Column | int, unit: str, sign: int = 1) -> Column:
    u, n = unit.upper(), (F.lit(n) if isinstance(n, int) else n) * sign
    if u not in UNITS:
        raise ValueError(f"unknown interval unit {unit}")
    zero = [F.lit(0)] * 7
    zero[{"YEAR": 0, "MONTH": 1, "DAY": 3, "HOUR": 4, "MINUTE": 5, "SECOND": 6}[u]] = n
    return d + F.make_interval(*zero)


def date_sub(d: Column, n: Column | int, unit: str) -> Column:
    return date_add(d, n, unit, -1)


def hour_second(text: Column) -> Column:
    """Interval of an ``h:m:s`` text."""
    p = F.split(text, ":")
    return F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), p[0].cast("int"), p[1].cast("int"), p[2].cast("decimal(18,6)"))


def shifted_format(d: Column, fmt: str, n: int, unit: str) -> Column:
    return date_format(date_add(d, n, unit), fmt)


def period_diff(a: Column, b: Column) -> Column:
    """Months between two YYYYMM numbers."""
    months = lambda p: F.floor(p / 100) * 12 + p % 100
    return (months(a) - months(b)).cast("long")


def makedate(year: Column, day: Column) -> Column:
    """The day of the year; day 0 and before give null."""
    return F.when(day > 0, F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int")))


def length(s: Column) -> Column:
    """Bytes."""
    return F.octet_length(s)


def char_length(s: Column) -> Column:
    return F.char_length(s)


def if_(c: Column, a: Column, b: Column) -> Column:
    return F.when(c, a).otherwise(b)


def substring_index(s: Column, sep: str, n: int) -> Column:
    """Parts up to the n-th separator; empty parts count."""
    return F.substring_index(s, sep, n)


def regexp(s: Column, p: str, case_insensitive: bool = True) -> Column:
    return s.rlike(("(?i)" if case_insensitive else "") + p)


def not_regexp(s: Column, p: str, case_insensitive: bool = True) -> Column:
    return ~regexp(s, p, case_insensitive)


def null_safe_equal(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def unsigned(c: Column) -> Column:
    """Unsigned 64-bit: negatives wrap round."""
    d = c.cast("decimal(20,0)")
    return F.when(d < 0, d + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(d).cast("decimal(20,0)")


def convert(c: Column, kind: str) -> Column:
    return c.try_cast(kind)


def as_text(c: Column) -> Column:
    return c.cast("string")


def not_exists(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    return df.join(other.select(*on), on, "left_anti")


def as_int(condition: Column) -> Column:
    return condition.cast("int")


def text_equal(a: Column, b: Column) -> Column:
    return a.cast("string") == b.cast("string")


def hex_text(c: Column, upper: bool = True) -> Column:
    return F.hex(c) if upper else F.lower(F.hex(c))


def chunks(s: Column, n: int) -> Column:
    """Pieces of ``n`` characters."""
    count = F.ceil(F.char_length(s) / n).cast("int")
    return F.when(count == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.substring(s, i * n + 1, F.lit(n))))


def csv_list(s: Column) -> Column:
    """Parts of a comma list, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")


def now() -> Column:
    return F.current_timestamp()
