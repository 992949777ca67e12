"""Cleaning kinds used by staging. Each is one native Column expression."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..policy import DEFAULT

MONEY = "decimal(18,4)"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean_str(c: Column) -> Column:
    return blank_to_null(c)


def clean_int(c: Column) -> Column:
    return c.cast("bigint")


def clean_num(c: Column) -> Column:
    return c.cast(MONEY)


def clean_date(c: Column) -> Column:
    return c


def clean_sdate(c: Column, sentinel: dt.date = DEFAULT.null_date) -> Column:
    return F.nullif(c, F.lit(sentinel))


def clean_bool(c: Column) -> Column:
    return c.cast("boolean")


def clean_pdate(c: Column) -> Column:
    # M/d/yyyy also reads one-digit months and days; bad text gives null
    return F.try_to_timestamp(blank_to_null(c), F.lit("M/d/yyyy")).cast("date")


def clean_pnum(c: Column) -> Column:
    return blank_to_null(c).try_cast(MONEY)


def clean_hsnum(c: Column) -> Column:
    return blank_to_null(c).try_cast("double")


def clean_raw(c: Column) -> Column:
    return c


KINDS = {
    "key": clean_str,
    "str": clean_str,
    "int": clean_int,
    "num": clean_num,
    "date": clean_date,
    "sdate": clean_sdate,
    "bool": clean_bool,
    "pdate": clean_pdate,
    "pnum": clean_pnum,
    "hsnum": clean_hsnum,
    "raw": clean_raw,
}


def flag_eq(c: Column, value: int = 2) -> Column:
    """Menu integers use 1 for no and 2 for yes."""
    return c == F.lit(value)


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def fk(c: Column, prefix: str | None = None, unknown: str = DEFAULT.unknown_key) -> Column:
    """Foreign key that lands on the UNKNOWN member when unresolved."""
    return F.coalesce(F.concat(F.lit(prefix), c) if prefix else c, F.lit(unknown))


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def ratio(num: Column, den: Column) -> Column:
    """num / den in double, null when the divisor is zero or null."""
    d = den.cast("double")
    return num.cast("double") / F.nullif(d, F.lit(0.0))


def surrogate_key(*cols: Column) -> Column:
    """md5 over the values as text, with a marker in place of nulls."""
    parts = [F.coalesce(c.cast("string"), F.lit("_dbt_utils_surrogate_key_null_")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
