"""Small column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshift.schema import MONEY


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plus_days(ts: str | Column, days: int | Column) -> Column:
    """``ts + days`` keeping the timestamp flavour (NTZ stays NTZ)."""
    n = F.lit(days) if isinstance(days, int) else days
    return col(ts) + F.make_dt_interval(days=n.cast("int"))


def padded(number: Column, width: int) -> Column:
    """Decimal text with leading zeros up to ``width``; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), padded(number, width))


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def money_lit(value: str) -> Column:
    """A decimal literal; multiplying money by a double would lose exactness."""
    return F.lit(Decimal(value))


def to_double(c: str | Column) -> Column:
    """Cast exact money to double at a report boundary."""
    return col(c).cast("double")


def ts_lit(value, data_type="timestamp_ntz") -> Column:
    """Timestamp literal from its wall-clock text, cast to ``data_type``.

    ``F.lit(datetime)`` goes through the Python process and session time
    zones; text cast to ``timestamp_ntz`` does not, so results do not depend
    on either.
    """
    if isinstance(value, (datetime, date)):
        value = value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(value).cast(data_type)
