"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: text standing in for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """Hex md5 over the ``-``-joined text of the fields; NULL fields still give a key."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: Column | str) -> Column:
    """``YYYYMMDD`` as an integer."""
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")
