"""String conforming."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# The Unicode space separators (category Zs).
SPACES = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """Strip every Unicode space separator (not only 0x20) from both ends; tabs stay."""
    return F.trim(_col(c), F.lit(SPACES))


def conform_name(c: Column | str) -> Column:
    return trim_spaces(F.lower(_col(c)))


def name_part(c: Column | str, part: int) -> Column:
    """``owner/name`` part 1 or 2; a missing part is '' and NULL stays NULL."""
    return F.split_part(_col(c), F.lit("/"), F.lit(part))
