"""Text cut to a number of UTF-8 bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cut_utf8(text: Column, size: int) -> Column:
    """The longest beginning of at most ``size`` bytes that ends with a whole character."""
    raw = F.encode(text, "UTF-8")
    tries = [F.try_validate_utf8(F.substring(raw, 1, size - k).cast("string")) for k in range(min(4, size))]
    return F.when(F.octet_length(text) <= size, text).when(text.isNotNull(), F.coalesce(*tries, F.lit("")))


def width(text: Column) -> Column:
    """Aggregate: the bytes of the longest text, one at least."""
    return F.greatest(F.lit(1), F.coalesce(F.max(F.octet_length(text)), F.lit(1)))
