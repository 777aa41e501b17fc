"""Header lookups on ``ARRAY<STRUCT<name, value>>`` columns.

Header names repeat and compare case-insensitively; the first hit wins. A
MAP would lose both properties, hence the array.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import HEADERS


def header(headers: Column, name: str) -> Column:
    """Value of the first header called ``name`` (any case); NULL if absent."""
    key = name.lower()
    hits = F.filter(headers, lambda h: F.lower(h["name"]) == F.lit(key))
    return F.try_element_at(hits, F.lit(1))["value"]


def make_headers(*pairs: tuple[str, Column | str]) -> Column:
    """Build a header array from (name, value) pairs; NULL values are skipped."""
    if not pairs:
        return F.array().cast(HEADERS)
    items = [F.struct(F.lit(n).alias("name"),
                      (v if isinstance(v, Column) else F.lit(v)).alias("value"))
             for n, v in pairs]
    return F.filter(F.array(*items), lambda h: h["value"].isNotNull())
