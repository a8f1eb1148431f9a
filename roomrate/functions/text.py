"""Text helpers for the competitor crawl (FN4, FN5, FLT5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: markers of the crawl's business-district text
METRO_LINE = "号线"
LINE_CHAR = "线"
CITY_SUFFIX = "市"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def crawl_block(district: Column | str, district_block: Column | str) -> Column:
    """FN4: the block name inside the crawl's district fields.

    * district names a metro line: the text after the last '线', ')' removed;
    * otherwise: the district-block text from character 3 for (bytes - 6)
      characters. MySQL ``length`` counts UTF-8 bytes, hence ``octet_length``;
      a negative length yields ''.
    """
    d, b = _c(district), _c(district_block)
    from_line = F.regexp_replace(F.substring_index(d, LINE_CHAR, -1), r"\)", "")
    n = F.octet_length(b) - 6
    from_block = F.when(n > 0, b.substr(F.lit(3), n)).when(n.isNotNull(), F.lit(""))
    return F.when(d.contains(METRO_LINE), from_line).otherwise(from_block)


def with_city_suffix(city: Column | str) -> Column:
    """FN5 ``concat(city, '市')``; NULL in, NULL out."""
    return F.concat(_c(city), F.lit(CITY_SUFFIX))
