"""SRC4 and FLT7: the two constant tables of the jobs.

Both are fixed, tiny and independent of the data, so broadcasting them is safe
at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomrate.functions.encode import CITY_LEVEL_ROWS

# fixed values: suites excluded from pricing, as listed in the rooms-to-price
# extract (85 entries, repeats included; compared numerically with suite_id)
SUITE_DENYLIST = (
    "7736", "5056", "9077", "8991", "8866", "9034", "9032", "10086", "10036", "8870",
    "10111", "10086", "10036", "8782", "9935", "10392", "10420", "10425", "10293", "8812",
    "10204", "10315", "10499", "10610", "10477", "10392", "10315", "10204", "10036", "8870",
    "10432", "10441", "107171", "10509", "10541", "10420", "10293", "9032", "9034", "10662",
    "10373", "8866", "10804", "10842", "10675", "10559", "10432", "10425", "8991", "8812",
    "11023", "10717", "10895", "10573", "11138", "11041", "10972", "10829", "11092", "11184",
    "10510", "10807", "11010", "10585", "11017", "10905", "11473", "11915", "13395", "13936",
    "14799", "14500", "14506", "14509", "14376", "14377", "14582", "14989", "21393", "22565",
    "22504", "20812", "21878", "23263", "22623",
)

CITY_LEVEL_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType(), False), T.StructField("city_level", T.IntegerType(), False)]
)


def denied_suite_ids() -> list[int]:
    """The denylist as distinct integers (a NOT IN over a numeric key)."""
    return sorted({int(s) for s in SUITE_DENYLIST})


def city_level_table(spark: SparkSession) -> DataFrame:
    """SRC4: the inline 8-row city tier table, marked for broadcast."""
    return F.broadcast(spark.createDataFrame(list(CITY_LEVEL_ROWS), CITY_LEVEL_SCHEMA))
