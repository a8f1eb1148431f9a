"""AGG8: R's ``summary()`` six-number profile of numeric columns.

min, first quartile, median, mean, third quartile and max per column (type-7
quartiles, exact), plus the number of NULLs R prints as "NA's". The columns are
unpivoted to (column, value) rows, so every column is one group; each group
holds a large share of all rows, which ``group_quantiles`` and ``group_sums`` handle without
sending a group to one task. NaN is missing, as NULL is: it counts among the NA's and
enters no statistic. Infinities are values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.grouped import attach, group_quantiles, group_sums, mean_of

SUMMARY_COLUMNS = ("column", "min", "q1", "median", "mean", "q3", "max", "nas")


def six_number_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    numbers = {c: F.col(c).cast("double") for c in columns}
    long = df.select(*[F.when(~F.isnan(x), x).alias(c) for c, x in numbers.items()]).unpivot([], list(columns), "column", "value")
    sums = group_sums(long, ["column"], {"value": "value"}, {"min": ("min", "value"), "max": ("max", "value")})
    basic = sums.select("column", "min", "max", mean_of("value").alias("mean"), F.col("value.missing").alias("nas"))
    quart = group_quantiles(long, ["column"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, levels=3)
    return attach(basic, quart, ["column"]).select(*SUMMARY_COLUMNS)
