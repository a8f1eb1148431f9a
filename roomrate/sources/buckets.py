"""Warehouse tables stored in buckets of their suite.

The suite-keyed aggregates and joins of JOB_C then read each bucket where it lies: the tables are
shuffled by suite once, when they are stored, and not by every run. Only two results of one row per
suite still move: the landlord's price, which is found by contract, and the decoration cost, whose
exact rounding is a Python step that Spark does not credit with keeping the buckets. The rooms to
price meet the finished chain in a shuffle of their own, which AQE can split.
A bucket is read by one task, so a table in which one suite (or the missing suite) holds more rows
than a bucket does on average is stored without buckets; jobs then shuffle it, and AQE can split
the suite.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables with a suite's key, and the key's column.
SUITE_KEYS = {
    "suites": "id",
    "rooms": "suite_id",
    "suite_decorations": "suite_id",
    "contract_with_landlords": "suite_id",
    "f_bi_sfinfor_day": "suite_id",
}


def spreads(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether no value of ``key``, NULL included, has more rows than a bucket has on average."""
    top = df.groupBy(key).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    return top["rows"] is None or top["most"] * buckets <= top["rows"]


def store_by_suite(tables, database: str, buckets: int, names: Iterable[str] | None = None) -> list[str]:
    """Save ``tables`` (all, or ``names``) in an existing metastore ``database``.

    Suite-keyed tables go to ``buckets`` buckets, one file each, unless one suite is too large for
    a bucket; other tables are saved as they are. A table that the database holds already raises.
    Returns the names of the tables that lie in buckets. Read them with
    ``RentalTables.from_catalog``.
    """
    kept = []
    for name in tables if names is None else names:
        df, key = tables[name], SUITE_KEYS.get(name)
        if key and spreads(df, key, buckets):
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key)  # the hash of the buckets
            kept.append(name)
        else:
            writer = df.write
        writer.format("parquet").saveAsTable(f"{database}.{name}")
    return kept


def bucketed(spark: SparkSession, database: str, names: Iterable[str]) -> frozenset[str]:
    """The suite-keyed tables of ``database`` that lie in buckets of their key, and of it alone."""
    return frozenset(
        n
        for n in names
        if n in SUITE_KEYS
        and [c.name for c in spark.catalog.listColumns(f"{database}.{n}") if c.isBucket] == [SUITE_KEYS[n]]
    )
