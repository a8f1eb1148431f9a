"""Join helpers.

dplyr joins match NULL keys to NULL keys (``na_matches = "na"``) while SQL
joins drop them. ``join_null_safe`` gives the dplyr behaviour with ``<=>``
conditions; Spark still plans it as an equi-join (hash / sort-merge /
broadcast), so it partitions and co-locates like any other key join.

No helper here forces a broadcast: sides whose size grows with the data are
left to AQE, which converts a sort-merge join to a broadcast join only when the
measured shuffle output is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and otherwise keeps the shuffle join (splitting skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_TAG = "__tag"


def join_spread(rows: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``side``, itself a chain of joins on ``key``, so that AQE can split
    a hot key's rows.

    AQE splits a join only if both inputs come straight from a shuffle; inside a chain of
    joins on one key they do not. So the chain runs without the rows, and the rows meet its
    result in one join on (key, hash of the key): the chain's partitioning by the key alone
    does not serve that join, so both inputs are shuffled for it. NULL keys match nothing.
    """
    tag = F.hash(key).alias(_TAG)
    return rows.select("*", tag).join(side.select("*", tag), [key, _TAG]).drop(_TAG)


#: Parts that a key's rows are dealt out to while they meet the keys wanted.
SALTS = 16


def reduced(facts: DataFrame, wanted: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """The rows of ``facts`` whose ``key`` is among the keys of ``wanted``, before they are aggregated.

    A semi join on (key, salt): a fact's salt is that of the task that scans it, and the wanted
    keys are repeated for every salt. So the rows of a hot key meet their copies of it in several
    tasks, each of which pre-aggregates what passes. A small ``wanted`` is broadcast by its
    measured or estimated size, and the facts are then aggregated where they are scanned. NULL
    keys are dropped. The result does not depend on the salts.
    """
    salt = F.pmod(F.hash(F.spark_partition_id()), F.lit(salts)).alias(_TAG)
    spread = wanted.select(key, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(_TAG))
    return facts.select("*", salt).join(spread, [key, _TAG], "left_semi").drop(_TAG)


def join_null_safe(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    right_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL.

    ``right_keys`` names the right-hand columns when they differ (dplyr
    ``by = c("block" = <own block column>)``). The result has one copy of each key
    under the left name; for a full join it is the coalesce of both sides.
    Non-key column names must not clash (rename before joining).
    """
    keys = list(keys)
    right_keys = list(right_keys or keys)
    tmp = [f"__rk{i}" for i in range(len(keys))]
    r = right.select(
        *[F.col(rk).alias(t) for rk, t in zip(right_keys, tmp)],
        *[c for c in right.columns if c not in right_keys],
    )
    cond: Column | None = None
    for k, t in zip(keys, tmp):
        term = left[k].eqNullSafe(r[t])
        cond = term if cond is None else cond & term
    joined = left.join(r, cond, how)
    if how in ("full", "outer", "full_outer", "fullouter"):
        out = [F.coalesce(left[k], r[t]).alias(k) for k, t in zip(keys, tmp)]
        rest = [left[c] for c in left.columns if c not in keys] + [
            r[c] for c in r.columns if c not in tmp
        ]
        return joined.select(*out, *rest)
    if how in ("left_anti", "anti", "left_semi", "semi", "leftanti", "leftsemi"):
        return joined
    return joined.drop(*tmp)
