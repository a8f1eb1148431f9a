"""Group statistics that scale past one hot group.

The reference computes its statistics with ``group_by() %>% mutate()``: one
value per group repeated on every row. The Spark form of that is a grouped
aggregate joined back to the rows on the (null-safe) group key, never a
window over raw rows: a window sorts a whole group inside one task, so one
community holding a third of the data would run in one task.

* Sums, counts and means decompose: ``group_sums`` pre-aggregates in every map task, so a
  hot group reaches its reducer as a few partial rows per task; its sums are exact.
* Quantiles do not decompose. ``group_quantiles`` computes exact order
  statistics without gathering a group: it counts each distinct (group, value)
  and each (group, bucket), where a value's bucket is a fixed monotone function
  of the value (a 4096th of an octave), finds the buckets that hold the wanted
  ranks from the running counts over buckets, and ranks the values of those
  buckets only. Nothing is sampled and no partition number enters the result.
  Interpolation is R's type 7 (also Spark ``percentile`` / DuckDB
  ``quantile_cont``): h = (n-1)p, x[lo] + (h-lo)(x[hi]-x[lo]).

NULL group keys form a group, as in dplyr and SQL GROUP BY.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from roomrate.operators.joins import join_null_safe

_V = "__v"
_C = "__c"
_B = "__b"
_G = "__g"
#: Buckets per doubling of a value.
OCTAVE = 4096
#: Parts of a bucket on each further level.
PARTS = 1024


def _digits(v: Column, levels: int) -> list[Column]:
    """Monotone bucket of a double, then its place in finer and finer parts of that bucket.

    Infinities and zero have a bucket of their own, NULL the lowest; these have no parts.
    """
    place = F.log2(F.abs(v)) * OCTAVE
    regular = v.isNotNull() & (v != 0) & (F.abs(v) < F.lit(float("inf")))
    size = F.floor(place) + 1100 * OCTAVE  # above 0 down to the smallest double
    far = F.lit(4000 * OCTAVE)
    b = F.when(v == 0, F.lit(0)).when(F.abs(v) == F.lit(float("inf")), F.signum(v) * far).otherwise(F.signum(v) * size)
    out = [F.when(v.isNull(), F.lit(-5000 * OCTAVE)).otherwise(b).cast("long")]
    rest = place - F.floor(place)
    for _ in range(levels - 1):
        out.append(F.when(regular, F.signum(v) * F.floor(rest * PARTS)).otherwise(F.lit(0)).cast("long"))
        rest = rest * PARTS - F.floor(rest * PARTS)
    return out


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    probs: Mapping[str, float],
    na_poisons: bool = False,
    na_fails: bool = False,
    levels: int = 1,
) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per group: one row per group.

    ``probs`` maps output column -> probability. NULL and NaN (R's NA) are left out of
    the ranking; with ``na_poisons`` (R without ``na.rm``) any NULL in a group makes
    every quantile of that group NULL. A group with no non-NULL value gets NULL. With
    ``na_fails`` (R's ``quantile`` on NA) a missing value fails the run, by the group's key.

    ``levels`` above 1 refine the buckets that hold the wanted ranks, ``PARTS`` times each, before
    values are ranked: for groups whose many distinct values lie in a narrow range, which would
    else be ranked by one task. Three levels tell apart 2 ** 32 parts of an octave. The result is
    the same at every number of levels.
    """
    keys = list(keys)
    val = F.col(value) if isinstance(value, str) else value
    # The group keys travel as one non-NULL struct: struct equality treats NULL
    # fields as equal (NULL keys form a group), so the internal join is a plain equi-join.
    val = val.cast("double")
    base = df.select(F.struct(*[F.col(k) for k in keys]).alias(_G), F.when(~F.isnan(val), val + F.lit(0.0)).alias(_V))

    # one row per distinct (group, value), NULL values as their own row: a hot
    # group shrinks to its distinct values, and every group keeps a row
    digits = [f"{_B}{i}" for i in range(levels)]
    counts = base.groupBy(_G, _V).agg(F.count(F.lit(1)).alias(_C))
    # No digit is NULL, and Spark is told so: else the join on them below filters one of its sides by
    # "digit is not NULL", down to the scan of ``df``, and the two sides no longer share one run of it.
    known = [F.coalesce(d, F.lit(0).cast("long")) for d in _digits(F.col(_V), levels)]
    counts = counts.withColumns(dict(zip(digits, known)))
    present = F.col(_V).isNotNull()

    buckets = None
    for level in range(levels):
        # running counts over the buckets of a group (or the parts of a bucket that holds a wanted
        # rank): a small table whatever the group's size
        outer, here = [_G, *digits[:level]], digits[level]
        known = [] if buckets is None else ["__off", "__n", "__nulls"]
        rows = counts if buckets is None else counts.join(buckets, outer)
        found = rows.groupBy(*outer, here, *known).agg(
            F.sum(F.when(present, F.col(_C)).otherwise(F.lit(0))).alias("__t"),
            F.sum(F.when(~present, F.col(_C)).otherwise(F.lit(0))).alias("__tn"),
        )
        within = Window.partitionBy(*outer)
        before = F.coalesce(F.sum("__t").over(within.orderBy(here).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = found.select(
            *outer,
            here,
            "__t",
            "__tn",
            (F.col("__off") + before if known else before).alias("__off"),
            (F.col("__n") if known else F.sum("__t").over(within)).alias("__n"),
            (F.col("__nulls") if known else F.sum("__tn").over(within)).alias("__nulls"),
        )
        wanted = F.col("__tn") > 0
        for p in probs.values():
            h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
            for rank in (F.floor(h), F.ceil(h)):
                wanted = wanted | ((F.col("__off") <= rank) & (rank < F.col("__off") + F.col("__t")))
        buckets = found.where(wanted).drop("__t", "__tn")

    # the values of those buckets, ranked
    inside = Window.partitionBy(_G, *digits).orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(buckets, [_G, *digits], "inner").withColumn(
        "__cum", F.sum(F.when(present, F.col(_C)).otherwise(F.lit(0))).over(inside)
    )
    hi_cum = F.col("__off") + F.col("__cum")  # non-NULL rows of the group up to and including this value
    lo_cum = hi_cum - F.col(_C)  # rows strictly below; this value holds ranks [lo_cum, hi_cum)

    picks, aggs, finals = [~present], [F.max("__nulls").alias("__nulls")], []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        cov_lo = present & (lo_cum <= lo) & (lo < hi_cum)
        cov_hi = present & (lo_cum <= hi) & (hi < hi_cum)
        picks.append(cov_lo | cov_hi)
        aggs += [
            F.max(F.when(cov_lo, F.col(_V))).alias(f"__lo{i}"),
            F.max(F.when(cov_hi, F.col(_V))).alias(f"__hi{i}"),
            F.max(h - lo).alias(f"__f{i}"),
        ]
        x_lo, x_hi, frac = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__f{i}")
        q = F.when((x_hi == x_lo) | (frac == 0), x_lo).otherwise((1 - frac) * x_lo + frac * x_hi)
        if na_poisons:
            q = F.when(F.col("__nulls") > 0, F.lit(None).cast("double")).otherwise(q)
        if na_fails:
            told = F.concat(F.lit(f"missing value of {name} in the group "), F.to_json(_G, {"ignoreNullFields": "false"}))
            q = F.when(F.col("__nulls") > 0, F.raise_error(told).cast("double")).otherwise(q)
        finals.append(q.alias(name))

    keep = picks[0]
    for c in picks[1:]:
        keep = keep | c
    # at most (1 + 2 * len(probs)) rows per group survive the filter
    chosen = ranked.where(keep).groupBy(_G).agg(*aggs)
    return chosen.select(*[F.col(_G).getField(k).alias(k) for k in keys], *finals)


# ------------------------------------------------------------------ exact sums
# A double SUM depends on the order in which rows arrive (partitioning, retries). Here a value is a
# whole number of the last binary place of its bin, BIN binary orders of magnitude wide; whole
# numbers of one bin add up exactly as decimals, in any order, and the few bins of a group are
# put together and rounded once, to the nearest double.
BIN = 32
#: Binary places kept below the foot of a bin: one more than a double has, for a logarithm rounded up.
_PLACES = 54
_HALF = 43  # a value's whole number has up to 87 bits; it goes through two longs
_UP, _DOWN = 1000, -1000  # bins of the infinities
#: Whole numbers of the lowest bin are multiples of 2 to the power of minus this.
_LOWEST = BIN * 34 + _PLACES


def _binned(v: Column) -> tuple[Column, Column]:
    """(bin, whole number) of a double; the bin is NULL for NULL and NaN."""
    size = F.abs(v)
    regular = F.floor(F.log2(size) / BIN).cast("int")
    place = (
        F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int"))
        .when(size == F.lit(float("inf")), F.when(v > 0, F.lit(_UP)).otherwise(F.lit(_DOWN)))
        .when(v == 0, F.lit(0))
        .otherwise(regular)
    )
    power = _PLACES - BIN * regular
    half = F.floor(power / 2)  # in two steps: one power of two may be beyond a double
    scaled = v * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (power - half).cast("double"))
    high = F.floor(scaled / float(2**_HALF))
    low = scaled - high * float(2**_HALF)
    whole = high.cast("decimal(15,0)") * F.lit(2**_HALF).cast("decimal(14,0)") + low.cast("long").cast("decimal(14,0)")
    usual = v.isNotNull() & ~F.isnan(v) & (size < F.lit(float("inf"))) & (v != 0)
    return place, F.when(usual, whole).otherwise(F.lit(0).cast("decimal(31,0)"))


def _put_together(bins: Column) -> Column:
    """The double nearest to the sum of a group's bins; NULL for none, or for both infinities."""
    up, down, width, lowest, places = _UP, _DOWN, BIN, _LOWEST, _PLACES

    # holds all it needs, so that tasks need no module of this package
    def nearest(batch: pa.Array) -> pa.Array:
        out = []
        for bins in batch.to_pylist():
            found = {b["b"] for b in bins or ()}
            if not found or {up, down} <= found:
                out.append(None)
            elif found & {up, down}:
                out.append(float("inf") if up in found else float("-inf"))
            else:
                total = sum(int(b["v"]) << (width * b["b"] - places + lowest) for b in bins)
                try:
                    out.append(total / (1 << lowest))  # division of whole numbers rounds correctly
                except OverflowError:
                    out.append(float("inf") if total > 0 else float("-inf"))
        return pa.array(out, pa.float64())

    return F.arrow_udf(nearest, DoubleType())(bins)


def group_sums(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, str | Column], extra: Mapping[str, tuple[str, str | Column]] | None = None
) -> DataFrame:
    """One row per group: for each of ``values`` a struct column ``<sum, n, missing>``.

    ``sum`` is the double nearest to the exact sum of the values that are neither NULL nor NaN,
    whatever the partitions and the order of rows; NULL if there is none (``n`` is 0), and with
    both infinities. ``missing`` counts the others. ``extra`` names plain aggregates of the same
    pass: ``("max" | "min" | "sum" | "count", column)``.

    A map task adds up its rows by group and bins (a hot group arrives as a few partial rows);
    what a group then gathers is bounded by the bins of a double (68 per value), not by its rows.
    """
    extra = dict(extra or {})
    plain = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    group = [f"__k{i}" for i in range(len(keys))]  # plain columns: rows that lie by a key stay there
    parts = {name: _binned(_col(c).cast("double")) for name, c in values.items()}
    base = df.select(
        *[F.col(k).alias(g) for k, g in zip(keys, group)],
        *[c.alias(f"__{x}_{name}") for name, pair in parts.items() for x, c in zip("bv", pair)],
        *[_col(c).alias(f"__x_{name}") for name, (_, c) in extra.items()],
    )
    first = base.groupBy(*group, *[f"__b_{n}" for n in parts]).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in parts],
        *[plain[how](f"__x_{n}").alias(f"__x_{n}") for n, (how, _) in extra.items()],
    )
    aggs = []
    for n in parts:
        known = F.col(f"__b_{n}").isNotNull()
        aggs += [
            F.collect_list(F.when(known, F.struct(F.col(f"__b_{n}").alias("b"), F.col(f"__v_{n}").alias("v")))).alias(f"__l_{n}"),
            F.sum(F.when(known, F.col("__rows")).otherwise(F.lit(0))).alias(f"__n_{n}"),
            F.sum(F.when(known, F.lit(0)).otherwise(F.col("__rows"))).alias(f"__m_{n}"),
        ]
    again = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}
    aggs += [again[how](f"__x_{n}").alias(n) for n, (how, _) in extra.items()]
    second = first.groupBy(*group).agg(*aggs)
    return second.select(
        *[F.col(g).alias(k) for k, g in zip(keys, group)],
        *[
            F.struct(_put_together(F.col(f"__l_{n}")).alias("sum"), F.col(f"__n_{n}").alias("n"), F.col(f"__m_{n}").alias("missing")).alias(n)
            for n in parts
        ],
        *extra,
    )


def mean_of(name: str) -> Column:
    """Mean of a struct of ``group_sums``: NULL when no value is known."""
    c = F.col(name)
    return F.when(c["n"] > 0, c["sum"] / c["n"])


def total_of(name: str, na_poisons: bool = False) -> Column:
    """Sum of a struct of ``group_sums``; with ``na_poisons`` (R without ``na.rm``) a missing value voids it."""
    c = F.col(name)
    return F.when(c["missing"] == 0, c["sum"]) if na_poisons else c["sum"]


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def na_poisoned(agg: Column, col: str) -> Column:
    """R aggregate without ``na.rm``: NULL when the group holds any NULL of ``col``."""
    return F.when(F.count(F.lit(1)) == F.count(F.col(col)), agg)


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``group_by(keys) %>% mutate(stats)``: the group's values on each of its rows."""
    return join_null_safe(rows, stats, keys, "left")
