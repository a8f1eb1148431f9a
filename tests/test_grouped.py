"""Group statistics: exact distributed quantiles, NA poisoning, null-safe attach."""

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomrate.operators.grouped import attach, group_quantiles, group_sums, mean_of, na_poisoned, total_of
from roomrate.operators.joins import join_null_safe


def test_median_and_q65_of_four(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 4, 10)], "g string, v double")
    r = group_quantiles(df, ["g"], "v", {"q50": 0.5, "q65": 0.65}).collect()[0]
    assert r["q50"] == 3.0
    assert r["q65"] == pytest.approx(3.9)


def test_null_key_is_a_group_and_all_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 5.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in group_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": None, "b": 5.0}


def test_na_poisoning(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 2.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in group_quantiles(df, ["g"], "v", {"m": 0.5}, na_poisons=True).collect()}
    assert got == {"g": None, "h": 2.0}
    s = df.groupBy("g").agg(na_poisoned(F.sum("v"), "v").alias("s")).collect()
    assert {r["g"]: r["s"] for r in s} == {"g": None, "h": 2.0}


def test_infinity_sorts_last(spark):
    # ratio by zero: 3000 with 0 bedrooms next to 1000 and 1200 per room
    df = spark.createDataFrame([("g", 1000.0), ("g", 1200.0), ("g", math.inf)], "g string, v double")
    r = group_quantiles(df, ["g"], "v", {"m": 0.5, "top": 1.0}).collect()[0]
    assert r["m"] == 1200.0 and r["top"] == math.inf


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-50, 50)), min_size=1, max_size=60),
    st.sampled_from([0.0, 0.25, 0.5, 0.6, 0.65, 1.0]),
)
def test_quantiles_match_numpy(spark, rows, p):
    pdf = pd.DataFrame(rows, columns=["g", "v"]).astype({"v": float})
    df = spark.createDataFrame(pdf, "g string, v double").repartition(5)
    got = {r["g"]: r["q"] for r in group_quantiles(df, ["g"], "v", {"q": p}).collect()}
    for g, sub in pdf.groupby("g", dropna=False):
        key = None if (isinstance(g, float) and math.isnan(g)) else g
        assert got[key] == pytest.approx(np.quantile(sub["v"].to_numpy(), p))


def test_hot_group_spans_partitions(spark):
    # one key holds most rows; the range partitioning must split it and the
    # result must still be exact
    rng = np.random.default_rng(7)
    n = 40000
    g = np.where(rng.random(n) < 0.8, "hot", "cold")
    v = rng.integers(0, 100000, n).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v})).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["g"]: (r["q1"], r["q3"]) for r in group_quantiles(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for key in ("hot", "cold"):
        x = v[g == key]
        assert got[key] == pytest.approx((np.quantile(x, 0.25), np.quantile(x, 0.75)))


def test_exact_sum_is_partition_independent(spark):
    vals = [(i % 7, 0.1 * i + 1e-3 * (i % 13)) for i in range(5000)]
    df = spark.createDataFrame(vals, "k int, v double")
    a, b = (
        {r[0]: (r[1], r[2]) for r in group_sums(df.repartition(k), ["k"], {"v": "v"}).select("k", total_of("v"), mean_of("v")).collect()}
        for k in (3, 17)
    )
    assert a == b
    assert a == {k: (math.fsum(v for g, v in vals if g == k), math.fsum(v for g, v in vals if g == k) / sum(g == k for g, _ in vals)) for k in range(7)}


def test_attach_preserves_rows_and_matches_nulls(spark):
    rows = spark.createDataFrame([("x", None, 1), ("x", None, 2), ("x", "b", 3), ("y", "b", 4)], "c string, k string, v int")
    stats = rows.groupBy("c", "k").agg(F.sum("v").alias("s"))
    out = attach(rows, stats, ["c", "k"]).collect()
    assert len(out) == 4
    assert sorted((r["v"], r["s"]) for r in out) == [(1, 3), (2, 3), (3, 3), (4, 4)]


def test_full_join_null_safe_coalesces_keys(spark):
    left = spark.createDataFrame([("a", None, 1.0), ("b", "x", 2.0)], "city string, community string, l double")
    right = spark.createDataFrame([("a", None, 5.0), ("c", "y", 6.0)], "city string, community string, r double")
    out = sorted(tuple(r) for r in join_null_safe(left, right, ["city", "community"], "full").collect())
    assert out == sorted([("a", None, 1.0, 5.0), ("b", "x", 2.0, None), ("c", "y", None, 6.0)], key=str)


def test_quantiles_do_not_depend_on_exchange_reuse_or_partitions(spark):
    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        ((F.xxhash64("id") % 10_000_000) / 7.0).alias("v"),
    )
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", 0.65).alias("q")).collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for reuse, parts in (("true", "5"), ("false", "13")):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r["g"]: r["q"] for r in group_quantiles(df, ["g"], "v", {"q": 0.65}).collect()}
            assert got.keys() == want.keys()
            assert all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_quantiles_of_special_values(spark):
    vs = [float("nan"), None, -math.inf, -3.5, -0.0, 0.0, 5e-324, 1e-300, 2.0, 1.7e308, math.inf]
    df = spark.createDataFrame([("g", v) for v in vs], "g string, v double")
    r = group_quantiles(df, ["g"], "v", {"lo": 0.0, "a": 0.125, "m": 0.5, "hi": 1.0}).collect()[0]
    assert (r["lo"], r["a"], r["m"], r["hi"]) == (-math.inf, -3.5, 5e-324, math.inf)


def test_exact_sums_of_infinities_and_nan(spark):
    rows = [("a", 1.0), ("a", math.inf), ("b", 1.0), ("b", math.nan), ("c", math.inf), ("c", -math.inf), ("d", None), ("e", -math.inf)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["s"], r["m"]) for r in group_sums(df, ["g"], {"v": "v"}).select("g", total_of("v").alias("s"), mean_of("v").alias("m")).collect()}
    assert got == {"a": (math.inf, math.inf), "b": (1.0, 1.0), "c": (None, None), "d": (None, None), "e": (-math.inf, -math.inf)}


def _sums(spark, groups, partitions=4):
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(partitions)
    return {r["g"]: r["s"] for r in group_sums(df, ["g"], {"v": "v"}).select("g", total_of("v").alias("s")).collect()}


def test_sums_of_any_size_are_right_to_the_last_bit(spark):
    groups = {
        "large and small": [1e30, 1.0, -1e30, 1e-12],
        "small": [1e-12] * 3,
        "smallest": [5e-324] * 5 + [2.2250738585072014e-308],
        "largest": [1.7976931348623157e308, 1e292, -1.7976931348623157e308],
        "beyond": [1.7976931348623157e308] * 2,
        "below": [-1.7976931348623157e308] * 2,
        "powers of two": [2.0**k for k in range(-1074, 1000, 31)] + [-(2.0**k) for k in range(-1074, 990, 62)],
        "zeros": [0.0, -0.0],
        "tie": [2.0**53, 1.0, 2.0**-60],
    }
    want = {"beyond": math.inf, "below": -math.inf}
    for g, vs in groups.items():
        if g not in want:
            want[g] = float(sum(map(Fraction, vs)))
    for partitions in (1, 3, 9):
        assert _sums(spark, groups, partitions) == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=80))
def test_sums_match_fsum(spark, vs):
    assert _sums(spark, {"g": vs}) == {"g": math.fsum(vs)}


def test_sums_with_missing_values_and_other_aggregates(spark):
    rows = [("a", 1.5, 3, "x"), ("a", None, 4, "y"), (None, math.nan, 5, None), (None, 2.0, None, "z"), ("b", None, None, None)]
    df = spark.createDataFrame(rows, "g string, v double, i int, t string")
    out = group_sums(df, ["g"], {"v": "v", "w": F.col("v") * 2}, {"i": ("sum", "i"), "t": ("max", "t"), "low": ("min", "t"), "rows": ("count", F.lit(1))})
    got = {r["g"]: (tuple(r["v"]), tuple(r["w"]), r["i"], r["t"], r["low"], r["rows"]) for r in out.collect()}
    assert got == {
        "a": ((1.5, 1, 1), (3.0, 1, 1), 7, "y", "x", 2),
        None: ((2.0, 1, 1), (4.0, 1, 1), 5, "z", "z", 2),
        "b": ((None, 0, 1), (None, 0, 1), None, None, None, 1),
    }
    assert group_sums(df.limit(0), ["g"], {"v": "v"}).collect() == []


def test_missing_quantile_input_fails_by_its_group(spark):
    df = spark.createDataFrame([("g", "n", 1.0), ("g", "n", 2.0), ("h", None, None)], "g string, b string, v double")
    with pytest.raises(Exception, match=r'missing value of m in the group \{"g":"h","b":null\}'):
        group_quantiles(df, ["g", "b"], "v", {"m": 0.5}, na_fails=True).collect()
    ok = group_quantiles(df.where("v is not null"), ["g", "b"], "v", {"m": 0.5}, na_fails=True).collect()
    assert [tuple(r) for r in ok] == [("g", "n", 1.5)]


def test_profile_counts_nan_as_missing(spark):
    from roomrate.plans.profile import six_number_summary

    df = spark.createDataFrame([(v, 1) for v in (1.0, math.nan, None, 4.0, 2.0, 1e30, -1e30)], "a double, b int")
    got = {r["column"]: tuple(r)[1:] for r in six_number_summary(df, ["a", "b"]).collect()}
    assert got["a"] == (-1e30, 1.0, 2.0, 1.4, 4.0, 1e30, 2)
    assert got["b"] == (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_quantiles_of_a_narrow_range(spark, levels):
    """A million distinct values within one bucket: finer levels share them out and change nothing."""
    from roomrate.operators.grouped import _digits

    df = spark.range(1_000_000).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("g"), (1 + 0.0001 * F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / (1 << 40)).alias("v")
    )
    want = {r["g"]: (r["q1"], r["m"]) for r in df.groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.5).alias("m")).collect()}
    got = {r["g"]: (r["q1"], r["m"]) for r in group_quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5}, levels=levels).collect()}
    assert got == {g: pytest.approx(q, rel=1e-13) for g, q in want.items()}
    largest = df.groupBy("g", *_digits(F.col("v"), levels)).count().agg(F.max("count")).first()[0]
    assert largest > 700_000 if levels == 1 else largest < 10_000


@pytest.mark.parametrize("levels", [1, 3])
def test_finer_levels_keep_the_order_of_values(spark, levels):
    from roomrate.operators.grouped import _digits

    rng = np.random.default_rng(8)
    vs = [-math.inf, math.inf, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]
    vs += (rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000)).tolist() + (1 + rng.random(3000) * 1e-6).tolist() + (-1 - rng.random(3000) * 1e-6).tolist()
    df = spark.createDataFrame([(v,) for v in vs], "v double").select("v", F.array(*_digits(F.col("v"), levels)).alias("d"))
    found = [r["d"] for r in df.orderBy("v").collect()]
    assert found == sorted(found)
