"""Unit rows for the column functions (FIXTURES.md §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomrate.functions import encode as E
from roomrate.functions.dates import month_in_interval
from roomrate.functions.numeric import clamp_nonneg, lenient_double, lenient_int, r_div, snap_price
from roomrate.functions.text import crawl_block, with_city_suffix


def one_col(spark, values, expr, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", _type(dtype))]))
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def _type(name):
    return {"double": T.DoubleType(), "string": T.StringType(), "int": T.IntegerType(), "date": T.DateType()}[name]


def test_snap_edges(spark):
    got = one_col(spark, [2100.0, 2130.0, 2130.01, 2160.0, 2160.01, 2195.0, -17.5, None], snap_price)
    assert got[:7] == pytest.approx([2130, 2130, 2160, 2160, 2190, 2190, -10])
    assert got[7] is None


def test_snap_property(spark):
    vals = [x / 7.0 for x in range(-3000, 30000, 13)]
    got = one_col(spark, vals, snap_price)
    for r, s in zip(vals, got):
        assert round(s % 100, 6) in (30.0, 60.0, 90.0)
        assert -10 < s - r <= 30 + 1e-9


def test_face_codes(spark):
    assert one_col(spark, ["北", "西北", "东", "南", None], E.face_code, "string") == [1, 2, 3, 4, 4]


def test_shape_codes(spark):
    df = spark.createDataFrame(
        [("狭长型", ""), ("斜顶", ""), ("其他", "L型"), ("其他", ""), (None, None), ("其他", None)], "shape string, note string"
    )
    got = [r[0] for r in df.select(E.shape_code("shape", "note")).collect()]
    assert got == [-1, 0, -2, 1, 1, 1]


def test_lighting_and_flags(spark):
    assert one_col(spark, ["非私有采光", "无采光", "私有采光", None], E.lighting_code, "string") == [0, -1, 1, 1]
    assert one_col(spark, ["有", "无", None], E.yes_flag, "string") == [1, 0, 0]
    assert one_col(spark, ["否", "是", None], E.small_window_code, "string") == [1, 0, 0]


def test_day_clamp(spark):
    assert one_col(spark, [-5, 0, 7, None], clamp_nonneg, "int") == [0, 0, 7, None]


def test_block_parser(spark):
    df = spark.createDataFrame(
        [("地铁10号线知春路)", "x"), ("", "朝阳望京"), ("", "朝阳望京站"), ("", "朝阳"), (None, None)], "d string, b string"
    )
    got = [r[0] for r in df.select(crawl_block("d", "b")).collect()]
    assert got == ["知春路", "望京", "望京站", "", None]


def test_city_suffix_null(spark):
    assert one_col(spark, ["北京", None], with_city_suffix, "string") == ["北京市", None]


def test_tiers(spark):
    df = spark.createDataFrame([("上海市", "上海"), ("成都市", "成都")], "full string, short string")
    row_sh, row_cd = df.select(
        E.tier("full", E.TIER_A), E.tier("short", E.TIER_B), E.tier("full", E.TIER_C)
    ).collect()
    assert tuple(row_sh) == (2, 1, 1)
    assert (row_cd[0], row_cd[2]) == (4, 4)
    from roomrate.sources.literals import city_level_table

    d = df.join(city_level_table(spark), df["full"] == F.col("city"), "left").select("full", "city_level").collect()
    assert dict((r[0], r[1]) for r in d) == {"上海市": 1, "成都市": None}


def test_lenient_numbers(spark):
    assert one_col(spark, ["3室1厅", " 12", "-4x", "abc", None, "2.5"], lenient_int, "string") == [3, 12, -4, None, None, 2]
    assert one_col(spark, ["600", "12.5元", ".5", "x"], lenient_double, "string") == [600.0, 12.5, 0.5, None]


def test_r_div(spark):
    df = spark.createDataFrame([(3000.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(r_div("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and got[2] is None and got[3] == 2.0 and got[4] is None


def test_month_in_interval(spark):
    as_of = dt.date(2001, 8, 1)
    df = spark.createDataFrame(
        [(dt.date(2001, 8, 31), dt.date(2001, 12, 31)), (dt.date(2001, 9, 1), dt.date(2001, 12, 31)),
         (dt.date(2000, 1, 1), dt.date(2001, 8, 1)), (dt.date(2000, 1, 1), dt.date(2001, 7, 31))],
        "s date, e date",
    )
    got = [r[0] for r in df.select(month_in_interval(as_of, "s", "e")).collect()]
    assert got == [True, False, True, False]


def _r_snap(r):
    # R: m <- r %% 100 (floored); ifelse chain of the pricing script
    m = r - 100 * math.floor(r / 100)
    if m <= 30:
        return r - m + 30
    if m <= 60:
        return r - m + 60
    return r - m + 90


def test_snap_matches_r_rule(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=200))
    def check(values):
        got = one_col(spark, values, snap_price)
        for r, s in zip(values, got):
            assert s == pytest.approx(_r_snap(r), abs=1e-6)

    check()


def _mysql_leading_int(s):
    # leading ASCII whitespace (what MySQL skips) and sign, then digits; NULL
    # (our choice; MySQL gives 0) when there are none
    import re

    m = re.match(r"^[ \t\n\x0b\f\r]*([+-]?[0-9]+)", s)
    return int(m.group(1)) if m else None


def test_lenient_int_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = st.one_of(
        st.from_regex(r"\A\s{0,2}[+-]?[0-9]{1,6}[室厅a-z.]{0,3}[0-9]{0,2}\Z"),
        st.text(alphabet="0123456789 +-.室x", max_size=8),
    )

    @settings(max_examples=5, deadline=None)
    @given(st.lists(texts, min_size=1, max_size=100))
    def check(values):
        got = one_col(spark, values, lenient_int, "string")
        assert got == [_mysql_leading_int(v) for v in values]

    check()


def test_r_div_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    num = st.one_of(st.just(0.0), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(num, num), min_size=1, max_size=100))
    def check(pairs):
        df = spark.createDataFrame(pairs, "a double, b double")
        got = [r[0] for r in df.select(r_div("a", "b")).collect()]
        for (a, b), g in zip(pairs, got):
            if b == 0:
                want = math.inf if a > 0 else (-math.inf if a < 0 else None)
                assert g == want
            else:
                assert g == a / b

    check()


def test_crawl_window_takes_iso_dates_only(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from roomrate.functions.dates import text_date_on_or_after

    texts = ["2024-01-23", "2024-01-23 10:00:00", "2024-02-01T00", "2024-01-22 23:59", "n/a", "待定", "2024/01/24", "2024-1-25", "2024-02-30", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = {r.t for r in df.where(text_date_on_or_after(F.col("t"), dt.date(2024, 1, 23))).collect()}
    assert kept == set(texts[:3])
