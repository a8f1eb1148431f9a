
import pytest
from pyspark.sql import functions as F

from roomrate.operators.joins import join_null_safe
from roomrate.plans import pricing as P
from roomrate.plans import standard as S

GROUP_SCHEMA = "city string, block string, community string, final_std_room_outprice_pre double"


def test_block_mean_counts_duplicated_own_price(spark):
    # community c1 has one own price and two crawl prices (two crawl blocks):
    # after the full join + distinct, the own price appears on two rows and
    # counts twice in the block mean
    own = spark.createDataFrame([("北京市", "B", "c1", 100.0), ("北京市", "B", "c2", 400.0)], GROUP_SCHEMA)
    crawl = spark.createDataFrame([("北京市", "x", "c1", 10.0), ("北京市", "y", "c1", 20.0)], GROUP_SCHEMA)
    out = S.reconcile(own, crawl).collect()
    block = {r["block_std_price"] for r in out if r["own_block"] == "B"}
    assert block == {(100.0 + 100.0 + 400.0) / 3}


def test_crawl_only_block_fallback(spark):
    own = spark.createDataFrame([("北京市", "B", "c1", 100.0)], GROUP_SCHEMA)
    crawl = spark.createDataFrame([("北京市", "x", "c9", 50.0), ("北京市", "y", "c8", 70.0)], GROUP_SCHEMA)
    out = {r["community"]: r for r in S.reconcile(own, crawl).collect()}
    assert out["c9"]["own_block"] is None
    assert out["c9"]["block_std_price"] == 60.0  # city-wide crawl-only mean
    assert out["c9"]["xiaoqu_std_price_final"] == 50.0
    assert out["c1"]["block_std_price"] == 100.0


def test_dedup_first_equals_rowlevel_full_join(spark):
    # R: full join of row-level frames, then select + distinct
    own_rows = spark.createDataFrame(
        [("a", "B", "c1", 1.0), ("a", "B", "c1", 1.0), ("a", None, "c2", 2.0), (None, "B", "c3", 3.0)], GROUP_SCHEMA
    )
    crawl_rows = spark.createDataFrame(
        [("a", "x", "c1", 5.0), ("a", "x", "c1", 5.0), ("a", "y", "c1", 6.0), (None, "z", "c3", 7.0), ("b", "z", "c4", 8.0)], GROUP_SCHEMA
    )
    l = own_rows.select("city", F.col("block").alias("own_block"), "community", F.col("final_std_room_outprice_pre").alias("final_own"))
    r = crawl_rows.select("city", "community", F.col("final_std_room_outprice_pre").alias("final_crawl"))
    rowlevel = join_null_safe(l, r, ["city", "community"], "full").select("city", "own_block", "community", "final_own", "final_crawl").distinct()
    fast = S.reconciled_pairs(own_rows, crawl_rows)
    assert sorted(map(tuple, rowlevel.collect()), key=str) == sorted(map(tuple, fast.collect()), key=str)


def test_coverage_gap_and_multi_block_fanout(spark):
    rooms = spark.createDataFrame(
        [("北京市", "B", "c1", 1), ("北京市", "B", "c7", 2)], "city string, block string, community string, room int"
    )
    std = spark.createDataFrame(
        [("北京市", "B", "c1", 100.0, 90.0), ("北京市", "C", "c1", 120.0, 95.0)],
        "city string, own_block string, community string, xiaoqu_std_price_final double, block_std_price double",
    )
    priced = P.attach_prices(rooms, std)
    rows = priced.collect()
    assert sorted((r["room"], r["xiaoqu_std_price_final"]) for r in rows if r["room"] == 1) == [(1, 100.0), (1, 120.0)]
    gaps = [tuple(r) for r in P.coverage_gaps(priced).collect()]
    assert gaps == [("北京市", "B", "c7")]


def test_quantile_65_arm_never_fires_on_suffixed_cities(spark, tables_small):
    from roomrate.plans.extracts import CRAWL_AS_OF, crawl_standard_pairs

    cities = {r[0] for r in crawl_standard_pairs(tables_small, CRAWL_AS_OF).select("city").distinct().collect()}
    assert S.QUANTILE_65_CITY not in cities


def test_a_missing_price_fails_the_quantiles_and_a_null_city_gives_null(spark, tables_small):
    from roomrate.plans.extracts import AS_OF, CRAWL_AS_OF, crawl_standard_pairs, own_standard_pairs
    from roomrate.sources.ensemble import CRAWL_MODEL, OWN_MODEL, demo_model

    own = own_standard_pairs(tables_small, AS_OF)
    assert S.own_group_prices(own, demo_model(OWN_MODEL)).count() > 0
    holed = own.withColumn("price_x", F.when(F.col("community") != own.first()["community"], F.col("price_x")))
    with pytest.raises(Exception, match="missing value of final_std_room_outprice_pre in the group"):
        S.own_standard_prices(holed, demo_model(OWN_MODEL)).collect()
    crawl = crawl_standard_pairs(tables_small, CRAWL_AS_OF)
    plain = crawl.withColumn("city", F.expr("case when city like '上海%' then '北京' when city like '深圳%' then null else city end"))
    got = S.crawl_group_prices(plain, demo_model(CRAWL_MODEL)).collect()
    rows = S.crawl_scored(plain, demo_model(CRAWL_MODEL)).toPandas()
    for r in got:
        if r["city"] is None:
            assert r["final_std_room_outprice_pre"] is None
            continue
        own = rows[(rows.city == r["city"]) & (rows.community == r["community"]) & ((rows.block == r["block"]) | (rows.block.isna() & (r["block"] is None)))]
        p = 0.65 if r["city"] == "北京" else 0.6
        assert r["final_std_room_outprice_pre"] == pytest.approx(own.std_room_outprice_pre.quantile(p))
    assert {r["city"] for r in got} >= {None, "北京"}
