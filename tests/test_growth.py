"""Work that must grow with the input only: repeated mapping rows, shared quantile input, schedules per contract."""

import datetime as dt

from pyspark.sql import functions as F

from roomrate.operators.grouped import group_quantiles
from roomrate.operators.suite import landlord_price_in_force
from roomrate.plans.extracts import AS_OF, CRAWL_AS_OF, crawl_standard_pairs
from roomrate.sources.tables import RentalTables


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_listing_meets_each_distinct_mapping_row_once(spark):
    """A mapping row loaded many times repeats no listing below the DISTINCT of JOB_B."""
    listing = {
        "city": "北京", "community_name": "c1", "business_district": "", "business_district_block": "朝阳望京站", "bedroom_num": "2",
        "building_area": "12", "independent_balcon": "", "price": "2000", "orientation": "南", "private_bathroom": "", "style": "风格4.0",
        "product_type": "友家合租", "date_created": str(CRAWL_AS_OF),
    }
    crawl = spark.createDataFrame([listing, {**listing, "community_name": "c2"}, {**listing, "community_name": None}])
    schema = "city string, jingdui string, block string, company string"
    rows = [("北京市", "c1", "b1", "own1"), ("北京市", "c1", None, "own1"), ("北京市", "c1", "b2", None), ("北京市", None, "b", "x")]
    found = {}
    for repeats in (1, 40):
        relations = spark.createDataFrame(rows * repeats, schema)
        df = crawl_standard_pairs(RentalTables({"archive_ziroom": crawl, "xiaoqurelations": relations}), CRAWL_AS_OF)
        found[repeats] = sorted(map(str, df.select("city", "block", "community").collect()))
    assert found[1] == found[40] and len(found[1]) == 5
    plan = _optimized(df).splitlines()
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    assert any("Aggregate [" in line for line in plan[join:]), "\n".join(plan)


def test_quantiles_read_their_input_once(spark, tmp_path):
    """Both sides of the join on the buckets share one run of the input, missing values and keys kept."""
    rows = [(g, None if g == "n" or v % 7 == 0 else float(v)) for v in range(40) for g in ("a", "b", "n", None)]
    spark.createDataFrame(rows, "g string, v double").write.parquet(str(tmp_path / "t"))
    twice = F.pandas_udf(lambda s: 2 * s, "double")
    for levels in (1, 3):
        df = spark.read.parquet(str(tmp_path / "t")).distinct().select("g", twice("v").alias("v"))
        out = group_quantiles(df, ["g"], "v", {"q": 0.5}, levels=levels)
        got = {r["g"]: r["q"] for r in out.collect()}
        assert got["n"] is None and got["a"] == got["b"] == got[None] == 39.0, got
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("ArrowEvalPython") == 1, final


def test_schedules_are_reduced_to_one_row_per_contract(spark):
    day = dt.date(2001, 1, 1)
    pay = [(1, 100.4, day, dt.date(2001, 12, 31), None), (1, 200.6, day, dt.date(2001, 12, 31), None), (1, 900.0, day, dt.date(2001, 12, 31), day)]
    pay += [(2, 50.0, day, dt.date(2001, 12, 31), None), (None, 70.0, day, dt.date(2001, 12, 31), None), (3, 80.0, day, dt.date(2001, 2, 1), None)]
    schedules = spark.createDataFrame(pay, "contract_id long, monthly_price double, date date, end_date date, deleted_at date")
    con = [(1, 7, "蛋壳A", "已签约", 36, 5), (2, 7, "蛋壳A", "已签约", 24, 9), (2, 8, "蛋壳A", "签约待确认", None, 1), (3, 9, "蛋壳A", "已签约", 1, 1), (None, 7, "蛋壳A", "已签约", 99, 99)]
    contracts = spark.createDataFrame(con, "id long, suite_id long, type string, status string, months int, free_days int")
    out = landlord_price_in_force(schedules, contracts, AS_OF)
    assert sorted(map(tuple, out.collect())) == [(7, 201.0, 36, 9), (8, 50.0, None, 1)]
    assert "Aggregate [contract_id" in _optimized(out)
