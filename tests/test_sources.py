"""Production source path: tables read from Parquet folders give the same jobs."""

import tempfile

from roomrate.plans import extracts as X
from roomrate.sources.tables import RENTAL_TABLES, RentalTables


def test_from_parquet_matches_fixture_views(spark, tables_small):
    root = tempfile.mkdtemp(prefix="roomrate-test-warehouse-")
    for name in RENTAL_TABLES:
        tables_small[name].write.mode("overwrite").parquet(f"{root}/{name}")
    wh = RentalTables.from_parquet(spark, root)
    for job in (X.rooms_to_price, X.own_standard_pairs, X.whole_unit_stats):
        a, b = job(tables_small, X.AS_OF), job(wh, X.AS_OF)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_filters_reach_the_parquet_scan(spark, tables_small):
    root = tempfile.mkdtemp(prefix="roomrate-test-warehouse-")
    tables_small["contract_with_landlords"].write.mode("overwrite").parquet(f"{root}/contract_with_landlords")
    tables_small["suite_decorations"].write.mode("overwrite").parquet(f"{root}/suite_decorations")
    wh = RentalTables.from_parquet(spark, root, names=("contract_with_landlords", "suite_decorations"))
    from roomrate.operators.suite import decoration_cost, signed_contracts

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = signed_contracts(wh["contract_with_landlords"], X.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(sign_date,2001-08-01)" in plan and "EqualTo(status," in plan
    plan = decoration_cost(wh["suite_decorations"], X.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(measure_approve_pass_at," in plan
