"""Declared schemas, what a load replaces, key slices, published runs, reduced facts."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from roomrate.operators.joins import reduced
from roomrate.plans.extracts import AS_OF
from roomrate.registry import queries
from roomrate.sinks.csv import dated_path, published, read_dated_csv, write_dated_csv
from roomrate.sources import contract, slices
from roomrate.sources.ensemble import demo_ensemble_table
from roomrate.sources.literals import city_level_table
from roomrate.sources.tables import RENTAL_TABLES, RentalTables

from conftest import SF_SMALL

DAY = dt.date(2001, 8, 1)


def test_every_table_has_a_contract_that_its_data_keeps(spark, tables_small):
    assert set(contract.TABLES) == {*RENTAL_TABLES, "city_level", "ensemble"} and len(contract.TABLES) == 13
    frames = {**tables_small, "city_level": city_level_table(spark), "ensemble": demo_ensemble_table(spark)}
    for name, df in frames.items():
        out = contract.conform(df, name)
        assert [f.name for f in out.schema.fields] == df.columns
        for field in contract.schema_of(name).fields:
            assert out.schema[field.name].dataType == field.dataType


def test_violations_of_the_contract_are_raised_by_name(spark, tables_small):
    pricing = tables_small["house_pricing"]
    with pytest.raises(contract.ContractViolation, match="house_pricing: missing column sales_wish_sum_price_yuan"):
        contract.conform(pricing.drop("sales_wish_sum_price_yuan"), "house_pricing")
    with pytest.raises(contract.ContractViolation, match="house_pricing.sales_wish_sum_price_yuan: boolean cannot be read as double"):
        contract.conform(pricing.withColumn("sales_wish_sum_price_yuan", F.lit(True)), "house_pricing")
    with pytest.raises(contract.ContractViolation, match="house_pricing.id: array<bigint> cannot be read as bigint"):
        contract.conform(pricing.withColumn("id", F.array("id")), "house_pricing")


def test_conform_reads_text_nan_and_zero_dates(spark):
    raw = [
        ("1", "1200.5", "2001-08-01", "2001-12-31 00:00:00", None),
        ("2", "NaN", "0000-00-00", " 2001-12-31", "0000-00-00 00:00:00"),
        ("x", "1,200", "2001-02-30", "", None),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(raw, "contract_id string, monthly_price string, date string, end_date string, deleted_at string").withColumn("more", F.lit(7))
    seen = Observation()
    got = [tuple(r) for r in contract.conform(df, "landlord_payment_schedules", observation=seen).collect()]
    day = dt.date(2001, 12, 31)
    assert got == [(1, 1200.5, DAY, day, None, 7), (2, None, None, day, None, 7), (None, None, None, None, None, 7), (None,) * 5 + (7,)]
    want = {
        "contract_id:unreadable": 1, "monthly_price:nan": 1, "monthly_price:unreadable": 1, "date:zero_date": 1, "date:unreadable": 1,
        "end_date:zero_date": 0, "end_date:unreadable": 1, "deleted_at:zero_date": 1, "deleted_at:unreadable": 0,
    }
    assert seen.get == {"rows": 4, **want}
    counted = {f"{r['column']}:{r['rule']}": r["rows"] for r in contract.violations(df, "landlord_payment_schedules").collect()}
    assert counted == want
    empty = contract.violations(df.limit(0), "landlord_payment_schedules").collect()
    assert {r["rows"] for r in empty} == {0}


def test_conform_of_typed_columns(spark):
    typed = spark.createDataFrame([(1, float("nan"), dt.date(1, 1, 1)), (2, 3.0, DAY)], "contract_id int, monthly_price float, date date")
    typed = typed.withColumns({"end_date": F.col("date").cast("timestamp"), "deleted_at": F.lit(None).cast("date")})
    out = contract.conform(typed, "landlord_payment_schedules", zero_dates=True)
    assert out.schema["contract_id"].dataType.simpleString() == "bigint" and out.schema["monthly_price"].dataType.simpleString() == "double"
    assert sorted(map(tuple, out.collect())) == [(1, None, None, None, None), (2, 3.0, DAY, DAY, None)]
    assert contract.conform(typed, "landlord_payment_schedules").where("date = '0001-01-01'").count() == 1


def test_load_queries_count_and_replace(spark):
    found = {(r["table"], r["column"], r["rule"]) for r in queries()["load_violations"](spark, SF_SMALL).collect()}
    assert ("rooms", "price", "nan") in found and ("suites", "ready_for_rent_date", "zero_date") in found


@pytest.mark.parametrize("bounds", [[3, 10, 20, 20, 55], [7], [], [None, 5, 5], ["2024-01-01", "2024-01-05", "it's"]])
def test_slices_take_every_row_once(spark, bounds):
    text = any(isinstance(b, str) for b in bounds)
    values = [None, "", "2024-01-01", "2024-01-04 10:00", "2024-01-05", "it's", "zz"] if text else [None, *range(-5, 70, 3), 10, 20, 20, 55]
    df = spark.createDataFrame([(v,) for v in values], "k string" if text else "k long")
    parts = slices.predicates("k", bounds)
    assert len(parts) >= 2 and "is null" in parts[-1]
    assert sum(df.where(p).count() for p in parts) == len(values)
    for i, p in enumerate(parts):
        assert all(df.where(f"({p}) and ({q})").count() == 0 for q in parts[:i])


def test_slices_are_planned_for_every_table():
    assert set(slices.KEYS) == set(RENTAL_TABLES)
    for name, key in slices.KEYS.items():
        assert key in contract.schema_of(name).fieldNames()
    import duckdb

    con = duckdb.connect()
    con.execute("create table t as select case when i % 3 = 0 then 7 when i % 50 = 1 then null else i end as k from range(1000) r(i)")
    cuts = [r[0] for r in con.execute(f"select * from {slices.bounds_query('t', 'k', 8)}").fetchall()]
    assert len(cuts) == 8
    sizes = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in slices.predicates("k", cuts)]
    assert sum(sizes) == 1000 and max(sizes) < 450  # a third of the rows has one key


def test_a_failed_write_leaves_the_published_run(spark, tmp_path):
    root, schema = str(tmp_path), "id long, t string, x double"
    rows = [(i, t, 0.1 * i) for i, t in enumerate(["a", "", None, "\x01", "\x01empty\x01", "\x01\x01b", 'q"', " "])]
    df = spark.createDataFrame(rows, schema)
    path = write_dated_csv(df, root, "out", DAY)
    assert path == dated_path(root, "out", DAY)
    first = published(spark, root, "out", DAY)
    assert first["rows"] == len(rows) and first["columns"] == df.columns
    read = lambda: sorted(map(tuple, read_dated_csv(spark, root, "out", DAY, df.schema).collect()))
    assert read() == rows
    bad = spark.range(100, numPartitions=4).select("id", F.lit("z").alias("t"), F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(0.0).alias("x"))
    with pytest.raises(Exception, match="lost"):
        write_dated_csv(bad, root, "out", DAY)
    assert published(spark, root, "out", DAY) == first and read() == rows
    for n in (3, 5, 2):
        write_dated_csv(df.limit(n), root, "out", DAY)
        assert published(spark, root, "out", DAY)["rows"] == n and len(read()) == n
    assert len(list((tmp_path / "out" / f"run_date={DAY}").glob("run-*"))) == 2  # the published run and the one before it
    write_dated_csv(df.limit(0), root, "out", DAY)
    assert read() == []
    with pytest.raises(FileNotFoundError):
        read_dated_csv(spark, root, "out", AS_OF + dt.timedelta(1), df.schema)


def test_reduced_facts(spark):
    facts = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 1, 2, 3, None, 4, 4])], "k long, i int").repartition(4)
    wanted = spark.createDataFrame([(1,), (1,), (4,), (9,), (None,)], "k long")
    for threshold in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            out = reduced(facts, wanted, "k")
            assert out.columns == ["k", "i"] and sorted(map(tuple, out.collect())) == [(1, 0), (1, 1), (1, 2), (4, 6), (4, 7)]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert reduced(facts, wanted.limit(0), "k").count() == 0


@pytest.mark.parametrize("name, reductions", [("job_a", 2), ("job_c", 1)])
def test_facts_are_reduced_below_their_aggregates(spark, name, reductions):
    df = queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    semis = [i for i, line in enumerate(plan) if "Join LeftSemi" in line]
    assert len(semis) == reductions, "\n".join(plan)
    for i in semis:  # an aggregate on the suite stands above each
        above, at = [], depth[i]
        for j in range(i, -1, -1):
            if depth[j] < at:
                above.append(plan[j])
                at = depth[j]
        assert any("Aggregate [suite_id" in line or "Aggregate [l_orderkey" in line or "Aggregate [o_orderkey" in line for line in above), "\n".join(plan)


def test_hot_key_is_reduced_by_several_tasks(spark):
    """A key with most rows is dealt out before its copies of the wanted keys are met."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(8000, numPartitions=16).select(F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id")).alias("k"))
        out = reduced(facts, spark.createDataFrame([(5,)], "k long"), "k")
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) > 2 and max(per_task) < 0.6 * sum(per_task)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
