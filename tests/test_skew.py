"""Hot keys: one group holding a third of the rows is never processed whole by one task."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from harness import ALL_DRIVER_TABLES, compare, duck
from roomrate.operators.grouped import attach, group_quantiles, group_sums, mean_of
from roomrate.operators.joins import join_spread
from roomrate.oracle_sql import oracle_sql
from roomrate.registry import queries

SKEW_CONF = {
    # shrink the thresholds so AQE's skew handling triggers on test-sized data
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    # several scan tasks of a small file: a hot partition is split by the tasks that wrote it
    "spark.sql.files.maxPartitionBytes": "64KB",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(spark, n=30000):
    keys = ["hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 7 == 0 else f"c{i % 500}") for i in range(n)]
    pdf = pd.DataFrame({"k": keys, "v": [float(i % 997) for i in range(n)]})
    return spark.createDataFrame(pdf, "k string, v double").repartition(8)


def test_join_back_splits_the_hot_key(spark, skew_conf):
    rows = _rows(spark)
    stats = group_sums(rows, ["k"], {"v": "v"}).select("k", mean_of("v").alias("m"))
    out = attach(rows, stats, ["k"])
    assert out.count() == rows.count()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" in plan or "skew=true" in plan, plan[:3000]


def test_quantiles_exact_under_skew_settings(spark, skew_conf):
    rows = _rows(spark)
    got = {r["k"]: r["q"] for r in group_quantiles(rows, ["k"], "v", {"q": 0.5}).collect()}
    pdf = rows.toPandas()
    want = pdf.groupby("k", dropna=False)["v"].median()
    for k, q in want.items():
        key = None if (isinstance(k, float) and pd.isna(k)) else k
        assert got[key] == pytest.approx(q)


def test_spread_join_shares_a_hot_key_out(spark, skew_conf):
    rows = _rows(spark).withColumn("i", F.monotonically_increasing_id())
    sides = [rows.where("k is not null").groupBy("k").agg(F.count("*").alias(n)) for n in ("a", "b", "c")]
    out = join_spread(rows, sides[0].join(sides[1], "k").join(sides[2], "k"), "k")
    assert out.columns == ["k", "v", "i", "a", "b", "c"]
    per_task = {}
    for r in out.withColumn("p", F.spark_partition_id()).collect():
        assert r["a"] == r["b"] == r["c"]
        per_task[r["p"]] = per_task.get(r["p"], 0) + 1
    assert sum(per_task.values()) == rows.where("k is not null").count()
    assert max(per_task.values()) < sum(per_task.values()) / 4  # a third of the rows has one key


def test_spread_join_edge_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3)], "k string, v int")
    side = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), (None, "n")], "k string, s string")
    got = sorted(map(tuple, join_spread(rows, side, "k").collect()))
    assert got == [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", 1, "y")]
    assert join_spread(rows.limit(0), side, "k").count() == 0


@pytest.fixture(scope="module")
def hot_suite_dir(tmp_path_factory):
    """The small tables plus one let and one unlet suite that hold a third of the rooms each."""
    out = tmp_path_factory.mktemp("hot")
    # one suite that reaches the result of JOB_A and one that reaches that of JOB_C
    own = duck(SF_SMALL).execute(f"select min(cast(split_part(code, '-', 1) as bigint)) from ({oracle_sql()['job_a']})").fetchall()
    open_ = duck(SF_SMALL).execute(f"select min(suite_id) from ({oracle_sql()['job_c']})").fetchall()
    for t in ALL_DRIVER_TABLES:
        src = f"select * from read_parquet('{SF_SMALL}/{t}.parquet')"
        if t == "lineitem":
            src += "".join(f" union all select * replace ({key} as l_orderkey) from ({src})" for ((key,),) in (own, open_))
        duckdb.connect().execute(f"copy ({src}) to '{os.path.join(out, t)}.parquet' (format parquet, row_group_size 2048)")
    return str(out)


@pytest.mark.parametrize("name", ["job_a", "job_c"])
def test_hot_suite_jobs(spark, skew_conf, hot_suite_dir, name):
    df = queries()[name](spark, hot_suite_dir)
    res = compare(df, duck(hot_suite_dir), oracle_sql()[name])
    assert res["ok"], res
    assert res["spark_rows"] > 1000  # the hot suite's rooms reach the result
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isSkewJoin=true" in final or "skew=true" in final, final


@pytest.mark.parametrize("name", ["job_h", "job_i"])
def test_reconciliation_runs_once(spark, skew_conf, name):
    df = queries()[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FullOuter") == 1, final
