"""End to end: checkpointed pipeline, dated CSV sinks, entry contract."""

import datetime as dt
import importlib.util
import os
import tempfile

from pyspark.sql import functions as F

from roomrate.plans.extracts import AS_OF, CRAWL_AS_OF
from roomrate.plans.pipeline import GAPS_NAME, RESULT_NAME, Models, price_all
from roomrate.registry import queries
from roomrate.sinks.csv import read_dated_csv
from roomrate.sources.ensemble import demo_ensemble_table

from conftest import ROOT, SF_SMALL


def test_pipeline_writes_both_csvs(spark, tables_small):
    out = tempfile.mkdtemp(prefix="roomrate-test-out-")
    models = Models.from_table(demo_ensemble_table(spark))
    res = price_all(tables_small, models, out, AS_OF, CRAWL_AS_OF)
    assert set(res.paths) == {GAPS_NAME, RESULT_NAME}
    assert res.paths[RESULT_NAME].endswith(f"run_date={AS_OF.isoformat()}")
    prices = read_dated_csv(spark, out, RESULT_NAME, AS_OF, res.prices.schema)
    gaps = read_dated_csv(spark, out, GAPS_NAME, AS_OF, res.gaps.schema)
    expected = queries()["job_i"](spark, SF_SMALL)
    assert prices.count() == expected.count() > 0
    assert gaps.count() == queries()["coverage_gaps"](spark, SF_SMALL).count()
    assert len(prices.columns) == 49
    # NULLs survive the round trip
    assert prices.where(F.col("block_std_price").isNull()).count() == res.prices.where(F.col("block_std_price").isNull()).count()


def test_command_line_with_boosters(spark, tmp_path, capsys):
    """The three models as JSON files: one tree each, named or numbered features; both match modes."""
    import json

    from roomrate.__main__ import main

    def booster(names, at, split):
        tree = {
            "left_children": [1, -1, -1], "right_children": [2, -1, -1], "split_indices": [at, 0, 0],
            "split_conditions": [split, -10.0, 25.0], "default_left": [1, 0, 0], "split_type": [0, 0, 0],
        }
        learner = {"feature_names": names, "learner_model_param": {"base_score": "5E-1"}, "gradient_booster": {"name": "gbtree", "model": {"trees": [tree]}}}
        return json.dumps({"learner": learner})

    paths = []
    for name, text in (("own", booster([], 4, 1500.0)), ("crawl", booster(["price_x"], 0, 1500.0)), ("room", booster([], 19, 2000.0))):
        paths.append(str(tmp_path / f"{name}.json"))
        (tmp_path / f"{name}.json").write_text(text)
    out = str(tmp_path / "out")
    dates = ["--as-of", AS_OF.isoformat(), "--crawl-as-of", CRAWL_AS_OF.isoformat()]
    main(["--driver-sf", SF_SMALL, "--booster", *paths, "--out", out, "--any-case", *dates])
    assert RESULT_NAME in capsys.readouterr().out
    models = Models.from_boosters(spark, *paths)
    from roomrate.sources.tables import RentalTables

    prices = price_all(RentalTables.from_driver(spark, SF_SMALL), models, None, AS_OF, CRAWL_AS_OF, any_case=True).prices
    back = read_dated_csv(spark, out, RESULT_NAME, AS_OF, prices.schema)
    assert back.count() == prices.count() > 0
    predicted = {round(r[0], 6) for r in back.select(F.col("xiaoqu_std_price_final") - F.col("room_outprice_pre")).collect()}
    assert predicted <= {-9.5, 25.5} and predicted


def test_csv_roundtrip_values(spark, tables_small):
    out = tempfile.mkdtemp(prefix="roomrate-test-csv-")
    from roomrate.sinks.csv import write_dated_csv

    df = queries()["job_c"](spark, SF_SMALL)
    write_dated_csv(df, out, "rooms", dt.date(2001, 8, 1))
    back = read_dated_csv(spark, out, "rooms", dt.date(2001, 8, 1), df.schema)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_csv_roundtrip_of_awkward_text(spark):
    from roomrate.sinks.csv import write_dated_csv

    out = tempfile.mkdtemp(prefix="roomrate-test-csv-")
    texts = ['say "hi"', " lead and trail ", "two\nlines", "a,b", "", "NA", None, '"', "\\"]
    df = spark.createDataFrame([(i, t, float(i) if i % 2 else None) for i, t in enumerate(texts)], "id long, t string, x double")
    write_dated_csv(df, out, "odd", dt.date(2001, 8, 1))
    back = read_dated_csv(spark, out, "odd", dt.date(2001, 8, 1), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert len(df.columns) == 49 and df.count() > 0
    assert set(queries()) <= set(mod.oracle_sql()) <= set(mod.queries())


def test_recency_absorbed_equals_literal(spark, tables_small):
    from roomrate.plans.extracts import recency_filter

    s = tables_small["suites"].join(tables_small["xiaoqus"].select(F.col("id").alias("xiaoqu_id"), "city"), "xiaoqu_id")
    a = s.where(recency_filter(F.col("ready_for_rent_date"), F.col("city"), AS_OF, absorbed=True))
    b = s.where(recency_filter(F.col("ready_for_rent_date"), F.col("city"), AS_OF, absorbed=False))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_anti_and_semi_partition_the_rooms(spark, tables_small):
    from roomrate.operators.suite import ever_available_suites
    from roomrate.plans.extracts import rooms_base

    base = rooms_base(tables_small)
    ever = ever_available_suites(tables_small["rooms"])
    anti, semi = base.join(ever, "suite_id", "left_anti"), base.join(ever, "suite_id", "left_semi")
    assert anti.count() + semi.count() == base.count()


def test_checkpoint_dir_comes_from_the_session(spark):
    from roomrate.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    assert folder  # already wired (earlier pipeline test) or set from spark.checkpoint.dir / local scratch
    assert ensure_checkpoint_dir(spark) == folder  # idempotent: never replaced once set
    df = spark.range(10).checkpoint()  # reliable checkpoint works against it
    assert df.count() == 10
