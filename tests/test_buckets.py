"""Tables stored in buckets of their suite."""

import re
import uuid

import pytest

from conftest import SF_SMALL
from harness import rows_of
from roomrate.plans import extracts as X
from roomrate.sources.buckets import bucketed, spreads, store_by_suite
from roomrate.sources.tables import RentalTables

NAMES = X.ROOMS_TO_PRICE_TABLES


@pytest.fixture()
def database(spark, tmp_path):
    name = f"by_suite_{uuid.uuid4().hex}"
    spark.sql(f"create database {name} location '{tmp_path}/{name}'")
    yield name
    spark.sql(f"drop database {name} cascade")


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def _suite_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange hashpartitioning\((?:suite_id|id)#\d+L, \d+\)", plan)


def test_job_c_reads_its_buckets_in_place(spark, tables_small, database, no_broadcast):
    kept = store_by_suite(tables_small, database, 8, NAMES)
    assert {"rooms", "suites", "suite_decorations"} <= set(kept)
    assert bucketed(spark, database, NAMES) == frozenset(kept)
    stored = RentalTables.from_catalog(spark, database, NAMES)
    assert stored.in_suite_buckets and not tables_small.in_suite_buckets
    got, want = X.rooms_to_price(stored, X.AS_OF), X.rooms_to_price(tables_small, X.AS_OF)
    assert _rows(got) == _rows(want)
    assert "contract_with_landlords" in kept
    # what moves by suite is one row each: the landlord's price, which is found by contract, and the
    # decoration cost, whose last rounding is a Python step; no table of facts does
    moved = _suite_exchanges(got)
    assert len(moved) == 2, moved
    assert len(_suite_exchanges(want)) > len(moved) + 3


def test_hot_suite_is_not_stored_in_one_bucket(spark, tables_small, database):
    rooms = tables_small["rooms"]
    hot = rooms.selectExpr("* except (suite_id)", "7L as suite_id").select(rooms.columns).unionAll(rooms)
    t = RentalTables({**{n: tables_small[n] for n in NAMES}, "rooms": hot})
    assert "rooms" not in store_by_suite(t, database, 8, NAMES)
    stored = RentalTables.from_catalog(spark, database, NAMES)
    assert not stored.in_suite_buckets
    assert stored["rooms"].count() == hot.count()
    assert _rows(X.rooms_to_price(stored, X.AS_OF)) == _rows(X.rooms_to_price(t, X.AS_OF))


def test_missing_suites_count_as_one_and_empty_tables_spread(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,), (None,), (None,)], "suite_id long")
    assert spreads(df, "suite_id", 2) and not spreads(df, "suite_id", 3)
    assert spreads(df.limit(0), "suite_id", 3)


def test_a_stored_table_is_not_overwritten(spark, tables_small, database):
    store_by_suite(tables_small, database, 4, ["house_pricing"])
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        store_by_suite(tables_small, database, 4, ["house_pricing"])
