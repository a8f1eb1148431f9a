"""The whole batch: extracts -> standard prices -> reconcile -> price rooms -> CSVs.

Replaces the two scripts' global-environment hand-off with explicit inputs
(tables, models, dates). Two tables are read more than once downstream, so
they are materialised with reliable ``checkpoint()`` into the shared folder
named by ``spark.checkpoint.dir``: the reconciled community rows (both lookup
tables of JOB_H) and the rooms with prices attached (the gap report and JOB_I). Losing
an executor after that point recomputes from the checkpoint, not from the
warehouse scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roomrate.operators.scoring import TreeModel, load_model
from roomrate.plans import extracts as X
from roomrate.plans import pricing as P
from roomrate.plans import standard as S
from roomrate.session import ensure_checkpoint_dir
from roomrate.sinks.csv import write_dated_csv
from roomrate.sources.ensemble import CRAWL_MODEL, OWN_MODEL, ROOM_MODEL, read_booster
from roomrate.sources.tables import RentalTables

RESULT_NAME = "room_prices"
GAPS_NAME = "communities_without_price"


@dataclass(frozen=True)
class Models:
    own: TreeModel
    crawl: TreeModel
    room: TreeModel

    @classmethod
    def from_table(cls, ensemble: DataFrame) -> "Models":
        return cls(load_model(ensemble, OWN_MODEL), load_model(ensemble, CRAWL_MODEL), load_model(ensemble, ROOM_MODEL))

    @classmethod
    def from_boosters(cls, spark: SparkSession, own: str, crawl: str, room: str) -> "Models":
        """The three boosters as JSON files; splits without a feature name count in the feature orders."""
        files = ((own, OWN_MODEL, S.OWN_FEATURES), (crawl, CRAWL_MODEL, S.CRAWL_FEATURES), (room, ROOM_MODEL, P.ROOM_FEATURES))
        return cls(*(load_model(read_booster(spark, path, name, features), name) for path, name, features in files))


@dataclass(frozen=True)
class PricingOutput:
    prices: DataFrame
    gaps: DataFrame
    paths: Mapping[str, str]


def price_all(
    t: RentalTables,
    models: Models,
    out_root: str | None,
    as_of: dt.date,
    crawl_as_of: dt.date,
    any_case: bool = False,
) -> PricingOutput:
    spark = t["rooms"].sparkSession
    ensure_checkpoint_dir(spark)
    own_groups = S.own_group_prices(X.own_standard_pairs(t, as_of), models.own)
    crawl_groups = S.crawl_group_prices(X.crawl_standard_pairs(t, crawl_as_of), models.crawl)
    rows = S.reconciled_pairs(own_groups, crawl_groups).checkpoint()
    attached = P.attach_lookups(X.rooms_to_price(t, as_of, any_case), S.community_prices(rows), S.block_prices(rows)).checkpoint()
    gaps = P.coverage_gaps(attached)
    prices = P.price_rooms(attached, models.room)
    paths = {}
    if out_root is not None:
        paths[GAPS_NAME] = write_dated_csv(gaps, out_root, GAPS_NAME, as_of)
        paths[RESULT_NAME] = write_dated_csv(prices, out_root, RESULT_NAME, as_of)
    return PricingOutput(prices, gaps, paths)
