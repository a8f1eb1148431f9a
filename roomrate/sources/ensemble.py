"""SRC5: the boosted-tree models as a node table, or read from a booster's JSON file.

The three pre-trained boosters of the original job are not published, so their
predictions cannot be reproduced; what is rebuilt is the scoring of any
supplied ensemble. Production reads the node table exported from the trained
boosters (``read_ensemble``). Tests, the bench and the registered queries use
the small hand-written ensemble below: three models with two to three shallow
trees each, a base-score leaf, and missing-value branches that the test data
reaches (for example a NULL ``block_std_price``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from roomrate.operators.scoring import ENSEMBLE_SCHEMA, TreeModel, model_from_rows

OWN_MODEL = "std_room_outprice_pre_model"
CRAWL_MODEL = "zir_std_room_outprice_pre_model"
ROOM_MODEL = "room_outprice_pre_model_has_balcony_area"

# (model, tree, node, feature, split, yes, no, missing, leaf)
DEMO_ENSEMBLE: tuple[tuple, ...] = (
    # own listings -> standard room: adjustment added to the listing's price
    (OWN_MODEL, 0, 0, None, None, None, None, None, 0.5),
    (OWN_MODEL, 1, 0, "area_xy_dev", 0.0, 1, 2, 2, None),
    (OWN_MODEL, 1, 1, None, None, None, None, None, -120.0),
    (OWN_MODEL, 1, 2, "face_xy_dev", 1.0, 3, 4, 3, None),
    (OWN_MODEL, 1, 3, None, None, None, None, None, 35.0),
    (OWN_MODEL, 1, 4, None, None, None, None, None, 80.0),
    (OWN_MODEL, 2, 0, "has_toilet_xy_dev", 0.0, 1, 2, 1, None),
    (OWN_MODEL, 2, 1, None, None, None, None, None, -150.0),
    (OWN_MODEL, 2, 2, "city_level", 2.5, 3, 4, 4, None),
    (OWN_MODEL, 2, 3, None, None, None, None, None, 20.0),
    (OWN_MODEL, 2, 4, None, None, None, None, None, -10.0),
    (OWN_MODEL, 3, 0, "bedroom_xy_dev", 0.5, 1, 2, 1, None),
    (OWN_MODEL, 3, 1, None, None, None, None, None, -25.0),
    (OWN_MODEL, 3, 2, None, None, None, None, None, 15.0),
    # competitor crawl -> standard room
    (CRAWL_MODEL, 0, 0, None, None, None, None, None, 0.5),
    (CRAWL_MODEL, 1, 0, "bathroom_xy_dev", 0.0, 1, 2, 2, None),
    (CRAWL_MODEL, 1, 1, None, None, None, None, None, -180.0),
    (CRAWL_MODEL, 1, 2, "balcony_xy_dev", 0.0, 3, 4, 4, None),
    (CRAWL_MODEL, 1, 3, None, None, None, None, None, -60.0),
    (CRAWL_MODEL, 1, 4, None, None, None, None, None, 10.0),
    (CRAWL_MODEL, 2, 0, "area_xy_dev", -2.5, 1, 2, 2, None),
    (CRAWL_MODEL, 2, 1, "bedroomnum_xy_dev", 0.5, 3, 4, 3, None),
    (CRAWL_MODEL, 2, 2, None, None, None, None, None, 30.0),
    (CRAWL_MODEL, 2, 3, None, None, None, None, None, -90.0),
    (CRAWL_MODEL, 2, 4, None, None, None, None, None, -40.0),
    # room price = community standard price minus this prediction
    (ROOM_MODEL, 0, 0, None, None, None, None, None, 0.5),
    (ROOM_MODEL, 1, 0, "living_area_dev", 0.0, 1, 2, 2, None),
    (ROOM_MODEL, 1, 1, "has_toilet", 0.5, 3, 4, 3, None),
    (ROOM_MODEL, 1, 2, "face_dev", 1.5, 5, 6, 6, None),
    (ROOM_MODEL, 1, 3, None, None, None, None, None, -140.0),
    (ROOM_MODEL, 1, 4, None, None, None, None, None, -260.0),
    (ROOM_MODEL, 1, 5, None, None, None, None, None, 25.0),
    (ROOM_MODEL, 1, 6, None, None, None, None, None, 70.0),
    (ROOM_MODEL, 2, 0, "block_std_price", 2000.0, 1, 2, 3, None),
    (ROOM_MODEL, 2, 1, None, None, None, None, None, 40.0),
    (ROOM_MODEL, 2, 2, None, None, None, None, None, -35.0),
    (ROOM_MODEL, 2, 3, None, None, None, None, None, 5.0),
    (ROOM_MODEL, 3, 0, "floor", 10.5, 1, 2, 1, None),
    (ROOM_MODEL, 3, 1, "xianfang_days", 500.0, 3, 4, 4, None),
    (ROOM_MODEL, 3, 2, None, None, None, None, None, -15.0),
    (ROOM_MODEL, 3, 3, None, None, None, None, None, -30.0),
    (ROOM_MODEL, 3, 4, None, None, None, None, None, 10.0),
)


def demo_model(name: str) -> TreeModel:
    rows = [r[1:] for r in DEMO_ENSEMBLE if r[0] == name]
    if not rows:
        raise KeyError(name)
    return model_from_rows(name, rows)


def demo_ensemble_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEMO_ENSEMBLE), ENSEMBLE_SCHEMA)


def read_ensemble(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The exported node table of the trained boosters."""
    return spark.read.format(fmt).schema(ENSEMBLE_SCHEMA).load(path)


def booster_rows(text: str, model: str, features: Sequence[str] | None = None) -> list[tuple]:
    """Node-table rows of a gradient-boosting model saved as JSON (the public model format).

    The base score becomes tree 0, a single leaf; features are named by ``features``, else by
    the names in the file, else by position (``f0``, ``f1``, ...). Only numeric splits of a
    single-output tree booster are read.
    """
    learner = json.loads(text)["learner"]
    booster = learner["gradient_booster"]
    if booster.get("name") != "gbtree":
        raise ValueError(f"not a tree booster: {booster.get('name')}")
    names = list(features or learner.get("feature_names") or ())
    base = float(str(learner["learner_model_param"].get("base_score", "0")).strip("[]"))
    rows = [(model, 0, 0, None, None, None, None, None, base)]
    for t, tree in enumerate(booster["model"]["trees"], 1):
        if any(tree.get("split_type", ())):
            raise ValueError("categorical splits are not supported")
        for node, (left, right) in enumerate(zip(tree["left_children"], tree["right_children"], strict=True)):
            value = float(tree["split_conditions"][node])
            if left < 0:
                rows.append((model, t, node, None, None, None, None, None, value))
            else:
                at = tree["split_indices"][node]
                missing = left if tree["default_left"][node] else right
                rows.append((model, t, node, names[at] if names else f"f{at}", value, left, right, missing, None))
    return rows


def read_booster(spark: SparkSession, path: str, model: str, features: Sequence[str] | None = None) -> DataFrame:
    """A booster's JSON file, in any store Spark reads, as a node table."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame(booster_rows(text, model, features), ENSEMBLE_SCHEMA)
