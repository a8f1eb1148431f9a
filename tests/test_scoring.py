"""Tree-ensemble scoring against hand-computed values, SQL and a plain walk."""

import numpy as np
from pyspark.sql import functions as F

from roomrate.operators.scoring import model_from_rows, score
from roomrate.sources.ensemble import DEMO_ENSEMBLE, OWN_MODEL, ROOM_MODEL, demo_ensemble_table, demo_model

TINY = model_from_rows(
    "tiny",
    [
        (0, 0, None, None, None, None, None, 0.5),
        (1, 0, "a", 1.5, 1, 2, 2, None),
        (1, 1, None, None, None, None, None, -1.0),
        (1, 2, "b", 0.0, 3, 4, 3, None),
        (1, 3, None, None, None, None, None, 10.0),
        (1, 4, None, None, None, None, None, 20.0),
    ],
)


def test_missing_and_split_branches(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, -1.0), (2.0, 1.0), (None, 1.0), (2.0, None), (float("nan"), 3.0)], "a double, b double")
    feats = {"a": F.col("a"), "b": F.col("b")}
    got = [r[0] for r in df.select(score(TINY, feats)).collect()]
    assert got == [-0.5, 10.5, 20.5, 20.5, 10.5, 20.5]


def test_large_model_sums_in_tree_order(spark):
    """More than 5000 nodes: the score is the single-precision sum in tree order."""
    leaves = [((t * 37) % 101) / 7 for t in range(4000)]
    rows = []
    for t in range(2000):
        rows += [(t, 0, "a", float(t % 50), 1, 2, 2, None), (t, 1, None, None, None, None, None, leaves[2 * t]),
                 (t, 2, None, None, None, None, None, leaves[2 * t + 1])]
    m = model_from_rows("big", rows)
    assert m.n_nodes == 6000
    df = spark.createDataFrame([(x,) for x in (0.0, 24.5, 60.0, None)], "a double")
    for r in df.select("a", score(m, {"a": F.col("a")}).alias("s")).collect():
        want = np.float32(0)
        for t in range(2000):
            want += np.float32(leaves[2 * t + (r.a is None or not r.a < t % 50)])
        assert r.s == float(want)


def test_float32_split(spark):
    m = model_from_rows("f", [(0, 0, "a", 0.1, 1, 2, 2, None), (0, 1, None, None, None, None, None, 1.0), (0, 2, None, None, None, None, None, 2.0)])
    # just below 0.1 in double precision, but equal to the split once both are single precision
    df = spark.createDataFrame([(0.09999999999,), (0.0999,)], "a double")
    assert [r[0] for r in df.select(score(m, {"a": F.col("a")}, float32=True)).collect()] == [2.0, 1.0]
    assert [r[0] for r in df.select(score(m, {"a": F.col("a")}, float32=False)).collect()] == [1.0, 1.0]


def test_ensemble_table_roundtrip(spark):
    from roomrate.operators.scoring import load_model

    table = demo_ensemble_table(spark)
    assert table.count() == len(DEMO_ENSEMBLE)
    for name in (OWN_MODEL, ROOM_MODEL):
        assert load_model(table, name) == demo_model(name)


def test_booster_json_matches_hand_computed_scores(spark, tmp_path):
    import json

    from roomrate.operators.scoring import load_model
    from roomrate.sources.ensemble import read_booster

    tree = {
        "left_children": [1, -1, 3, -1, -1], "right_children": [2, -1, 4, -1, -1], "split_indices": [0, 0, 1, 0, 0],
        "split_conditions": [1.5, -1.0, 0.0, 10.0, 20.0], "default_left": [0, 0, 1, 0, 0], "split_type": [0, 0, 0, 0, 0],
    }
    learner = {
        "feature_names": ["a", "b"], "learner_model_param": {"base_score": "5E-1"},
        "gradient_booster": {"name": "gbtree", "model": {"trees": [tree]}},
    }
    (tmp_path / "m.json").write_text(json.dumps({"learner": learner}))
    m = load_model(read_booster(spark, str(tmp_path / "m.json"), "m"), "m")
    df = spark.createDataFrame([(1.0, 5.0), (2.0, -1.0), (2.0, 1.0), (None, 1.0), (2.0, None)], "a double, b double")
    got = [r[0] for r in df.select(score(m, {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == [-0.5, 10.5, 20.5, 20.5, 10.5]
