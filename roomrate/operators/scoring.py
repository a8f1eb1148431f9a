"""SCR1-SCR3: score a boosted-tree ensemble held as a node table.

Ensemble table columns: ``model, tree, node, feature, split, yes, no, missing,
leaf``. A row with a NULL ``feature`` is a leaf. Prediction = sum over the
model's trees of the reached leaf (a one-leaf tree carries the base score).
At a split the row goes to ``yes`` when ``x < split``, to ``no`` otherwise and
to ``missing`` when x is NULL or NaN (the learned default direction of
sparsity-aware boosting). Like the native runtime, the comparison is made in
single precision unless ``float32=False``.

The model is a parameter, not data: its size is bounded by its tree count and
depth, never by the table being scored. It is read to the driver once, flattened
into numpy arrays, broadcast, and walked by a pandas UDF over Arrow batches, all
trees together. Leaves are added in tree order in single precision (double when
``float32=False``), as the native runtime does, so a score does not depend on
the size of the model or of the batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENSEMBLE_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("tree", T.IntegerType(), False),
        T.StructField("node", T.IntegerType(), False),
        T.StructField("feature", T.StringType(), True),
        T.StructField("split", T.DoubleType(), True),
        T.StructField("yes", T.IntegerType(), True),
        T.StructField("no", T.IntegerType(), True),
        T.StructField("missing", T.IntegerType(), True),
        T.StructField("leaf", T.DoubleType(), True),
    ]
)

@dataclass(frozen=True)
class Node:
    tree: int
    node: int
    feature: str | None
    split: float | None
    yes: int | None
    no: int | None
    missing: int | None
    leaf: float | None


@dataclass(frozen=True)
class TreeModel:
    name: str
    trees: tuple[tuple[Node, ...], ...]

    @property
    def n_nodes(self) -> int:
        return sum(len(t) for t in self.trees)

    @property
    def features(self) -> list[str]:
        return sorted({n.feature for t in self.trees for n in t if n.feature is not None})


def load_model(ensemble: DataFrame, model: str) -> TreeModel:
    """Read one model's nodes from the ensemble table."""
    nodes = ensemble.where(F.col("model") == model)
    n = nodes.count()
    if n == 0:
        raise ValueError(f"model {model!r} not in ensemble table")
    rows = nodes.select(*[f.name for f in ENSEMBLE_SCHEMA.fields if f.name != "model"]).collect()
    return model_from_rows(model, [tuple(r) for r in rows])


def model_from_rows(model: str, rows: Sequence[tuple]) -> TreeModel:
    by_tree: dict[int, list[Node]] = {}
    for r in rows:
        node = Node(*r)
        by_tree.setdefault(node.tree, []).append(node)
    return TreeModel(model, tuple(tuple(sorted(v, key=lambda n: n.node)) for _, v in sorted(by_tree.items())))


def _flatten(model: TreeModel, features: Sequence[str]):
    fidx = {f: i for i, f in enumerate(features)}
    offsets, size = [], 0
    for tree in model.trees:
        offsets.append(size)
        size += max(n.node for n in tree) + 1
    feat = np.full(size, -1, dtype=np.int64)
    split = np.zeros(size, dtype=np.float64)
    yes = np.zeros(size, dtype=np.int64)
    no = np.zeros(size, dtype=np.int64)
    miss = np.zeros(size, dtype=np.int64)
    leaf = np.zeros(size, dtype=np.float64)
    roots = []
    for off, tree in zip(offsets, model.trees):
        roots.append(off + tree[0].node)
        for n in tree:
            i = off + n.node
            if n.feature is None:
                leaf[i] = n.leaf
                yes[i] = no[i] = miss[i] = i
            else:
                feat[i], split[i] = fidx[n.feature], n.split
                yes[i], no[i], miss[i] = off + n.yes, off + n.no, off + n.missing
    depth = max(len(t) for t in model.trees)
    return feat, split, yes, no, miss, leaf, np.array(roots, dtype=np.int64), depth


def score(model: TreeModel, feats: Mapping[str, Column], float32: bool = True) -> Column:
    """Prediction of ``model`` from named feature Columns.

    The flattened node arrays travel as one broadcast variable, fetched once per
    executor instead of inside every task.
    """
    names = model.features
    feat, split, yes, no, miss, leaf, roots, depth = _flatten(model, names)
    dtype = np.float32 if float32 else np.float64
    nodes = SparkSession.active().sparkContext.broadcast((feat, split.astype(dtype), yes, no, miss, leaf, roots))

    @F.pandas_udf(T.DoubleType())
    def _score(batch: pd.DataFrame) -> pd.Series:
        feat, split_c, yes, no, miss, leaf, roots = nodes.value
        X = batch.to_numpy(dtype=np.float64, na_value=np.nan).astype(dtype)
        n = X.shape[0]
        idx = np.broadcast_to(roots, (n, roots.size)).copy()
        rows = np.arange(n)[:, None]
        for _ in range(depth):
            f = feat[idx]
            inner = f >= 0
            if not inner.any():
                break
            x = X[rows, np.where(inner, f, 0)]
            nxt = np.where(np.isnan(x), miss[idx], np.where(x < split_c[idx], yes[idx], no[idx]))
            idx = np.where(inner, nxt, idx)
        total = np.zeros(n, dtype)
        for t in range(roots.size):
            total += leaf[idx[:, t]].astype(dtype)
        return pd.Series(total.astype(np.float64))

    return _score(F.struct(*[feats[n].cast("double").alias(f"f{i}") for i, n in enumerate(names)]))


def numeric_features(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """PRJ2 + PRJ10: the named feature block, as R's ``sapply(as.numeric)``."""
    return {n: df[n].try_cast("double") for n in names}
