"""Permutation importance and Boruta: recovery of signal, independence of partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dichot.operators import permutation, sampling, selection
from dichot.plans import frames

from conftest import SF_SMALL


def frame(spark):
    return frames.labeled_features(spark, SF_SMALL).withColumn("noise", sampling.uniform_column(["o_orderkey"], 3))


def test_tree_separates_and_predicts():
    r = np.random.default_rng(1)
    x = np.column_stack([r.integers(0, 16, 2000), r.integers(0, 5, 2000), r.integers(0, 16, 2000)]).astype(np.uint8)
    y = ((x[:, 0] > 7) ^ np.isin(x[:, 1], (0, 3))).astype(np.uint8)         # a cut and a set of levels
    tree = permutation.Tree(x, y, np.ones(2000, int), np.array([16, 5, 16]), np.array([False, True, False]), 3, r)
    assert (tree.predict(x) == (y > 0)).mean() > 0.99
    losses = permutation.tree_losses(x, y, np.array([16, 5, 16]), np.array([False, True, False]), 3, np.random.default_rng(2))
    assert losses[0] > 0.2 and losses[1] > 0.2 and abs(losses[2]) < 0.05
    alone = permutation.Tree(x[:, :1] * 0, y, np.ones(2000, int), np.array([1]), np.array([False]), 1, r)
    assert len(set(alone.predict(x[:, :1]).tolist())) == 1


def test_importance_does_not_depend_on_partitioning(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK_ROWS", 300)                      # several blocks
    df = frame(spark)
    args = (["price", "noise"], ["o_orderpriority"], "y", ["o_orderkey"])
    a = {r["variable"]: tuple(r) for r in selection.permutation_importance(df, *args, num_trees=40).collect()}
    b = {r["variable"]: tuple(r) for r in selection.permutation_importance(df.repartition(13), *args, num_trees=40).collect()}
    assert a.keys() == b.keys() == {"price", "noise", "o_orderpriority"}
    for name in a:
        assert a[name][1:] == pytest.approx(b[name][1:], abs=1e-9)
    assert a["price"][1] > 0.1 and a["price"][2] > 10 and abs(a["noise"][1]) < 0.03


def test_boruta_decides_over_numeric_terms_and_factors(spark):
    df = frame(spark)
    hist, stats = selection.boruta(df, ["price", "noise"], "y", ["o_orderkey"], num_trees=30, seed=3, factors=["o_orderpriority"])
    decided = {r["variable"]: r["decision"] for r in stats.collect()}
    assert decided["price"] == "Confirmed" and decided["noise"] != "Confirmed" and set(decided) == {"price", "noise", "o_orderpriority"}
    again, _ = selection.boruta(df.repartition(5).withColumn("x", F.lit(1)), ["price", "noise"], "y", ["o_orderkey"], num_trees=30, seed=3,
                                factors=["o_orderpriority"])
    def rows(h):
        return sorted((r["run"], r["variable"], round(r["importance"], 6)) for r in h.collect())
    assert rows(hist) == rows(again)
