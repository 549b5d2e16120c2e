"""Histogram boosting against trees grown one by one on the raw rows."""

import numpy as np
import pytest

from dichot.operators import gbm, glm, resampling, sampling
from dichot.plans import frames

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    df = frames.labeled_features(spark, SF_SMALL).withColumn("noise", sampling.uniform_column(["o_orderkey"], 3))
    design = glm.build_design(df, numeric=["price", "acctbal", "noise"], factors=["o_orderpriority"])
    data = resampling.fold_blocks(df, "y", design, ["o_orderkey"], 3, 1, seed=9)
    edges = gbm.bin_edges(df, design, 16)
    x, y, f = [], [], []
    for row in data.blocks.collect():
        x.append(np.frombuffer(row["x"]).reshape(row["n"], data.width))
        y.append(np.frombuffer(row["y"]))
        f.append(np.frombuffer(row["f"], np.uint8).reshape(row["n"], 1)[:, 0])
    yield df, design, data, edges, np.vstack(x), np.concatenate(y), np.concatenate(f)
    data.unpersist()


def brute(x, y, edges, depth, trees, shrinkage, least):
    """Margins of all rows of a model fitted to the rows of ``y`` that are not nan."""
    told = ~np.isnan(y)
    margin = np.full(len(x), np.log(y[told].mean() / (1 - y[told].mean())))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.where(told, y - p, 0), np.where(told, p * (1 - p), 0)
        leaves = [np.ones(len(x), bool)]
        for _ in range(depth):
            best = None
            for i, leaf in enumerate(leaves):
                for j, cuts in enumerate(edges):
                    for e in cuts:
                        left, right = leaf & told & (x[:, j] <= e), leaf & told & (x[:, j] > e)
                        if left.sum() < least or right.sum() < least:
                            continue
                        nl, nr = left.sum(), right.sum()
                        gain = nl * nr / (nl + nr) * (g[left].mean() - g[right].mean()) ** 2
                        if best is None or gain > best[0] + 1e-9:
                            best = gain, i, j, e
            if best is None:
                break
            _, i, j, e = best
            leaf = leaves.pop(i)
            leaves += [leaf & (x[:, j] <= e), leaf & (x[:, j] > e)]
        for leaf in leaves:
            margin[leaf] += shrinkage * g[leaf].sum() / h[leaf].sum()
    return margin


def test_trees_equal_brute_force(run):
    _, _, data, edges, x, y, f = run
    got = gbm.train_gbm(data, edges, depths=(1, 3), trees=3, shrinkage=0.3, least=5)
    assert [p["depth"] for p in got.grid] == [1, 3] and len(got.results) == 6
    for g, depth in enumerate((1, 3)):
        assert np.allclose(got.models[g].margins(x), brute(x, y, edges, depth, 3, 0.3, 5), atol=1e-9)
        for fold in range(3):
            held = f == fold
            m = brute(x, np.where(held, np.nan, y), edges, depth, 3, 0.3, 5)[held]
            pos, neg = m[y[held] > 0.5][:, None], m[y[held] < 0.5][None, :]
            row = next(r for r in got.results if (r["grid_index"], r["fold"]) == (g, fold))
            assert row["ROC"] == pytest.approx((np.round(pos - neg, 9) > 0).mean() + 0.5 * (np.round(pos - neg, 9) == 0).mean(), abs=1e-6)


def test_scoring_and_importance(run):
    df, design, data, edges, x, y, _ = run
    got = gbm.train_gbm(data, edges, depths=(2,), trees=11, shrinkage=0.2)      # past a checkpoint
    model = got.model
    rows = model.transform(df).select("price", "acctbal", "noise", "probability", "y").collect()
    assert len(rows) == len(y) and all(0 < r["probability"] < 1 for r in rows)
    assert sorted(r["probability"] for r in rows) == pytest.approx(sorted(1 / (1 + np.exp(-model.margins(x)))))
    share = model.importance()
    assert sum(share.values()) == pytest.approx(100) and max(share, key=share.get) == "price"
    nothing = df.limit(1).withColumn("price", df["price"] * float("nan")).selectExpr("* except (price)", "cast(null as double) as price")
    assert model.transform(nothing).first()["probability"] is None


def test_columns_without_splits(spark):
    df = frames.labeled_features(spark, SF_SMALL).selectExpr("o_orderkey", "y", "1.0D AS flat")
    design = glm.build_design(df, numeric=["flat"])
    data = resampling.fold_blocks(df, "y", design, ["o_orderkey"], 2, 1, seed=1)
    got = gbm.train_gbm(data, gbm.bin_edges(df, design), depths=(1,), trees=2)
    assert np.isclose(got.models[0].start, got.models[0].margins(np.ones((1, 1)))[0])
    assert all(r["ROC"] == 0.5 for r in got.results)
    data.unpersist()


def test_margins_travel_by_size_and_paths_find_nodes():
    """A pass reads one margin column a size, and a node's rows by the splits above it only."""
    r = np.random.default_rng(4)
    tree = gbm.Trees(np.array([[0, 0], [1, 2], [4, gbm.NO_NODE]], np.uint8), r.integers(0, 3, (3, 2)), r.integers(1, 6, (3, 2)), None, None)
    code = r.integers(0, 8, (500, 3)).astype(np.uint8)
    for node in range(7):
        for member in (0, 1):
            if node > 4 and member:
                continue
            keep = np.ones((500, 1), bool)
            for column, edge, right in tree.path(np.array([member]), np.array([node])):
                keep &= (code[:, column] > edge) == right
            inside = [node]                                   # the node and all below it
            for s in range(3):
                if tree.parent[s, member] in inside:
                    inside += [2 * s + 1, 2 * s + 2]
            assert (keep[:, 0] == np.isin(tree.nodes(code)[:, member], inside)).all()


def test_a_tree_takes_fewer_passes_than_splits(run, monkeypatch):
    """A pass takes all leaves that may be split next, not one split; the tree is that of one split at a time."""
    _, _, data, edges, x, y, _ = run
    passes, add = [], gbm.add_vectors
    monkeypatch.setattr(gbm, "add_vectors", lambda *a: passes.append(1) or add(*a))
    got = gbm.train_gbm(data, edges, depths=(9,), trees=1, shrinkage=0.3, least=5)
    assert len(passes) < 9
    assert np.allclose(got.models[0].margins(x), brute(x, y, edges, 9, 1, 0.3, 5), atol=1e-9)


def test_columns_of_few_bins_are_counted_together():
    joint = gbm._joint([64, 2, 2, 200, 1])
    assert sorted(j for js, _, _ in joint for j in js) == [0, 1, 2, 3, 4] and len(joint) == 2
    for js, strides, size in joint:
        assert size <= gbm.JOINT_BINS and [s for s in strides][0] == 1
