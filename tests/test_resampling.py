"""Shared-pass resampling against models fitted one by one in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dichot.operators import evaluate, glm, models, resampling, sampling
from dichot.plans import frames

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def small(spark):
    df = frames.labeled_features(spark, SF_SMALL).withColumn("noise", sampling.uniform_column(["o_orderkey"], 3))
    design = glm.build_design(df, numeric=["price", "acctbal", "noise"], factors=["o_orderpriority"])
    data = resampling.fold_blocks(df, "y", design, ["o_orderkey"], 3, 2, seed=9)
    x, y, f = [], [], []
    for row in data.blocks.collect():
        n = row["n"]
        x.append(np.frombuffer(row["x"]).reshape(n, data.width))
        y.append(np.frombuffer(row["y"]))
        f.append(np.frombuffer(row["f"], np.uint8).reshape(n, 2))
    yield df, design, data, np.vstack(x), np.concatenate(y), np.vstack(f)
    data.unpersist()


def members(f):
    """Training rows of every resample, then all."""
    return [f[:, r] != i for r in range(2) for i in range(3)] + [np.ones(len(f), bool)]


def newton(x, y):
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        mu = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x.T * (mu * (1 - mu))) @ x, x.T @ (y - mu))
    return b


def brute_auc(y, s):
    pos, neg = s[y > 0.5][:, None], s[y < 0.5][None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


def test_blocks_hold_every_row_and_balanced_folds(small):
    df, _, data, x, y, f = small
    assert len(y) == df.count() and set(np.unique(f)) == {0, 1, 2}
    for r in range(2):
        for cls in (0, 1):
            sizes = np.bincount(f[y == cls, r])
            assert sizes.max() - sizes.min() <= 1
    assert not (f[:, 0] == f[:, 1]).all()


def test_logits_of_all_resamples(small):
    _, _, data, x, y, f = small
    got = resampling.fit_logits(data)
    for b, at in zip(got, members(f)):
        assert np.allclose(b, newton(x[at], y[at]), atol=1e-6)


def test_aliased_columns_are_left_out(spark):
    df = frames.labeled_features(spark, SF_SMALL).withColumn("twice", F.col("price") * 2)
    design = glm.build_design(df, numeric=["price", "twice"])
    data = resampling.fold_blocks(df, "y", design, ["o_orderkey"], 2, 1, seed=1)
    got = resampling.fit_logits(data)
    assert np.all(got[:, 2] == 0) and np.all(np.abs(got[:, 1]) > 0.1)
    data.unpersist()


def test_elastic_net_meets_its_optimality_conditions(small):
    _, _, data, x, y, f = small
    mom = resampling.moments(data)
    grid = resampling.elastic_grid(data, mom, 3)
    assert len(grid) == 9 and {a for a, _ in grid} == {0.1, 0.55, 1.0}
    got = resampling.fit_elastic_nets(data, grid, mom)
    zeros = 0
    for (alpha, lam), per_member in zip(grid, got):
        for b, at in zip(per_member, members(f)):
            z = (x[at] - x[at].mean(0)) / x[at].std(0)
            coef = b[1:] * x[at].std(0)
            mu = 1 / (1 + np.exp(-(b[0] + x[at] @ b[1:])))
            grad = z.T @ (y[at] - mu) / at.sum() - lam * (1 - alpha) * coef
            on = np.abs(coef) > 1e-9
            assert np.allclose(grad[on], lam * alpha * np.sign(coef[on]), atol=2e-5)
            assert np.all(np.abs(grad[~on]) <= lam * alpha + 2e-5)
            assert abs((y[at] - mu).mean()) < 1e-5
            zeros += int((~on).sum())
    assert zeros > 0


def test_boosting_equals_one_fit_at_a_time(spark, small):
    df, design, data, x, y, f = small
    got = resampling.fit_boosted_logits(data, [3, 12])
    assert got.shape == (2, 7, data.width + 1)
    frame = models.assemble(df, design, "y", keep=["o_orderkey"])
    model = models.GLMBoost(mstop=12, nu=0.1).fit(frame)
    for i, m in enumerate((3, 12)):
        one = model.at(m)
        assert np.allclose(got[i, -1], 2 * np.array([one.intercept, *one.coefficients]), atol=1e-9)
    at = members(f)[1]                      # one resample, step by step
    z = np.column_stack([np.ones(at.sum()), x[at] - x[at].mean(0)])
    ys = 2 * y[at] - 1
    b = np.zeros(z.shape[1])
    off = 0.5 * np.log(y[at].mean() / (1 - y[at].mean()))
    for _ in range(3):
        u = 2 * ys / (1 + np.exp(2 * ys * (off + z @ b)))
        j = np.argmax((z.T @ u) ** 2 / (z * z).sum(0))
        b[j] += 0.1 * (z[:, j] @ u) / (z[:, j] @ z[:, j])
    plain = 2 * np.array([off + b[0] - x[at].mean(0) @ b[1:], *b[1:]])
    assert np.allclose(got[0, 1], plain, atol=1e-9)


@pytest.mark.parametrize("share", [resampling.RANGE_ROWS, 40])
def test_held_out_figures(monkeypatch, small, share):
    _, _, data, x, y, f = small
    monkeypatch.setattr(resampling, "RANGE_ROWS", share)
    beta = np.stack([resampling.fit_logits(data), np.zeros((7, data.width + 1))])
    got = resampling.held_out(data, beta, resampling.moments(data))
    assert len(got) == 2 * 2 * 3
    for row in got:
        at = f[:, row["repeat"] - 1] == row["fold"]
        b = beta[row["grid_index"], (row["repeat"] - 1) * 3 + row["fold"]]
        s = b[0] + x[at] @ b[1:]
        assert row["ROC"] == pytest.approx(brute_auc(y[at], s), abs=1e-12)
        assert row["Sens"] == pytest.approx(((s > 0) & (y[at] > 0.5)).sum() / (y[at] > 0.5).sum())
        assert row["Spec"] == pytest.approx(((s <= 0) & (y[at] < 0.5)).sum() / (y[at] < 0.5).sum())


def test_train_returns_the_refitted_best_point(spark, small):
    df, design, data, *_ = small
    fit = glm.fit_logit(df, "y", design)
    glm_run = resampling.train(data, "glm")
    assert glm_run.best == {} and all(glm_run.coef[n] == pytest.approx(v, abs=1e-6) for n, v in fit.coef_dict().items())
    net = resampling.train(data, "glmnet", 2)
    assert len(net.grid) == 4 and len(net.results) == 4 * 6 and net.best in net.grid
    table = net.table(spark).toPandas()
    assert len(table) == 12 and (table.resamples == 6).all() and table.best.sum() == 3
    boost = resampling.train(data, "glmboost", grid=[{"mstop": 2}, {"mstop": 5}])
    assert boost.means().shape == (2,) and set(boost.coef) == {"(Intercept)", *design.columns}
    with pytest.raises(ValueError):
        resampling.train(data, "svm")


def test_repeated_folds_do_not_depend_on_partitioning(spark):
    o = frames.orders_labeled(spark, SF_SMALL).select("o_orderkey", "y")
    a = sampling.repeated_kfold(o, "y", ["o_orderkey"], 4, 3, 7)
    b = sampling.repeated_kfold(o.repartition(13), "y", ["o_orderkey"], 4, 3, 7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    for r in (1, 2, 3):
        one = sampling.kfold(o, "y", ["o_orderkey"], 4, 7 + r, "fold")
        assert {tuple(x) for x in one.select("o_orderkey", "fold").collect()} == {tuple(x) for x in a.select("o_orderkey", f"fold_{r}").collect()}


def test_packed_folds_are_those_of_repeated_kfold(spark):
    """Also for null and repeated keys, over several hash ranges, without ranking each repeat by a window."""
    rows = [(None if i % 50 == 0 else i - (i % 9 == 0), float(i % 3 == 0), float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, y double, v double")
    design = glm.build_design(df, numeric=["v"])
    want = {r["v"]: [r[f"fold_{i}"] for i in (1, 2, 3)] for r in sampling.repeated_kfold(df, "y", ["id"], 4, 3, 7).collect()}
    keep, ranges = sampling.repeated_kfold, resampling.RANGE_ROWS
    sampling.repeated_kfold, resampling.RANGE_ROWS = None, 700
    try:
        data = resampling.fold_blocks(df, "y", design, ["id"], 4, 3, seed=7)
    finally:
        sampling.repeated_kfold, resampling.RANGE_ROWS = keep, ranges
    got = {}
    for r in data.blocks.collect():
        folds = np.frombuffer(r["f"], np.uint8).reshape(r["n"], 3).tolist()
        got.update(zip(np.frombuffer(r["x"]).tolist(), folds))
    assert len(got) == 3000 and got == want
    data.unpersist()


def test_resamples_start_from_the_fit_of_all_rows(small, monkeypatch):
    """The fits of all resamples take a few passes each; those from afar are made for all rows only."""
    _, _, data, *_ = small
    fits, passes = [], resampling._working_sums

    def counted(data, beta, rep, fold):
        fits.append(len(rep))
        return passes(data, beta, rep, fold)

    monkeypatch.setattr(resampling, "_working_sums", counted)
    resampling.fit_logits(data)
    assert fits[0] == 1
    fits.clear()
    grid = [(a, v) for a in (0.1, 1.0) for v in (0.1, 0.01, 0.001)]
    resampling.fit_elastic_nets(data, grid)
    assert fits[0] == 2 and fits.count(12) >= 3


def test_scores_sent_in_several_lots(small, monkeypatch):
    """Scores that a task sends in several lots, ties over lots and ranges, give the brute-force AUC."""
    _, _, data, x, y, f = small
    beta = np.zeros((2, 7, data.width + 1))
    beta[0, :, 1], beta[1, :, 4] = 1.0, 2.0              # a number, and a factor's column: many ties
    monkeypatch.setattr(resampling, "HELD_SCORES", 1)
    monkeypatch.setattr(resampling, "RANGE_ROWS", 100)
    for r in resampling.held_out(data, beta, resampling.moments(data)):
        out = f[:, r["repeat"] - 1] == r["fold"]
        s = x[out] @ beta[r["grid_index"], 0, 1:]
        assert r["ROC"] == pytest.approx(brute_auc(y[out], s), abs=1e-12)
        assert r["Sens"] == pytest.approx((s[y[out] > 0.5] > 0).mean()) and r["Spec"] == pytest.approx((s[y[out] < 0.5] <= 0).mean())


def test_blocks_are_packed_without_loss_and_leave_no_other_folder(spark):
    """Columns of zeros and ones take a bit a row, and the rows that the folds were numbered from are deleted."""
    import os
    df = spark.createDataFrame([(i, float(i % 2), float(i % 3 == 0), i * 0.1) for i in range(5000)], "id long, y double, flag double, v double")
    design = glm.build_design(df, numeric=["flag", "v"])
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(kept))
    data = resampling.fold_blocks(df, "y", design, ["id"], 3, 2, seed=5)
    new = set(os.listdir(kept)) - before
    assert len(new) == 1 and new.pop().startswith("folds-")
    assert sum(len(r["x"]) for r in data.packed.collect()) < 9 * 5000
    rows = np.vstack([np.frombuffer(r["x"]).reshape(r["n"], 2) for r in data.blocks.collect()])
    assert sorted(map(tuple, rows)) == sorted((float(i % 3 == 0), i * 0.1) for i in range(5000))
    data.unpersist()
    assert set(os.listdir(kept)) == before
    v = np.array([-(1 << 63), 0, (1 << 63) - 1])
    assert (resampling._unpacked_ints(resampling._packed_ints(v)) == v).all()
    assert (resampling._unpacked_ints(resampling._packed_ints(v[:0])) == v[:0]).all()


def test_held_out_figures_come_in_lots(small, monkeypatch):
    """Scores of large tables are sent in lots of repeats, or of grid points of one repeat, with the same figures."""
    _, _, data, *_ = small
    mom, sent, lot = resampling.moments(data), [], resampling._lot
    beta = np.stack([resampling.fit_logits(data) * s for s in (1, 0.5, -1)])
    want = resampling.held_out(data, beta, mom)
    monkeypatch.setattr(resampling, "_lot", lambda *a: sent.append(a[2:4]) or lot(*a))
    for share, lots in ((3, 2), (2, 4), (0, 6)):
        monkeypatch.setattr(resampling, "LOT_SCORES", share * mom.n[-1])
        assert resampling.held_out(data, beta, mom) == want and len(sent) == lots
        sent.clear()
