"""Fitted-model operators: signal recovery and algebraic properties."""
import inspect

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from dichot.operators import evaluate, glm, models, sampling, selection
from dichot.plans import frames, jobs

from conftest import SF_MID, SF_SMALL


def _frame(spark, sf):
    df = frames.labeled_features(spark, sf).withColumn("noise", F.rand(11))
    d = glm.build_design(df, numeric=["price", "acctbal", "noise"])
    return df, d, models.assemble(df, d, "y", keep=["o_orderkey"])


def test_glmboost_selects_signal_and_ranks_like_glm(spark):
    _, _, frame = _frame(spark, SF_SMALL)
    m = models.GLMBoost(mstop=200, nu=0.1).fit(frame)
    assert 0 in m.selected()  # price is design column 0
    p = models.p_positive(m.transform(frame))
    a_boost = evaluate.auc(p, "label", "p1")
    g = models.p_positive(models.glm_estimator().fit(frame).transform(frame))
    a_glm = evaluate.auc(g, "label", "p1")
    assert abs(a_boost - a_glm) < 0.02


def test_resample_tuning_table(spark):
    _, _, frame = _frame(spark, SF_SMALL)
    frame = sampling.kfold(frame, "label", ["o_orderkey"], 3, 1)
    est = models.glmnet_estimator()
    grid = models.param_grid(est, regParam=[0.001, 0.1])
    res = models.resample(est, grid, frame, ["fold"])
    assert len(res) == 6
    tab = models.tuning_table(spark, est, grid, res).toPandas()
    assert (tab.resamples == 3).all() and tab["mean"].between(0.5, 1.0).all()


def test_boruta_confirms_signal(spark):
    df = frames.labeled_features(spark, SF_SMALL).withColumn("noise", F.rand(2))
    hist, stats = selection.boruta(df, ["price", "acctbal", "noise"], "y", ["o_orderkey"],
                                   max_runs=10, num_trees=20, seed=3)
    dec = {r["variable"]: r["decision"] for r in stats.collect()}
    assert dec["price"] == "Confirmed"
    assert dec["noise"] != "Confirmed"
    assert 27 <= hist.count() <= 30


def test_boruta_runs_long_enough_to_decide(spark):
    df = frames.labeled_features(spark, SF_SMALL)
    with pytest.raises(ValueError):
        selection.boruta(df, ["price", "acctbal"], "y", ["o_orderkey"], max_runs=3)
    for f, name in ((selection.boruta, "max_runs"), (jobs.model_job, "boruta_runs")):
        assert inspect.signature(f).parameters[name].default == 100


def test_pca_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    load, sd = selection.pca(emb, "v", 3)
    x = np.stack([r["v"].toArray() for r in emb.collect()])
    sv = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) / np.sqrt(len(x) - 1)
    got = sd.orderBy("component").toPandas().sdev.to_numpy()
    assert np.allclose(got, sv[:3], rtol=1e-6)
    L = load.toPandas().pivot(index="variable", columns="component", values="loading").to_numpy()
    assert np.allclose(L.T @ L, np.eye(3), atol=1e-8)
    assert np.all(L[np.argmax(np.abs(L), axis=0), range(3)] > 0)


def test_pca_in_blocks_gives_all_components_and_scores(spark, monkeypatch):
    monkeypatch.setattr(selection, "PCA_BLOCK", 7)
    r = np.random.default_rng(3)
    x = r.normal(size=(200, 20)) @ r.normal(size=(20, 20))
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)] + [(None, None, "x")], "id long, v array<double>, scores string")
    load, sd = selection.pca(df.repartition(3), "v")
    sv = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) / np.sqrt(len(x) - 1)
    assert np.allclose(sd.orderBy("component").toPandas().sdev, sv)
    scores = np.array([row["scores"] for row in selection.pca_scores(df, ["id"], "v").orderBy("id").collect()])
    assert np.allclose(scores.std(axis=0, ddof=1), sv) and np.allclose(scores.mean(axis=0), 0, atol=1e-9)
    L = load.toPandas().pivot(index="variable", columns="component", values="loading").to_numpy()
    assert np.allclose(scores @ L.T, x - x.mean(axis=0))
    assert selection.pca(df.limit(0), "v")[1].count() == 0


def test_ensemble_joins_on_key(spark):
    a = spark.createDataFrame([(1, 0.9, 1.0), (2, 0.2, 0.0)], "k long, p1 double, label double")
    b = spark.createDataFrame([(2, 0.6, 0.0), (1, 0.7, 1.0)], "k long, p1 double, label double")
    e = {r["k"]: r for r in models.ensemble({"a": a, "b": b}, ["k"], "label").collect()}
    assert abs(e[1]["p_mean"] - 0.8) < 1e-12 and e[1]["vote"] == 1.0
    assert abs(e[2]["p_mean"] - 0.4) < 1e-12 and e[2]["vote"] == 0.0


def test_glmboost_path_equals_refit(spark):
    _, _, frame = _frame(spark, SF_SMALL)
    full = models.GLMBoost(mstop=30).fit(frame)
    short = models.GLMBoost(mstop=12).fit(frame)
    cut = full.at(12)
    assert np.allclose(cut.coefficients, short.coefficients, atol=1e-12)
    assert abs(cut.intercept - short.intercept) < 1e-12


def test_model_job_compares_four_models(spark):
    df = frames.labeled_features(spark, SF_SMALL)
    out = jobs.model_job(spark, df, "y", ["o_orderkey"], ["price", "acctbal"], ["o_orderpriority"],
                         boruta_trees=20, repeats=1, tune_length=1, gbm_trees=3)
    assert "price" in out["boruta_confirmed"] and "price" in out["selected"]
    assert {n for n, _ in out["leaderboard"]} == {"glm", "glmboost", "glmnet", "gbm"}
    assert all(0.6 < v < 1 for _, v in out["leaderboard"]) and out["auc"] > 0.6


def test_forest_query_runs_the_whole_job(spark, tmp_path, monkeypatch):
    """rf_cv fits 500 trees for each of five values of mtry and all of 5 x 10 resamples."""
    from dichot.plans.queries import QUERIES
    spark.range(400).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "1000D * id AS o_totalprice", "concat('p', id % 5) AS o_orderpriority",
        "substr('FOP', cast(id % 3 AS int) + 1, 1) AS o_orderstatus").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(7).selectExpr("id AS c_custkey", "id AS c_nationkey", "cast(id AS double) AS c_acctbal",
                              "concat('s', id % 5) AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    seen = {}

    def resample(est, grid, frame, fold_cols):
        seen.update(trees=est.getNumTrees(), mtry=[list(p.values())[0] for p in grid],
                    folds=[frame.select(c).distinct().count() for c in fold_cols], rows=frame.count())
        return [{"fold_col": c, "fold": f, "grid_index": g, "metric": 0.5} for c in fold_cols for f in range(5) for g in range(len(grid))]

    monkeypatch.setattr(models, "resample", resample)
    out = QUERIES["rf_cv"](spark, str(tmp_path)).collect()
    assert seen == {"trees": 500, "mtry": ["2", "4", "7", "10", "13"], "folds": [5] * 10, "rows": 400}
    assert len(out) == 5 and all(r["resamples"] == 50 for r in out)
    assert models.mtry_values(3, 5) == ["2", "3"] and models.mtry_values(1, 5) == ["1"]
