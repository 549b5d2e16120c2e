"""Logistic IRLS against Spark's GLR, score equations, aliasing, GVIF, stepwise."""
import math

import numpy as np
from pyspark.sql import functions as F

from dichot.operators import glm, inference, selection
from dichot.plans import frames

from conftest import SF_MID, SF_SMALL


def _frame(spark, sf=SF_MID):
    return frames.labeled_features(spark, sf)


def test_irls_matches_spark_glr(spark):
    df = _frame(spark)
    d = glm.build_design(df, numeric=["price", "acctbal"], factors=["o_orderpriority"])
    fit = glm.fit_logit(df, "y", d, tol=1e-10)
    model, _ = glm.spark_glr(df, "y", d)
    assert math.isclose(fit.coef[0], model.intercept, abs_tol=1e-7)
    assert np.allclose(fit.coef[1:], model.coefficients.toArray(), atol=1e-7)
    se = model.summary.coefficientStandardErrors  # intercept last
    assert np.allclose(fit.std_errors()[1:], se[:-1], rtol=1e-5)
    assert math.isclose(fit.std_errors()[0], se[-1], rel_tol=1e-5)
    assert math.isclose(fit.deviance, model.summary.deviance, rel_tol=1e-9)
    assert math.isclose(fit.aic, model.summary.aic, rel_tol=1e-9)


def test_score_equations(spark):
    df = _frame(spark)
    d = glm.build_design(df, numeric=["price"], factors=["o_orderstatus"])
    fit = glm.fit_logit(df, "y", d, tol=1e-12)
    scored = inference.fitted_columns(df, fit, "y")
    r = F.col("y") - F.col("fitted")
    sums = scored.agg(F.sum(r).alias("s0"), F.sum(r * F.col("price")).alias("s1")).first()
    assert abs(sums["s0"]) < 1e-6 and abs(sums["s1"]) < 1e-6


def test_expected_fixture_values(spark):
    o = frames.orders_labeled(spark, SF_MID).withColumn("price", F.col("o_totalprice") / 1e5)
    fit = glm.fit_logit(o, "y", glm.build_design(o, numeric=["price"]))
    assert round(fit.coef[0], 6) == -2.657311 and round(fit.coef[1], 6) == 1.059738
    fit2 = glm.fit_logit(o, "status_f", glm.build_design(o, factors=["o_orderpriority"]))
    assert round(fit2.deviance, 6) == 18999.461957 and round(fit2.aic, 6) == 19009.461957
    assert fit2.names[1] == "o_orderpriority2-HIGH"  # base level 1-URGENT dropped


def test_aliased_column_gets_na(spark):
    df = _frame(spark, SF_SMALL).withColumn("price2", F.col("price") * 2)
    d = glm.build_design(df, numeric=["price", "price2", "acctbal"])
    fit = glm.fit_logit(df, "y", d)
    assert fit.aliased == ["price2"]
    assert np.isnan(fit.coef[2]) and not np.isnan(fit.coef[1])
    assert inference.rank_deficiency(fit) == ["price2"]


def test_gvif_near_one_and_large_when_collinear(spark):
    df = _frame(spark).withColumn("noise", F.rand(3))
    d = glm.build_design(df, numeric=["price", "noise"], factors=["o_orderpriority"])
    g = {t: adj for t, _, _, adj in selection.gvif(glm.fit_logit(df, "y", d))}
    assert all(abs(v - 1) < 0.05 for v in g.values())
    df2 = df.withColumn("near", F.col("price") + 0.01 * F.col("noise"))
    d2 = glm.build_design(df2, numeric=["price", "near"])
    g2 = {t: adj for t, _, _, adj in selection.gvif(glm.fit_logit(df2, "y", d2))}
    assert g2["price"] > 10


def test_stepwise_aic_never_rises_and_finds_signal(spark):
    df = _frame(spark).withColumn("noise", F.rand(5))
    d = glm.build_design(df, numeric=["price", "noise"], factors=["o_orderstatus"])
    data = d.matrix(df, "y")
    terms, path, _ = selection.stepwise(data, d, "both")
    aics = [p[5] for p in path]
    assert all(b <= a for a, b in zip(aics, aics[1:]))
    assert "price" in terms
    back_terms, back_path, _ = selection.stepwise(data, d, "backward")
    assert "price" in back_terms


def test_wald_and_lrt_agree_in_large_sample(spark):
    o = frames.orders_labeled(spark, SF_MID)
    d = glm.build_design(o, factors=["o_orderpriority"])
    fit = glm.fit_logit(o, "status_f", d)
    w = inference.wald_term(fit, "o_orderpriority")
    lr = fit.null_deviance - fit.deviance
    assert abs(w["chisq"] - lr) < 0.05 * max(1.0, lr) + 0.05


def test_profile_interval_hits_the_chi_square_cut(spark):
    df = _frame(spark, SF_SMALL)
    d = glm.build_design(df, numeric=["price"], factors=["o_orderstatus"])
    data = d.matrix(df, "y")
    fit = glm.fit_logit_many(data, d, [d.indices(d.sources)], tol=1e-10)[0]
    prof = {n: (lo, hi) for n, lo, hi in inference.confint_profile(data, fit)}
    lo, hi = prof["price"]
    devs = inference._constrained_deviances(data, fit, [(1, lo), (1, hi)])
    for dv in devs:
        assert abs(dv - fit.deviance - 3.841458820694124) < 1e-4
    wald = {n: (a, b) for n, a, b in inference.confint_wald(fit)}
    assert lo < fit.coef[1] < hi
    assert abs(lo - wald["price"][0]) < 0.2 * (hi - lo)


def test_profile_limit_is_found_or_missing(spark):
    df = _frame(spark, SF_SMALL)
    d = glm.build_design(df, numeric=["price"])
    data = d.matrix(df, "y")
    fit = glm.fit_logit_many(data, d, [d.indices(d.sources)], tol=1e-10)[0]
    assert all(lo is None and hi is None for _, lo, hi in inference.confint_profile(data, fit, iterations=1))
    assert all(lo < hi for _, lo, hi in inference.confint_profile(data, fit))
