"""Likelihood-based inference and diagnostics for a fitted logit.

Everything here starts from a :class:`dichot.operators.glm.LogitFit` (its
coefficients, covariance and deviances), so it costs at most one extra pass
over the data: row-level diagnostics are projections with the small
covariance matrix shipped in the closure, grouped ones are one aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dichot.functions.stats import chi2_sf, f_sf, normal_ppf
from dichot.operators.glm import Design, LogitFit, fit_logit_many
from dichot.operators.ordered import exact_quantiles


def _rows_df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ I01-I03

def coef_table(spark, fit: LogitFit) -> DataFrame:
    """Estimate, standard error, z and p per coefficient (intercept first)."""
    return _rows_df(spark, fit.table(),
                    "term string, estimate double, std_error double, z_value double, p_value double")


def confint_wald(fit: LogitFit, level: float = 0.95) -> list[tuple]:
    """Wald interval beta +- z * SE (``confint.default``)."""
    z = normal_ppf(0.5 + level / 2)
    out = []
    for name, b, s in zip(fit.names, fit.coef, fit.std_errors()):
        out.append((name, None, None) if np.isnan(b) else (name, float(b - z * s), float(b + z * s)))
    return out


def odds_ratios(spark, fit: LogitFit, level: float = 0.95) -> DataFrame:
    """``exp(cbind(OR = coef(fit), confint(fit)))`` with Wald limits."""
    rows = []
    for (name, lo, hi), b in zip(confint_wald(fit, level), fit.coef):
        if np.isnan(b):
            rows.append((name, None, None, None))
        else:
            rows.append((name, math.exp(b), math.exp(lo), math.exp(hi)))
    return _rows_df(spark, rows, "term string, odds_ratio double, or_lower double, or_upper double")


# ------------------------------------------------------------------ I04-I10, I14

def deviance_stats(fit: LogitFit) -> dict:
    """Deviances, df, log-likelihood, model chi-square, dispersion."""
    stat, dof, p = fit.lr_test_vs_null()
    return {"null_deviance": fit.null_deviance, "df_null": fit.df_null,
            "deviance": fit.deviance, "df_residual": fit.df_residual,
            "loglik": fit.loglik, "aic": fit.aic, "bic": fit.bic,
            "chisq": stat, "chisq_df": dof, "p_value": p,
            "dispersion": fit.deviance / fit.df_residual,
            "overdispersed": fit.deviance / fit.df_residual > 1.5}


def pseudo_r2(fit: LogitFit) -> dict:
    """``pscl::pR2``: llh, llhNull, G2, McFadden, r2ML, r2CU."""
    llh, lln, n = fit.loglik, fit.null_loglik, fit.n
    g2 = -2 * (lln - llh)
    r2ml = 1 - math.exp(-g2 / n)
    r2cu = r2ml / (1 - math.exp(2 * lln / n))
    return {"llh": llh, "llh_null": lln, "g2": g2, "mcfadden": 1 - llh / lln,
            "r2ml": r2ml, "r2cu": r2cu}


def nagelkerke(fit: LogitFit) -> dict:
    """McFadden, Cox and Snell, Nagelkerke and the model LR test."""
    r = pseudo_r2(fit)
    stat, dof, p = fit.lr_test_vs_null()
    return {"mcfadden": r["mcfadden"], "cox_snell": r["r2ml"], "nagelkerke": r["r2cu"],
            "lr_chisq": stat, "lr_df": dof, "lr_p": p}


def lr_test(small: LogitFit, big: LogitFit) -> dict:
    """``anova(m1, m2, test="Chisq")`` / ``lrtest``."""
    stat = small.deviance - big.deviance
    dof = small.df_residual - big.df_residual
    return {"deviance_small": small.deviance, "deviance_big": big.deviance,
            "statistic": stat, "df": dof, "p_value": chi2_sf(stat, dof)}


def anova_sequential(spark, data: DataFrame, design: Design, terms: Sequence[str] | None = None) -> DataFrame:
    """``anova(model, test="Chisq")``: terms added in order.

    All nested models are fitted in the same passes over the data.
    """
    terms = list(terms or design.sources)
    models = [design.indices(terms[:k]) for k in range(len(terms) + 1)]
    fits = fit_logit_many(data, design, models)
    rows = [("NULL", None, None, fits[0].df_residual, fits[0].deviance, None)]
    for k in range(1, len(fits)):
        d = fits[k - 1].deviance - fits[k].deviance
        dof = fits[k - 1].df_residual - fits[k].df_residual
        rows.append((terms[k - 1], dof, d, fits[k].df_residual, fits[k].deviance,
                     chi2_sf(d, dof) if dof > 0 else None))
    return _rows_df(spark, rows, "term string, df long, deviance double, resid_df long, "
                                 "resid_dev double, p_value double")


def compare_models(spark, fits: dict) -> DataFrame:
    """``compareGLM``: one row per model with AIC, AICc, BIC, pseudo R2, p."""
    rows = []
    for name, f in fits.items():
        k, n = f.rank, f.n
        aicc = f.aic + 2 * k * (k + 1) / (n - k - 1)
        r = nagelkerke(f)
        rows.append((name, k, f.df_residual, f.aic, aicc, f.bic, r["mcfadden"], r["cox_snell"],
                     r["nagelkerke"], r["lr_p"] if r["lr_df"] > 0 else None))
    return _rows_df(spark, rows, "model string, rank long, df_residual long, aic double, "
                                 "aicc double, bic double, mcfadden double, cox_snell double, "
                                 "nagelkerke double, p_value double")


# ------------------------------------------------------------------ I12/I13

def _term_positions(fit: LogitFit, term: str) -> list[int]:
    cols = set(fit.design.term(term).columns)
    kept = [i for i, b in enumerate(fit.coef) if not np.isnan(b)]
    # positions inside the covariance (non-aliased coefficients only)
    return [j for j, i in enumerate(kept) if fit.names[i] in cols]


def wald_term(fit: LogitFit, term: str) -> dict:
    """``regTermTest``: Wald chi-square of a term's coefficient block,
    with the F form on the residual df as ``survey`` reports it for glm fits."""
    pos = _term_positions(fit, term)
    kept = [b for b in fit.coef if not np.isnan(b)]
    beta = np.array([kept[j] for j in pos])
    v = fit.cov[np.ix_(pos, pos)]
    chisq = float(beta @ np.linalg.solve(v, beta))
    dof = len(pos)
    return {"term": term, "chisq": chisq, "df": dof, "p_chisq": chi2_sf(chisq, dof),
            "f": chisq / dof, "ddf": fit.df_residual,
            "p_f": f_sf(chisq / dof, dof, fit.df_residual)}


def type2_wald(spark, fit: LogitFit) -> DataFrame:
    """``car::Anova(type="II", test="Wald")`` for a main-effects model."""
    rows = []
    for t in fit.terms:
        w = wald_term(fit, t)
        rows.append((t, w["chisq"], w["df"], w["p_chisq"]))
    return _rows_df(spark, rows, "term string, chisq double, df long, p_value double")


# ------------------------------------------------------------------ I16-I18

def fitted_columns(df: DataFrame, fit: LogitFit, label_col: str) -> DataFrame:
    """Add ``eta``, ``fitted`` and ``dev_resid`` (I16) as JVM expressions."""
    y = F.col(label_col).cast("double")
    mu = F.col("fitted")
    dev_unit = -2.0 * (F.when(y > 0, y * F.log(mu)).otherwise(F.lit(0.0))
                       + F.when(y < 1, (F.lit(1.0) - y) * F.log(F.lit(1.0) - mu)).otherwise(F.lit(0.0)))
    return (df.withColumn("eta", fit.eta())
              .withColumn("fitted", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("eta"))))
              .withColumn("dev_resid", F.signum(y - mu) * F.sqrt(F.greatest(dev_unit, F.lit(0.0)))))


def _quad_form_udf(cov: np.ndarray, kept_idx: list[int]):
    """Vectorised x'Vx over the design columns (one struct of doubles per row,
    Arrow batches, numpy; V is p x p and travels in the closure)."""
    v = cov.copy()

    @F.pandas_udf("double")
    def quad(xs: pd.DataFrame) -> pd.Series:
        if len(xs) == 0:
            return pd.Series([], dtype="float64")
        x = xs.to_numpy(dtype=np.float64)
        x = np.hstack([np.ones((len(x), 1)), x[:, kept_idx]])
        return pd.Series(np.einsum("ij,jk,ik->i", x, v, x))

    return quad


def _design_struct(design: Design) -> Column:
    return F.struct(*[e.cast("double").alias(f"x_{i}") for i, e in enumerate(design.exprs())])


def standardized_residuals(df: DataFrame, fit: LogitFit, label_col: str) -> DataFrame:
    """Leverage h = w x'Vx and ``rstandard`` = dev_resid / sqrt(1 - h)."""
    kept = [fit.index[j - 1] for j in range(1, len(fit.coef)) if not np.isnan(fit.coef[j])]
    quad = _quad_form_udf(fit.cov, kept)
    x = _design_struct(fit.design)
    out = fitted_columns(df, fit, label_col)
    w = F.col("fitted") * (F.lit(1.0) - F.col("fitted"))
    return (out.withColumn("leverage", w * quad(x))
               .withColumn("std_resid", F.col("dev_resid") / F.sqrt(F.lit(1.0) - F.col("leverage"))))


def component_residuals(df: DataFrame, fit: LogitFit, label_col: str, term: str,
                        n_bins: int = 10) -> DataFrame:
    """``crPlots`` data: bins of x with mean of beta*x + working residual."""
    t = fit.design.term(term)
    if t.kind != "numeric":
        raise ValueError("component+residual needs a numeric term")
    b = fit.coef_dict()[t.columns[0]]
    out = fitted_columns(df, fit, label_col)
    mu = F.col("fitted")
    work = (F.col(label_col).cast("double") - mu) / (mu * (F.lit(1.0) - mu))
    x = F.col(term).cast("double")
    rng = out.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    width = (rng["hi"] - rng["lo"]) / n_bins or 1.0
    bin_ = F.least(F.floor((x - F.lit(rng["lo"])) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    return (out.filter(x.isNotNull())
               .groupBy(bin_.alias("bin"))
               .agg(F.avg(x).alias("x_mean"), F.avg(F.lit(b) * x + work).alias("partial_resid"),
                    F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ M14/I19/I20

def predict_grid(grid: DataFrame, fit: LogitFit, level: float = 0.95) -> DataFrame:
    """Response on a grid with SE and interval: inverse logit of eta +- z*se."""
    kept = [fit.index[j - 1] for j in range(1, len(fit.coef)) if not np.isnan(fit.coef[j])]
    quad = _quad_form_udf(fit.cov, kept)
    z = normal_ppf(0.5 + level / 2)
    x = _design_struct(fit.design)
    inv = lambda e: F.lit(1.0) / (F.lit(1.0) + F.exp(-e))
    return (grid.withColumn("eta", fit.eta())
                .withColumn("se_eta", F.sqrt(quad(x)))
                .withColumn("fit", inv(F.col("eta")))
                .withColumn("lower", inv(F.col("eta") - z * F.col("se_eta")))
                .withColumn("upper", inv(F.col("eta") + z * F.col("se_eta"))))


def effects(df: DataFrame, fit: LogitFit, term: str, level: float = 0.95) -> DataFrame:
    """``allEffects`` for one term: its levels (or five quantiles) with the
    other design columns held at their means; fitted response and interval."""
    design = fit.design
    t = design.term(term)
    used = design.matrix(df, None, persist=False)
    p = len(design.columns)
    means_row = used.agg(*[F.avg(f"x_{i}").alias(f"m{i}") for i in range(p)]).first()
    means = [means_row[f"m{i}"] for i in range(p)]
    if t.kind == "factor":
        values = [(v,) for v in t.levels]
        spark = df.sparkSession
        grid = spark.createDataFrame(values, [term])
    else:
        q = exact_quantiles(df, term, [0.0, 0.25, 0.5, 0.75, 1.0]).select(F.col("quantile").alias(term))
        grid = q.distinct()
    pos = design.indices([term])
    held = {}
    for i, (c, e) in enumerate(zip(design.columns, design.exprs())):
        if i in pos:
            held[c] = e.cast("double")
        else:
            held[c] = F.lit(float(means[i]))
    # a grid design whose expressions read the grid term and constants elsewhere
    from dichot.operators.glm import Term
    terms = []
    k = 0
    for tt in design.terms:
        cols = tt.columns
        terms.append(Term(tt.name, tt.kind, cols, [held[c] for c in cols], tt.levels))
        k += len(cols)
    gfit = LogitFit(Design(terms), fit.index, fit.names, fit.coef, fit.cov, fit.deviance,
                    fit.null_deviance, fit.n, fit.n_pos, fit.iterations, fit.converged, fit.aliased)
    return predict_grid(grid, gfit, level).select(term, "fit", "se_eta", "lower", "upper")


def rank_deficiency(fit: LogitFit) -> list[str]:
    """Design columns dropped as aliased (NA coefficients, as R reports)."""
    return list(fit.aliased)


# ------------------------------------------------------------------ I02 profile likelihood

def _constrained_deviances(data: DataFrame, fit: LogitFit, specs: list[tuple[int, float]],
                           max_iter: int = 25, tol: float = 1e-10) -> list[float]:
    """Deviance of the model with one coefficient held at a value, for many
    (coefficient position, value) pairs at once.

    The held coefficient becomes an offset; the others are refitted by IRLS
    started from the unconstrained fit, all pairs advancing in the same pass
    over the design matrix (numpy partials, one row per partition).
    """
    kept = [fit.index[j - 1] for j in range(1, len(fit.coef)) if not np.isnan(fit.coef[j])]
    theta = np.array([fit.coef[0]] + [fit.coef[1 + fit.index.index(i)] for i in kept])
    k_all = len(theta)
    p = len(fit.design.columns)
    states = []
    for c, b in specs:
        free = [j for j in range(k_all) if j != c]
        states.append({"c": c, "b": b, "free": free, "beta": theta[free].copy(), "dev": None,
                       "prev": None, "done": False, "halvings": 0})
    from dichot.functions.linalg import design_block, sum_partials
    for _ in range(max_iter):
        active = [s for s in states if not s["done"]]
        if not active:
            break
        payload = [(s["c"], s["b"], s["free"], s["beta"].copy()) for s in active]
        k = k_all - 1
        length = sum(k * k + k + 1 for _ in payload)

        def partial(pdf, payload=payload, k=k, length=length):
            x = design_block(pdf, p)
            xf = np.hstack([np.ones((len(pdf), 1)), x[:, kept]])
            y = pdf["y"].to_numpy(dtype=np.float64)
            out = np.empty(length)
            pos = 0
            for c, b, free, beta in payload:
                xm = xf[:, free]
                off = b * xf[:, c]
                eta = xm @ beta + off
                mu = np.clip(1.0 / (1.0 + np.exp(-eta)), 1e-15, 1 - 1e-15)
                var = mu * (1 - mu)
                z = eta + (y - mu) / var - off
                xw = xm.T * var
                out[pos:pos + k * k] = (xw @ xm).ravel()
                pos += k * k
                out[pos:pos + k] = xw @ z
                pos += k
                out[pos] = -2.0 * np.sum(y * np.log(mu) + (1 - y) * np.log(1 - mu))
                pos += 1
            return out

        sums = sum_partials(data, partial, length)
        pos = 0
        for s in active:
            g = sums[pos:pos + k * k].reshape(k, k)
            pos += k * k
            r = sums[pos:pos + k]
            pos += k
            dev = sums[pos]
            pos += 1
            if s["dev"] is not None and s["halvings"] < 10 and dev > s["dev"] + 1e-9 * (abs(s["dev"]) + 1):
                s["beta"] = (s["beta"] + s["prev"]) / 2.0  # step halving, as glm.fit
                s["halvings"] += 1
                continue
            s["halvings"] = 0
            if s["dev"] is not None and abs(dev - s["dev"]) / (abs(dev) + 0.1) < tol:
                s["dev"], s["done"] = dev, True
                continue
            s["dev"], s["prev"] = dev, s["beta"].copy()
            s["beta"] = np.linalg.solve(g, r)
    return [float(s["dev"]) for s in states]


def confint_profile(data: DataFrame, fit: LogitFit, level: float = 0.95,
                    iterations: int = 50) -> list[tuple]:
    """Profile-likelihood interval, ``confint(glm)`` (MASS), for every
    non-aliased coefficient.

    The signed root r(b) = sign(b - beta) * sqrt(dev(b) - dev) is nearly
    linear in b; starting at the Wald limits, secant steps solve
    r(b) = +-z with all 2 x (coefficients) constrained fits sharing each pass,
    until the root is met or a step is a millionth of the standard error.  A
    limit not found within ``iterations`` is None (R: NA).
    """
    z = normal_ppf(0.5 + level / 2)
    se = fit.std_errors()
    pos = [j for j in range(len(fit.coef)) if not np.isnan(fit.coef[j])]
    beta = {j: float(fit.coef[j]) for j in pos}
    cov_pos = {j: n for n, j in enumerate(pos)}
    ends = [(j, side) for j in pos for side in (-1, 1)]
    pts = {e: [(beta[e[0]], 0.0)] for e in ends}
    cur = {(j, s): beta[j] + s * z * se[j] for j, s in ends}
    todo = list(ends)
    for _ in range(iterations):
        devs = _constrained_deviances(data, fit, [(cov_pos[j], cur[(j, s)]) for j, s in todo])
        still = []
        for (j, s), d in zip(todo, devs):
            r = s * math.sqrt(max(d - fit.deviance, 0.0))
            pts[(j, s)].append((cur[(j, s)], r))
            if abs(r - s * z) < 1e-7:
                continue  # this limit is solved; keep the point it was found at
            (b0, r0), (b1, r1) = pts[(j, s)][-2], pts[(j, s)][-1]
            if abs(r1 - r0) > 1e-12:
                step = (s * z - r1) * (b1 - b0) / (r1 - r0)
                cur[(j, s)] = b1 + step
                if abs(step) < 1e-6 * se[j]:
                    continue
            still.append((j, s))
        todo = still
        if not todo:
            break
    out = []
    for j, name in enumerate(fit.names):
        if j not in beta:
            out.append((name, None, None))
        else:
            out.append((name, *(None if (j, s) in todo else float(cur[(j, s)]) for s in (-1, 1))))
    return out
