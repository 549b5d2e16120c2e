"""Model matrix and maximum-likelihood logistic regression.

``Design`` turns named terms into numbered design columns with R's
treatment contrasts (first level of a factor is the base).  ``fit_logit``
runs iteratively re-weighted least squares as Spark jobs: each iteration is
one pass in which every partition forms X'WX and X'Wz with numpy and the
partials are summed by an aggregate.  Several models can share one pass
(``fit_logit_many``), which is what stepwise search, sequential deviance
tables and Boruta-free screening need: p candidate fits cost the passes of
one fit, not p times as many jobs.

The fit returns what ``summary.glm`` prints plus the coefficient covariance,
which ``GeneralizedLinearRegression`` does not expose and which GVIF, Wald
tests, leverage and prediction intervals need.  ``spark_glr`` gives the same
model through ``pyspark.ml`` for pipelines; the tests check both agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dichot.functions.linalg import aliased_columns, design_block, sum_partials, x_cols
from dichot.functions.stats import chi2_sf, normal_sf
from dichot.operators.schema import levels_many

INTERCEPT = "(Intercept)"


@dataclass
class Term:
    name: str
    kind: str                 # "numeric" or "factor"
    columns: list[str]        # design column names
    exprs: list[Column] = field(repr=False, default_factory=list)
    levels: list | None = None


@dataclass
class Design:
    terms: list[Term]

    @property
    def columns(self) -> list[str]:
        return [c for t in self.terms for c in t.columns]

    @property
    def sources(self) -> list[str]:
        return [t.name for t in self.terms]

    def exprs(self) -> list[Column]:
        return [e for t in self.terms for e in t.exprs]

    def term(self, name: str) -> Term:
        for t in self.terms:
            if t.name == name:
                return t
        raise KeyError(name)

    def indices(self, names: Sequence[str]) -> list[int]:
        """Design-column positions (0-based, no intercept) of some terms."""
        pos, out = 0, []
        wanted = set(names)
        for t in self.terms:
            if t.name in wanted:
                out.extend(range(pos, pos + len(t.columns)))
            pos += len(t.columns)
        return out

    def subset(self, names: Sequence[str]) -> "Design":
        keep = set(names)
        return Design([t for t in self.terms if t.name in keep])

    def matrix(self, df: DataFrame, label_col: str | None, keep_cols: Sequence[str] = (),
               weight_col: str | None = None, persist: bool = True) -> DataFrame:
        """Complete cases of the used columns as ``(keep..., x_0..x_{p-1}, y[, w])``."""
        used = list(dict.fromkeys(self.sources + ([label_col] if label_col else [])
                                  + ([weight_col] if weight_col else [])))
        cc = df.dropna(subset=used)
        cols = list(keep_cols) + [e.cast("double").alias(n)
                                  for e, n in zip(self.exprs(), x_cols(len(self.columns)))]
        if label_col:
            cols.append(F.col(label_col).cast("double").alias("y"))
        if weight_col:
            cols.append(F.col(weight_col).cast("double").alias("w"))
        out = cc.select(*cols)
        return out.persist(StorageLevel.MEMORY_AND_DISK) if persist else out

    def eta(self, coef: dict) -> Column:
        """Linear predictor as a JVM expression (no UDF)."""
        expr = F.lit(float(coef.get(INTERCEPT, 0.0)))
        for name, e in zip(self.columns, self.exprs()):
            b = coef.get(name)
            if b is not None and not (isinstance(b, float) and math.isnan(b)):
                expr = expr + F.lit(float(b)) * e.cast("double")
        return expr


def build_design(df: DataFrame, numeric: Sequence[str] = (), factors: Sequence[str] = (),
                 order: Sequence[str] | None = None, max_levels: int = 1000,
                 level_map: dict | None = None) -> Design:
    """Terms in ``order`` (default: numeric then factors); factor levels from one job."""
    numeric, factors = list(numeric), list(factors)
    level_map = dict(level_map or {})
    missing = [f for f in factors if f not in level_map]
    if missing:
        level_map.update(levels_many(df, missing, max_levels))
    names = list(order) if order else numeric + factors
    terms = []
    for n in names:
        if n in factors:
            lv = level_map[n]
            cols = [f"{n}{v}" for v in lv[1:]]
            exprs = [(F.col(n) == F.lit(v)).cast("double") for v in lv[1:]]
            terms.append(Term(n, "factor", cols, exprs, lv))
        else:
            terms.append(Term(n, "numeric", [n], [F.col(n).cast("double")]))
    return Design(terms)


@dataclass
class LogitFit:
    design: Design
    index: list[int]          # design columns in the model (0-based, no intercept)
    names: list[str]          # intercept first, then the used design columns
    coef: np.ndarray          # NaN for aliased columns
    cov: np.ndarray           # over the non-aliased coefficients, same order
    deviance: float
    null_deviance: float
    n: int
    n_pos: float
    iterations: int
    converged: bool
    aliased: list[str] = field(default_factory=list)

    @property
    def rank(self) -> int:
        return int(np.sum(~np.isnan(self.coef)))

    @property
    def df_residual(self) -> int:
        return self.n - self.rank

    @property
    def df_null(self) -> int:
        return self.n - 1

    @property
    def aic(self) -> float:
        return self.deviance + 2 * self.rank

    @property
    def bic(self) -> float:
        return self.deviance + math.log(self.n) * self.rank

    @property
    def loglik(self) -> float:
        return -self.deviance / 2.0

    @property
    def null_loglik(self) -> float:
        return -self.null_deviance / 2.0

    @property
    def terms(self) -> list[str]:
        used = set(self.index)
        out, pos = [], 0
        for t in self.design.terms:
            if any(i in used for i in range(pos, pos + len(t.columns))):
                out.append(t.name)
            pos += len(t.columns)
        return out

    def coef_dict(self) -> dict:
        return dict(zip(self.names, self.coef.tolist()))

    def start_values(self) -> dict:
        """Coefficients keyed by design column (-1 = intercept), for warm starts."""
        out = {-1: float(self.coef[0])}
        for j, i in enumerate(self.index):
            b = self.coef[1 + j]
            if not np.isnan(b):
                out[i] = float(b)
        return out

    def std_errors(self) -> np.ndarray:
        se = np.full(len(self.coef), np.nan)
        ok = ~np.isnan(self.coef)
        se[ok] = np.sqrt(np.diag(self.cov))
        return se

    def table(self) -> list[tuple]:
        """(term, estimate, std_error, z_value, p_value) rows, intercept first."""
        se = self.std_errors()
        rows = []
        for name, b, s in zip(self.names, self.coef, se):
            if np.isnan(b):
                rows.append((name, None, None, None, None))
                continue
            z = b / s
            rows.append((name, float(b), float(s), float(z), float(2 * normal_sf(abs(z)))))
        return rows

    def lr_test_vs_null(self) -> tuple[float, int, float]:
        stat = self.null_deviance - self.deviance
        df = self.df_null - self.df_residual
        return stat, df, chi2_sf(stat, df)

    def eta(self) -> Column:
        return self.design.eta(self.coef_dict())

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.eta()))


# literal coefficients are compiled into the generated code of every pass, so the
# JVM path pays off only for very small models; larger ones use numpy partials
SQL_MAX_TERMS = 12


def _sql_terms(sizes) -> int:
    return sum(k * (k + 1) // 2 + k + 1 for k in sizes)


def _sql_partials(data: DataFrame, payload, p: int, weighted: bool, length: int) -> np.ndarray:
    """The IRLS sums of every model as JVM expressions (small models: no Python
    in the tasks).  A projection computes each model's weight, working
    response and deviance once per row; one aggregate then forms the sums.
    Same layout as the numpy partials."""
    x = [F.col(c) for c in x_cols(p)]
    y = F.col("y")
    w0 = F.col("w") if weighted else F.lit(1.0)
    proj = [y.alias("_y"), w0.alias("_w0")] + [c.alias(f"_x{i}") for i, c in enumerate(x)]
    for m, (kept, beta) in enumerate(payload):
        if beta is None:
            mu = (w0 * y + 0.5) / (w0 + 1.0)
            eta = F.log(mu / (F.lit(1.0) - mu))
        else:
            eta = F.lit(float(beta[0]))
            for b, i in zip(beta[1:], kept):
                eta = eta + F.lit(float(b)) * x[i]
            mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        mu = F.least(F.greatest(mu, F.lit(1e-15)), F.lit(1 - 1e-15))
        var = mu * (F.lit(1.0) - mu)
        proj.append((w0 * var).alias(f"_wt{m}"))
        proj.append((w0 * var * (eta + (y - mu) / var)).alias(f"_wz{m}"))
        proj.append((-2.0 * w0 * (F.when(y > 0, y * F.log(mu)).otherwise(F.lit(0.0))
                                  + F.when(y < 1, (F.lit(1.0) - y) * F.log(F.lit(1.0) - mu))
                                  .otherwise(F.lit(0.0)))).alias(f"_dv{m}"))
    rows = data.select(*proj)
    xc = [F.col(f"_x{i}") for i in range(p)]
    aggs = [F.count(F.lit(1)).cast("double"), F.sum(F.col("_w0") * F.col("_y")), F.sum("_w0")]
    layout = []
    for m, (kept, _) in enumerate(payload):
        cols = [F.lit(1.0)] + [xc[i] for i in kept]
        wt, wz = F.col(f"_wt{m}"), F.col(f"_wz{m}")
        k = len(cols)
        for i in range(k):
            for j in range(i, k):
                aggs.append(F.sum(wt * cols[i] * cols[j]))
                layout.append((m, "g", i, j))
        for i in range(k):
            aggs.append(F.sum(wz * cols[i]))
            layout.append((m, "b", i, 0))
        aggs.append(F.sum(f"_dv{m}"))
        layout.append((m, "d", 0, 0))
    row = rows.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    vals = [row[f"a{i}"] or 0.0 for i in range(len(aggs))]
    out = np.zeros(length)
    out[:3] = vals[:3]
    sizes = [len(kept) + 1 for kept, _ in payload]
    starts, pos = [], 3
    for k in sizes:
        starts.append(pos)
        pos += k * k + k + 1
    for (m, kind, i, j), v in zip(layout, vals[3:]):
        k, base = sizes[m], starts[m]
        if kind == "g":
            out[base + i * k + j] = v
            out[base + j * k + i] = v
        elif kind == "b":
            out[base + k * k + i] = v
        else:
            out[base + k * k + k] = v
    return out


def _deviance_terms(y, mu, w):
    eps = 1e-300
    return -2.0 * np.sum(w * (y * np.log(np.maximum(mu, eps)) + (1 - y) * np.log(np.maximum(1 - mu, eps))))


def fit_logit_many(data: DataFrame, design: Design, models: Sequence[Sequence[int]],
                   max_iter: int = 25, tol: float = 1e-8, weighted: bool = False,
                   gram: np.ndarray | None = None,
                   start: Sequence[dict | None] | None = None) -> list[LogitFit]:
    """Fit several logistic models over one cached ``Design.matrix`` frame.

    ``models`` are lists of design-column positions.  All unconverged models
    advance together: one Spark pass per IRLS iteration.  ``start`` may give,
    per model, starting coefficients ``{design column or -1 (intercept): value}``
    (a neighbouring model's fit), which saves passes in stepwise search.  Aliased columns are
    found per model from the unweighted Gram (sequential pivoting, as R
    does) and get NA coefficients.
    """
    p = len(design.columns)
    states = []
    for idx in models:
        idx = list(idx)
        # aliasing is decided from the first pass's weighted Gram (positive
        # weights: same rank structure as X'X), so no separate pass is needed
        st = {"idx": idx, "kept": idx if gram is None else _kept(gram, idx),
              "beta": None, "dev": None, "done": False, "iter": 0, "gram": None,
              "dev_hist": [], "checked": gram is not None}
        init = start[len(states)] if start is not None else None
        if init is not None and gram is not None:
            st["beta"] = np.array([init.get(-1, 0.0)] + [init.get(i, 0.0) for i in st["kept"]])
        states.append(st)
    totals = None
    for it in range(max_iter + 1):
        active = [s for s in states if not s["done"]]
        if not active:
            break
        payload = [(s["kept"], None if s["beta"] is None else s["beta"].copy()) for s in active]
        sizes = [len(k) + 1 for k, _ in payload]
        length = 3 + sum(k * k + k + 1 for k in sizes)

        def partial(pdf, payload=payload, sizes=sizes, length=length):
            x = design_block(pdf, p)
            y = pdf["y"].to_numpy(dtype=np.float64)
            w0 = pdf["w"].to_numpy(dtype=np.float64) if weighted else np.ones(len(y))
            out = np.empty(length)
            out[0], out[1], out[2] = len(y), np.sum(w0 * y), np.sum(w0)
            pos = 3
            ones = np.ones((len(y), 1))
            for (kept, beta), k in zip(payload, sizes):
                xm = np.hstack([ones, x[:, kept]]) if kept else ones
                if beta is None:
                    mu = (w0 * y + 0.5) / (w0 + 1.0)
                    eta = np.log(mu / (1 - mu))
                else:
                    eta = xm @ beta
                    mu = 1.0 / (1.0 + np.exp(-eta))
                mu = np.clip(mu, 1e-15, 1 - 1e-15)
                var = mu * (1 - mu)
                wt = w0 * var
                z = eta + (y - mu) / var
                xw = xm.T * wt
                out[pos:pos + k * k] = (xw @ xm).ravel()
                pos += k * k
                out[pos:pos + k] = xw @ z
                pos += k
                out[pos] = _deviance_terms(y, mu, w0)
                pos += 1
            return out

        if _sql_terms(sizes) <= SQL_MAX_TERMS:
            sums = _sql_partials(data, payload, p, weighted, length)
        else:
            sums = sum_partials(data, partial, length)
        totals = sums[:3]
        pos = 3
        for s, k in zip(active, sizes):
            g = sums[pos:pos + k * k].reshape(k, k)
            pos += k * k
            b = sums[pos:pos + k]
            pos += k
            dev = sums[pos]
            pos += 1
            if s["beta"] is not None:
                s["dev_hist"].append(dev)
                prev = s.get("prev_beta")
                if (prev is not None and s["dev"] is not None and s.get("halvings", 0) < 10
                        and (not np.isfinite(dev) or dev > s["dev"] + 1e-9 * (abs(s["dev"]) + 1))):
                    # deviance rose: halve the step back towards the last iterate (as glm.fit)
                    s["beta"] = (s["beta"] + prev) / 2.0
                    s["halvings"] = s.get("halvings", 0) + 1
                    continue
                s["halvings"] = 0
                if s["dev"] is not None and abs(dev - s["dev"]) / (abs(dev) + 0.1) < tol:
                    s["done"] = True
                    s["gram"] = g
                    s["dev"] = dev
                    continue
                s["dev"] = dev
                s["gram"] = g
            if it == max_iter:
                s["done"] = True
                continue
            if not s["checked"]:
                s["checked"] = True
                sub = [0] + [1 + j for j in range(len(s["kept"]))]
                drop = aliased_columns(g[np.ix_(sub, sub)])
                if drop:
                    keep_pos = [j for j in range(1, len(sub)) if j not in drop]
                    s["kept"] = [s["kept"][j - 1] for j in keep_pos]
                    sel = [0] + keep_pos
                    g, b = g[np.ix_(sel, sel)], b[sel]
            s["prev_beta"] = None if s["beta"] is None else s["beta"].copy()
            try:
                s["beta"] = np.linalg.solve(g, b)
            except np.linalg.LinAlgError:
                s["beta"] = np.linalg.lstsq(g, b, rcond=None)[0]
            s["iter"] += 1
    n, n_pos, wsum = totals
    ybar = n_pos / wsum
    null_dev = -2.0 * (n_pos * math.log(ybar) + (wsum - n_pos) * math.log(1 - ybar)) \
        if 0 < ybar < 1 else 0.0
    fits = []
    for s in states:
        idx, kept = s["idx"], s["kept"]
        names = [INTERCEPT] + [design.columns[i] for i in idx]
        coef = np.full(len(idx) + 1, np.nan)
        coef[0] = s["beta"][0]
        for j, i in enumerate(kept):
            coef[1 + idx.index(i)] = s["beta"][1 + j]
        try:
            cov = np.linalg.inv(s["gram"])
        except np.linalg.LinAlgError:
            cov = np.linalg.pinv(s["gram"])
        fits.append(LogitFit(design, idx, names, coef, cov, float(s["dev"]), float(null_dev),
                             int(n), float(n_pos), s["iter"], s["iter"] < max_iter,
                             [design.columns[i] for i in idx if i not in kept]))
    return fits


def _kept(gram: np.ndarray, idx: list[int]) -> list[int]:
    sub = [0] + [i + 1 for i in idx]
    drop = aliased_columns(gram[np.ix_(sub, sub)])
    return [idx[j - 1] for j in range(1, len(sub)) if j not in drop]


def full_gram(data: DataFrame, p: int, weighted: bool = False) -> np.ndarray:
    """Unweighted (or prior-weighted) X'X with the intercept first."""
    k = p + 1

    def partial(pdf):
        x = np.hstack([np.ones((len(pdf), 1)), design_block(pdf, p)])
        w = pdf["w"].to_numpy(dtype=np.float64) if weighted else np.ones(len(pdf))
        return ((x.T * w) @ x).ravel()

    return sum_partials(data, partial, k * k).reshape(k, k)


def fit_logit(df: DataFrame, label_col: str, design: Design, terms: Sequence[str] | None = None,
              weight_col: str | None = None, data: DataFrame | None = None, **kw) -> LogitFit:
    """``glm(y ~ terms, family = binomial(link = "logit"))``."""
    own = data is None
    data = data if data is not None else design.matrix(df, label_col, weight_col=weight_col)
    idx = design.indices(terms if terms is not None else design.sources)
    try:
        return fit_logit_many(data, design, [idx], weighted=weight_col is not None, **kw)[0]
    finally:
        if own:
            data.unpersist()


def null_model(df: DataFrame, label_col: str) -> dict:
    """``glm(y ~ 1)`` in closed form: intercept = logit(mean y)."""
    r = df.filter(F.col(label_col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("double")).alias("s")).first()
    n, s = r["n"], r["s"]
    ybar = s / n
    dev = -2.0 * (s * math.log(ybar) + (n - s) * math.log(1 - ybar))
    return {"intercept": math.log(ybar / (1 - ybar)), "deviance": dev, "aic": dev + 2,
            "n": n, "df_residual": n - 1, "se": math.sqrt(1.0 / (n * ybar * (1 - ybar)))}


def spark_glr(df: DataFrame, label_col: str, design: Design, family: str = "binomial",
              link: str | None = None, max_iter: int = 25, tol: float = 1e-8):
    """M01/M03 through ``pyspark.ml``: returns (model, assembled frame).

    Design columns are built by one projection and assembled into a vector;
    the fitted ``GeneralizedLinearRegressionModel`` carries the usual
    summary (intercept last in its standard-error arrays).
    """
    used = design.sources + [label_col]
    frame = df.dropna(subset=used).select(
        *[e.alias(c) for c, e in zip(design.columns, design.exprs())],
        F.col(label_col).cast("double").alias("label"))
    frame = VectorAssembler(inputCols=design.columns, outputCol="features").transform(frame)
    glr = GeneralizedLinearRegression(family=family, link=link or ("logit" if family == "binomial" else "identity"),
                                      maxIter=max_iter, tol=tol, regParam=0.0,
                                      featuresCol="features", labelCol="label")
    return glr.fit(frame), frame


def fit_linear(df: DataFrame, label_col: str, design: Design):
    """``lm(y ~ .)`` as a Gaussian GLM; returns the fitted pyspark model."""
    model, _ = spark_glr(df, label_col, design, family="gaussian", link="identity")
    return model
