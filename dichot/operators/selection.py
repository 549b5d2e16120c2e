"""Variable screening and selection.

Stepwise search fits all candidate models of a step in the same passes
over one cached design matrix (:func:`fit_logit_many`); Boruta compares
permutation Z-scores with those of shadow copies; GVIF works on the fitted
coefficient covariance.  Selections return their log as a DataFrame instead
of being typed in by hand after reading printed output.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.functions.linalg import cov_to_corr, logdet, stack_rows, sum_partials
from dichot.functions.stats import binom_cdf, binom_sf
from dichot.operators.glm import Design, LogitFit, fit_logit_many, full_gram

# ------------------------------------------------------------------ F01-F03

def stepwise(data: DataFrame, design: Design, direction: str = "both",
             start: Sequence[str] | None = None, k: float = 2.0) -> tuple[list[str], list[tuple], LogitFit]:
    """``step(..., direction=)`` by AIC with whole terms (a factor's dummies move together).

    Returns (final terms, path rows (step, action, term, df, deviance, aic), final fit).
    ``forward`` and ``both`` start from the intercept-only model unless
    ``start`` is given; ``backward`` starts from all terms.
    """
    terms = design.sources
    if start is None:
        current = list(terms) if direction == "backward" else []
    else:
        current = list(start)

    def crit(f: LogitFit) -> float:
        return f.deviance + k * f.rank

    p = len(design.columns)
    gram = full_gram(data, p)  # one pass; lets every candidate start from the current fit
    fit = fit_logit_many(data, design, [design.indices(current)], gram=gram)[0]
    best = crit(fit)
    path = [(0, "start", None, fit.rank, fit.deviance, best)]
    for step in count(1):           # every step lowers the criterion, so this ends
        cands = []
        if direction in ("both", "forward"):
            cands += [("+", t, current + [t]) for t in terms if t not in current]
        if direction in ("both", "backward"):
            cands += [("-", t, [c for c in current if c != t]) for t in current]
        if not cands:
            break
        # every candidate starts from the current fit: an added term at 0; for a
        # dropped term its mean contribution moves into the intercept
        warm = fit.start_values()
        means = gram[0, 1:] / gram[0, 0]
        starts = []
        for action, term, _ in cands:
            st = dict(warm)
            if action == "-":
                for i in design.indices([term]):
                    st[-1] = st.get(-1, 0.0) + st.pop(i, 0.0) * means[i]
            starts.append(st)
        fits = fit_logit_many(data, design, [design.indices([t for t in terms if t in set(c[2])])
                                             for c in cands], gram=gram, start=starts)
        scores = [crit(f) for f in fits]
        i = int(np.argmin(scores))
        if scores[i] >= best - 1e-10:
            break
        action, term, new = cands[i]
        current = [t for t in terms if t in set(new)]
        fit, best = fits[i], scores[i]
        path.append((step, action, term, fit.rank, fit.deviance, best))
    return current, path, fit


def stepwise_table(spark, path: list[tuple]) -> DataFrame:
    return spark.createDataFrame(path, "step long, action string, term string, df long, "
                                       "deviance double, aic double")


# ------------------------------------------------------------------ F04/F05/F08

def varimp_glm(spark, fit: LogitFit, scale: bool = False) -> DataFrame:
    """``varImp(glm, scale=FALSE)``: |z| per coefficient (intercept excluded)."""
    rows = [(name, abs(z)) for name, _, _, z, _ in fit.table()[1:] if z is not None]
    if scale and rows:
        lo, hi = min(v for _, v in rows), max(v for _, v in rows)
        rows = [(n, 100 * (v - lo) / (hi - lo) if hi > lo else 100.0) for n, v in rows]
    return spark.createDataFrame(rows, "variable string, importance double")


def varimp_model(spark, model, feature_names: Sequence[str], design: Design | None = None,
                 scale: bool = True) -> DataFrame:
    """importance of tree / boosted / penalised models, summed per source
    term when a design is given, optionally scaled 0-100 like caret."""
    if hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        c = model.coefficients
        imp = np.abs(c.toArray() if hasattr(c, "toArray") else np.asarray(c))
    else:
        raise TypeError("model has no importance")
    rows = list(zip(feature_names, imp.tolist()))
    if design is not None:
        agg: dict = {}
        for t in design.terms:
            agg[t.name] = sum(v for n, v in rows if n in set(t.columns))
        rows = list(agg.items())
    if scale and rows:
        lo, hi = min(v for _, v in rows), max(v for _, v in rows)
        rows = [(n, 100 * (v - lo) / (hi - lo) if hi > lo else 100.0) for n, v in rows]
    return spark.createDataFrame(rows, "variable string, importance double")


def random_probe_screen(importance: DataFrame, probe: str = "randpred") -> DataFrame:
    """keep variables whose importance beats the random probe column."""
    ref = importance.filter(F.col("variable") == probe).select("importance").first()
    level = ref[0] if ref else 0.0
    return (importance.filter(F.col("variable") != probe)
                      .withColumn("beats_probe", F.col("importance") > F.lit(level)))


# ------------------------------------------------------------------ F09/F10

def gvif(fit: LogitFit) -> list[tuple]:
    """``car::vif``: (term, GVIF, Df, GVIF^(1/(2 Df))) from the coefficient
    correlation matrix without the intercept (Fox & Monette 1992)."""
    kept = [i for i, b in enumerate(fit.coef) if not np.isnan(b)]
    names = [fit.names[i] for i in kept]
    v = fit.cov[1:, 1:]
    r = cov_to_corr(v)
    names = names[1:]
    det_all = logdet(r)
    out = []
    for t in fit.terms:
        cols = set(fit.design.term(t).columns)
        s = [j for j, n in enumerate(names) if n in cols]
        rest = [j for j in range(len(names)) if j not in s]
        ld = logdet(r[np.ix_(s, s)]) + (logdet(r[np.ix_(rest, rest)]) if rest else 0.0) - det_all
        g = math.exp(ld)
        out.append((t, g, len(s), g ** (1.0 / (2 * len(s)))))
    return out


def gvif_table(spark, fit: LogitFit) -> DataFrame:
    return spark.createDataFrame(gvif(fit), "term string, gvif double, df long, gvif_adj double")


def vif_prune(data: DataFrame, design: Design, terms: Sequence[str], limit: float = 2.236,
              ) -> tuple[list[str], list[tuple]]:
    """drop the term with the largest adjusted GVIF and refit until all
    are at most ``limit`` (sqrt(5): VIF 5 for one-df terms).  Returns (kept, log)."""
    current = list(terms)
    log = []
    step = 0
    while len(current) > 1:
        fit = fit_logit_many(data, design, [design.indices(current)])[0]
        g = sorted(gvif(fit), key=lambda r: -r[3])
        step += 1
        if g[0][3] <= limit:
            log.append((step, None, g[0][0], g[0][3]))
            break
        log.append((step, g[0][0], g[0][0], g[0][3]))
        current = [t for t in current if t != g[0][0]]
    return current, log


# ------------------------------------------------------------------ F06/F07 Boruta

def boruta(df: DataFrame, features: Sequence[str], label_col: str, key_cols: Sequence[str],
           max_runs: int = 100, p_value: float = 0.01, seed: int = 1, num_trees: int = 500,
           runs_per_pass: int = 10, factors: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Boruta all-relevant selection over numeric ``features`` and ``factors``.

    Each run grows a forest on the real features plus freshly permuted shadows
    and takes the permutation Z-score of every feature on out-of-bag rows
    (:class:`dichot.operators.permutation.ForestBlocks`); a feature scores a hit
    when it beats the best shadow.  After each pass of ``runs_per_pass`` runs,
    which is one Spark job, undecided features are tested with a binomial test
    (p = 0.5, Bonferroni over the features): Confirmed / Rejected, the rest
    Tentative; rejected features and their shadows take no part in later
    passes.  ``max_runs`` and ``num_trees`` are the R package's; a number of runs
    that cannot decide even a feature with a hit in each is an error.  The
    result depends on rows, keys and ``seed`` only, not on cores or partitions.
    Returns (history (run, variable, importance, shadow_max), statistics).
    """
    from dichot.operators.permutation import ForestBlocks
    spark = df.sparkSession
    features = list(features) + list(factors)
    m = len(features)
    if 0.5 ** max_runs >= p_value / max(m, 1):
        raise ValueError(f"{max_runs} runs cannot decide {m} features at {p_value}")
    blocks = ForestBlocks(df, [f for f in features if f not in set(factors)], factors, label_col, key_cols, seed)
    hits = dict.fromkeys(features, 0)
    decision = dict.fromkeys(features, "Tentative")
    history = []
    run = 0
    while run < max_runs and "Tentative" in decision.values():
        live = [f for f in features if decision[f] != "Rejected"]
        chunk = range(run + 1, min(max_runs, run + runs_per_pass) + 1)
        z: dict = {}
        for r in blocks.importance(chunk, num_trees, seed, live, shadows=True).collect():
            z.setdefault(r["run"], {})[r["feature"]] = r["z"]
        for run in chunk:
            top = max(v for f, v in z[run].items() if f.startswith("shadow_"))
            for f in live:
                history.append((run, f, float(z[run][f]), float(top)))
                hits[f] += z[run][f] > top
        for f in features:
            if decision[f] == "Tentative":
                if binom_sf(hits[f], run, 0.5) < p_value / m:
                    decision[f] = "Confirmed"
                elif binom_cdf(hits[f], run, 0.5) < p_value / m:
                    decision[f] = "Rejected"
    blocks.unpersist()
    hist = spark.createDataFrame(history, "run long, variable string, importance double, shadow_max double")
    stats = (hist.groupBy("variable")
                 .agg(F.avg("importance").alias("mean_imp"),
                      F.percentile("importance", 0.5).alias("median_imp"),
                      F.min("importance").alias("min_imp"), F.max("importance").alias("max_imp"),
                      F.avg((F.col("importance") > F.col("shadow_max")).cast("double")).alias("norm_hits")))
    dec = spark.createDataFrame(list(decision.items()), "variable string, decision string")
    return hist, stats.join(dec, "variable").orderBy(F.col("mean_imp").desc())


def permutation_importance(df: DataFrame, numeric: Sequence[str], factors: Sequence[str], label_col: str, key_cols: Sequence[str],
                           num_trees: int = 500, seed: int = 1) -> DataFrame:
    """mean loss of accuracy of a forest on out-of-bag rows when a term is
    permuted, and its Z-score: ``variable, importance, z, trees``."""
    from dichot.operators.permutation import ForestBlocks
    blocks = ForestBlocks(df, numeric, factors, label_col, key_cols, seed)
    out = blocks.importance([1], num_trees, seed).collect()
    blocks.unpersist()
    return df.sparkSession.createDataFrame([(r["feature"], r["mean"], r["z"], r["trees"]) for r in out],
                                           "variable string, importance double, z double, trees long")


# ------------------------------------------------------------------ F11

#: columns of one block of the covariance; a partial sum is at most a square of it
PCA_BLOCK = 256


def _plain_vector(df: DataFrame, vector_col: str) -> DataFrame:
    kind = df.schema[vector_col].dataType
    v = F.col(vector_col).cast("array<double>") if isinstance(kind, T.ArrayType) else vector_to_array(F.col(vector_col))
    return df.where(F.col(vector_col).isNotNull()).withColumn("_v", v)


def _centre(plain: DataFrame, width: int) -> tuple[int, np.ndarray]:
    def partial(pdf):
        x = stack_rows(pdf["_v"], width)
        return np.append(x.sum(axis=0), len(x))
    got = sum_partials(plain.select("_v"), partial, width + 1)
    return int(got[-1]), got[:-1] / max(got[-1], 1)


def pca(df: DataFrame, vector_col: str, k: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``prcomp(x)`` (centred, unscaled): loadings and standard deviations
    of the first ``k`` components (default: all).

    The exact mean is subtracted before rows are multiplied.  The covariance is
    summed in square blocks of column pairs, each its own row of a grouped sum,
    so wide vectors make more groups and not larger ones; the driver holds one
    (width x width) matrix.  A loading vector's largest entry is positive.
    Returns (loadings (component, variable, loading), sdev (component, sdev,
    proportion)).
    """
    spark = df.sparkSession
    plain = _plain_vector(df, vector_col).select("_v")
    width = (plain.agg(F.max(F.size("_v"))).first()[0] or 0)
    n, mean = _centre(plain, width)
    if n < 2 or not width:
        return (spark.createDataFrame([], "component long, variable long, loading double"),
                spark.createDataFrame([], "component long, sdev double, proportion double"))
    cuts = list(range(0, width, PCA_BLOCK)) + [width]

    def partials(batches):
        total: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            x = stack_rows(pdf["_v"], width) - mean
            for i in range(len(cuts) - 1):
                for j in range(i, len(cuts) - 1):
                    part = x[:, cuts[i]:cuts[i + 1]].T @ x[:, cuts[j]:cuts[j + 1]]
                    total[i, j] = total[i, j] + part if (i, j) in total else part
        if total:
            yield pd.DataFrame({"i": [i for i, _ in total], "j": [j for _, j in total], "v": [m.ravel().tolist() for m in total.values()]})

    sums = plain.mapInPandas(partials, "i int, j int, v array<double>").groupBy("i", "j").agg(
        Summarizer.metrics("sum").summary(array_to_vector("v")).alias("s"))
    cov = np.zeros((width, width))
    for r in sums.select("i", "j", "s.sum").collect():
        at, to = slice(cuts[r["i"]], cuts[r["i"] + 1]), slice(cuts[r["j"]], cuts[r["j"] + 1])
        block = r["sum"].toArray().reshape(at.stop - at.start, to.stop - to.start) / (n - 1)
        cov[at, to], cov[to, at] = block, block.T
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(width)])
    k, share = min(k or width, width), values / max(values.sum(), 1e-300)
    load = [(c + 1, j, float(vectors[j, c])) for c in range(k) for j in range(width)]
    sd = [(c + 1, float(math.sqrt(values[c])), float(share[c])) for c in range(k)]
    return (spark.createDataFrame(load, "component long, variable long, loading double"),
            spark.createDataFrame(sd, "component long, sdev double, proportion double"))


def pca_scores(df: DataFrame, key_cols: Sequence[str], vector_col: str, k: int | None = None) -> DataFrame:
    """``prcomp(x)$x``: key columns and the array ``scores`` of every row
    on the first ``k`` components."""
    load, _ = pca(df, vector_col, k)
    rows = load.collect()
    plain = _plain_vector(df, vector_col)
    if not rows:
        return plain.select(*key_cols, F.lit(None).cast("array<double>").alias("scores"))
    axes = np.zeros((max(r["variable"] for r in rows) + 1, max(r["component"] for r in rows)))
    for r in rows:
        axes[r["variable"], r["component"] - 1] = r["loading"]
    _, mean = _centre(plain.select("_v"), len(axes))

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        return pd.Series(list((stack_rows(v, len(axes)) - mean) @ axes))

    return plain.select(*key_cols, project("_v").alias("scores"))


# ------------------------------------------------------------------ F12

def lasso_select(frame: DataFrame, feature_names: Sequence[str], reg: float = 0.01) -> list[tuple]:
    """LASSO logit (alpha = 1) on standardised features; non-zero coefficients."""
    model = LogisticRegression(elasticNetParam=1.0, regParam=reg, standardization=True,
                               maxIter=200).fit(frame)
    coef = model.coefficients.toArray()
    return [(n, float(c)) for n, c in zip(feature_names, coef) if c != 0.0]


def mrmr(df: DataFrame, features: Sequence[str], label_col: str, key_cols: Sequence[str],
         k: int = 3, n_bins: int = 10) -> list[tuple]:
    """greedy max-relevance min-redundancy on equal-frequency bins.

    Relevance I(x; y) for all features comes from one grouped count over the
    melted, binned frame; each greedy step adds one grouped count of the
    candidates against the last selected feature.  Returns (rank, feature, score).
    """
    features = list(features)
    from pyspark.ml.feature import QuantileDiscretizer
    # rows are matched by their own key, so a recomputed block cannot renumber them
    rid = F.struct(*[F.col(c) for c in key_cols]).alias("_rid")
    data = df.dropna(subset=features + [label_col]).select(
        rid, *features, F.col(label_col).cast("double").alias("_y"))
    disc = QuantileDiscretizer(numBuckets=n_bins, inputCols=features,
                               outputCols=[f + "_b" for f in features], relativeError=0.001)
    binned = disc.fit(data).transform(data).select("_rid", "_y", *[F.col(f + "_b").alias(f) for f in features])
    binned = binned.persist(StorageLevel.MEMORY_AND_DISK)
    n = binned.count()
    long = binned.unpivot(["_rid", "_y"], features, "feature", "b")

    def mi(pairs: DataFrame, a: str, b: str) -> dict:
        joint = pairs.groupBy("feature", a, b).agg(F.count(F.lit(1)).alias("n"))
        pa = joint.groupBy("feature", a).agg(F.sum("n").alias("na"))
        pb = joint.groupBy("feature", b).agg(F.sum("n").alias("nb"))
        t = joint.join(pa, ["feature", a]).join(pb, ["feature", b])
        r = t.groupBy("feature").agg(F.sum(F.col("n") / n * F.log((F.col("n") * n) / (F.col("na") * F.col("nb")))).alias("mi"))
        return {row["feature"]: row["mi"] for row in r.collect()}

    relevance = mi(long, "b", "_y")
    selected: list[str] = []
    redundancy = {f: 0.0 for f in features}
    out = []
    for rank in range(1, min(k, len(features)) + 1):
        cand = [f for f in features if f not in selected]
        score = {f: relevance[f] - (redundancy[f] / len(selected) if selected else 0.0) for f in cand}
        best = max(cand, key=lambda f: (score[f], f))
        out.append((rank, best, float(score[best])))
        selected.append(best)
        pairs = long.filter(F.col("feature") != best).join(
            binned.select("_rid", F.col(best).alias("s")), "_rid")
        red = mi(pairs, "b", "s")
        for f in cand:
            if f != best:
                redundancy[f] += red.get(f, 0.0)
    binned.unpersist()
    return out
