"""AUC/ROC/HL/confusion against brute force, and the driver-side distributions."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dichot.functions import stats
from dichot.operators import evaluate
from dichot.plans import frames

from conftest import SF_SMALL


def _scored(spark):
    o = frames.orders_labeled(spark, SF_SMALL)
    return o.withColumn("s", F.round(F.col("o_totalprice") / 1e5, 1))  # many ties


def test_auc_brute_force(spark):
    df = _scored(spark)
    pdf = df.select("y", "s").toPandas()
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
        len(pos) * len(neg))
    assert math.isclose(evaluate.auc(df, "y", "s"), ref, rel_tol=1e-12)
    assert math.isclose(evaluate.auc(df, "y", "s", direction="<"), 1 - ref, rel_tol=1e-12)


def test_roc_endpoints_and_monotone(spark):
    pts = evaluate.roc_points(_scored(spark), "y", "s").toPandas().sort_values(["fpr", "tpr"])
    assert (pts.fpr.iloc[0], pts.tpr.iloc[0]) == (0.0, 0.0)
    assert math.isclose(pts.fpr.iloc[-1], 1.0) and math.isclose(pts.tpr.iloc[-1], 1.0)
    assert (np.diff(pts.tpr.to_numpy()) >= -1e-15).all()


def test_hosmer_lemeshow_matches_pandas(spark):
    df = frames.orders_labeled(spark, SF_SMALL).withColumn(
        "p", F.lit(1.0) / (1 + F.exp(-(F.col("o_totalprice") / 1e5 * 1.06 - 2.66))))
    hl = evaluate.hosmer_lemeshow(df, "y", "p", 10)
    pdf = df.select("y", "p").toPandas()
    cuts = np.unique(np.quantile(pdf.p, np.linspace(0, 1, 11)))
    grp = np.searchsorted(cuts[1:-1], pdf.p, side="left")
    stat = 0.0
    for g in np.unique(grp):
        sub = pdf[grp == g]
        o1, e1, n = sub.y.sum(), sub.p.sum(), len(sub)
        stat += (o1 - e1) ** 2 / e1 + ((n - o1) - (n - e1)) ** 2 / (n - e1)
    assert math.isclose(hl["statistic"], stat, rel_tol=1e-9)
    assert hl["df"] == 8


def test_confusion_stats_known_counts(spark):
    rows = [(1.0, 1.0)] * 40 + [(1.0, 0.0)] * 10 + [(0.0, 1.0)] * 5 + [(0.0, 0.0)] * 45
    df = spark.createDataFrame(rows, "y double, pred double")
    s = evaluate.confusion_stats(df, "y", "pred", positive=1.0)
    assert (s["tp"], s["fn"], s["fp"], s["tn"]) == (40, 10, 5, 45)
    assert math.isclose(s["accuracy"], 0.85)
    assert math.isclose(s["sensitivity"], 0.8) and math.isclose(s["specificity"], 0.9)
    assert math.isclose(s["kappa"], 0.7)
    assert 0.76 < s["acc_lower"] < 0.85 < s["acc_upper"] < 0.92


def test_threshold_sweep_one_pass(spark):
    df = _scored(spark).withColumn("p", F.col("s") / 6)
    sw = evaluate.threshold_sweep(df, "y", "p").toPandas()
    assert list(np.round(sw.threshold, 10)) == [k / 10 for k in range(1, 10)]
    pdf = df.select("y", "p").toPandas()
    for t, acc in zip(sw.threshold, sw.accuracy):
        assert math.isclose(acc, ((pdf.p > t) == (pdf.y == 1)).mean())


def test_distributions():
    assert math.isclose(stats.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(stats.chi2_sf(18.307038053275146, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(stats.normal_ppf(0.975), 1.959963984540054, rel_tol=1e-12)
    assert math.isclose(stats.t_sf_two_sided(2.0, 10), 0.07338803477074, rel_tol=1e-9)
    assert math.isclose(stats.binom_sf(8, 10, 0.5), 56 / 1024, rel_tol=1e-9)
    assert math.isclose(stats.f_sf(3.0, 2, 20), 1.3 ** -10, rel_tol=1e-9)  # closed form for d1 = 2


def test_durbin_watson_brute_force(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("e", F.col("o_totalprice") / 1e5 - 2)
    s = evaluate.durbin_watson(o, ["o_orderkey"], "e")
    e = o.toPandas().sort_values("o_orderkey").e.to_numpy()
    assert math.isclose(s["dw"], ((e[1:] - e[:-1]) ** 2).sum() / (e ** 2).sum(), rel_tol=1e-10)
    ac = (e[1:] * e[:-1]).sum() / (e ** 2).sum()
    assert math.isclose(s["autocorrelation"], ac, rel_tol=1e-9, abs_tol=1e-12)


def test_durbin_watson_hand_numbers(spark):
    df = spark.createDataFrame(list(enumerate([1.0, 2.0, 4.0, 3.0, 5.0, 6.0])), "k long, e double")
    s = evaluate.durbin_watson(df, ["k"], "e")
    assert math.isclose(s["dw"], 11 / 91) and math.isclose(s["autocorrelation"], 67 / 91) and s["n"] == 6


def test_missing_scores_have_no_class_and_no_rank(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (1.0, None), (0.0, nan), (1.0, 0.1)], "y double, p double")
    got = [r["c"] for r in df.select(evaluate.predict_class(F.col("p")).alias("c")).collect()]
    assert got == [1.0, 0.0, None, None, 0.0]
    s = evaluate.confusion_stats(df.withColumn("c", evaluate.predict_class(F.col("p"))), "y", "c")
    assert (s["tp"], s["fn"], s["fp"], s["tn"]) == (1, 1, 0, 1)
    # pairs (0.9 > 0.2) and (0.1 < 0.2): one of two in order
    assert evaluate.auc(df, "y", "p") == 0.5 and evaluate.auc_many(df, "y", ["p"]) == {"p": 0.5}
    with pytest.raises(ValueError):
        evaluate.confusion_stats(spark.createDataFrame([(1.0, 2.0), (0.0, 1.0)], "y double, c double"), "y", "c")


def test_merge_splits_hot_composite_keys(spark):
    """Hot, NA and cold composite keys, rows of a kind and a clashing column, against a merge without parts."""
    from dichot.operators import relational
    x = spark.createDataFrame([("a", None, i % 7, "l") for i in range(500)] + [("b", i % 9, i, "l") for i in range(90)] + [(None, 1, 5, "l")],
                              "k string, j int, v int, _salt string")
    y = spark.createDataFrame([("a", None, 1), ("b", 3, 2), ("b", 3, 3), (None, 1, 4), ("c", 1, 5)], "k string, j int, v int")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)
    for null_safe in (False, True):
        for how in ("inner", "left"):
            plain = relational.merge(x, y, ["k", "j"], null_safe=null_safe, how=how)
            split = relational.merge(x, y, ["k", "j"], null_safe=null_safe, how=how, hot_rows=9)
            assert split.columns == plain.columns == ["k", "j", "v.x", "_salt", "v.y"]
            assert rows(split) == rows(plain)
    assert relational.merge(x, y, ["k", "j"], null_safe=True, hot_rows=9).count() == 500 + 20 + 1
    dealt, copies, salt = relational._salted(x, y, ["k", "j"], 100)
    assert copies.where("k = 'a'").count() == 5 and dealt.where("k = 'a'").select(salt).distinct().count() > 1
    assert rows(relational.merge(x.limit(0), y, ["k", "j"], hot_rows=9)) == []
    with pytest.raises(ValueError):
        relational.merge(x, y, ["k", "j"], how="full", hot_rows=9)


def test_spearman_of_several_columns_with_nulls(spark):
    """Two columns with nulls in different rows, ties, and a pair without a complete row."""
    import numpy as np
    import pandas as pd
    from dichot.operators import profile
    r = np.random.default_rng(3)
    pdf = pd.DataFrame(r.integers(0, 12, (200, 4)).astype(float), columns=["a", "b", "c", "d"])
    pdf["a"] += pdf["b"]
    pdf.loc[pdf.index % 3 == 0, "b"] = np.nan
    pdf.loc[pdf.index % 4 == 1, "c"] = np.nan
    pdf.loc[pdf.index % 4 != 1, "d"] = np.nan
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in row) for row in pdf.values], "a double, b double, c double, d double")
    got = {(x["var1"], x["var2"]): x for x in profile.spearman_long(df, list(pdf.columns)).collect()}
    assert len(got) == 12
    for a in pdf.columns:
        for b in pdf.columns:
            if a == b:
                continue
            sub = pdf[[a, b]].dropna()
            assert got[a, b]["n"] == len(sub)
            if not len(sub):
                assert got[a, b]["rho"] is None and got[a, b]["p_value"] is None
                continue
            rho = sub.rank().corr().iloc[0, 1]
            assert math.isclose(got[a, b]["rho"], rho, rel_tol=1e-9, abs_tol=1e-12) and 0 <= got[a, b]["p_value"] <= 1


def test_spearman_pairwise_complete_matches_pandas(spark):
    from dichot.operators import profile
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        "l_quantity", "l_discount",
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_extendedprice")).alias("price"))
    got = {(r["var1"], r["var2"]): r for r in
           profile.spearman_long(li, ["l_quantity", "l_discount", "price"]).collect()}
    pdf = li.toPandas()
    for a, b in [("l_quantity", "price"), ("l_quantity", "l_discount")]:
        sub = pdf[[a, b]].dropna()
        ref = sub.rank().corr().iloc[0, 1]  # ranks on the complete pairs, ties averaged
        assert math.isclose(got[(a, b)]["rho"], ref, rel_tol=1e-9, abs_tol=1e-12)
        assert got[(a, b)]["n"] == len(sub)


def test_merge_deals_a_key_with_many_rows_on_both_sides(spark):
    from dichot.operators import relational
    a = spark.createDataFrame([(None if i % 13 == 0 else i % 3, i, i % 5) for i in range(300)], "k int, i int, v int")
    b = spark.createDataFrame([(None if j % 7 == 0 else j % 4, j, j % 5) for j in range(80)], "k int, j int, v int")
    for how in ("inner", "left"):
        for null_safe in (False, True):
            plain = relational.merge(a, b, ["k"], null_safe=null_safe, how=how)
            dealt = relational.merge(a, b, ["k"], null_safe=null_safe, how=how, part_rows=100)
            assert dealt.columns == plain.columns
            assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    dealt = relational.merge(a, b, ["k"], part_rows=100)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    # three keys make the rows: undealt, no more than three tasks would make them
    assert len(sizes) > 10 and max(sizes) < sum(sizes) / 4
    with pytest.raises(ValueError):
        relational.merge(a, b, ["k"], how="full", part_rows=100)


def test_merge_with_a_small_side_repeats_no_rows(spark, monkeypatch):
    """A bounded right side is held by every executor; what is shuffled does not grow with the parts. A larger one is dealt as before."""
    from dichot.operators import relational
    a = spark.createDataFrame([(i % 3, i) for i in range(300)], "k int, i int")
    b = spark.createDataFrame([(j % 4, f"s{j}") for j in range(80)], "k int, j string")
    want = sorted(map(tuple, a.join(b, "k").collect()))
    dealt = relational.merge(a, b, ["k"], part_rows=100)
    plan = dealt._jdf.queryExecution().toString()
    assert "explode" not in plan and "BroadcastHashJoin" in plan and sorted(map(tuple, dealt.collect())) == want
    monkeypatch.setattr(relational, "BROADCAST_BYTES", 100)
    dealt = relational.merge(a, b, ["k"], part_rows=100)
    assert "explode" in dealt._jdf.queryExecution().toString() and sorted(map(tuple, dealt.collect())) == want
