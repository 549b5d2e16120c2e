"""Sources/sinks and the cleaning / scoring jobs."""
import math
import os
import tempfile

from pyspark.sql import functions as F

from dichot.operators import glm
from dichot.plans import frames
from dichot.plans.jobs import CleanConfig, ScoringModel, clean_job, score_job
from dichot.sources import io

from conftest import SF_SMALL


def test_csv_blank_handling(spark):
    d = tempfile.mkdtemp(prefix="dichot-io-")
    path = os.path.join(d, "f.csv")
    with open(path, "w") as fh:
        fh.write('id,txt,num\n1,a,1.5\n2,,2.5\n3,"",\n4,NA,4\n')
    s01 = {r["id"]: r for r in io.read_csv_blank_null(spark, path, "id int, txt string, num double").collect()}
    assert s01[2]["txt"] is None and s01[3]["txt"] is None and s01[3]["num"] is None
    s02 = {r["id"]: r for r in io.read_csv_keep_blank(spark, path, "id int, txt string, num double").collect()}
    assert s02[2]["txt"] == "" and s02[4]["txt"] is None


def test_csv_keeps_missing_and_blank_apart(spark):
    d = tempfile.mkdtemp(prefix="dichot-io-")
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None), (3, "", 2.0)], "id int, txt string, num double")
    io.write_table(df, os.path.join(d, "na"), fmt="csv", na="NA")
    for schema in (df.schema, None):
        back = {r["id"]: (r["txt"], r["num"]) for r in io.read_csv_keep_blank(spark, os.path.join(d, "na"), schema).collect()}
        assert back == {1: ("a", 1.5), 2: (None, None), 3: ("", 2.0)}


def test_unscorable_rows_have_no_class(spark):
    model = ScoringModel(["x"], {"f": ["a", "b"]}, ["x", "f"], {"(Intercept)": 0.0, "x": 1.0, "fb": 0.5}, {})
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "a"), (3, 1.0, "zzz"), (4, 1.0, None), (5, float("nan"), "b"),
                                (6, -2.0, "b")], "k int, x double, f string")
    got = {r["k"]: (r["probability"] is None, r["class"]) for r in score_job(spark, model, df).collect()}
    assert got == {1: (False, "Spend"), 2: (True, None), 3: (True, None), 4: (True, None), 5: (True, None),
                   6: (False, "Reduce")}


def test_write_read_round_trip(spark):
    d = tempfile.mkdtemp(prefix="dichot-io-")
    df = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    io.write_table(df, os.path.join(d, "c_csv"), fmt="csv")
    back = io.read_csv_blank_null(spark, os.path.join(d, "c_csv"), df.schema)
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0


def test_scoring_model_save_load_and_score(spark):
    df = frames.labeled_features(spark, SF_SMALL)
    d = glm.build_design(df, numeric=["price"], factors=["o_orderpriority"])
    fit = glm.fit_logit(df, "y", d)
    model = ScoringModel.from_fit(fit, impute={"price": 2.0})
    path = os.path.join(tempfile.mkdtemp(prefix="dichot-model-"), "m")
    model.save(spark, path)
    back = ScoringModel.load(spark, path)
    new = df.withColumn("price", F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("price")))
    scored = score_job(spark, back, new, keep=["o_orderkey", "price"]).collect()
    direct = {r["o_orderkey"]: r["p"] for r in
              df.withColumn("p", fit.probability()).select("o_orderkey", "p").collect()}
    for r in scored:
        if r["o_orderkey"] % 5 != 0:
            assert math.isclose(r["probability"], direct[r["o_orderkey"]], rel_tol=1e-12)
        assert r["class"] in ("Reduce", "Spend")


def test_clean_job_log(spark):
    left = frames.orders_with_defects(spark, SF_SMALL).drop("c_nationkey")
    right = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    cfg = CleanConfig(keys=["o_custkey"], label="o_orderstatus", positive="F", max_blank=10,
                      max_null=50, zero_fill=["nation_price"])
    out, log = clean_job(left, right, cfg)
    assert "o_orderpriority" in log["dropped_blank"]
    assert "o_totalprice" in log["dropped_null"]
    assert "nation_price" in out.columns
    assert out.filter(F.col("nation_price").isNull()).count() == 0
    assert set(r[0] for r in out.select("o_orderstatus").distinct().collect()) <= {0.0, 1.0}


def test_tab_delimited_named_table_and_prediction_sink(spark):
    d = tempfile.mkdtemp(prefix="dichot-io-")
    path = os.path.join(d, "t.tsv")
    with open(path, "w") as fh:
        fh.write("id\tx\n1\t0.5\n2\t\n")
    tsv = {r["id"]: r["x"] for r in io.read_delimited(spark, path, schema="id int, x double").collect()}
    assert tsv == {1: 0.5, 2: None}
    pq = os.path.join(d, "orders_pq")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.parquet(pq)
    assert io.read_table(spark, pq).count() == 1500
    df = frames.labeled_features(spark, SF_SMALL)
    fit = glm.fit_logit(df, "y", glm.build_design(df, numeric=["price"]))
    model = ScoringModel.from_fit(fit, impute={})
    scored = score_job(spark, model, df, keep=["o_orderkey"])
    out = os.path.join(d, "pred")
    io.write_predictions(scored, out, keep=["o_orderkey"], fmt="csv")
    back = io.read_csv_blank_null(spark, out, "o_orderkey long, class string, probability double")
    assert back.count() == df.count()
    assert set(r[0] for r in back.select("class").distinct().collect()) <= {"Reduce", "Spend"}


def test_dotted_names_and_nan(spark):
    from dichot.operators import clean, profile
    df = spark.createDataFrame([("Mr. X", 1.0, 2.0), ("Mr. X", 1.5, None), ("b", 1.0, float("nan"))],
                               "`g.x` string, `d.y` double, `v.x` double")
    cells = {tuple(r) for r in profile.crosstab(df, "d.y", "g.x").collect()}
    assert cells == {(1.0, "Mr. X", 1), (1.0, "b", 1), (1.5, "Mr. X", 1), (1.5, "b", 0)}
    filled, values = clean.impute(df, ["v.x"])
    assert values == {"v.x": 2.0} and [r["v.x"] for r in filled.collect()] == [2.0] * 3
    row = profile.numeric_summary(df, ["v.x"]).first()
    assert (row["column_name"], row["n"], row["n_na"], row["mean"], row["q3"]) == ("v.x", 1, 2, 2.0, 2.0)
