"""Modelling frames derived from the test tables, by rules both engines repeat.

The raw tables carry almost no signal, so the modelling queries use a label
mixing price with an md5-of-key uniform (mean ~0.5, corr with price ~0.58),
and the cleaning queries plant missing values by key rule.  Each rule has a
DuckDB twin in ``dichot.plans.oracle`` so results can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.session import table

# fixed values of the derived label and defect rules (kept equal in the SQL twins)
PRICE_SCALE = 5e5
DEFECT_NULL_PRICE_MOD = 17
DEFECT_SENTINEL_MOD = 23
DEFECT_BLANK_MOD = 29
ZERO_FILL_NATION = 7


def key_uniform(col: str) -> F.Column:
    """Uniform from the first 8 hex digits of md5(key) (no seed prefix)."""
    return F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 8), 16, 10).cast("long") \
        / F.lit(4294967296.0)


def with_label(orders: DataFrame) -> DataFrame:
    """orders + ``y`` (1.0/0.0) + ``status_f`` (o_orderstatus = 'F')."""
    score = 0.5 * (F.col("o_totalprice") / F.lit(PRICE_SCALE)) + 0.5 * key_uniform("o_orderkey")
    return (orders.withColumn("y", F.when(score > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))
                  .withColumn("status_f", (F.col("o_orderstatus") == "F").cast("double")))


def orders_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_label(table(spark, sf_dir, "orders"))


def orders_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer nation, with the planted defects of FIXTURES.md.

    o_totalprice null for key % 17 = 0; o_orderpriority 'NULL' for key % 23 = 0,
    '' for key % 29 = 0; price_text = price as text; nation_price null for
    customers of nation 7 (the zero-fill rule); price2 = 2 * price (collinear).
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    price = F.when(k % DEFECT_NULL_PRICE_MOD == 0, F.lit(None).cast("double")) \
             .otherwise(F.col("o_totalprice"))
    prio = (F.when(k % DEFECT_SENTINEL_MOD == 0, F.lit("NULL"))
             .when(k % DEFECT_BLANK_MOD == 0, F.lit(""))
             .otherwise(F.col("o_orderpriority")))
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")
    return (joined.withColumn("o_totalprice", price)
                  .withColumn("o_orderpriority", prio)
                  .withColumn("price_text", F.col("o_totalprice").cast("string"))
                  .withColumn("nation_price", F.when(F.col("c_nationkey") == ZERO_FILL_NATION,
                                                     F.lit(None).cast("double"))
                                               .otherwise(F.col("o_totalprice")))
                  .withColumn("price2", F.col("o_totalprice") * 2))


def labeled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelling frame: orders label + customer fields + price in 1e5 units."""
    o = orders_labeled(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                 "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")
             .withColumn("price", F.col("o_totalprice") / 1e5)
             .withColumn("acctbal", F.col("c_acctbal") / 1e3))
