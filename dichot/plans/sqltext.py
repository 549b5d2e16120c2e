"""DuckDB text pieces shared by the oracle queries.

The oracle has no normal or chi-square distribution function, so p-values
are written as convergent series with ``lgamma`` (enough terms for the
ranges used; far tails are exactly 0 at six decimals).
"""

from __future__ import annotations

LABELED = """labeled AS (
  SELECT *,
    CAST(CASE WHEN 0.5*(o_totalprice/5e5)
              + 0.5*(('0x'||substr(md5(CAST(o_orderkey AS VARCHAR)),1,8))::BIGINT/4294967296.0) > 0.5
         THEN 1.0 ELSE 0.0 END AS DOUBLE) AS y,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS status_f
  FROM orders)"""

_PRICE = "(CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_totalprice END)"

DEFECTS = f"""defects AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
    {_PRICE} AS o_totalprice,
    o.o_orderdate,
    CASE WHEN o.o_orderkey % 23 = 0 THEN 'NULL' WHEN o.o_orderkey % 29 = 0 THEN ''
         ELSE o.o_orderpriority END AS o_orderpriority,
    c.c_nationkey,
    CAST({_PRICE} AS VARCHAR) AS price_text,
    CASE WHEN c.c_nationkey = 7 THEN NULL ELSE {_PRICE} END AS nation_price,
    {_PRICE} * 2 AS price2
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

DEFECT_COLUMNS = [("o_orderkey", "n"), ("o_custkey", "n"), ("o_orderstatus", "s"),
                  ("o_totalprice", "n"), ("o_orderdate", "n"), ("o_orderpriority", "s"),
                  ("c_nationkey", "n"), ("price_text", "s"), ("nation_price", "n"),
                  ("price2", "n")]


def uniform(seed, key: str) -> str:
    return (f"(('0x'||substr(md5('{seed}:'||CAST({key} AS VARCHAR)),1,8))::BIGINT"
            f"/4294967296.0)")


def norm_sf2(z: str) -> str:
    """Two-sided normal p-value 2*(1 - Phi(|z|))."""
    a = f"abs({z})"
    series = (f"list_sum([exp((2*ii_+1)*ln(greatest({a}, 1e-300)) - ((ii_+1)*ln(2.0) + lgamma(ii_+1.5)"
              f" - 0.5*ln(pi()))) for ii_ in range(0, 400)])")
    return (f"(CASE WHEN {a} > 8.5 THEN 0.0 ELSE greatest(0.0, 1.0 - 2.0*exp(-{a}*{a}/2.0)"
            f"/sqrt(2*pi())*{series}) END)")


def chi2_sf(x: str, df: str) -> str:
    """Upper tail of chi-square: 1 - P(df/2, x/2) by the power series of P."""
    a = f"(({df})/2.0)"
    y = f"(({x})/2.0)"
    series = (f"list_sum([exp(({a}+ii_)*ln(greatest({y}, 1e-300)) - {y} - lgamma({a}+ii_+1))"
              f" for ii_ in range(0, 1500)])")
    return f"(CASE WHEN {y} > 600 THEN 0.0 WHEN {y} <= 0 THEN 1.0 ELSE greatest(0.0, 1.0 - {series}) END)"


def r6(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6)"
