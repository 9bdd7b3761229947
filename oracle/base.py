"""Building blocks of the DuckDB oracle: the daily fact as CTEs and typed result columns."""

from __future__ import annotations

FACT = """
names AS (
  SELECT p_name, MIN(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS price_c,
         ROW_NUMBER() OVER (ORDER BY p_name) - 1 AS pidx
  FROM part GROUP BY p_name),
goods AS (
  SELECT p_name, price_c, pidx, s_name, s_suppkey FROM names
  JOIN supplier ON s_suppkey = pidx % (SELECT COUNT(*) FROM supplier)),
days AS (
  SELECT CAST(l_shipdate AS DATE) AS day, r_name, r_regionkey AS rk, p_name,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS demand,
         MAX(CAST(ROUND(l_discount * 100) AS INTEGER)) AS disc,
         CAST(SUM(l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 1000 AS BIGINT) AS k
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey
  GROUP BY 1, 2, 3, 4),
lines AS (
  SELECT *, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS so,
         CASE WHEN k % 5 = 0 THEN GREATEST(1, demand // 3) ELSE 0 END AS lost,
         CASE WHEN k % 5 = 0 THEN 0 ELSE k END AS stock,
         120 + (pidx * 7 + rk * 13) % 80 AS rop, 250 + (pidx * 11 + rk * 17) % 250 AS rq,
         (price_c * (100 - disc) + 50) // 100 AS sell_c
  FROM days JOIN goods USING (p_name)),
fact AS (
  SELECT day AS date, r_name AS store, SPLIT_PART(p_name, ' ', 2) AS category, p_name AS product,
         s_name AS supplier, price_c, sell_c, price_c / 100.0 AS unit_price,
         disc AS discount_pct, sell_c / 100.0 AS sell_price, demand,
         CAST(demand - lost AS BIGINT) AS units_sold, CAST(lost AS BIGINT) AS lost_sales,
         CAST((demand - lost) * sell_c AS BIGINT) AS revenue_c,
         (demand - lost) * sell_c / 100.0 AS revenue,
         CAST(stock + demand - lost AS BIGINT) AS opening_stock,
         CAST(stock AS BIGINT) AS closing_stock, CAST(rop AS BIGINT) AS reorder_point,
         CAST(rq AS BIGINT) AS reorder_qty, CASE WHEN stock <= rop THEN 1 ELSE 0 END AS reordered,
         CAST(CASE WHEN stock <= rop THEN rq ELSE 0 END AS BIGINT) AS ordered_qty,
         CAST(CASE WHEN k % 4 = 0 THEN rq ELSE 0 END AS BIGINT) AS received_qty,
         so AS stockout, CASE WHEN disc >= 10 THEN 1 ELSE 0 END AS promo_event,
         CAST(3 + s_suppkey % 8 + CASE WHEN k % 11 = 0 THEN 2 ELSE 0 END AS INTEGER)
           AS lead_time_days,
         (85 + s_suppkey % 15) / 100.0 AS on_time_rate, (1 + s_suppkey % 8) / 100.0 AS defect_rate,
         CASE WHEN stock <= rop AND k % 7 = 0 THEN 1 ELSE 0 END AS supplier_delay
  FROM lines)"""

# Result column kinds: as is, BIGINT, INTEGER, DOUBLE rounded to 6 places.
CASTS = {
    "": "{c}",
    "b": "CAST({c} AS BIGINT) AS {c}",
    "i": "CAST({c} AS INTEGER) AS {c}",
    "d": "ROUND(CAST({c} AS DOUBLE) + SIGN(CAST({c} AS DOUBLE)) * 1e-9, 6) + 0.0 AS {c}",
    "t": "CAST({c} AS DATE) AS {c}",
}


def oracle(columns: str, body: str, ctes: str = "") -> str:
    """A full statement over the fact; ``columns`` is 'name[:kind]' separated by blanks."""
    picked = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        picked.append(CASTS[kind].format(c=name))
    more = f",\n{ctes}" if ctes else ""
    return f"WITH {FACT}{more},\nanswer AS ({body})\nSELECT {', '.join(picked)} FROM answer"
