"""Oracle SQL for sources, star-schema ETL and the star-schema queries."""

from __future__ import annotations

from oracle.base import oracle

NUMBERS = ("unit_price discount_pct sell_price demand units_sold lost_sales revenue opening_stock "
           "closing_stock reorder_point reorder_qty reordered ordered_qty received_qty stockout "
           "promo_event lead_time_days on_time_rate defect_rate supplier_delay").split()

FACT_COLUMNS = ["date", "store", "category", "product", "supplier", *NUMBERS]

STORES = """store_dim AS (
  SELECT store AS store_name, ROW_NUMBER() OVER (ORDER BY store) AS store_id
  FROM (SELECT DISTINCT store FROM fact))"""
SUPPLIERS = """supplier_dim AS (
  SELECT supplier AS supplier_name, lead_time_days, on_time_rate, defect_rate,
         ROW_NUMBER() OVER (ORDER BY supplier) AS supplier_id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY supplier ORDER BY store, product, date) AS rn
        FROM fact) WHERE rn = 1)"""
PRODUCTS = """product_dim AS (
  SELECT product AS product_name, category, supplier_id, unit_price,
         ROW_NUMBER() OVER (ORDER BY product) AS product_id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product ORDER BY store, date) AS rn FROM fact)
  JOIN supplier_dim ON supplier_name = supplier WHERE rn = 1)"""
ALL_DIMS = ",\n".join([STORES, SUPPLIERS, PRODUCTS])

MONTHLY = """monthly AS (
  SELECT CAST(DATE_TRUNC('month', date) AS DATE) AS month, SUM(revenue_c) / 100.0 AS rev,
         SUM(units_sold * price_c * 60) / 10000.0 AS cost, SUM(demand) AS dem
  FROM fact GROUP BY 1)"""

ORACLES = {
    "read_retail_daily": oracle(
        "date store category product supplier unit_price:d discount_pct:i sell_price:d demand:b "
        "units_sold:b lost_sales:b revenue:d opening_stock:b closing_stock:b reorder_point:b "
        "reorder_qty:b reordered:i ordered_qty:b received_qty:b stockout:i promo_event:i "
        "lead_time_days:i on_time_rate:d defect_rate:d supplier_delay:i",
        "SELECT * FROM fact"),
    "write_artifact": oracle(
        "date store category product supplier unit_price:d discount_pct:i sell_price:d demand:b "
        "units_sold:b lost_sales:b revenue:d opening_stock:b closing_stock:b reorder_point:b "
        "reorder_qty:b reordered:i ordered_qty:b received_qty:b stockout:i promo_event:i "
        "lead_time_days:i on_time_rate:d defect_rate:d supplier_delay:i",
        "SELECT * FROM fact"),
    "read_optional": oracle("source row_count:b", """
        SELECT 'absent' AS source, 0 AS row_count
        UNION ALL SELECT 'present', COUNT(*) FROM fact"""),
    "require_columns": oracle("store demand:b", """
        SELECT store, SUM(demand) AS demand FROM fact GROUP BY 1"""),
    "fallback_column": oracle(
        "lost_value_at_sell_price:d lost_value_at_list_price:d stockout_days:b lost_sales_days:b",
        """SELECT SUM(lost_sales * sell_c) / 100.0 AS lost_value_at_sell_price,
                  SUM(lost_sales * price_c) / 100.0 AS lost_value_at_list_price,
                  SUM(stockout) AS stockout_days,
                  COUNT(*) FILTER (WHERE lost_sales > 0) AS lost_sales_days FROM fact"""),
    "dq_null_check": oracle("null_cells:b", """
        SELECT SUM(25 - (""" + " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)"
                                        for c in FACT_COLUMNS) + """)) AS null_cells
        FROM (SELECT * REPLACE (
                CASE WHEN opening_stock % 97 <> 0 THEN opening_stock END AS opening_stock,
                CASE WHEN DAY(date) <> 13 THEN supplier END AS supplier) FROM fact)"""),
    "dq_duplicate_check": oracle("duplicate_rows:b", """
        SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM twice)) AS duplicate_rows
        FROM twice""", """twice AS (
          SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE opening_stock % 97 = 0)"""),
    "coerce_numeric": oracle(
        " ".join(f"{c}:d" for c in NUMBERS),
        "SELECT " + ", ".join(f"SUM({c}) AS {c}" for c in NUMBERS if c not in
                              ("unit_price", "sell_price", "revenue", "on_time_rate",
                               "defect_rate"))
        + ", SUM(price_c) / 100.0 AS unit_price, SUM(sell_c) / 100.0 AS sell_price"
        ", SUM(revenue_c) / 100.0 AS revenue"
        ", SUM(CAST(ROUND(on_time_rate * 100) AS BIGINT)) / 100.0 AS on_time_rate"
        ", SUM(CAST(ROUND(defect_rate * 100) AS BIGINT)) / 100.0 AS defect_rate FROM fact"),
    "dim_stores": oracle("store_id:b store_name", "SELECT * FROM store_dim", STORES),
    "dim_suppliers": oracle(
        "supplier_id:b supplier_name lead_time_days:i on_time_rate:d defect_rate:d",
        "SELECT * FROM supplier_dim", SUPPLIERS),
    "dim_products": oracle(
        "product_id:b product_name category supplier_id:b unit_price:d",
        "SELECT * FROM product_dim", f"{SUPPLIERS},\n{PRODUCTS}"),
    "fact_sales": oracle(
        "sale_date store_id:b product_id:b unit_price:d discount_pct:d sell_price:d demand:b "
        "units_sold:b lost_sales:b revenue:d promo_event:i",
        """SELECT f.date AS sale_date, s.store_id, p.product_id, f.unit_price, f.discount_pct,
                  f.sell_price, f.demand, f.units_sold, f.lost_sales, f.revenue, f.promo_event
           FROM fact f JOIN store_dim s ON s.store_name = f.store
           JOIN product_dim p ON p.product_name = f.product""", ALL_DIMS),
    "fact_inventory": oracle(
        "inventory_date store_id:b product_id:b opening_stock:b closing_stock:b reorder_point:b "
        "reorder_qty:b reordered:i ordered_qty:b received_qty:b stockout:i supplier_delay:i",
        """SELECT f.date AS inventory_date, s.store_id, p.product_id, f.opening_stock,
                  f.closing_stock, f.reorder_point, f.reorder_qty, f.reordered, f.ordered_qty,
                  f.received_qty, f.stockout, f.supplier_delay
           FROM fact f JOIN store_dim s ON s.store_name = f.store
           JOIN product_dim p ON p.product_name = f.product""", ALL_DIMS),
    "insert_if_absent": oracle(
        "supplier_id:b supplier_name",
        """SELECT supplier_id, supplier_name FROM supplier_dim
           UNION ALL
           SELECT (SELECT MAX(supplier_id) FROM supplier_dim)
                  + ROW_NUMBER() OVER (ORDER BY s_name), s_name
           FROM supplier WHERE s_name NOT IN (SELECT supplier_name FROM supplier_dim)""",
        SUPPLIERS),
    "table_counts": oracle("table_name row_count:b", """
        SELECT 'stores' AS table_name, COUNT(DISTINCT store) AS row_count FROM fact
        UNION ALL SELECT 'suppliers', COUNT(DISTINCT supplier) FROM fact
        UNION ALL SELECT 'products', COUNT(DISTINCT product) FROM fact
        UNION ALL SELECT 'sales', COUNT(*) FROM fact
        UNION ALL SELECT 'inventory', COUNT(*) FROM fact"""),
    "reload_star": oracle("table_name row_count:b", """
        SELECT 'stores' AS table_name, COUNT(DISTINCT store) AS row_count FROM fact
        UNION ALL SELECT 'suppliers', COUNT(DISTINCT supplier) FROM fact
        UNION ALL SELECT 'products', COUNT(DISTINCT product) FROM fact
        UNION ALL SELECT 'sales', COUNT(*) FROM fact
        UNION ALL SELECT 'inventory', COUNT(*) FROM fact"""),

    "biz_top_products": oracle(
        "product_name category total_units_sold:b total_revenue:d",
        """SELECT product AS product_name, category, SUM(units_sold) AS total_units_sold,
                  SUM(revenue_c) / 100.0 AS total_revenue
           FROM fact GROUP BY 1, 2 ORDER BY SUM(revenue_c) DESC, 1 LIMIT 10"""),
    "biz_store_performance": oracle(
        "store_name total_units_sold:b total_revenue:d revenue_per_unit:d",
        """SELECT store AS store_name, SUM(units_sold) AS total_units_sold,
                  SUM(revenue_c) / 100.0 AS total_revenue,
                  ROUND(SUM(revenue_c) / 100.0 / NULLIF(SUM(units_sold), 0) + 1e-9, 2)
                    AS revenue_per_unit
           FROM fact GROUP BY 1"""),
    "biz_stockout_rate": oracle(
        "product_name category total_days:b stockout_days:b stockout_rate:d",
        """SELECT product AS product_name, category, COUNT(*) AS total_days,
                  SUM(stockout) AS stockout_days,
                  ROUND(100.0 * (CAST(SUM(stockout) AS DOUBLE) / COUNT(*)) + 1e-9, 2)
                    AS stockout_rate
           FROM fact GROUP BY 1, 2"""),
    "biz_lost_sales": oracle(
        "product_name category total_demand:b total_units_sold:b total_lost_sales:b "
        "lost_sales_rate:d",
        """SELECT product AS product_name, category, SUM(demand) AS total_demand,
                  SUM(units_sold) AS total_units_sold, SUM(lost_sales) AS total_lost_sales,
                  ROUND(100.0 * (CAST(SUM(lost_sales) AS DOUBLE) / NULLIF(SUM(demand), 0)) + 1e-9,
                        2) AS lost_sales_rate
           FROM fact GROUP BY 1, 2 ORDER BY SUM(lost_sales) DESC, 1 LIMIT 10"""),
    "biz_monthly_demand_growth": oracle(
        "month:t total_demand:b previous_month_demand:b growth_percentage:d",
        """SELECT a.month, a.dem AS total_demand, b.dem AS previous_month_demand,
                  ROUND(100.0 * (CAST(a.dem - b.dem AS DOUBLE) / NULLIF(b.dem, 0))
                        + SIGN(a.dem - b.dem) * 1e-9, 2) AS growth_percentage
           FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY month) AS n FROM monthly) a
           LEFT JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY month) AS n FROM monthly) b
             ON b.n = a.n - 1""", MONTHLY),
    "biz_top3_per_category": oracle(
        "category product_name total_revenue:d category_rank:i",
        """SELECT category, product AS product_name, rev / 100.0 AS total_revenue,
                  1 + (SELECT COUNT(*) FROM totals o
                       WHERE o.category = t.category AND o.rev > t.rev) AS category_rank
           FROM totals t
           WHERE (SELECT COUNT(*) FROM totals o
                  WHERE o.category = t.category AND o.rev > t.rev) < 3""",
        "totals AS (SELECT category, product, SUM(revenue_c) AS rev FROM fact GROUP BY 1, 2)"),
    "biz_inventory_risk": oracle(
        "store_name product_name category inventory_date closing_stock:b reorder_point:b "
        "inventory_status",
        """SELECT store AS store_name, product AS product_name, category, date AS inventory_date,
                  closing_stock, reorder_point,
                  CASE WHEN closing_stock > reorder_point THEN 'NORMAL'
                       WHEN closing_stock > reorder_point * 0.5 THEN 'HIGH'
                       ELSE 'CRITICAL' END AS inventory_status
           FROM fact WHERE date = (SELECT MAX(date) FROM fact)"""),
    "biz_supplier_rule_risk": oracle(
        "supplier_name lead_time_days:i on_time_rate:d defect_rate:d supplier_risk",
        """SELECT supplier_name, lead_time_days, on_time_rate, defect_rate,
                  CASE WHEN on_time_rate >= 0.95 AND defect_rate <= 0.03 THEN 'LOW'
                       WHEN on_time_rate >= 0.9 AND defect_rate <= 0.05 THEN 'MEDIUM'
                       ELSE 'HIGH' END AS supplier_risk
           FROM supplier_dim""", SUPPLIERS),

    "fin_monthly_margin": oracle(
        "month:t revenue:d cogs:d gross_profit:d gross_margin_pct:d",
        """SELECT month, rev AS revenue, cost AS cogs, rev - cost AS gross_profit,
                  ROUND(100.0 * ((rev - cost) / NULLIF(rev, 0)) + SIGN(rev - cost) * 1e-9, 2)
                    AS gross_margin_pct FROM monthly""", MONTHLY),
    "fin_budget_vs_actual_sql": oracle(
        "month:t budget_revenue:d actual_revenue:d revenue_variance:d revenue_variance_pct:d "
        "budget_cogs:d actual_cogs:d cogs_variance:d",
        """SELECT *, actual_revenue - budget_revenue AS revenue_variance,
                  ROUND(100.0 * ((actual_revenue - budget_revenue) / NULLIF(budget_revenue, 0))
                        + SIGN(actual_revenue - budget_revenue) * 1e-9, 2) AS revenue_variance_pct,
                  actual_cogs - budget_cogs AS cogs_variance
           FROM (SELECT month, rev AS actual_revenue, cost AS actual_cogs,
                        COALESCE(1.05 * LAG(rev) OVER (ORDER BY month), rev) AS budget_revenue,
                        COALESCE(1.03 * LAG(cost) OVER (ORDER BY month), cost) AS budget_cogs
                 FROM monthly)""", MONTHLY),
    "fin_store_turnover": oracle(
        "store cogs:d average_inventory_value:d inventory_turnover:d dio:d",
        """SELECT store, cost AS cogs, value AS average_inventory_value,
                  ROUND(cost / NULLIF(value, 0) + 1e-9, 2) AS inventory_turnover,
                  ROUND(365.0 / NULLIF(cost / NULLIF(value, 0), 0) + 1e-9, 2) AS dio
           FROM (SELECT store, SUM(units_sold * price_c * 60) / 10000.0 AS cost,
                        SUM(closing_stock * price_c * 60) / 10000.0 / COUNT(*) AS value
                 FROM fact GROUP BY store)"""),
    "fin_abc_sql": oracle(
        "product category revenue:d revenue_share_pct:d cumulative_share_pct:d abc_class",
        """SELECT product, category, rev / 100.0 AS revenue,
                  ROUND(100.0 * (CAST(rev AS DOUBLE) / total) + 1e-9, 2) AS revenue_share_pct,
                  ROUND(100.0 * (CAST(run AS DOUBLE) / total) + 1e-9, 2) AS cumulative_share_pct,
                  CASE WHEN run * 100 <= total * 80 THEN 'A' WHEN run * 100 <= total * 95 THEN 'B'
                       ELSE 'C' END AS abc_class
           FROM (SELECT *, SUM(rev) OVER () AS total,
                        SUM(rev) OVER (ORDER BY rev DESC, product
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
                 FROM (SELECT product, category, SUM(revenue_c) AS rev FROM fact GROUP BY 1, 2))"""
    ),
    "fin_promotion_sql": oracle(
        "promo_label days:b units_sold:b revenue:d average_daily_units:d average_daily_revenue:d "
        "conversion_pct:d",
        """SELECT CASE promo_event WHEN 1 THEN 'Promotion' ELSE 'Non-promotion' END AS promo_label,
                  COUNT(*) AS days, SUM(units_sold) AS units_sold,
                  SUM(revenue_c) / 100.0 AS revenue,
                  ROUND(CAST(SUM(units_sold) AS DOUBLE) / COUNT(*) + 1e-9, 2)
                    AS average_daily_units,
                  ROUND(SUM(revenue_c) / 100.0 / COUNT(*) + 1e-9, 2) AS average_daily_revenue,
                  ROUND(100.0 * (CAST(SUM(units_sold) AS DOUBLE) / NULLIF(SUM(demand), 0)) + 1e-9,
                        2) AS conversion_pct
           FROM fact GROUP BY promo_event"""),
    "fin_supplier_impact_sql": oracle(
        "supplier lost_sales_units:b lost_sales_value:d stockout_days:b average_lead_time_days:d "
        "on_time_rate:d defect_rate:d",
        """SELECT supplier, SUM(lost_sales) AS lost_sales_units,
                  SUM(lost_sales * sell_c) / 100.0 AS lost_sales_value,
                  SUM(stockout) AS stockout_days,
                  ROUND(AVG(d.lead_time_days) + 1e-9, 2) AS average_lead_time_days,
                  ROUND(AVG(d.on_time_rate) + 1e-9, 2) AS on_time_rate,
                  ROUND(AVG(d.defect_rate) + 1e-9, 2) AS defect_rate
           FROM fact JOIN supplier_dim d ON d.supplier_name = supplier GROUP BY supplier""",
        SUPPLIERS),
}
