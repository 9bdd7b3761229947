"""Oracle SQL for the finance operators on the daily fact."""

from __future__ import annotations

from oracle.base import oracle
from oracle.star import MONTHLY

SUMMARY = """kpi AS (
  SELECT *, CASE WHEN stock_value = 0 THEN 0 ELSE cogs / stock_value END AS turnover
  FROM (SELECT SUM(revenue_c) / 100.0 AS revenue,
               SUM(units_sold * price_c * 60) / 10000.0 AS cogs,
               SUM(closing_stock * price_c * 60) / 10000.0 / COUNT(*) AS stock_value,
               SUM(lost_sales * sell_c) / 100.0 AS lost_value FROM fact))"""

ABC = """abc AS (
  SELECT category, product, rev / 100.0 AS revenue,
         100.0 * (CAST(rev AS DOUBLE) / total) AS revenue_share_pct,
         100.0 * (CAST(run AS DOUBLE) / total) AS cumulative_share_pct,
         CASE WHEN run * 100 <= total * 80 THEN 'A' WHEN run * 100 <= total * 95 THEN 'B'
              ELSE 'C' END AS abc_class
  FROM (SELECT *, SUM(rev) OVER () AS total,
               SUM(rev) OVER (ORDER BY rev DESC, product
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
        FROM (SELECT product, category, SUM(revenue_c) AS rev FROM fact GROUP BY 1, 2)))"""

IMPACT = """impact AS (
  SELECT supplier, SUM(revenue_c) / 100.0 AS revenue, SUM(lost_sales) AS lost_sales_units,
         SUM(lost_sales * sell_c) / 100.0 AS lost_sales_value, SUM(stockout) AS stockout_days,
         AVG(lead_time_days) AS average_lead_time_days, AVG(on_time_rate) AS on_time_rate,
         AVG(defect_rate) AS defect_rate FROM fact GROUP BY supplier)"""

IMPACT_COLUMNS = ("supplier revenue:d lost_sales_units:b lost_sales_value:d stockout_days:b "
                  "average_lead_time_days:d on_time_rate:d defect_rate:d")
ABC_COLUMNS = ("category product revenue:d revenue_share_pct:d cumulative_share_pct:d abc_class")

ORACLES = {
    "finance_columns": oracle(
        "date store product unit_cost:d cogs:d gross_profit:d gross_margin_pct:d "
        "inventory_value:d lost_sales_value:d",
        """SELECT date, store, product, price_c * 60 / 10000.0 AS unit_cost,
                  units_sold * price_c * 60 / 10000.0 AS cogs,
                  (revenue_c * 100 - units_sold * price_c * 60) / 10000.0 AS gross_profit,
                  CASE WHEN revenue_c > 0
                       THEN 100.0 * (((revenue_c * 100 - units_sold * price_c * 60) / 10000.0)
                                     / (revenue_c / 100.0)) ELSE 0 END AS gross_margin_pct,
                  closing_stock * price_c * 60 / 10000.0 AS inventory_value,
                  lost_sales * sell_c / 100.0 AS lost_sales_value FROM fact"""),
    "finance_summary": oracle(
        "revenue:d cogs:d gross_profit:d gross_margin_pct:d average_inventory_value:d "
        "inventory_turnover:d days_inventory_outstanding:d annual_holding_cost:d "
        "historical_lost_sales_value:d",
        """SELECT revenue, cogs, revenue - cogs AS gross_profit,
                  CASE WHEN revenue = 0 THEN 0 ELSE 100.0 * ((revenue - cogs) / revenue) END
                    AS gross_margin_pct,
                  stock_value AS average_inventory_value, turnover AS inventory_turnover,
                  CASE WHEN turnover = 0 THEN 0 ELSE 365.0 / turnover END
                    AS days_inventory_outstanding,
                  stock_value * 0.25 AS annual_holding_cost,
                  lost_value AS historical_lost_sales_value FROM kpi""", SUMMARY),
    "budget_vs_actual": oracle(
        "month:t actual_revenue:d actual_cogs:d actual_gross_profit:d budget_revenue:d "
        "budget_cogs:d budget_gross_profit:d revenue_variance:d revenue_variance_pct:d "
        "cogs_variance:d gross_profit_variance:d margin_variance_pct:d",
        """SELECT *, budget_revenue - budget_cogs AS budget_gross_profit,
                  actual_revenue - budget_revenue AS revenue_variance,
                  COALESCE(100.0 * ((actual_revenue - budget_revenue)
                                    / NULLIF(budget_revenue, 0)), 0) AS revenue_variance_pct,
                  actual_cogs - budget_cogs AS cogs_variance,
                  actual_gross_profit - (budget_revenue - budget_cogs) AS gross_profit_variance,
                  COALESCE(100.0 * (actual_gross_profit / NULLIF(actual_revenue, 0))
                           - 100.0 * ((budget_revenue - budget_cogs) / NULLIF(budget_revenue, 0)),
                           0) AS margin_variance_pct
           FROM (SELECT month, rev AS actual_revenue, cost AS actual_cogs,
                        rev - cost AS actual_gross_profit,
                        COALESCE(1.05 * LAG(rev) OVER (ORDER BY month), rev) AS budget_revenue,
                        COALESCE(1.03 * LAG(cost) OVER (ORDER BY month), cost) AS budget_cogs
                 FROM monthly)""", MONTHLY),
    "promotion_effectiveness": oracle(
        "promo_event:i days:b units_sold:b revenue:d demand:b average_daily_units:d "
        "average_daily_revenue:d conversion_pct:d promo_label",
        """SELECT promo_event, COUNT(date) AS days, SUM(units_sold) AS units_sold,
                  SUM(revenue_c) / 100.0 AS revenue, SUM(demand) AS demand,
                  AVG(units_sold) AS average_daily_units,
                  SUM(revenue_c) / 100.0 / COUNT(*) AS average_daily_revenue,
                  100.0 * (CAST(SUM(units_sold) AS DOUBLE) / NULLIF(SUM(demand), 0))
                    AS conversion_pct,
                  CASE promo_event WHEN 1 THEN 'Promotion' ELSE 'Non-promotion' END AS promo_label
           FROM fact GROUP BY promo_event"""),
    "abc_analysis": oracle(ABC_COLUMNS, "SELECT * FROM abc", ABC),
    "supplier_stockout_impact": oracle(IMPACT_COLUMNS, "SELECT * FROM impact", IMPACT),
}
