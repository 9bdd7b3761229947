"""Oracle SQL for stock policy, supplier risk, temporal disruption, actions and impact."""

from __future__ import annotations

from oracle.base import oracle
from oracle.demand import RECURSION
from oracle.finance import ABC, ABC_COLUMNS, IMPACT, IMPACT_COLUMNS, SUMMARY


def r2(expression: str) -> str:
    return f"ROUND({expression} + SIGN({expression}) * 1e-9, 2)"


PROFILE = """span AS (
  SELECT GREATEST(DATE_DIFF('day', MIN(date), MAX(date)) + 1, 1) AS days FROM fact),
profile AS (
  SELECT store, product, ARG_MIN(category, date) AS category, ARG_MIN(supplier, date) AS supplier,
         SUM(demand) AS total_demand, SUM(price_c) / 100.0 / COUNT(*) AS unit_price,
         AVG(lead_time_days) AS lead_time_days, ARG_MAX(closing_stock, date) AS current_stock,
         STDDEV_SAMP(CAST(demand AS DOUBLE)) AS demand_std,
         SUM(stockout) AS historical_stockout_days, COUNT(date) AS observed_days,
         SUM(demand) * (365.0 / (SELECT days FROM span)) AS annual_demand,
         CAST(SUM(stockout) AS DOUBLE) / COUNT(date) AS historical_stockout_rate
  FROM fact GROUP BY store, product)"""
POLICY = f"""{PROFILE},
filled AS (
  SELECT * REPLACE (COALESCE(demand_std, (SELECT MEDIAN(demand_std) FROM profile), 0)
                    AS demand_std),
         annual_demand / 365 AS forecast_daily_demand,
         annual_demand / 365 * 30 AS forecast_30_day_demand
  FROM profile),
policy AS (
  SELECT *, 1.645 * demand_std * SQRT(GREATEST(lead_time_days, 1)) AS safety_stock,
         forecast_daily_demand * lead_time_days AS expected_lead_time_demand,
         forecast_daily_demand * lead_time_days
           + 1.645 * demand_std * SQRT(GREATEST(lead_time_days, 1)) AS reorder_point
  FROM filled),
ordering AS (
  SELECT *, SQRT(2 * GREATEST(annual_demand, 1) * 2000.0 / GREATEST(unit_price * 0.25, 0.01))
    AS eoq FROM policy),
sized AS (
  SELECT *, CASE WHEN current_stock > reorder_point THEN 0
                 ELSE LEAST(eoq, forecast_30_day_demand) END AS recommended_order_qty
  FROM ordering),
graded AS (
  SELECT *, CASE WHEN current_stock > reorder_point THEN 'NORMAL'
                 WHEN current_stock > safety_stock THEN 'REORDER' ELSE 'CRITICAL' END
              AS inventory_status,
         GREATEST(reorder_point - current_stock, 0) AS shortage_to_rop,
         current_stock / GREATEST(forecast_daily_demand, 0.01) AS days_of_stock,
         CASE WHEN current_stock <= 0 THEN 1 ELSE 0 END AS current_stockout,
         CASE WHEN current_stock / GREATEST(forecast_daily_demand, 0.01) < 7 THEN 1 ELSE 0 END
           AS low_coverage_7d
  FROM sized)"""
ROUNDED = ("annual_demand forecast_daily_demand forecast_30_day_demand demand_std safety_stock "
           "expected_lead_time_demand reorder_point eoq recommended_order_qty shortage_to_rop "
           "days_of_stock historical_stockout_rate").split()
INVENTORY = f"""{POLICY},
stock_table AS (SELECT * REPLACE ({', '.join(f'{r2(c)} AS {c}' for c in ROUNDED)}) FROM graded)"""

PROFILE_COLUMNS = ("store product category supplier total_demand:b unit_price:d lead_time_days:d "
                   "current_stock:b demand_std:d historical_stockout_days:b observed_days:b "
                   "annual_demand:d historical_stockout_rate:d")
POLICY_COLUMNS = (f"{PROFILE_COLUMNS} forecast_daily_demand:d forecast_30_day_demand:d "
                  "safety_stock:d expected_lead_time_demand:d reorder_point:d")
ORDER_COLUMNS = f"{POLICY_COLUMNS} eoq:d recommended_order_qty:d"
STATUS_COLUMNS = (f"{ORDER_COLUMNS} inventory_status shortage_to_rop:d days_of_stock:d "
                  "current_stockout:i low_coverage_7d:i")

METRICS = """service AS (
  SELECT supplier, AVG(lead_time_days) AS average_lead_time, AVG(on_time_rate) AS on_time_rate,
         AVG(defect_rate) AS defect_rate, SUM(supplier_delay) AS total_supplier_delays,
         SUM(ordered_qty) AS total_ordered, SUM(received_qty) AS total_received,
         CAST(SUM(received_qty) AS DOUBLE)
           / CASE SUM(ordered_qty) WHEN 0 THEN 1 ELSE SUM(ordered_qty) END AS fill_rate,
         AVG(on_time_rate) * 100 AS on_time_percentage,
         AVG(defect_rate) * 100 AS defect_percentage,
         100 * CAST(SUM(received_qty) AS DOUBLE)
           / CASE SUM(ordered_qty) WHEN 0 THEN 1 ELSE SUM(ordered_qty) END AS fill_percentage
  FROM fact GROUP BY supplier)"""
RISK = f"""{METRICS},
scored AS (
  SELECT *, 0.4 * (100 - on_time_percentage) + 1.5 * defect_percentage
            + 0.3 * (100 - fill_percentage) AS raw FROM service),
risk AS (
  SELECT supplier, on_time_rate, defect_rate, total_supplier_delays, total_ordered,
         total_received, fill_rate, {r2('average_lead_time')} AS average_lead_time,
         {r2('on_time_percentage')} AS on_time_percentage,
         {r2('defect_percentage')} AS defect_percentage,
         {r2('fill_percentage')} AS fill_percentage, {r2('raw')} AS risk_score,
         CASE WHEN raw > 20 THEN 'HIGH' WHEN raw > 10 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM scored)"""
METRIC_COLUMNS = ("supplier average_lead_time:d on_time_rate:d defect_rate:d "
                  "total_supplier_delays:b total_ordered:b total_received:b fill_rate:d "
                  "on_time_percentage:d defect_percentage:d fill_percentage:d")
RISK_COLUMNS = f"{METRIC_COLUMNS} risk_score:d risk_level"

MEASURES = ["lead_time", "on_time", "defect_rate", "fill_rate", "demand", "stockout"]
BEFORE = "(PARTITION BY supplier, product ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
TEMPORAL = f"""signals_daily AS (
  SELECT supplier, product, date, AVG(lead_time_days) AS lead_time, AVG(on_time_rate) AS on_time,
         AVG(defect_rate) AS defect_rate, SUM(ordered_qty) AS ordered,
         SUM(received_qty) AS received, SUM(demand) AS demand, AVG(stockout) AS stockout,
         CASE SUM(ordered_qty) WHEN 0 THEN 0
              ELSE CAST(SUM(received_qty) AS DOUBLE) / SUM(ordered_qty) END AS fill_rate
  FROM fact GROUP BY 1, 2, 3),
based AS (
  SELECT *, {', '.join(f"CASE WHEN COUNT(*) OVER {BEFORE} >= 5 THEN AVG({m}) OVER {BEFORE} END AS {m}_baseline" for m in MEASURES)}
  FROM signals_daily),
changed AS (
  SELECT *, {', '.join(f"{m} - {m}_baseline AS {m}_change" for m in MEASURES)} FROM based),
relative AS (
  SELECT supplier, product, date, lead_time, on_time, defect_rate, ordered, received, demand,
         stockout, fill_rate,
         {', '.join(f"COALESCE({m}_{s}, 0) AS {m}_{s}" for m in MEASURES
                    for s in ('baseline', 'change'))},
         {', '.join(f"COALESCE({m}_change / NULLIF({m}_baseline, 0), 0) AS {n}_pct_change"
                    for n, m in (('lead_time', 'lead_time'), ('fill_rate', 'fill_rate'),
                                 ('on_time', 'on_time'), ('defect', 'defect_rate')))}
  FROM changed),
signalled AS (
  SELECT *, LEAST(100, GREATEST(0, lead_time_pct_change) * 35
                       + GREATEST(0, 0 - fill_rate_pct_change) * 25
                       + GREATEST(0, 0 - on_time_pct_change) * 20
                       + GREATEST(0, defect_pct_change) * 10
                       + GREATEST(0, stockout_change) * 10) AS disruption_signal
  FROM relative),
staged AS (
  SELECT *, CASE WHEN disruption_signal > 70 THEN 'CRITICAL'
                 WHEN disruption_signal > 40 THEN 'EMERGING'
                 WHEN disruption_signal > 20 THEN 'EARLY_WARNING' ELSE 'NORMAL' END
              AS disruption_stage, disruption_signal > 40 AS is_disruption
  FROM signalled)"""
DAY_COLUMNS = ("supplier product date lead_time:d on_time:d defect_rate:d ordered:b received:b "
               "demand:b stockout:d fill_rate:d")
BASE_COLUMNS = DAY_COLUMNS + "".join(f" {m}_baseline:d {m}_change:d" for m in MEASURES)
PCT_COLUMNS = (f"{BASE_COLUMNS} lead_time_pct_change:d fill_rate_pct_change:d "
               "on_time_pct_change:d defect_pct_change:d")
STAGE_COLUMNS = f"{PCT_COLUMNS} disruption_signal:d disruption_stage is_disruption"

ACTIONS = f"""{INVENTORY},
{RISK},
actions AS (
  SELECT s.*, CAST(NULL AS DOUBLE) AS average_30_day_forecast,
         CAST(NULL AS DOUBLE) AS total_30_day_forecast, r.average_lead_time, r.on_time_rate,
         r.defect_rate, r.total_supplier_delays, r.total_ordered, r.total_received, r.fill_rate,
         r.on_time_percentage, r.defect_percentage, r.fill_percentage, r.risk_score, r.risk_level,
         CASE inventory_status WHEN 'NORMAL' THEN 'LOW' WHEN 'REORDER' THEN 'MEDIUM'
              ELSE CASE WHEN r.risk_level = 'HIGH' THEN 'URGENT' ELSE 'HIGH' END END AS priority
  FROM stock_table s LEFT JOIN risk r USING (supplier)),
advised AS (
  SELECT *, CASE priority WHEN 'LOW' THEN 'Monitor' WHEN 'MEDIUM' THEN 'Plan replenishment'
                 WHEN 'HIGH' THEN 'Expedite replenishment'
                 ELSE 'Expedite + supplier escalation' END AS action FROM actions)"""
RISK_EXTRA = ("average_lead_time:d on_time_rate:d defect_rate:d total_supplier_delays:b "
              "total_ordered:b total_received:b fill_rate:d on_time_percentage:d "
              "defect_percentage:d fill_percentage:d risk_score:d risk_level")
ACTION_COLUMNS = (f"{STATUS_COLUMNS} average_30_day_forecast:d total_30_day_forecast:d "
                  f"{RISK_EXTRA} priority action")

LATEST = """latest AS (
  SELECT *, closing_stock <= 0 AS current_stockout
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store, product ORDER BY date DESC) AS newest
        FROM fact) WHERE newest = 1)"""
IMPACT_ROW = f"""{INVENTORY},
{LATEST},
impact_row AS (
  SELECT (SELECT COUNT(*) FROM latest) AS total_sku_store_pairs,
         (SELECT COUNT(*) FROM latest WHERE current_stockout) AS current_stockout_pairs,
         (SELECT SUM(stockout) FROM fact) AS historical_stockout_days,
         (SELECT SUM(lost_sales * sell_c) / 100.0 FROM fact) AS historical_lost_sales_value,
         (SELECT {r2('SUM(closing_stock * price_c * 60) / 10000.0')} FROM latest)
           AS current_inventory_value,
         (SELECT {r2('SUM(CAST(ROUND(recommended_order_qty * 100) AS BIGINT)) / 100.0')}
            FROM stock_table) AS recommended_replenishment_units,
         (SELECT COUNT(*) FROM stock_table WHERE inventory_status = 'CRITICAL')
           AS critical_inventory_pairs,
         (SELECT COUNT(*) FROM stock_table WHERE inventory_status = 'REORDER')
           AS reorder_inventory_pairs,
         (SELECT COUNT(*) FROM stock_table WHERE inventory_status = 'NORMAL')
           AS normal_inventory_pairs,
         (SELECT SUM(low_coverage_7d) FROM stock_table) AS low_coverage_pairs_7d)"""


def counts(levels: list[str], source: str, column: str, label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS measure, '{level}' AS level, "
        f"COUNT(*) AS row_count FROM {source} WHERE {column} = '{level}'" for level in levels)


RULE = "SELECT '{a}' AS artifact, '{r}' AS rule, {p} AS passed FROM {t}"


#: Every result table of the chain, present and whole wherever the fact has rows.
RESULT_TABLES = [
    "baseline_results", "boosted_results", "sku_30_day_forecast", "inventory_optimization",
    "supplier_risk", "disruption_detection", "disruption_model_comparison", "disruption_pca",
    "action_priorities", "business_impact", "finance_summary", "budget_vs_actual",
    "promotion_effectiveness", "abc_analysis", "supplier_stockout_impact", "feature_attribution"]
TABLE_RULES = ["is present", "has required columns", "is not empty"]


def rules(*entries: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(RULE.format(a=a, r=r, p=p, t=t) for a, r, p, t in entries)


KPI = f"""{RECURSION},
kpi AS (
  SELECT store, product, SUM(forecast_demand) / 30 AS forecast_mean,
         SUM(forecast_demand) AS forecast_total FROM ahead GROUP BY 1, 2)"""


def with_forecast(ctes: str) -> str:
    """The stock tables with the seasonal-naive forecast in place of the annual demand."""
    for old, new in (
            ("annual_demand / 365 AS forecast_daily_demand",
             "COALESCE(forecast_mean, annual_demand / 365) AS forecast_daily_demand"),
            ("annual_demand / 365 * 30 AS forecast_30_day_demand",
             "COALESCE(forecast_total, annual_demand / 365 * 30) AS forecast_30_day_demand"),
            ("FROM profile),\npolicy", "FROM profile LEFT JOIN kpi USING (store, product)),\npolicy"),
            ("CAST(NULL AS DOUBLE) AS average_30_day_forecast",
             "forecast_mean AS average_30_day_forecast"),
            ("CAST(NULL AS DOUBLE) AS total_30_day_forecast",
             "forecast_total AS total_30_day_forecast")):
        ctes = ctes.replace(old, new)
    return f"{KPI},\n{ctes}"


IMPACT_KPIS = (
    "total_sku_store_pairs:b current_stockout_pairs:b historical_stockout_days:b "
    "historical_lost_sales_value:d current_inventory_value:d recommended_replenishment_units:d "
    "critical_inventory_pairs:b reorder_inventory_pairs:b normal_inventory_pairs:b "
    "low_coverage_pairs_7d:b")


def both(name: str, columns: str, body: str, ctes: str) -> dict[str, str]:
    return {name: oracle(columns, body, with_forecast(ctes)),
            f"{name}_fallback": oracle(columns, body, ctes)}


ORACLES = {
    "inventory_profile": oracle(PROFILE_COLUMNS, "SELECT * FROM profile", PROFILE),
    **both("inventory_policy", POLICY_COLUMNS, "SELECT * FROM policy", POLICY),
    **both("economic_order_qty", ORDER_COLUMNS, "SELECT * FROM sized", POLICY),
    **both("inventory_status", STATUS_COLUMNS, "SELECT * FROM graded", POLICY),
    **both("inventory_optimization", STATUS_COLUMNS, "SELECT * FROM stock_table", INVENTORY),
    "inventory_status_summary": oracle(
        "inventory_status pairs:b current_stockouts:b low_coverage_pairs:b all_pairs:b "
        "mean_stockout_rate_pct:d",
        """SELECT inventory_status, COUNT(*) AS pairs,
                  (SELECT SUM(current_stockout) FROM stock_table) AS current_stockouts,
                  (SELECT SUM(low_coverage_7d) FROM stock_table) AS low_coverage_pairs,
                  (SELECT COUNT(*) FROM stock_table) AS all_pairs,
                  (SELECT 100 * AVG(historical_stockout_rate) FROM stock_table)
                    AS mean_stockout_rate_pct
           FROM stock_table GROUP BY 1""", with_forecast(INVENTORY)),

    "supplier_metrics": oracle(METRIC_COLUMNS, "SELECT * FROM service", METRICS),
    "supplier_risk_score": oracle(RISK_COLUMNS, "SELECT * FROM risk", RISK),
    "supplier_risk_report": oracle(RISK_COLUMNS, "SELECT * FROM risk", RISK),

    "temporal_daily": oracle(DAY_COLUMNS, "SELECT * FROM signals_daily", TEMPORAL),
    "temporal_baseline": oracle(BASE_COLUMNS, "SELECT * FROM changed", TEMPORAL),
    "temporal_pct_change": oracle(PCT_COLUMNS, "SELECT * FROM relative", TEMPORAL),
    "disruption_signal": oracle(f"{PCT_COLUMNS} disruption_signal:d",
                                "SELECT * FROM signalled", TEMPORAL),
    "disruption_stage": oracle(STAGE_COLUMNS, "SELECT * FROM staged", TEMPORAL),
    "disruption_timeline": oracle(
        "supplier product date disruption_signal:d",
        """SELECT * FROM staged
           WHERE supplier = (SELECT MIN(supplier) FROM fact)
             AND product = (SELECT MIN(product) FROM fact
                            WHERE supplier = (SELECT MIN(supplier) FROM fact))""", TEMPORAL),

    **both("action_priorities", ACTION_COLUMNS, "SELECT * FROM advised", ACTIONS),
    "priority_counts": oracle(
        "priority row_count:b",
        "SELECT level AS priority, row_count FROM ("
        + counts(["URGENT", "HIGH", "MEDIUM", "LOW"], "advised", "priority", "p") + ")",
        with_forecast(ACTIONS)),
    "latest_state": oracle(
        "store product date closing_stock:b unit_price:d current_stockout",
        "SELECT * FROM latest", LATEST),
    **both("business_impact", IMPACT_KPIS, "SELECT * FROM impact_row", IMPACT_ROW),

    "validate_finance": oracle(
        "artifact rule passed",
        rules(("finance_summary", "revenue is positive", "revenue > 0", "kpi"),
              ("finance_summary", "cogs is not negative", "cogs >= 0", "kpi"),
              ("finance_summary", "gross profit is revenue minus cogs",
               "ABS((revenue - cogs) - (SELECT SUM(units_sold * (100 * sell_c - 60 * price_c)) "
               "/ 10000.0 FROM fact)) < 0.01", "kpi"),
              ("finance_summary", "gross margin is between 0 and 100",
               "(revenue - cogs) * 100 / revenue BETWEEN 0 AND 100", "kpi"),
              ("finance_summary", "turnover and days of inventory are not negative",
               "turnover >= 0", "kpi")), SUMMARY),
    "validate_abc_impact": oracle(
        "artifact rule passed",
        rules(("abc_analysis", "classes are A, B or C", "COUNT(*) FILTER (WHERE abc_class NOT IN "
               "('A', 'B', 'C')) = 0", "abc"),
              ("business_impact", "pair count is as expected",
               "total_sku_store_pairs = (SELECT COUNT(*) FROM profile)", "impact_row"),
              ("business_impact", "values are not negative",
               "historical_lost_sales_value >= 0 AND current_inventory_value >= 0",
               "impact_row")), with_forecast(f"{IMPACT_ROW},\n{ABC}")),

    "validate_schemas": oracle(
        "artifact rule passed detail",
        f"""SELECT artifact, rule, (SELECT COUNT(*) FROM fact) > 0 AS passed, '' AS detail
            FROM (SELECT UNNEST({RESULT_TABLES}) AS artifact),
                 (SELECT UNNEST({TABLE_RULES}) AS rule)"""),
    "validate_disruption": oracle(
        "artifact rule passed detail",
        """SELECT 'disruption_detection' AS artifact, rule, (SELECT COUNT(*) FROM fact) > 0 AS passed,
                  '' AS detail
           FROM (SELECT UNNEST(['score is between 0 and 100', 'status is NORMAL or ANOMALY'])
                   AS rule)"""),

    "kpi_strip_without_disruption": oracle(
        "store_product_pairs:b high_priority:b critical_inventory:b reorder_inventory:b "
        "high_risk_suppliers:b critical_disruptions:b",
        """SELECT COUNT(*) AS store_product_pairs,
                  COUNT(*) FILTER (WHERE priority IN ('HIGH', 'URGENT')) AS high_priority,
                  COUNT(*) FILTER (WHERE inventory_status = 'CRITICAL') AS critical_inventory,
                  COUNT(*) FILTER (WHERE inventory_status = 'REORDER') AS reorder_inventory,
                  (SELECT COUNT(*) FROM risk WHERE risk_level = 'HIGH') AS high_risk_suppliers,
                  0 AS critical_disruptions FROM advised""", with_forecast(ACTIONS)),
    "action_view": oracle(
        "priority action store product category supplier inventory_status days_of_stock:d "
        "shortage_to_rop:d recommended_order_qty:d average_30_day_forecast:d risk_level",
        "SELECT * FROM advised WHERE store = 'ASIA' AND priority = 'MEDIUM'",
        with_forecast(ACTIONS)),
    "level_counts": oracle(
        "measure level row_count:b",
        counts(["A", "B", "C"], "abc", "abc_class", "abc_class") + " UNION ALL "
        + counts(["LOW", "MEDIUM", "HIGH"], "risk", "risk_level", "risk_level"),
        f"{RISK},\n{ABC}"),
    "score_histogram": oracle(
        "bin:i bin_from:d bin_to:d row_count:b",
        """SELECT n AS bin, CASE n WHEN 1 THEN lo - 0.001 * (hi - lo)
                                 ELSE lo + (n - 1) * ((hi - lo) / 10) END AS bin_from,
                  lo + n * ((hi - lo) / 10) AS bin_to,
                  COUNT(raw) AS row_count
           FROM (SELECT UNNEST(RANGE(1, 11)) AS n) b
           CROSS JOIN (SELECT MIN(raw) AS lo, MAX(raw) AS hi FROM scored) e
           LEFT JOIN scored ON (n = 1 OR raw > lo + (n - 1) * ((hi - lo) / 10))
                           AND (n = 10 OR raw <= lo + n * ((hi - lo) / 10))
           GROUP BY n, lo, hi""", RISK),
    "top_exposure": oracle(IMPACT_COLUMNS, """
        SELECT * FROM impact ORDER BY lost_sales_value DESC, supplier LIMIT 10""", IMPACT),
    "top_revenue_products": oracle(ABC_COLUMNS, """
        SELECT * FROM abc ORDER BY revenue DESC, product LIMIT 30""", ABC),
}
