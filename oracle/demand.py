"""Oracle SQL for demand features, baselines, folds and the recursion with the naive model."""

from __future__ import annotations

from oracle.base import oracle

DAILY = """daily AS (
  SELECT store, product, category, date, SUM(demand) AS demand, SUM(promo_event) AS promo_event,
         AVG(discount_pct) AS discount_pct, SUM(price_c) / 100.0 / COUNT(*) AS unit_price
  FROM fact GROUP BY 1, 2, 3, 4)"""
NETWORK = """network AS (
  SELECT date, SUM(demand) AS demand, SUM(promo_event) AS promo_event,
         AVG(discount_pct) AS average_discount FROM fact GROUP BY 1)"""


def features(source: str, name: str, partition: str = "PARTITION BY store, product") -> str:
    """CTE with lags, rolling figures and calendar columns of a daily table."""
    over = f"OVER ({partition} ORDER BY date"
    lags = ", ".join(f"LAG(demand, {n}) {over}) AS lag_{n}" for n in (1, 7, 14, 30))
    rolled = ", ".join(
        f"CASE WHEN COUNT(demand) {over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} "
        f"THEN {f}(demand) {over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS {c}"
        for f, n, c in (("AVG", 7, "rolling_mean_7"), ("AVG", 30, "rolling_mean_30"),
                        ("STDDEV_SAMP", 7, "rolling_std_7")))
    return f"""{name} AS (
  SELECT *, {lags}, {rolled}, ISODOW(date) - 1 AS day_of_week, MONTH(date) AS month,
         DAY(date) AS day_of_month, CASE WHEN ISODOW(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         COUNT(*) OVER ({partition}) AS history
  FROM {source})"""


FEATURE_COLUMNS = ("lag_1:b lag_7:b lag_14:b lag_30:b rolling_mean_7:d rolling_mean_30:d "
                   "rolling_std_7:d day_of_week:i month:i day_of_month:i is_weekend:i "
                   "promo_event:b")
SERIES_COLUMNS = "store product category date demand:b unit_price:d discount_pct:d"
TRAINING = ("training AS (SELECT * FROM featured WHERE history > 60 AND lag_30 IS NOT NULL "
            "AND rolling_mean_30 IS NOT NULL AND rolling_std_7 IS NOT NULL)")
FEATURED = f"{DAILY},\n{features('daily', 'featured')}"

NAIVE = f"""{DAILY},
lagged AS (
  SELECT *, LAG(demand, 1) OVER w AS lag_1, LAG(demand, 7) OVER w AS lag_7 FROM daily
  WINDOW w AS (PARTITION BY store, product ORDER BY date)),
scorable AS (SELECT * FROM lagged WHERE lag_7 IS NOT NULL),
held AS (SELECT * FROM scorable WHERE date > (SELECT MAX(date) FROM scorable) - 60),
errors AS (
  SELECT 'SKU Naive-1-Day' AS model, demand AS y, lag_1 AS p FROM held
  UNION ALL SELECT 'SKU Seasonal-Naive-7-Day', demand, lag_7 FROM held),
metrics AS (
  SELECT model, AVG(ABS(y - p)) AS "MAE", SQRT(AVG((y - p) * (y - p))) AS "RMSE",
         COALESCE(100.0 * AVG(ABS((y - p) / CAST(y AS DOUBLE))) FILTER (WHERE y <> 0), 0) AS "MAPE"
  FROM errors GROUP BY model)"""

RECURSION = f"""{DAILY},
newest AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY store, product ORDER BY date DESC) AS age,
         COUNT(*) OVER (PARTITION BY store, product) AS history FROM daily),
ahead AS (
  SELECT CAST(l.date + h.step AS DATE) AS date, l.store, l.product, l.category, l.unit_price,
         CAST(w.demand AS DOUBLE) AS forecast_demand
  FROM newest l CROSS JOIN (SELECT UNNEST(RANGE(1, 31))::INTEGER AS step) h
  JOIN newest w ON w.store = l.store AND w.product = l.product
               AND w.age = 7 - (h.step - 1) % 7
  WHERE l.age = 1 AND l.history >= 30)"""

FOLDS = f"""{NETWORK},
{features('network', 'featured', '')},
usable AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS n, COUNT(*) OVER () AS total
           FROM featured WHERE lag_30 IS NOT NULL),
bounds AS (
  SELECT f.fold, b.first, b.size, b.total,
         b.first + (f.fold - 1) * b.size AS train_end,
         LEAST(b.total, b.first + f.fold * b.size) AS test_end
  FROM (SELECT UNNEST(RANGE(1, 5)) AS fold) f,
       (SELECT DISTINCT total, CAST(FLOOR(total * 0.6) AS BIGINT) AS first,
               GREATEST(1, (total - CAST(FLOOR(total * 0.6) AS BIGINT)) // 4) AS size
        FROM usable) b)"""

ORACLES = {
    "daily_demand": oracle("store product date demand:b", "SELECT * FROM daily", DAILY),
    "daily_demand_drivers": oracle(SERIES_COLUMNS + " promo_event:b", "SELECT * FROM daily", DAILY),
    "network_daily_demand": oracle("date demand:b promo_event:b average_discount:d",
                                   "SELECT * FROM network", NETWORK),
    "demand_lags": oracle("store product date demand:b lag_1:b lag_7:b lag_14:b lag_30:b",
                          "SELECT * FROM featured", FEATURED),
    "demand_rolling": oracle(
        "store product date demand:b rolling_mean_7:d rolling_mean_30:d rolling_std_7:d",
        "SELECT * FROM featured", FEATURED),
    "calendar_features": oracle(
        "store product date demand:b day_of_week:i month:i day_of_month:i is_weekend:i",
        "SELECT * FROM featured", FEATURED),
    "forecast_training_set": oracle(f"{SERIES_COLUMNS} {FEATURE_COLUMNS}",
                                    "SELECT * FROM training", f"{FEATURED},\n{TRAINING}"),
    "temporal_split": oracle(
        "store product date demand:b split",
        """SELECT *, CASE WHEN date > (SELECT MAX(date) FROM training) - 60 THEN 'test'
                          ELSE 'train' END AS split FROM training""", f"{FEATURED},\n{TRAINING}"),
    "forecast_metrics": oracle("model MAE:d RMSE:d MAPE:d", """
        SELECT * FROM metrics WHERE model = 'SKU Seasonal-Naive-7-Day'""", NAIVE),
    "naive_baselines": oracle(
        "model MAE:d RMSE:d MAPE:d sku_store_pairs:b",
        """SELECT *, (SELECT COUNT(*) FROM (SELECT DISTINCT store, product FROM scorable))
             AS sku_store_pairs FROM metrics""", NAIVE),
    "recursive_forecast_naive": oracle(
        "date store product category forecast_demand:d unit_price:d", "SELECT * FROM ahead",
        RECURSION),
    "walk_forward_folds": oracle(
        f"fold:i role date demand:b average_discount:d {FEATURE_COLUMNS}",
        """SELECT u.*, b.fold, CASE WHEN u.n <= b.train_end THEN 'train' ELSE 'test' END AS role
           FROM usable u JOIN bounds b ON u.n <= b.test_end AND b.test_end > b.train_end""",
        FOLDS),
    "pair_coverage": oracle("sku_store_pairs:b", """
        SELECT COUNT(*) AS sku_store_pairs FROM (SELECT DISTINCT store, product FROM fact)"""),
    "forecast_pairs": oracle("store product", "SELECT DISTINCT store, product FROM ahead",
                             RECURSION),
    "forecast_totals": oracle(
        "store product total_forecast:d average_forecast:d",
        """SELECT store, product, SUM(forecast_demand) AS total_forecast,
                  AVG(forecast_demand) AS average_forecast FROM ahead GROUP BY 1, 2""", RECURSION),
    "forecast_kpi": oracle(
        "store product forecast_daily_demand:d forecast_30_day_demand:d",
        """SELECT store, product, SUM(forecast_demand) / 30 AS forecast_daily_demand,
                  SUM(forecast_demand) AS forecast_30_day_demand FROM ahead GROUP BY 1, 2""",
        RECURSION),
    "model_benchmark": oracle("model MAE:d RMSE:d MAPE:d", "SELECT * FROM metrics", NAIVE),
}
