"""Finance, stock policy, supplier and temporal edges on small hand-made frames."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import actions, finance, inventory, supplier, temporal, validation, views


def test_budget_first_month_and_zero_month(spark):
    rows = [(date(2024, 1, 5), "100.00", 1, "50.00"), (date(2024, 2, 5), "0.00", 0, "50.00"),
            (date(2024, 3, 5), "80.00", 2, "50.00")]
    df = spark.createDataFrame(
        [(d, Decimal(r), u, Decimal(p), 1, 0, Decimal(p)) for d, r, u, p in rows],
        "date date, revenue decimal(18,2), units_sold long, unit_price decimal(12,2), "
        "closing_stock long, lost_sales long, sell_price decimal(12,2)")
    jan, feb, mar = finance.budget_vs_actual(df).collect()
    assert (jan.budget_revenue, jan.revenue_variance, jan.budget_cogs) == (100, 0, 30)
    assert (float(feb.budget_revenue), feb.revenue_variance_pct) == (105.0, -100.0)
    assert (float(feb.budget_cogs), float(feb.cogs_variance)) == (30.9, -30.9)
    assert feb.margin_variance_pct == 0  # no revenue: the missing margin becomes zero
    assert (mar.budget_revenue, mar.revenue_variance_pct) == (0, 0)


def test_summary_of_nothing_sold(spark):
    df = spark.createDataFrame(
        [(Decimal("0.00"), 0, Decimal("5.00"), 0, 0, Decimal("5.00"))],
        "revenue decimal(18,2), units_sold long, unit_price decimal(12,2), closing_stock long, "
        "lost_sales long, sell_price decimal(12,2)")
    row = finance.finance_summary(df).first()
    assert (row.gross_margin_pct, row.inventory_turnover, row.days_inventory_outstanding) == (
        0, 0, 0)


def test_abc_boundaries_and_ties(spark, many_slices):
    revenue = {"p1": 50, "p2": 15, "p3": 15, "p4": 15, "p5": 5}
    df = spark.createDataFrame([("c", p, Decimal(r)) for p, r in revenue.items()],
                               "category string, product string, revenue decimal(18,2)")
    got = [(r["product"], r.cumulative_share_pct, r.abc_class)
           for r in finance.abc_analysis(df).collect()]
    assert got == [("p1", 50.0, "A"), ("p2", 65.0, "A"), ("p3", 80.0, "A"), ("p4", 95.0, "B"),
                   ("p5", 100.0, "C")]


def policy_rows(spark, stocks):
    return spark.createDataFrame(
        [("s", f"p{i}", stock, 10.0, 30.0, 2.0, 60.0, 100.0, 365.0)
         for i, stock in enumerate(stocks)],
        "store string, product string, current_stock long, safety_stock double, "
        "reorder_point double, forecast_daily_demand double, forecast_30_day_demand double, "
        "unit_price double, annual_demand double")


def test_status_boundaries(spark):
    table = inventory.inventory_status(
        inventory.economic_order_qty(policy_rows(spark, [0, 10, 11, 30, 31])))
    got = [(r.inventory_status, r.shortage_to_rop, r.current_stockout, r.low_coverage_7d,
            r.recommended_order_qty) for r in table.orderBy("product").collect()]
    assert got == [("CRITICAL", 30.0, 1, 1, 60.0), ("CRITICAL", 20.0, 0, 1, 60.0),
                   ("REORDER", 19.0, 0, 1, 60.0), ("REORDER", 0.0, 0, 0, 60.0),
                   ("NORMAL", 0.0, 0, 0, 0.0)]


def test_policy_fills_forecast_and_deviation(spark):
    profile = spark.createDataFrame(
        [("s", "a", 365.0, 2.0, 4.0), ("s", "b", 730.0, None, 0.5), ("s", "c", 365.0, 6.0, 4.0)],
        "store string, product string, annual_demand double, demand_std double, "
        "lead_time_days double")
    kpi = spark.createDataFrame([("s", "a", 5.0, 150.0)],
                                "store string, product string, forecast_daily_demand double, "
                                "forecast_30_day_demand double")
    a, b, c = inventory.inventory_policy(profile, kpi).orderBy("product").collect()
    assert (a.forecast_daily_demand, a.forecast_30_day_demand) == (5.0, 150.0)
    assert (b.forecast_daily_demand, b.forecast_30_day_demand, b.demand_std) == (2.0, 60.0, 4.0)
    assert b.safety_stock == pytest.approx(1.645 * 4.0)  # lead time counts as one day at least
    assert a.reorder_point == pytest.approx(5.0 * 4 + 1.645 * 2 * 2)


def test_supplier_score_boundaries(spark):
    # Nothing ordered counts as one; scores exactly 10 and 20 stay in the lower level.
    rows = [("a", 75.0, 0.0, 100.0), ("b", 50.0, 0.0, 100.0), ("c", 49.9, 0.0, 100.0)]
    df = spark.createDataFrame(
        [(s, 3.0, t, d, f) for s, t, d, f in rows],
        "supplier string, average_lead_time double, on_time_percentage double, "
        "defect_percentage double, fill_percentage double")
    got = [(r.supplier, r.risk_score, r.risk_level)
           for r in supplier.supplier_risk_report(supplier.supplier_risk_score(df)).collect()]
    assert got == [("c", 20.04, "HIGH"), ("b", 20.0, "MEDIUM"), ("a", 10.0, "LOW")]


def test_zero_orders(spark):
    df = spark.createDataFrame([("u", 3, 0.9, 0.01, 0, 0, 7)],
                               "supplier string, lead_time_days int, on_time_rate double, "
                               "defect_rate double, supplier_delay int, ordered_qty long, "
                               "received_qty long")
    assert supplier.supplier_metrics(df).first()["fill_rate"] == 7.0


def test_temporal_baseline_needs_five_rows(spark):
    rows = [("u", "p", date(2024, 1, 1) + timedelta(days=i), 4.0 if i < 19 else 40.0, 0.9, 0.0,
             10, 10 if i < 19 else 0, 5, 0.0) for i in range(20)]
    daily = spark.createDataFrame(
        rows, "supplier string, product string, date date, lead_time double, on_time double, "
              "defect_rate double, ordered long, received long, demand long, stockout double"
    ).withColumn("fill_rate", F.col("received") / F.col("ordered"))
    based = temporal.temporal_baseline(daily).orderBy("date").collect()
    assert [r.lead_time_baseline is None for r in based[:7]] == [True] * 5 + [False] * 2
    staged = temporal.disruption_stage(temporal.disruption_signal(
        temporal.temporal_pct_change(temporal.temporal_baseline(daily)))).orderBy("date").collect()
    assert (staged[0].disruption_signal, staged[0].disruption_stage) == (0.0, "NORMAL")
    assert staged[0].lead_time_baseline == 0 and staged[18].defect_pct_change == 0
    last = staged[19]  # lead time ten-fold: 315, plus 25 for fill, clipped
    assert (last.disruption_signal, last.disruption_stage, last.is_disruption) == (
        100.0, "CRITICAL", True)


def test_stage_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (20.0, 20.1, 40.0, 70.0, 70.1)],
                               "disruption_signal double")
    got = [(r.disruption_stage, r.is_disruption) for r in temporal.disruption_stage(df).collect()]
    assert got == [("NORMAL", False), ("EARLY_WARNING", False), ("EARLY_WARNING", False),
                   ("EMERGING", True), ("CRITICAL", True)]


def test_priorities_and_counts(spark):
    stock = spark.createDataFrame(
        [("s", "a", "u1", "CRITICAL", 1.0), ("s", "b", "u2", "CRITICAL", 9.0),
         ("s", "c", "u1", "REORDER", 5.0), ("s", "d", "none", "NORMAL", 0.0)],
        "store string, product string, supplier string, inventory_status string, "
        "shortage_to_rop double")
    risk = spark.createDataFrame([("u1", "HIGH"), ("u2", "LOW")],
                                 "supplier string, risk_level string")
    table = actions.action_priorities(stock, risk)
    assert [(r["product"], r.priority) for r in table.collect()] == [
        ("a", "URGENT"), ("b", "HIGH"), ("c", "MEDIUM"), ("d", "LOW")]
    only = actions.priority_counts(table.where(F.col("priority") == "LOW")).collect()
    assert [tuple(r) for r in only] == [("URGENT", 0), ("HIGH", 0), ("MEDIUM", 0), ("LOW", 1)]


def test_impact_falls_back_to_list_price(spark):
    df = spark.createDataFrame(
        [("s", "p", date(2024, 1, 1), 5, 2, Decimal("10.00"), 4),
         ("s", "p", date(2024, 1, 2), 5, 0, Decimal("10.00"), 0)],
        "store string, product string, date date, demand long, lost_sales long, "
        "unit_price decimal(12,2), closing_stock long")
    row = actions.business_impact(df).first()
    assert (row.historical_lost_sales_value, row.historical_stockout_days) == (20, 1)
    assert (row.current_stockout_pairs, row.current_inventory_value) == (1, 0)
    assert "low_coverage_pairs_7d" not in row.asDict()


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    rows = views.score_histogram(df, "x").collect()
    assert [r.row_count for r in rows] == [2] + [1] * 9  # right-closed, minimum included
    assert rows[0].bin_from == pytest.approx(-0.01) and rows[9].bin_to == 10.0
    flat = views.score_histogram(df.select(F.lit(5.0).alias("x")), "x").collect()
    assert sum(r.row_count for r in flat) == 11
    assert (flat[0].bin_from, flat[9].bin_to) == (4.995, 5.005)


def test_benchmark_keeps_the_first_table(spark):
    a = spark.createDataFrame([("m", 2.0, 1.0, 1.0), ("n", 1.0, 1.0, 1.0)],
                              "model string, MAE double, RMSE double, MAPE double")
    b = a.withColumn("MAE", F.lit(0.5))
    assert [(r.model, r.MAE) for r in views.model_benchmark(a, b).collect()] == [
        ("n", 1.0), ("m", 2.0)]


def test_validation_lists_every_failure(spark):
    good = spark.createDataFrame(
        [(10.0, 4.0, 6.0, 60.0, 1.0, 365.0)],
        "revenue double, cogs double, gross_profit double, gross_margin_pct double, "
        "inventory_turnover double, days_inventory_outstanding double")
    assert validation.validate_finance({"finance_summary": good}).where(~F.col("passed")).isEmpty()
    bad = good.withColumn("gross_profit", F.lit(5.0)).withColumn("cogs", F.lit(None).cast("double"))
    failed = validation.validate_finance({"finance_summary": bad}).where(~F.col("passed"))
    assert failed.count() == 2
    with pytest.raises(ValueError, match="cogs is not negative.*gross profit is revenue"):
        validation.require_valid(validation.validate_finance({"finance_summary": bad}))
    report = validation.validation_report(spark, {"finance_summary": good}, 1)
    missing = report.where((F.col("rule") == "is present") & ~F.col("passed")).count()
    assert missing == len(validation.CONTRACT) - 1
