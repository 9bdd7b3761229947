"""Rules over the result tables: one row (artifact, rule, passed, detail) per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.features import SERIES
from shelfwise.operators.forecast import SEASONAL_NAIVE

Artifacts = dict[str, DataFrame]

# Fixed contract: required columns of each result table.
CONTRACT = {
    "baseline_results": ["model", "MAE", "RMSE", "MAPE", "sku_store_pairs"],
    "boosted_results": ["model", "MAE", "RMSE", "MAPE", "sku_store_pairs"],
    "sku_30_day_forecast": ["date", "store", "product", "forecast_demand"],
    "inventory_optimization": ["store", "product", "inventory_status"],
    "supplier_risk": ["supplier", "risk_score", "risk_level"],
    "disruption_detection": ["supplier", "cluster", "anomaly_status", "anomaly_score",
                             "disruption_score", "disruption_level"],
    "disruption_model_comparison": ["model", "parameters", "silhouette", "davies_bouldin",
                                    "calinski_harabasz"],
    "disruption_pca": ["supplier", "cluster", "pc1", "pc2"],
    "action_priorities": ["store", "product", "priority", "action"],
    "business_impact": ["total_sku_store_pairs", "current_stockout_pairs",
                        "historical_lost_sales_value"],
    "finance_summary": ["revenue", "cogs", "gross_profit", "gross_margin_pct",
                        "inventory_turnover", "days_inventory_outstanding",
                        "annual_holding_cost"],
    "budget_vs_actual": ["month", "actual_revenue", "budget_revenue", "revenue_variance",
                         "revenue_variance_pct", "actual_cogs", "budget_cogs"],
    "promotion_effectiveness": ["promo_event", "days", "units_sold", "revenue",
                                "conversion_pct"],
    "abc_analysis": ["product", "category", "revenue", "revenue_share_pct",
                     "cumulative_share_pct", "abc_class"],
    "supplier_stockout_impact": ["supplier", "lost_sales_units", "lost_sales_value",
                                 "stockout_days"],
    "feature_attribution": ["feature", "mean_abs_shap"],
}


def _stack(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _known(spark: SparkSession, artifact: str, rule: str, passed: bool, detail: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(  # one row, one partition
        F.lit(artifact).alias("artifact"), F.lit(rule).alias("rule"),
        F.lit(passed).alias("passed"), F.lit(detail).alias("detail"))


def _rules(one_row: DataFrame, artifact: str, rules: dict[str, Column],
           detail: Column | None = None) -> DataFrame:
    """Turn a one-row table into one row per rule; a NULL outcome counts as failed."""
    note = F.lit("") if detail is None else detail.cast("string")
    listed = F.array(*[
        F.struct(F.lit(artifact).alias("artifact"), F.lit(rule).alias("rule"),
                 F.coalesce(passed, F.lit(False)).alias("passed"), note.alias("detail"))
        for rule, passed in rules.items()])
    return one_row.select(F.explode(listed).alias("r")).select("r.*")


def validate_schemas(spark: SparkSession, artifacts: Artifacts) -> DataFrame:
    """Every contracted table is present, has its columns and is not empty."""
    rows = []
    for name, required in CONTRACT.items():
        table = artifacts.get(name)
        rows.append(_known(spark, name, "is present", table is not None, ""))
        if table is None:
            continue
        missing = [c for c in required if c not in table.columns]
        rows.append(_known(spark, name, "has required columns", not missing, ", ".join(missing)))
        head = table.limit(1).agg(F.count(F.lit(1)).alias("n"))
        rows.append(_rules(head, name, {"is not empty": F.col("n") > 0}))
    return _stack(rows)


def validate_forecast(artifacts: Artifacts, expected_pairs: int) -> DataFrame:
    """The boosted model beats the seasonal-naive one on every metric and covers all pairs."""
    metrics = ["MAE", "RMSE", "MAPE"]
    seasonal = artifacts["baseline_results"].where(F.col("model") == SEASONAL_NAIVE).agg(
        F.struct(*[F.first(m).alias(m) for m in metrics])).scalar()
    covered = artifacts["sku_30_day_forecast"].select(*SERIES).distinct().agg(
        F.count(F.lit(1))).scalar()
    boosted = artifacts["boosted_results"].limit(1)
    better = reduce(Column.__and__, [F.col(m) < seasonal[m] for m in metrics])
    pairs = F.col("sku_store_pairs")
    return _stack([
        _rules(boosted, "boosted_results", {
            "beats the seasonal-naive model on MAE, RMSE and MAPE": better,
            "pair count is as expected": pairs == expected_pairs}, pairs),
        _rules(boosted.withColumn("_covered", covered), "sku_30_day_forecast", {
            "covers the pairs of the model": F.col("_covered") == pairs}, F.col("_covered")),
    ])


def validate_disruption(artifacts: Artifacts) -> DataFrame:
    counts = artifacts["disruption_detection"].agg(
        F.count_if(~F.coalesce(F.col("disruption_score").between(0, 100), F.lit(False)))
        .alias("out_of_range"),
        F.count_if(~F.coalesce(F.col("anomaly_status").isin("NORMAL", "ANOMALY"), F.lit(False)))
        .alias("unknown"))
    return _rules(counts, "disruption_detection", {
        "score is between 0 and 100": F.col("out_of_range") == 0,
        "status is NORMAL or ANOMALY": F.col("unknown") == 0})


def validate_finance(artifacts: Artifacts) -> DataFrame:
    """KPIs reconcile; profit is compared exactly because money is decimal."""
    return _rules(artifacts["finance_summary"].limit(1), "finance_summary", {
        "revenue is positive": F.col("revenue") > 0,
        "cogs is not negative": F.col("cogs") >= 0,
        "gross profit is revenue minus cogs":
            F.col("gross_profit") == F.col("revenue") - F.col("cogs"),
        "gross margin is between 0 and 100": F.col("gross_margin_pct").between(0, 100),
        "turnover and days of inventory are not negative":
            (F.col("inventory_turnover") >= 0) & (F.col("days_inventory_outstanding") >= 0)})


def validate_abc_impact(artifacts: Artifacts, expected_pairs: int | Column) -> DataFrame:
    unknown = artifacts["abc_analysis"].agg(
        F.count_if(~F.col("abc_class").isin("A", "B", "C")).alias("unknown"))
    return _stack([
        _rules(unknown, "abc_analysis", {"classes are A, B or C": F.col("unknown") == 0}),
        _rules(artifacts["business_impact"].limit(1), "business_impact", {
            "pair count is as expected": F.col("total_sku_store_pairs") == expected_pairs,
            "values are not negative": (F.col("historical_lost_sales_value") >= 0)
            & (F.col("current_inventory_value") >= 0)}),
    ])


def validation_report(spark: SparkSession, artifacts: Artifacts,
                      expected_pairs: int) -> DataFrame:
    """All rules; the value rules only once every table is present, complete and not empty."""
    schemas = validate_schemas(spark, artifacts)
    if not schemas.where(~F.col("passed")).isEmpty():
        return schemas
    return _stack([schemas, validate_forecast(artifacts, expected_pairs),
                   validate_disruption(artifacts), validate_finance(artifacts),
                   validate_abc_impact(artifacts, expected_pairs)])


def require_valid(report: DataFrame) -> DataFrame:
    """Fail once with every broken rule (the number of rules is fixed)."""
    broken = report.where(~F.col("passed")).select("artifact", "rule", "detail").collect()
    if broken:
        raise ValueError("; ".join(f"{r.artifact}: {r.rule} {r.detail}".strip() for r in broken))
    return report
