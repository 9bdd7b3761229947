"""Schemas of the daily fact and of the star tables, and the ordered level names."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
REVENUE = T.DecimalType(18, 2)

FACT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("supplier", T.StringType()),
    T.StructField("unit_price", MONEY),
    T.StructField("discount_pct", T.IntegerType()),
    T.StructField("sell_price", MONEY),
    T.StructField("demand", T.LongType()),
    T.StructField("units_sold", T.LongType()),
    T.StructField("lost_sales", T.LongType()),
    T.StructField("revenue", REVENUE),
    T.StructField("opening_stock", T.LongType()),
    T.StructField("closing_stock", T.LongType()),
    T.StructField("reorder_point", T.LongType()),
    T.StructField("reorder_qty", T.LongType()),
    T.StructField("reordered", T.IntegerType()),
    T.StructField("ordered_qty", T.LongType()),
    T.StructField("received_qty", T.LongType()),
    T.StructField("stockout", T.IntegerType()),
    T.StructField("promo_event", T.IntegerType()),
    T.StructField("lead_time_days", T.IntegerType()),
    T.StructField("on_time_rate", T.DoubleType()),
    T.StructField("defect_rate", T.DoubleType()),
    T.StructField("supplier_delay", T.IntegerType()),
])

# The 20 columns of the fact that must hold numbers.
NUMERIC = [f.name for f in FACT.fields if isinstance(f.dataType, T.NumericType)]

STAR_TABLES = ["stores", "suppliers", "products", "sales", "inventory"]

# Fixed level names, worst first unless noted.
PRIORITIES = ["URGENT", "HIGH", "MEDIUM", "LOW"]
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
DISRUPTION_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ABC_CLASSES = ["A", "B", "C"]
