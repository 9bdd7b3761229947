"""Map the order tables (lineitem, orders, customer, ...) onto the daily retail fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.sources.schema import FACT


def daily_fact_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (store, product, date); integer arithmetic only, so the result is exact."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    part, supplier = table("part"), table("supplier")
    # Product names are two words of a fixed vocabulary: a few dozen rows at any scale.
    names = part.groupBy(F.col("p_name").alias("product")).agg(
        F.min(F.round(F.col("p_retailprice") * 100).cast("long")).alias("unit_price_cents")
    ).withColumn("pidx", F.row_number().over(W.orderBy("product")).cast("long") - 1)
    supplier_count = supplier.agg(F.count(F.lit(1))).scalar()
    products = names.withColumn("suppkey", F.col("pidx") % supplier_count).join(
        supplier.select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("supplier")),
        "suppkey",
    )

    placed = (
        table("orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
        .join(table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
              "o_custkey")
        .join(table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
              "c_nationkey")
        .join(table("region").select(F.col("r_regionkey").alias("n_regionkey"),
                                     F.col("r_name").alias("store")), "n_regionkey")
        .select("orderkey", "store", F.col("n_regionkey").cast("long").alias("skey"))
    )
    lines = table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber")).alias("mix"),
    )
    daily = (
        lines.join(placed, "orderkey")
        .join(part.select(F.col("p_partkey").alias("partkey"), F.col("p_name").alias("product")),
              "partkey")
        .groupBy("date", "store", "skey", "product")
        .agg(F.sum("quantity").alias("demand"),
             F.max("discount").alias("discount_pct"),
             (F.sum("mix") % 1000).alias("k"))
    )
    flags = daily.join(products, "product").withColumn(
        "stockout", (F.col("k") % 5 == 0).cast("int")
    ).withColumns({
        "lost_sales": F.when(F.col("stockout") == 1,
                             F.greatest(F.lit(1).cast("long"), F.expr("demand div 3")))
        .otherwise(F.lit(0).cast("long")),
        "closing_stock": F.when(F.col("stockout") == 1, F.lit(0).cast("long"))
        .otherwise(F.col("k")),
        "reorder_point": 120 + (F.col("pidx") * 7 + F.col("skey") * 13) % 80,
        "reorder_qty": 250 + (F.col("pidx") * 11 + F.col("skey") * 17) % 250,
        "sell_price_cents": F.expr("(unit_price_cents * (100 - discount_pct) + 50) div 100"),
    }).withColumns({
        "units_sold": F.col("demand") - F.col("lost_sales"),
        "reordered": (F.col("closing_stock") <= F.col("reorder_point")).cast("int"),
    })
    money = lambda cents: cents.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
    columns = {
        "category": F.split("product", " ")[1],
        "unit_price": money(F.col("unit_price_cents")),
        "sell_price": money(F.col("sell_price_cents")),
        "revenue": money(F.col("units_sold") * F.col("sell_price_cents")),
        "opening_stock": F.col("closing_stock") + F.col("units_sold"),
        "ordered_qty": F.col("reordered") * F.col("reorder_qty"),
        "received_qty": F.when(F.col("k") % 4 == 0, F.col("reorder_qty"))
        .otherwise(F.lit(0).cast("long")),
        "promo_event": (F.col("discount_pct") >= 10).cast("int"),
        "lead_time_days": 3 + F.col("suppkey") % 8 + F.when(F.col("k") % 11 == 0, 2).otherwise(0),
        "on_time_rate": (85 + F.col("suppkey") % 15) / 100.0,
        "defect_rate": (1 + F.col("suppkey") % 8) / 100.0,
        "supplier_delay": F.when((F.col("reordered") == 1) & (F.col("k") % 7 == 0), 1).otherwise(0),
    }
    full = flags.withColumns(columns)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT.fields])
