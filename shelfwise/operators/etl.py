"""Derive the star schema from the daily fact and load it all or nothing."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.jobs import side_by_side
from shelfwise.functions.ordering import number_rows
from shelfwise.functions.storage import materialise
from shelfwise.functions.versions import Versions
from shelfwise.operators.quality import coerce_numeric, require_clean
from shelfwise.sources.schema import NUMERIC, STAR_TABLES

Star = dict[str, DataFrame]

#: The day column of each fact, and name and id column of each dimension.
FACT_DAYS = {"sales": "sale_date", "inventory": "inventory_date"}
DIMENSION_KEYS = {"stores": ("store_name", "store_id"), "suppliers": ("supplier_name", "supplier_id"),
                  "products": ("product_name", "product_id")}
BUCKET_ROWS = 250_000

SUPPLIER_FACTS = ["lead_time_days", "on_time_rate", "defect_rate"]
PRODUCT_FACTS = ["category", "supplier", "unit_price"]


def _earliest(keys: list[str], values: list[str]) -> Column:
    """The values of the row that comes first in key order (ties: smallest values)."""
    return F.min(F.struct(*keys, *values))


ATTRIBUTES = ["category", "unit_price", *SUPPLIER_FACTS]


def first_rows(fact: DataFrame) -> DataFrame:
    """Attributes of every (store, product, supplier) on its first date.

    Stores, suppliers and products all follow from this table, which stays small even if prices
    and rates change daily. The first dates are a hash aggregation with map-side partial results;
    a struct with text in it would make Spark sort the fact instead.
    """
    names = ["store", "product", "supplier"]
    dates = fact.groupBy(*names).agg(F.min("date").alias("date"))
    return fact.join(dates, [*names, "date"]).groupBy(*names, *ATTRIBUTES).agg(
        F.min("date").alias("date"))


def dim_stores(fact: DataFrame) -> DataFrame:
    """Distinct stores, ids 1..n in name order."""
    names = fact.select(F.col("store").alias("store_name")).distinct()
    return number_rows(names, [F.col("store_name")], "store_id").select("store_id", "store_name")


def dim_suppliers(fact: DataFrame) -> DataFrame:
    """First row per supplier in (store, product, date) order, ids in name order."""
    firsts = first_rows(fact).groupBy(F.col("supplier").alias("supplier_name")).agg(
        _earliest(["store", "product", "date"], SUPPLIER_FACTS).alias("head"))
    named = firsts.select("supplier_name", *[f"head.{c}" for c in SUPPLIER_FACTS])
    return number_rows(named, [F.col("supplier_name")], "supplier_id").select(
        "supplier_id", "supplier_name", *SUPPLIER_FACTS)


def dim_products(fact: DataFrame, suppliers: DataFrame) -> DataFrame:
    """First row per product, its supplier resolved to the surrogate id."""
    firsts = first_rows(fact).groupBy(F.col("product").alias("product_name")).agg(
        _earliest(["store", "date"], PRODUCT_FACTS).alias("head"))
    named = firsts.select("product_name", *[f"head.{c}" for c in PRODUCT_FACTS]).join(
        suppliers.select("supplier_id", F.col("supplier_name").alias("supplier")),
        "supplier", "left")
    return number_rows(named, [F.col("product_name")], "product_id").select(
        "product_id", "product_name", "category",
        _known("supplier_id", "supplier").alias("supplier_id"), "unit_price")


def _known(key: str, name: str) -> Column:
    """The surrogate id, or a failed job when the name is not in its dimension."""
    missing = F.raise_error(F.concat(F.lit(f"no {key} for "), F.col(name)))
    return F.when(F.col(key).isNull(), missing.cast("long")).otherwise(F.col(key))


def _with_ids(fact: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    # Left joins keep every fact row; an unknown name raises instead of losing the row.
    return (
        fact.join(stores.withColumnRenamed("store_name", "store"), "store", "left")
        .join(products.select("product_id", F.col("product_name").alias("product")),
              "product", "left")
        .withColumns({"store_id": _known("store_id", "store"),
                      "product_id": _known("product_id", "product")})
    )


def fact_sales(fact: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    whole = ["demand", "units_sold", "lost_sales"]
    return _with_ids(fact, stores, products).select(
        F.col("date").alias("sale_date"), "store_id", "product_id",
        "unit_price", F.col("discount_pct").cast("double").alias("discount_pct"), "sell_price",
        *[F.col(c).cast("long").alias(c) for c in whole],
        "revenue", F.col("promo_event").cast("int").alias("promo_event"))


def fact_inventory(fact: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    long = ["opening_stock", "closing_stock", "reorder_point", "reorder_qty"]
    flags = ["stockout", "supplier_delay"]
    return _with_ids(fact, stores, products).select(
        F.col("date").alias("inventory_date"), "store_id", "product_id",
        *[F.col(c).cast("long").alias(c) for c in long],
        F.col("reordered").cast("int").alias("reordered"),
        F.col("ordered_qty").cast("long").alias("ordered_qty"),
        F.col("received_qty").cast("long").alias("received_qty"),
        *[F.col(c).cast("int").alias(c) for c in flags])


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str,
                     id_column: str) -> DataFrame:
    """Keep existing rows; append incoming keys not present, ids continuing from the highest."""
    others = [c for c in incoming.columns if c != key]
    once = incoming.groupBy(key).agg(F.min(F.struct(*others)).alias("row")).select(
        key, *[f"row.{c}" for c in others]) if others else incoming.distinct()
    absent = once.join(existing.select(key), key, "left_anti")
    highest = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    fresh = number_rows(absent, [F.col(key)], id_column).withColumn(
        id_column, F.col(id_column) + highest)
    return existing.unionByName(fresh.select(*existing.columns))


def build_star(fact: DataFrame) -> Star:
    """The five tables as DataFrames; the dimensions share one pass over the fact."""
    heads = materialise(first_rows(fact))
    # The table keeps "date", so the same first row wins as on the fact.
    # Written dimensions have a known size: the joins below broadcast them when they are small
    # and sort-merge when they are not.
    stores = materialise(dim_stores(heads))
    suppliers = materialise(dim_suppliers(heads))
    products = materialise(dim_products(heads, suppliers))
    return {
        "stores": stores, "suppliers": suppliers, "products": products,
        "sales": fact_sales(fact, stores, products),
        "inventory": fact_inventory(fact, stores, products),
    }


def _laid_out(table: DataFrame, path: str, name: str, day: str, buckets: int) -> None:
    """Write a fact by month, in buckets of its key: a filter on ``month`` prunes folders, and two
    facts written alike are joined on (store_id, product_id, day) without a shuffle."""
    key = ["store_id", "product_id", day]
    by_month = table.withColumn("month", _month(F.col(day))).repartition(buckets, *key)
    by_month.write.format("parquet").partitionBy("month").bucketBy(buckets, *key).sortBy(
        *key).option("path", path).saveAsTable(name)


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def latest_day(table: DataFrame, day: str) -> DataFrame:
    """The rows of the table's last day, read from the folder of its last month."""
    if "month" not in table.columns:
        return table.where(F.col(day) == table.agg(F.max(day)).scalar())
    month = table.agg(F.max("month")).first()[0]  # reads no column
    own = table.where(F.col("month") == month)
    return own.where(F.col(day) == own.agg(F.max(day)).first()[0])


def reload_star(fact: DataFrame, out_dir: str, check: bool = True,
                bucket_rows: int = BUCKET_ROWS) -> Star:
    """Replace the star tables as one step.

    With ``check`` a fact with null cells, repeated rows or text in a numeric column raises before
    anything is written.
    Every load goes to its own folder; readers move to it only after all five tables are written
    and the row counts agree, by publishing a new version. A failed load leaves the previous one in
    place. A load that was overtaken by another writer raises ``StaleVersion``. Facts are laid out
    by month and in buckets of about ``bucket_rows`` rows.
    """
    spark = fact.sparkSession
    versions = Versions(spark, out_dir)
    base, _ = versions.latest()
    if check:
        fact = require_clean(coerce_numeric(fact, [c for c in NUMERIC if c in fact.columns]))
    load = f"load-{uuid.uuid4().hex}"
    star = build_star(fact)
    expected = fact.count()
    buckets = max(1, -(-expected // bucket_rows))

    def write(name: str) -> None:
        path = f"{out_dir}/{load}/{name}"
        if name in FACT_DAYS:
            _laid_out(star[name], path, _table_name(path), FACT_DAYS[name], buckets)
        else:
            star[name].write.parquet(path)

    side_by_side(spark, write, STAR_TABLES)
    content = {"buckets": buckets, "tables": {n: f"{load}/{n}" for n in STAR_TABLES}}
    written = _read_version(spark, out_dir, content)
    for name in FACT_DAYS:
        found = written[name].count()
        if found != expected:
            raise ValueError(f"{name} has {found} rows, the fact has {expected}")
    versions.publish(base, content)
    return written


def extend_dimension(spark: SparkSession, out_dir: str, name: str, incoming: DataFrame) -> Star:
    """Add rows whose name a dimension doesn't have yet, with ids that follow the highest.

    The new table is published as a version of its own against the one that was read, so two
    writers never give one id twice: the second raises ``StaleVersion`` and may read again.
    """
    versions = Versions(spark, out_dir)
    base, content = versions.latest()
    key, id_column = DIMENSION_KEYS[name]
    path = f"load-{uuid.uuid4().hex}/{name}"
    table = insert_if_absent(_read_version(spark, out_dir, content)[name], incoming, key, id_column)
    table.write.parquet(f"{out_dir}/{path}")
    content = {**content, "tables": {**content["tables"], name: path}}
    versions.publish(base, content)
    return _read_version(spark, out_dir, content)


def _table_name(path: str) -> str:
    """A catalog name for a table in a folder, as unique as the folder."""
    return "star_" + re.sub(r"\W", "_", "_".join(path.rstrip("/").split("/")[-2:]))


def _read_version(spark: SparkSession, out_dir: str, content: dict) -> Star:
    star = {}
    for name in STAR_TABLES:
        path = f"{out_dir}/{content['tables'][name]}"
        if name not in FACT_DAYS:
            star[name] = spark.read.parquet(path)
            continue
        known = _table_name(path)
        if not spark.catalog.tableExists(known):
            key = f"store_id, product_id, {FACT_DAYS[name]}"
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                for f in spark.read.parquet(path).schema)
            spark.sql(f"CREATE TABLE {known} ({columns}) USING parquet PARTITIONED BY (month) "
                      f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {content['buckets']} BUCKETS "
                      f"LOCATION '{path}'")
        star[name] = spark.table(known)
    return star


def open_star(spark: SparkSession, out_dir: str) -> Star:
    """The star tables of the latest published version."""
    number, content = Versions(spark, out_dir).latest()
    if not number:
        raise FileNotFoundError(f"no star was loaded into {out_dir}")
    return _read_version(spark, out_dir, content)


def register_star(star: Star) -> None:
    """Expose the tables to ``spark.sql`` under their own names."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)


def table_counts(star: Star) -> DataFrame:
    """Row count of each table."""
    counts = [
        star[name].agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in STAR_TABLES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
