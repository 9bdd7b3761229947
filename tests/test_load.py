"""Sources, gates and the star-schema load."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.versions import StaleVersion, Versions
from shelfwise.operators import business, etl, finance_star, quality
from shelfwise.sources import retail
from shelfwise.sources.schema import FACT, NUMERIC
from shelfwise.sources.testdata import daily_fact_from_orders


@pytest.fixture(scope="module")
def fact(spark):
    return daily_fact_from_orders(spark, "/root/testdata/sf0.001").persist()


def test_fact_fingerprint(fact):
    got = fact.agg(F.count("*"), F.sum("demand"), F.sum("lost_sales"), F.sum("revenue") * 100,
                   F.sum("stockout"), F.sum("lead_time_days")).first()
    assert [int(v) for v in got] == [5967, 152257, 9431, 12263751713, 1205, 35526]
    keys = fact.select("store", "product", "date").distinct().count()
    assert keys == 5967 and fact.schema.simpleString() == FACT.simpleString()


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_round_trip(spark, fact, tmp_path, form):
    path = f"{tmp_path}/{form}"
    retail.write_artifact(fact, path, form)
    back = retail.read_retail_daily(spark, path, form)
    assert back.exceptAll(fact).isEmpty() and fact.exceptAll(back).isEmpty()


def test_bad_csv_value_fails(spark, tmp_path):
    header = ",".join(f.name for f in FACT.fields)
    row = ["2024-01-01", "s", "c", "p", "u", "abc"] + ["1"] * 19
    (tmp_path / "bad.csv").write_text(header + "\n" + ",".join(row) + "\n")
    with pytest.raises(Exception):
        retail.read_retail_daily(spark, str(tmp_path), "csv").collect()


def test_missing_table_is_empty(spark, tmp_path):
    empty = retail.read_optional(spark, f"{tmp_path}/none", FACT)
    assert empty.isEmpty() and empty.columns == FACT.names


def test_required_columns_are_named(fact):
    with pytest.raises(ValueError, match=r"\['absent', 'gone'\]"):
        retail.require_columns(fact, ["store", "gone", "absent"])


def test_gates_raise(spark, fact):
    assert quality.require_clean(fact) is fact
    with pytest.raises(ValueError, match="1 duplicate"):
        quality.require_clean(fact.unionByName(fact.limit(1)))
    holed = fact.withColumn("demand", F.when(F.col("demand") > 0, F.col("demand")))
    holed = holed.withColumn("on_time_rate", F.lit(float("nan")))
    assert quality.dq_null_check(holed).first()["null_cells"] == 5967
    with pytest.raises(ValueError, match="missing values"):
        quality.require_clean(holed)


def test_text_that_is_not_a_number(spark):
    df = spark.createDataFrame([("1.5", "3"), ("x", "4"), (None, "5")],
                               "unit_price string, demand string")
    bad = {r["column"]: r.bad_cells for r in
           quality.numeric_errors(df, ["unit_price", "demand"]).collect()}
    assert bad == {"unit_price": 1, "demand": 0}
    with pytest.raises(Exception, match="unit_price is not numeric: x"):
        quality.coerce_numeric(df, ["unit_price"]).collect()
    assert quality.coerce_numeric(df, ["demand"]).agg(F.sum("demand")).first()[0] == 12


def test_insert_if_absent_continues_ids(spark):
    have = spark.createDataFrame([(1, "a"), (4, "c")], "id long, name string")
    new = spark.createDataFrame([("c",), ("b",), ("d",), ("b",)], "name string")
    got = sorted(tuple(r) for r in etl.insert_if_absent(have, new, "name", "id").collect())
    assert got == [(1, "a"), (4, "c"), (5, "b"), (6, "d")]


def test_first_row_wins_in_dimensions(spark, fact):
    rows = [("2024-01-02", "s1", "p", "u1", "late"), ("2024-01-01", "s1", "p", "u2", "first"),
            ("2023-01-01", "s2", "p", "u1", "other store")]
    extra = fact.limit(1)
    tiny = None
    for date, store, product, supplier, category in rows:
        row = extra.withColumns({
            "date": F.lit(date).cast("date"), "store": F.lit(store), "product": F.lit(product),
            "supplier": F.lit(supplier), "category": F.lit(category)})
        tiny = row if tiny is None else tiny.unionByName(row)
    star = etl.build_star(tiny)
    assert star["products"].first()["category"] == "first"
    direct = etl.dim_products(tiny, etl.dim_suppliers(tiny))
    assert direct.first() == star["products"].first()


def test_failed_load_keeps_the_previous_one(spark, fact, tmp_path, monkeypatch):
    out = f"{tmp_path}/star"
    etl.reload_star(fact, out)
    smaller = fact.where(F.col("store") == "ASIA")
    full = etl.build_star(fact)
    monkeypatch.setattr(etl, "build_star", lambda _: full)
    with pytest.raises(ValueError, match="rows"):
        etl.reload_star(smaller, out)
    assert etl.open_star(spark, out)["sales"].count() == 5967
    monkeypatch.undo()
    etl.reload_star(smaller, out)
    assert etl.open_star(spark, out)["sales"].count() == smaller.count()


def test_unknown_product_fails_instead_of_losing_rows(fact):
    stores = etl.dim_stores(fact)
    products = etl.dim_products(fact, etl.dim_suppliers(fact))
    short = products.where(F.col("product_id") > 1)
    with pytest.raises(Exception, match="no product_id for"):
        etl.fact_sales(fact, stores, short).collect()


def test_star_answers_sql(spark, fact):
    star = etl.build_star(fact)
    etl.register_star(star)
    got = spark.sql("""
        SELECT st.store_name, SUM(s.units_sold) AS units FROM sales s
        JOIN stores st ON s.store_id = st.store_id GROUP BY 1""").collect()
    want = fact.groupBy("store").agg(F.sum("units_sold").alias("u")).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


def test_numeric_columns_are_twenty():
    assert len(NUMERIC) == 20


def test_dirty_fact_leaves_the_previous_load(spark, fact, tmp_path):
    out = f"{tmp_path}/star"
    etl.reload_star(fact, out)
    nulls = fact.withColumn("demand", F.when(F.col("store") != "ASIA", F.col("demand")))
    repeated = fact.unionByName(fact.where(F.col("store") == "ASIA"))
    text = fact.withColumn("demand", F.when(F.col("store") == "ASIA", "many").otherwise(
        F.col("demand").cast("string")))
    for dirty, problem in ((nulls, "missing"), (repeated, "duplicate"), (text, "not numeric")):
        with pytest.raises(Exception, match=problem):
            etl.reload_star(dirty, out)
        assert etl.open_star(spark, out)["sales"].count() == fact.count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_day_reads_one_month_folder(spark, fact, tmp_path):
    star = etl.reload_star(fact, f"{tmp_path}/star", check=False)
    got = business.biz_inventory_risk(star)
    plan = plan_of(got)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("month" in f for f in filters), plan
    read = [f for f in star["inventory"].where("month = 200111").inputFiles()]
    assert 0 < len(read) < len(star["inventory"].inputFiles()) / 10
    day = fact.agg(F.max("date")).first()[0]
    assert got.count() == fact.where(F.col("date") == day).count()
    assert {r.inventory_date for r in got.collect()} == {day}


def test_facts_are_joined_where_they_lie(spark, fact, tmp_path):
    star = etl.reload_star(fact, f"{tmp_path}/star", check=False, bucket_rows=1000)
    again = etl.open_star(spark.newSession(), f"{tmp_path}/star")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(key, value)
        for own in (star, again):
            joined = finance_star._sales_with_stock(own, ["units_sold"], ["closing_stock"])
            plan = plan_of(joined)
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
            assert joined.count() == fact.count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_of_two_racing_loads_one_raises(spark, fact, tmp_path, monkeypatch):
    out = f"{tmp_path}/star"
    etl.reload_star(fact, out, check=False)
    smaller, build = fact.where(F.col("store") == "ASIA"), etl.build_star

    def overtaken(own):
        monkeypatch.setattr(etl, "build_star", build)
        etl.reload_star(smaller, out, check=False)  # another writer is faster
        return build(own)

    monkeypatch.setattr(etl, "build_star", overtaken)
    with pytest.raises(StaleVersion):
        etl.reload_star(fact, out, check=False)
    assert etl.open_star(spark, out)["sales"].count() == smaller.count()


def test_no_id_is_given_twice(spark, fact, tmp_path):
    out = f"{tmp_path}/star"
    etl.reload_star(fact, out, check=False)
    versions = Versions(spark, out)
    base, content = versions.latest()
    new = spark.createDataFrame([("ASIA",), ("X",), ("Y",)], "store_name string")
    star = etl.extend_dimension(spark, out, "stores", new)
    ids = {r.store_name: r.store_id for r in star["stores"].collect()}
    assert len(ids) == 7 and sorted(ids.values()) == list(range(1, 8))
    with pytest.raises(StaleVersion):
        versions.publish(base, content)
    entry = versions._entry(versions.latest()[0] + 1)
    versions.fs.create(entry).close()  # a writer that has taken the number but not yet written
    with pytest.raises(StaleVersion):
        etl.extend_dimension(spark, out, "stores", spark.createDataFrame(
            [("Z",)], "store_name string"))
    assert etl.open_star(spark, out)["stores"].count() == 7
