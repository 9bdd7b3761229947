"""Rounding, null-safe division, levels and the distributed order statistics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.numeric import rank_of, ratio, ratio_or_zero, right_closed, round_to
from shelfwise.functions.ordering import exact_median, number_rows, pct_rank, running_totals


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, places, expected", [
    (1.005, 2, 1.01), (-1.005, 2, -1.01), (0.125, 2, 0.13), (2.5, 0, 3.0), (None, 2, None)])
def test_rounds_ties_away_from_zero(spark, value, places, expected):
    assert one(spark, round_to(F.lit(value).cast("double"), places)) == expected


def test_negative_zero_becomes_zero(spark):
    assert math.copysign(1, one(spark, round_to(F.lit(-1e-12), 6))) == 1


def test_division_by_zero_is_null_or_zero(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio_or_zero(F.lit(1), F.lit(0))) == 0.0


def test_levels_belong_to_the_lower_bin(spark):
    rows = spark.createDataFrame([(10.0,), (10.01,), (20.0,), (20.5,), (None,)], "x double")
    level = right_closed("x", [(10, "LOW"), (20, "MEDIUM")], "HIGH")
    assert [r[0] for r in rows.select(level).collect()] == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH", None]


def test_unknown_level_sorts_last(spark):
    rows = spark.createDataFrame([("B",), ("Z",), ("A",)], "x string")
    assert [r.x for r in rows.orderBy(rank_of("x", ["B", "A"])).collect()] == ["B", "A", "Z"]


def test_running_totals_over_slices(spark, many_slices):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 5, 7, rng.randint(0, 99)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "v long, id long").repartition(7)
    out = running_totals(df, [F.desc("v"), F.col("id")], {"run": F.col("v")}).collect()
    expected, total = {}, 0
    for v, i in sorted(rows, key=lambda r: (-r[0], r[1])):
        total += v
        expected[i] = total
    assert {r.id: r.run for r in out} == expected
    assert {r.run_total for r in out} == {total}


def test_row_numbers_are_dense(spark, many_slices):
    df = spark.createDataFrame([(f"n{i:03d}",) for i in range(200)], "name string").repartition(5)
    got = {r.name: r.id for r in number_rows(df, [F.col("name")], "id").collect()}
    assert got == {f"n{i:03d}": i + 1 for i in range(200)}


@pytest.mark.parametrize("values, expected", [
    ([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0, 1.0, 2.0], 1.5), ([5.0, 5.0, 5.0, 5.0], 5.0),
    ([None, 7.0], 7.0), ([None], None)])
def test_median(spark, many_slices, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first()["median"] == expected


@pytest.mark.parametrize("ascending", [True, False])
def test_pct_rank_averages_ties_and_skips_nulls(spark, many_slices, ascending):
    values = [1.0, 2.0, 2.0, 2.0, 9.0, None, 4.0]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    got = {r.id: r.p for r in pct_rank(df, "v", ascending, "p", ["id"]).collect()}
    known = [v for v in values if v is not None]
    for i, v in enumerate(values):
        if v is None:
            assert got[i] is None
            continue
        before = sum((x < v) if ascending else (x > v) for x in known)
        assert got[i] == pytest.approx((before + (known.count(v) + 1) / 2) / len(known))


def test_pct_rank_with_one_hot_value(spark, many_slices):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, 7.0)
                                  .otherwise(F.col("id").cast("double")).alias("v"))
    got = pct_rank(df, "v", True, "p", ["id"]).agg(
        F.min("p").alias("low"), F.max("p").alias("high"), F.count("p").alias("n")).first()
    assert (got["low"], got["high"], got["n"]) == (500.5 / 3000, 1.0, 3000)


def test_a_step_written_alone_leaves_the_setting_as_it_was(spark):
    from shelfwise.functions.storage import materialise_alone

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for value in ("false", "true"):
        spark.conf.set(name, value)
        step = materialise_alone(spark.range(50).repartition("id"))
        assert spark.conf.get(name) == value and step.count() == 50
    spark.conf.unset(name)
