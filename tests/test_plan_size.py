"""Expressions that are built per column of wide tables hold no branches that can't apply, and give the same values."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sparkqc.functions.transforms import TRANSFORM_TYPES, apply_named
from sparkqc.operators.shape import to_long
from sparkqc.plans import fixtures as fx


def test_wide_holes_equal_the_long_ones(spark):
    wide = fx.holes_wide_view(spark, SF001)
    names = [f"e{i + 1}" for i in range(fx.N_DIMS)]
    long = fx.holes_view(spark, SF001).select("vec_id", "y", F.concat(F.lit("e"), F.col("pos")).alias("col"), "v")
    got = to_long(wide, ["vec_id", "y"], names)
    assert got.count() == long.count() and got.exceptAll(long).count() == 0
    assert got.groupBy("col").agg(F.count_if(F.col("v").isNull()).alias("n")).where("n > 0").count() == 5


def test_a_column_without_holes_is_a_plain_column(spark):
    v = F.col("v")
    assert str(fx.holes_expr(F.col("vec_id"), 20, v)) == str(v)
    assert str(fx.holes_expr(F.col("vec_id"), 1, v)).count("WHEN") == 1


@pytest.mark.parametrize("kind", [*TRANSFORM_TYPES, "other"])
def test_a_literal_transform_builds_its_own_branch_only(spark, kind):
    df = spark.createDataFrame([(-2.5,), (-1.0,), (0.0,), (0.5,), (3.0,), (None,)], "v double")
    v = F.col("v")
    own, any_of = apply_named(kind, v, F.lit(0.7)), apply_named(F.concat(F.lit(kind), F.lit("")), v, F.lit(0.7))
    assert len(str(own)) < len(str(any_of)) / 2
    assert all(r.same for r in df.select(own.eqNullSafe(any_of).alias("same")).collect())
