import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tachoflow.functions.exact import LIMB_BITS, exact_mean_of, exact_sum, joined, limb_sums
from tachoflow.operators.gold import agg_efficiency, agg_trip_summary, fct_vehicle_telemetry, rollup_fact
from tachoflow.operators.quality import sensor_statistics
from tachoflow.operators.silver import enrich
from tachoflow.sources.sensors import sensor_rows

EVENTS = "/root/testdata/sf0.001/events.parquet"


def _values(seed=3, n=4000):
    """Mixed sizes and signs, with sums that plain addition gives differently in another order."""
    rng = random.Random(seed)
    return [rng.choice((1, -1)) * rng.random() * 10.0 ** rng.randint(-7, 12) for _ in range(n)] + [0.0, -0.0, None, 1e13, -1e13, 0.1, 1e-9, -1e-9]


def _frame(spark, values, partitions):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k INT, v DOUBLE").repartition(partitions, "k")


def test_sums_are_equal_at_any_number_of_partitions(spark):
    values = _values()
    found = set()
    for partitions in (1, 8, 200):
        for order in (values, values[::-1], sorted(values, key=lambda v: (v is None, abs(v or 0)))):
            row = _frame(spark, order, partitions).selectExpr(f"{exact_sum('v')} as s", f"{exact_mean_of('v')} as m").first()
            found.add(tuple(row))
    assert len(found) == 1
    total, mean = found.pop()
    numbers = [Fraction(v) for v in values if v is not None]
    exact = sum(numbers)
    assert abs(Fraction(total) - exact) <= abs(exact) * Fraction(1, 2**52) + len(numbers) * Fraction(1, 2**(2 * LIMB_BITS))
    assert mean == pytest.approx(float(exact / len(numbers)), rel=1e-12)


def test_parts_merge_exactly(spark):
    df = _frame(spark, _values(9), 8)
    names = [f"s{k}" for k in range(3)]
    grouped = df.groupBy((F.col("k") % 37).alias("g")).agg(*[F.expr(s).alias(n) for s, n in zip(limb_sums("v"), names)])
    merged = grouped.selectExpr(f"{joined([f'sum({n})' for n in names])} as s").first().s
    assert merged == df.selectExpr(f"{exact_sum('v')} as s").first().s


def test_no_values(spark):
    none = spark.createDataFrame([(None,), (None,)], "v DOUBLE")
    for df in (none, none.limit(0)):
        row = df.selectExpr(f"{exact_sum('v')} as s", f"{exact_mean_of('v')} as m").first()
        assert tuple(row) == (None, None)


def test_published_figures_do_not_depend_on_partitions(spark):
    rows = sensor_rows(spark.read.parquet(EVENTS))
    found = set()
    for partitions in (1, 8, 60):
        fact = fct_vehicle_telemetry(enrich(rows.repartition(partitions, "id")))
        for source in (fact, rollup_fact(fact)):
            efficiency = sorted(tuple(r) for r in agg_efficiency(source).collect())
            found.add((tuple(efficiency), tuple(agg_trip_summary(source).first())))
        assert sensor_statistics(rows.repartition(partitions, "id")).count() == 20
    assert len(found) == 1
