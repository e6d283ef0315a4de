"""Order-free sums against exact ones, whatever the partitions."""

from __future__ import annotations

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from daybook import Tables, daily
from daybook.functions import exact
from daybook.operators import kpis
from tests import small

INF, NAN = float("inf"), float("nan")


def groups() -> dict[str, list[float]]:
    some = random.Random(1)

    def spread(n, low, high):
        return [math.ldexp(some.uniform(-1, 1), some.randint(low, high)) for _ in range(n)]

    out = {
        "cancelling": [1e30, 1e-5, -1e30, 0.1, 0.2, 0.3], "tenths": [0.1] * 1000, "far apart": [5e-324, 1.7e308, -1.7e308],
        "small negative": [-(2.0**-57)], "negative": [-0.5, -1e-20], "lost ones": [1e16, 1.0, 1.0, -1e16], "zero": [0.0, -0.0],
        "ties to even": [2.0**53, 1.0], "above a tie": [2.0**53, 1.0, 1e-300], "below a tie": [2.0**53, 1.0, -1e-300],
        "tie in the window": [1.0, 2.0**-53], "above it": [1.0, 2.0**-53, 2.0**-110 * 2.0**53 * 2.0**-53],
        "edges": [2.0**-58, 2.0**-59, 2.0**54, -(2.0**53)], "nothing left": [3.0, -3.0, 1e-200, -1e-200],
        "money": [round(some.uniform(-1e5, 1e6), 2) for _ in range(3000)], "wide": spread(500, -300, 300), "widest": spread(200, -1060, 1000),
    }
    for i in range(150):
        out[f"random {i}"] = spread(some.randint(1, 6), -57, 52) if i % 3 else spread(some.randint(2, 5), -130, 130)
    return out


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_sums_are_exact(spark, partitions):
    rows = [(name, x) for name, values in groups().items() for x in values]
    random.Random(partitions).shuffle(rows)
    frame = spark.createDataFrame(rows, "name string, x double").repartition(partitions)
    found = {r["name"]: r["x"] for r in exact.sum_by(frame, ["name"], "x").collect()}
    assert found == {name: math.fsum(values) for name, values in groups().items()}


def test_what_is_no_number(spark):
    rows = [("a", INF), ("a", 1.0), ("b", INF), ("b", -INF), ("c", NAN), ("d", None), ("e", None), ("e", 2.5), ("f", -INF), ("f", 1e300)]
    found = {r["name"]: r["x"] for r in exact.sum_by(spark.createDataFrame(rows, "name string, x double"), ["name"], "x").collect()}
    assert math.isnan(found.pop("b")) and math.isnan(found.pop("c"))
    assert found == {"a": INF, "d": None, "e": 2.5, "f": -INF}


def awkward(spark):
    """Purchases and campaigns whose sums depend on their order when added up as they come."""
    members, transactions, campaigns = small.raw(spark)
    amounts = ["1e30", "0.00001", "-1e30", "0.1", "0.2", "0.3", "-1e-30", "1e16", "-1e16"]
    some = F.element_at(F.array(*map(F.lit, amounts)), (F.pmod(F.xxhash64(*transactions.columns), F.lit(9)) + 1).cast("int"))
    figure = F.element_at(F.array(*map(F.lit, ["1000000000000000000000", "0.1", "-1000000000000000000000", "0.7"])), F.col("i"))
    many = campaigns.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(4))))
    return members, transactions.withColumn("eligible_amt", some), many.withColumn("incremental_rev", figure).drop("i")


@pytest.mark.parametrize("cfg", [small.CONFIG, replace(small.CONFIG, wrap_year_end=True)])
def test_measures_have_the_same_bits_for_any_partitions(spark, cfg):
    sources = awkward(spark)
    results = []
    for partitions in (1, 8, 60):
        tables = Tables(*[frame.repartition(partitions) for frame in sources], cfg)
        frames = [kpis.transacted_sales(tables, cfg), kpis.incremental_revenue(tables, cfg), daily(tables, cfg)]
        results.append([sorted(map(repr, frame.collect())) for frame in frames])
    assert results[0] == results[1] == results[2]
    amounts = {}
    for row in Tables(*sources, cfg).transactions.where("card_no IS NOT NULL AND amount IS NOT NULL").collect():
        amounts.setdefault(row["invoice_date"], []).append(row["amount"])
    found = {r["date"]: r["transactedcustomersales"] for r in kpis.transacted_sales(Tables(*sources, cfg), cfg).collect()}
    assert found == {day: math.fsum(values) for day, values in amounts.items()}
    consolidated = {r["date"]: r["transactedcustomersales"] for r in daily(Tables(*sources, cfg), cfg).collect()}
    assert all(consolidated[day] == total for day, total in found.items() if day in consolidated)
