"""What the plans must look like, whatever the size of the data."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest

from pyspark.sql import functions as F

from daybook import Tables, daily
from daybook.operators import kpis
from daybook.plans.clustered import cluster_job, read_clustered
from daybook.plans.jobs import clean_job, read_clean
from tests import small
from workload import inputs
from workload.queries import QUERIES


def plan_of(frame, mode="formatted") -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw tables on disk, with columns nothing asks for."""
    folder = tmp_path_factory.mktemp("raw")
    paths = []
    for name, frame in zip(("members", "transactions", "campaigns"), small.raw(spark)):
        frame.selectExpr("*", "'x' AS unused").write.parquet(f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    return Tables(*[spark.read.parquet(path) for path in paths], small.CONFIG)


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}\]", plan))


def test_daily_reads_each_fact_once(stored):
    plan = plan_of(daily(stored, small.CONFIG))
    assert scans(plan, "transactions") == 1
    assert scans(plan, "campaigns") == 1
    assert scans(plan, "members") == 1


def test_daily_shuffles(stored):
    """By card and day, by card (purchases, members), by split, by day, the campaigns three times, and the stacked days."""
    plan = plan_of(daily(stored, small.CONFIG), "simple")
    assert plan.count("Exchange hashpartitioning") <= 9
    literal = plan_of(daily(stored, replace(small.CONFIG, semantics="reference")))
    assert scans(literal, "members") == 3


@pytest.mark.parametrize("measure", [kpis.members_archived, kpis.dormant_customers])
def test_states_read_each_table_once(stored, measure):
    plan = plan_of(measure(stored, small.CONFIG))
    assert scans(plan, "transactions") == 1
    assert scans(plan, "members") == 1


@pytest.mark.parametrize(
    "measure", [kpis.campaigns_deployed, kpis.targeted_count, kpis.campaign_buyers, kpis.incremental_revenue]
)
def test_campaign_totals_shuffle_once(stored, measure):
    literal = replace(small.CONFIG, semantics="reference")
    assert plan_of(measure(stored, literal), "simple").count("Exchange hashpartitioning") == 1
    # order-free sums meet once more, when a day has a row per figure and bin
    plan = plan_of(measure(stored, small.CONFIG), "simple")
    assert plan.count("Exchange hashpartitioning") == 2
    lines = plan.splitlines()
    assert all("partial_sum" in lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)


def test_filters_on_clean_tables_reach_the_scan(spark, tmp_path):
    clean_job(*small.raw(spark), small.CONFIG, str(tmp_path))
    plan = plan_of(kpis.keyword_buyers(read_clean(spark, str(tmp_path)), small.CONFIG))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(channel,", plan)


def test_daily_has_no_pairwise_join(stored):
    plan = plan_of(daily(stored, small.CONFIG))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_daily_reads_only_needed_columns(stored):
    plan = plan_of(daily(stored, small.CONFIG))
    assert "unused" not in plan
    assert "PushedFilters: [IsNotNull(invoice_date)]" in plan.replace("PushedFilters: [IsNotNull(invoice_date), ]", "")


def test_purchases_are_combined_before_they_are_shuffled(stored):
    """The first shuffle of purchases is by card and day, on partial sums; never by card alone."""
    plan = plan_of(daily(stored, small.CONFIG), "simple")
    shuffles = re.findall(r"Exchange hashpartitioning\((card_no#\d+, (?:invoice_)?date#\d+)", plan)
    assert len(shuffles) == 1
    lines = plan.splitlines()
    first = next(i for i, line in enumerate(lines) if "hashpartitioning(card_no" in line and "invoice_date" in line)
    assert "partial_sum" in lines[first + 1]


def test_the_only_forced_broadcast_is_the_month_day_table(stored):
    def forced(cfg):
        plan = plan_of(daily(stored, cfg), "simple")
        return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "month(" in line]

    assert len(forced(replace(small.CONFIG, semantics="reference"))) == 1
    assert not forced(small.CONFIG)


@pytest.mark.parametrize("measure", [
    kpis.members_archived, kpis.dormant_customers, kpis.low_point_balance_customers,
    kpis.birthdays_per_day, kpis.anniversaries_per_day, kpis.cross_channel_buyers,
])
def test_measures_have_no_pairwise_join(stored, measure):
    plan = plan_of(measure(stored, small.CONFIG))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("measure, tables", [
    (kpis.new_customers, {"transactions": 1}),
    (kpis.transacted_sales, {"transactions": 1}),
    (kpis.repeat_customer_sales, {"transactions": 1}),
    (kpis.birthday_sales, {"transactions": 1, "members": 1}),
    (kpis.active_customers, {"transactions": 1, "members": 1}),
    (kpis.enrolled_customers, {"members": 1}),
    (kpis.campaign_details, {"campaigns": 1}),
])
def test_measures_read_only_what_they_need(stored, measure, tables):
    plan = plan_of(measure(stored, small.CONFIG))
    for name in ("members", "transactions", "campaigns"):
        assert scans(plan, name) == tables.get(name, 0)


def test_no_python_in_any_plan(spark):
    for name, (run, _) in QUERIES.items():
        if "roundtrip" not in name:
            plan = plan_of(run(spark, "/root/testdata/sf0.001"), "simple")
            assert "Python" not in plan and "CartesianProduct" not in plan, name


def test_nothing_is_read_before_it_is_needed(spark):
    def fail():
        raise AssertionError("read")

    tables = Tables(fail, lambda: small.raw(spark)[1], fail, small.CONFIG)
    kpis.new_customers(tables, small.CONFIG)
    assert inputs.CONFIG.focus_channel == "store"


@pytest.fixture(scope="module")
def clustered(spark, stored, tmp_path_factory):
    cluster_job(stored, small.CONFIG, "plans", str(tmp_path_factory.mktemp("clustered")), buckets=4)
    return read_clustered(spark, stored, "plans")


@pytest.mark.parametrize("measure", [
    kpis.new_customers, kpis.repeat_customers, kpis.birthday_customers, kpis.active_customers, kpis.repeat_customer_sales, daily,
])
def test_tables_stored_by_card_are_not_shuffled_by_card(stored, clustered, measure):
    plan = plan_of(measure(clustered, small.CONFIG), "simple")
    assert "hashpartitioning(card_no" not in plan
    assert sorted(map(repr, measure(clustered, small.CONFIG).collect())) == sorted(map(repr, measure(stored, small.CONFIG).collect()))


def test_a_hot_card_has_a_row_per_day_in_its_bucket(spark, tmp_path):
    members, transactions, campaigns = small.raw(spark)
    one = transactions.where("invoice_date IS NOT NULL").limit(1).withColumns({"card_no": F.lit("hot"), "invoice_date": F.lit("2024-02-03")})
    many = transactions.union(one.select(*transactions.columns).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("i"))
    tables = Tables(members, many, campaigns, small.CONFIG)
    cluster_job(tables, small.CONFIG, "hot", str(tmp_path), buckets=4)
    assert read_clustered(spark, tables, "hot").card_days.where("card_no = 'hot'").count() == 1
