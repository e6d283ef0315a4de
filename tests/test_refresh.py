"""A state that takes changes against a full run, bit by bit."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from daybook import Tables, daily
from daybook.plans.refresh import CHANGE, DailyState
from tests import small
from workload.queries import WRONG, changes, written_parts


def rows(frame):
    return sorted(map(repr, frame.collect()))


def loads(spark):
    return list(zip(*[changes(raw, wrong) for raw, wrong in zip(small.raw(spark), WRONG.values())]))


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    state = DailyState(spark, str(tmp_path_factory.mktemp("state")), small.CONFIG)
    for number, load in enumerate(loads(spark)):
        state.refresh(*load, number)
    return state


def test_loads_equal_a_full_run(spark, state):
    full = daily(small.tables(spark), small.CONFIG)
    assert rows(state.frame()) == rows(full)


def test_a_refresh_that_runs_again_counts_once(spark, state):
    state.refresh(*loads(spark)[3], 3)
    assert rows(state.frame()) == rows(daily(small.tables(spark), small.CONFIG))


def test_a_compact_state_goes_on(spark, state, tmp_path):
    compact = state.compact(str(tmp_path / "compact"))
    assert rows(compact.frame()) == rows(state.frame())
    members, transactions, campaigns = [raw.withColumn(CHANGE, F.lit(1)) for raw in small.raw(spark)]
    none = [raw.where("false") for raw in (members, campaigns)]
    compact.refresh(none[0], transactions, none[1], 1)
    raw = small.raw(spark)
    twice = Tables(raw[0], raw[1].union(raw[1]), raw[2], small.CONFIG)
    assert rows(compact.frame()) == rows(daily(twice, small.CONFIG))


def test_only_days_that_change_are_written(spark, tmp_path):
    state = DailyState(spark, str(tmp_path), small.CONFIG)
    members, transactions, campaigns = [raw.withColumn(CHANGE, F.lit(1)) for raw in small.raw(spark)]
    state.refresh(members, transactions, campaigns, 0)
    none = [raw.where("false") for raw in (members, campaigns)]
    bought = transactions.where("invoice_date IS NOT NULL").limit(1).withColumns({
        "card_no": F.lit("a card of its own"), "invoice_date": F.lit("2024-02-03"), "channel": F.lit("kiosk")
    })
    state.refresh(none[0], bought, none[1], 1)
    written = spark.read.parquet(f"{tmp_path}/days/refresh=1")
    assert {str(r["on"]) for r in written.collect()} == {"2024-02-03"}
    state.refresh(none[0], bought.withColumn(CHANGE, F.lit(-1)), none[1], 2)
    assert rows(state.frame()) == rows(daily(small.tables(spark), small.CONFIG))


def test_results_that_cannot_be_taken_away_are_refused(spark):
    for cfg in (replace(small.CONFIG, semantics="reference"), replace(small.CONFIG, amount_type="decimal(18,4)")):
        with pytest.raises(ValueError, match="corrected"):
            DailyState(spark, "/nowhere", cfg)


def test_a_load_on_most_cards_takes_one_pass_and_a_load_on_few_reads_these_only(spark, tmp_path, monkeypatch):
    passes, contributions = [], DailyState._contributions
    monkeypatch.setattr(DailyState, "_contributions", lambda *a, **b: passes.append(a) or contributions(*a, **b))
    raw = small.raw(spark)
    state = DailyState(spark, str(tmp_path), small.CONFIG)
    state.refresh(*[rows.withColumn(CHANGE, F.lit(1)) for rows in raw], 0)
    state.refresh(*[rows.withColumn(CHANGE, F.lit(1)) for rows in raw], 1)
    assert len(passes) == 2
    gone = [rows.withColumn(CHANGE, F.lit(-1)) for rows in raw]
    one = gone[1].where("card_no IS NOT NULL").limit(1)
    state.refresh(gone[0].where("false"), one, gone[2].where("false"), 2)
    assert len(passes) == 4
    state.refresh(gone[0].where("false"), one.withColumn(CHANGE, F.lit(1)), gone[2], 3)
    state.refresh(gone[0], gone[1], gone[2].where("false"), 4)
    assert rows(state.frame()) == rows(daily(small.tables(spark), small.CONFIG))


def test_loads_come_from_rows_that_are_made_once(spark):
    raw, wrong = small.raw(spark)[1], WRONG["transactions"]
    made = spark.createDataFrame([(1,)], "one int").join(raw.withColumn("one", F.lit(1)), "one").drop("one")
    written = changes(written_parts(spark, made), wrong)
    for load, plain in zip(written, changes(raw, wrong)):
        assert "Join" not in load._jdf.queryExecution().optimizedPlan().toString()
        assert load.columns == plain.columns
        assert rows(load) == rows(plain)
