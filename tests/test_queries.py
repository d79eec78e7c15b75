"""Every registered query against its DuckDB SQL on the smallest tables, plus plan checks."""

import os
import sys

import pytest

import __spark_entry__ as entry
from kinfold.plans.catalog import QUERIES
from oracle_compare import compare, duck

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_report import final_lines, plans_run, summarise  # noqa: E402

SF = os.environ.get("KINFOLD_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["status"] == "match", r


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["last_updated", "level", "enrolled", "invited", "dropped", "avg_enrolled_fam_size",
                          "enroll_pct"]
    assert df.count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    banned = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
              "BroadcastNestedLoopJoin"]
    for node in banned:
        assert node not in plan, (name, node)


def test_participant_join_is_inner(spark):
    plan = entry.queries()["responses_clean"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line and "participantid" in line]
    assert joins and all("Join Inner" in line for line in joins), joins


def test_scan_pruning_and_pushdown(spark):
    plan = _plan(entry.queries()["last_refresh"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    plan = _plan(entry.queries()["combine_hour"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def _ran(spark, name):
    return summarise(plans_run(lambda: QUERIES[name](spark, SF)))


def _scans(found, table):
    return sum(t == table for t, _, _ in found["scans"])


def test_final_lines_leave_nested_initial_plans_out():
    plan = "A\n+- == Final Plan ==\n   B\n   +- C\n      +- == Final Plan ==\n         D\n      +- == Initial Plan ==\n         X\n   +- E\n+- == Initial Plan ==\n   Y\n   +- Z"
    kept = [line.strip(" +-") for line in final_lines(plan)]
    assert [k for k in kept if len(k) == 1] == ["A", "B", "C", "D", "E"]


# Table scans of the whole of each query, jobs that run while it is built included. Participant rows are read twice by
# design: once for the per-family sums and once for the rows they are joined back to (WIN1).
SCANS = {
    "enrollment_summary": {"customer": 2, "orders": 0},  # the orders join is not needed: Catalyst drops it
    "dropped_founders": {"customer": 1},
    "enriched_all": {"events": 2, "customer": 2, "orders": 1},  # events: the responses, and the dictionary
    "topic_slices": {"events": 2},
    "topic_slice": {"events": 2},
    "stress_totals": {"events": 2},
    "combine_hour": {"events": 2},
    "box_numbers": {"lineitem": 3},  # histogram, counted bins, fences
    "year_compare": {"lineitem": 2},  # histogram, cumulative counts
    "two_sample_events": {"events": 2},
    "period_compare": {"events": 4},  # each of the four series once
    "envelope_rejects": {"customer": 1},
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_scan_counts(spark, name):
    found = _ran(spark, name)
    assert {t: _scans(found, t) for t in SCANS[name]} == SCANS[name], found["scans"]


def test_statistics_plans(spark):
    for name in ("box_numbers", "year_compare", "two_sample_events"):
        assert _ran(spark, name)["counts"].get("InMemoryTableScan", 0) == 0
    pushed = [p for t, _, p in _ran(spark, "year_compare")["scans"] if t == "lineitem"]
    assert pushed and all("GreaterThanOrEqual(l_shipdate" in p for p in pushed)


def test_no_single_partition_for_many_people(spark):
    for name in ("hrv_daily_by_person", "combine_day_by_person", "combine_hour_by_person", "scaled_pair_by_person"):
        assert "Exchange SinglePartition" not in _ran(spark, name)["counts"], name
