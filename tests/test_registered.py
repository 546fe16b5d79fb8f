"""Every registered query against its SQL, and checks of the plans."""

import compare
import pytest

import __spark_entry__ as contract
from stopwise.plans import queries as Q
from stopwise.plans import surrogates as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.entry(spark).take(1)) == 1


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_equals_sql(spark, con, name):
    assert compare.differences(Q.QUERIES[name](spark, SF), con, Q.ORACLES[name]) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["nearest_forecast", "headway", "lead_labels", "first_detections", "mttd_flags", "column_profile",
     "delay_labels", "replay_batches", "precision_at_k", "metrics_alerts"],
)
def test_no_cross_join(spark, name):
    plan = plan_of(Q.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(Q.QUERIES["future_window"](spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan" in line]
    assert scan and all("event_id" not in line and "props" not in line for line in scan)
    assert "PushedFilters: [IsNotNull(event_type)" in plan


def test_nearest_is_reduced_before_the_shuffle(spark):
    plan = plan_of(Q.QUERIES["nearest_forecast"](spark, SF))
    assert "partial_min" in plan


def test_precision_limits_rows_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(Q.QUERIES["precision_at_k"](spark, SF))


def test_surrogates_read_the_given_tables(spark):
    assert S.trip_updates(spark, SF).count() > 0
