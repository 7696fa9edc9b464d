"""Every named query against its SQL, and what its plan may not contain."""

from __future__ import annotations

import pytest

from closebook.catalog.inputs import StarInputs
from closebook.catalog.oracles import STATEMENTS
from closebook.catalog.queries import REGISTRY
from closebook.plans import quality
from closebook.sources import tables
from tools.check_sql import connect, difference
from tools.method_sizes import COMPILED, method_sizes

FOLDER = "/root/testdata/sf0.001"
#: Queries that write files or fetch a dictionary while they are built.
WRITTEN = {
    "headerless_scan", "scan_decimal_comma", "scan_decimal_point", "decimal_scan", "nan_as_null",
    "csv_sink_roundtrip", "result_table_roundtrip", "ledger_project", "trailing_minus_parse",
    "run_hand_off", "control_totals", "sign_flag_remap", "ffill", "ffill_ties", "data_quality", "checked_balance",
}
HEAVY = ("bcm_balance_open", "ir_rollforward", "pl_movement_lrc", "sign_flag_remap", "bcm_reduction")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_sql():
    assert set(REGISTRY) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    found = REGISTRY[name](spark, FOLDER).toPandas()
    assert len(found) > 0
    assert difference(found, con.execute(STATEMENTS[name]).df()) is None


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_plans_stay_on_the_jvm_without_cross_joins(spark, name):
    plan = _physical(REGISTRY[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


@pytest.mark.parametrize(
    "name", [*HEAVY, "sm_closing", "pl_movement_ir", "pl_movement_lic_past", "pl_movement_lic_current", "portfolio_lookup"]
)
def test_generated_methods_are_small_enough_for_the_compiler(spark, name):
    assert 0 < max(method_sizes(REGISTRY[name](spark, FOLDER))) <= COMPILED


def test_quality_checks_value_the_line_items_once(spark, monkeypatch):
    seen = []

    def noted(df, name="hand-off"):
        seen.append(_physical(df))
        return tables.hand_off(df)

    monkeypatch.setattr(quality, "hand_off", noted)
    result = _physical(REGISTRY["data_quality"](spark, FOLDER))
    assert [plan.count("lineitem.parquet") for plan in seen] == [1] and "lineitem.parquet" not in result


def test_two_grains_value_the_line_items_once(spark):
    plan = _physical(REGISTRY["bcm_balance_open_grains"](spark, FOLDER))
    assert len([x for x in plan.splitlines() if "FileScan parquet" in x and "lineitem.parquet" in x]) == 1


def test_movement_needs_one_shuffle_on_its_keys(spark):
    plan = _physical(REGISTRY["pl_movement_lrc"](spark, FOLDER))
    own = plan.split("InMemoryRelation")[0]
    keyed = [line for line in own.splitlines() if "Exchange hashpartitioning(contract" in line]
    assert len(keyed) == 1


@pytest.mark.parametrize("name", ["ir_rollforward", "pl_movement_ir", "pl_movement_lrc", "pl_movement_lic_past"])
def test_runs_read_the_line_items_once(spark, name):
    plan = _physical(REGISTRY[name](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem.parquet" in line]
    assert len(scans) == 1


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(REGISTRY) - WRITTEN):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        REGISTRY[name](spark, FOLDER)
        assert list(tracker.getJobIdsForGroup(f"build-{name}")) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_odd_rows_of_each_kind_change_a_result(spark, con):
    """Rows without id, code or currency, of another exposure, and (in the larger tables) at a rate of zero."""
    given = StarInputs(spark, FOLDER)
    rows = given.bcm().cache()
    for odd in ("I17REFOBJID IS NULL", "I17COSTREVENUE IS NULL", "I17ESTCURR IS NULL", "I17EXPCHANGE = 70"):
        assert rows.filter(odd).count() > 0
    assert given.rates_open().filter("EXCHANGE_RATE = 0").count() == 1
    kept = {r["I17REFOBJID"] for r in REGISTRY["contract_totals"](spark, FOLDER).collect()}
    assert None not in kept
    assert "0" in {r["contract"] for r in REGISTRY["ir_rollforward"](spark, FOLDER).collect()}
    exposures = {r["I17EXPCHANGE"] for r in REGISTRY["fx_by_exposure"](spark, FOLDER).collect()}
    assert exposures == {10, 60}
    dropped = REGISTRY["dropped_amounts"](spark, FOLDER).first()
    unmapped = rows.filter("I17COSTREVENUE = 'Y999'").count()
    assert dropped["rows_dropped"] > unmapped
    usd = REGISTRY["fx_convert"](spark, "/root/testdata/sf0.01").filter("I17ESTCURR = 'USD'").first()
    assert usd["nominal_table"] is None and usd["nominal_forced"] is not None
    rows.unpersist()
