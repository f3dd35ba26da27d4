"""Plan regression tests: scale properties of the final (adaptive) physical plans."""

import pytest

from hydroframe.plans.report import final_plan, summarize
from tests.conftest import SF_SMALL

import __spark_entry__ as E
from hydroframe.plans import queries as Q


@pytest.fixture(scope="module")
def plans(spark):
    return {name: final_plan(fn(spark, SF_SMALL)) for name, fn in E.queries().items() if name in Q.queries()}


def test_no_nested_loops_cartesian_or_python(plans):
    for name, plan in plans.items():
        s = summarize(plan)
        assert s["nested_loop"] == 0, name
        assert s["python"] == 0, name


def test_flagship_two_partial_aggregated_exchanges(plans):
    plan = plans["daily_forcing"]
    assert summarize(plan)["shuffles"] == 2
    assert "partial_max_by" in plan and "partial_sum" in plan      # map-side combine before both
    assert "BroadcastHashJoin" in plan                              # catalog rules, in-stage


def test_outlet_series_final_plan_scans_once(plans):
    # Its eager pass (the cell nearest the outlet) is a job of its own, a second scan.
    assert summarize(plans["outlet_series"])["scans"] == 1


def test_soil_maps_need_no_shuffle(plans):
    assert summarize(plans["soil_grid"])["shuffles"] == 0


def test_clip_stays_above_the_scan(plans):
    scan_lines = [ln for ln in plans["clipped_polygons"].splitlines() if "FileScan parquet" in ln]
    assert scan_lines and all("transform(" not in ln for ln in scan_lines)


def test_every_query_reads_data(plans):
    # File scans of the given tables (or of outputs written from them); queries that cut their
    # lineage with a reliable checkpoint read it back as an ExistingRDD scan of data derived
    # from the tables (their oracle comparisons show the values come from the tables).
    for name, plan in plans.items():
        assert "FileScan" in plan or "Scan ExistingRDD" in plan or "BatchScan parquet" in plan, name


def test_chunk_rows_prune_the_months_at_run_time(plans):
    scans = [ln for ln in plans["chunk_rows_pruned"].splitlines() if "PartitionFilters" in ln and "month" in ln]
    assert any("dynamicpruning" in ln for ln in scans)


def test_write_check_answers_from_footers(plans):
    assert "PushedAggregation: [COUNT(*)" in plans["forcing_write_check"]


def test_cube_shape_moves_bitmaps_not_points(plans):
    exchanges = [ln for ln in plans["climate_cube_shape"].splitlines() if "Exchange hashpartitioning" in ln]
    assert exchanges and all("hashpartitioning(kind#" in ln for ln in exchanges)  # kind of place and number of the bitmap
