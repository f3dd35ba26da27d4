"""Every registered query against its DuckDB twin (row count, columns, values)."""

import pytest

from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_compare import compare, duck

import __spark_entry__ as E
from hydroframe.plans import queries as Q

NAMES = sorted(Q.queries())  # the reference's own; tests/llm has the others


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, con_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    ok, msg = compare(df, sql, SF_SMALL, con_small)
    assert ok, msg


@pytest.mark.parametrize("name", ["daily_forcing", "reservoirs", "upstream_cells", "lai_cube"])
def test_query_matches_oracle_check_scale(spark, name):
    df = E.queries()[name](spark, SF_CHECK)
    ok, msg = compare(df, E.oracle_sql()[name], SF_CHECK)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day", "lat", "lon", "precip", "temp", "kin", "kout", "press_msl"]


def test_flagship_with_fixture_parameters_and_buffer(spark):
    """The FIXTURES.md job (2x2 degree extent, one week) with the default 2-degree climate
    buffer (A14, I19), against the same oracle built with those parameters."""
    from hydroframe.operators import climate
    from hydroframe.params import FIXTURE_JOB
    from hydroframe.plans import oracle as O
    from hydroframe.sources import fixtures as fx
    for job in (FIXTURE_JOB, FIXTURE_JOB.with_(climate_buffer=0.0)):
        df = climate.daily_forcing(spark, fx.obs_hourly(spark, SF_CHECK), job)
        ok, msg = compare(df, O.daily_forcing_sql(job), SF_CHECK)
        assert ok, msg
