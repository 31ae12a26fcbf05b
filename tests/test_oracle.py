"""Catalog queries equal their DuckDB oracle on the smallest data set."""

import math

import duckdb
import pytest

from dialstat.plans.catalog import QUERIES
from dialstat.plans.oracle import ORACLE
from dialstat.sources.tables import TABLES
from tests.conftest import SF_SMALL

SAMPLE = ["contacts_clean", "campaign_kpis", "monthly_trend", "roi_by_duration", "segment_summary", "dq_summary",
          "coerce_numeric", "null_profile", "conversion_rates", "median_by_group"]


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else v
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    got = _rows(QUERIES[name](spark, SF_SMALL).toPandas())
    want = _rows(con.execute(ORACLE[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
