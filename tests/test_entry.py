"""Driver contract: entry() runs, every query has an oracle, names line up."""
import os

import pytest

import __spark_entry__ as E
from strata.plans import catalog


def test_queries_and_oracles_align():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(catalog.names()) <= set(o) and len(o) >= 70
    for name, sql in o.items():
        assert sql.strip().upper().startswith(("WITH", "SELECT")), name


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="test tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "sale_date" in df.columns and "gross_revenue" in df.columns
