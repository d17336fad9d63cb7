"""Every registered query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from forest_evidence import plans
from forest_evidence.plans.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(str(tuple(None if v is None or v != v else round(float(v), 3) if isinstance(v, float) else v for v in r)) for r in frame.astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours, theirs = plans.queries()[name](spark, SF).toPandas(), duck.sql(plans.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", ["a11_crosscheck_rows", "j7_concave_zones", "j6_boxes_of_all_sizes", "a2_sloped_zones"])
def test_same_rows_on_larger_tables(spark, name):
    con, sf = duckdb.connect(), "/root/testdata/sf0.01"
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    ours, theirs = plans.queries()[name](spark, sf).toPandas(), con.sql(plans.oracle_sql()[name]).df()
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", ["q4_reports", "q4_report_rules"])
@pytest.mark.parametrize("valid", ["l_orderkey % 200 between 50 and 99", "false"])
def test_zones_without_valid_pixels(spark, tmp_path, name, valid):
    """Zone A1 alone or none has a valid pixel, as in large tables where lines of each pixel pile up."""
    con = duckdb.connect()
    for t in TABLES:
        source = f"select * replace (case when {valid} then l_tax else 0.08 end as l_tax) from '{SF}/{t}.parquet'" if t == "lineitem" else f"from '{SF}/{t}.parquet'"
        con.execute(f"copy ({source}) to '{tmp_path}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    ours, theirs = plans.queries()[name](spark, str(tmp_path)).toPandas(), con.sql(plans.oracle_sql()[name]).df()
    assert rows(ours) == rows(theirs)
