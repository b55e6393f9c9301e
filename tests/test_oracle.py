"""A sample of registered queries against their DuckDB oracle on sf0.001."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = ["iv_report", "woe_table", "chi_square_pvalue", "csi_report", "band_psi", "ks_curve", "vif",
         "classification_report", "missing_profile", "group_categories"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].astype(object).where(pdf[cols].notna(), None)
                         .itertuples(index=False)), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = rows(entry.queries()[name](spark, SF).toPandas())
    exp = rows(con.execute(entry.oracle_sql()[name]).fetchdf())
    assert got == exp


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1 and "iv" in df.columns
