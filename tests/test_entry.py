"""Driver contract: entry(), queries() and oracle_sql() are consistent."""

import __spark_entry__ as se


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "c_custkey"


def test_every_oracle_has_a_query():
    q, sql = se.queries(), se.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 60


def test_no_row_caps_in_oracles():
    for name, text in se.oracle_sql().items():
        if name not in ("s2_capped_scan", "o3_top40_by_mean"):
            assert " LIMIT " not in text.upper(), name
