"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""


import __spark_entry__ as entry
from compare import check
from incidentlake.schemas import GOLD_DIMS

from conftest import SF_SMALL


def test_registry_and_oracle_keys_match():
    core = {k for k in entry.queries() if not (k[:2] == "op" and k[2].isdigit()) and k != "pipeline"}
    assert core <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 473
    assert tuple(df.columns[:5]) == GOLD_DIMS


def test_all_queries_match_oracle(spark):
    results = check(spark, SF_SMALL, verbose=False)
    failed = {k: v[1] for k, v in results.items() if not v[0]}
    assert not failed, failed
