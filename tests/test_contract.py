import re

import __spark_entry__ as entry
from tidemark.queries import ORACLE, QUERIES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "jq_code", "close_hfq", "ret_1d", "bias20"]


def test_registry():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 100
    assert not [q for q in QUERIES if re.fullmatch(r"op\d+_.*", q)]
    assert set(entry.queries()) == set(QUERIES) | set(entry.LLM_QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLE) | set(entry.LLM_ORACLE)
