"""Every registered query: whole tables, and DuckDB where there is SQL."""

import pytest
from oracle_check import digest, duck, type_diffs

from lakeload.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in registry.ORACLE:
        if name != "op5_threshold_topk":
            assert len(got) == 200
        return
    res = duck(SF).execute(registry.ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and not type_diffs(df, res)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]
