"""Every query of the core against its SQL, on the smallest tables where they are there."""

import math
import os
from collections import Counter

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, list):
        return [cell(v) for v in x]
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5)
    return x


def tally(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(repr([cell(r[k]) for k in order]) for r in rows)


def compare(spark, module):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    bad = []
    for name, sql in module.oracle_sql().items():
        got = module.queries()[name](spark, DATA)
        rows = got.collect()
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        if sorted(columns) != sorted(got.columns) or tally(got.columns, [tuple(r) for r in rows]) != tally(columns, want.fetchall()):
            bad.append(name)
    assert not bad


def test_core_queries_match_their_sql(spark):
    from leafmill.plans import queries

    compare(spark, queries)


def test_queries_without_sql_run(spark):
    from leafmill.plans import queries

    checked = queries.oracle_sql()
    for name, q in queries.queries().items():
        if name not in checked:
            df = q(spark, DATA)
            assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
