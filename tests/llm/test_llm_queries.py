"""Queries of the subpackage against their SQL, and the others run, on the smallest tables where they are there."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from test_queries import DATA, compare  # noqa: E402

from leafmill.llm import queries  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def test_queries_match_their_sql(spark):
    compare(spark, queries)


def test_queries_without_sql(spark):
    checked = queries.oracle_sql()
    got = {name: q(spark, DATA).collect() for name, q in queries.queries().items() if name not in checked}
    pairs, classes = got["p9_found"], got["p9_classes"]
    assert sum(r.n_links for r in classes) == 2 * len(pairs) and {r.doc_id for r in classes} == {i for r in pairs for i in r}
    assert len(got["p4_splits"]) == spark.read.parquet(f"{DATA}/resources.parquet").count()
    shares = {r.source: r for r in got["p8_shares"]}
    assert {r.source for r in got["p8_found"]} == {s for s, r in shares.items() if r.short}
    assert {s: r.mixed_tokens for s, r in shares.items()} == {s: sum(r.mixed_tokens for r in got["p8_leaves"] if r.source == s) for s in shares}
    texts = {(r.kind, r.id): sorted(r.noise) for r in got["p3_texts"]}
    assert sum(map(len, texts.values())) == len(got["p3_found"])
