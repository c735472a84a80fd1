"""Co-occurrence, term frequency and splits against brute force, and the defined edge cases."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest

from leafmill.llm import cooccur, splits, termfreq

LISTS = "id int, items array<string>, n_ab int"


def baskets(seed=1, n=300):
    rng = random.Random(seed)
    rows = [(k, [rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 6))] + (["hot"] if k % 3 else []), 0) for k in range(n)]
    return [*rows, (n, None, 1), (n + 1, [], 1), (n + 2, [None, "", "a", "a"], 1), rows[0]]


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_pairs_against_brute_force(spark, broadcast):
    rows = baskets()
    got = cooccur.cooccurrence(spark.createDataFrame(rows, LISTS), "items", broadcast_items=broadcast).collect()
    sets = [{x for x in (r[1] or []) if x} for r in rows]
    single = Counter(x for s in sets for x in s)
    pairs = Counter(p for s in sets for p in combinations(sorted(s), 2))
    assert {(r.concept_a, r.concept_b): r.n_ab for r in got} == pairs
    for r in got:
        assert (r.n_a, r.n_b, r.n_records) == (single[r.concept_a], single[r.concept_b], len(rows))
        cells = (r.n_ab + 0.5, r.n_a - r.n_ab + 0.5, r.n_b - r.n_ab + 0.5, len(rows) - r.n_a - r.n_b + r.n_ab + 0.5)
        assert math.isclose(r.odds_ratio, cells[0] * cells[3] / (cells[1] * cells[2]))
        assert math.isclose(r.lift, r.n_ab * len(rows) / (r.n_a * r.n_b))


def test_thresholds_prune_without_loss(spark):
    df = spark.createDataFrame(baskets(2), LISTS)
    every = {(r.concept_a, r.concept_b) for r in cooccur.cooccurrence(df).collect() if r.n_ab >= 4 and r.n_ab * r.n_records >= 2 * r.n_a * r.n_b}
    assert {(r.concept_a, r.concept_b) for r in cooccur.cooccurrence(df, min_pair=4, min_lift=2).collect()} == every


def test_no_records_no_pairs(spark):
    assert cooccur.cooccurrence(spark.createDataFrame([], LISTS)).count() == 0
    assert cooccur.cooccurrence(spark.createDataFrame([(1, None, 1)], LISTS)).count() == 0


def test_runs_cross_batches():
    import pyarrow as pa

    batch = lambda codes: pa.RecordBatch.from_pydict({"code": pa.array(codes, pa.int64()), "n": pa.array([1] * len(codes), pa.int64())})
    out = [r for b in cooccur._runs(iter([batch([1, 1, 2]), batch([2, 2]), batch([]), batch([2, 3])])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert out == [(1, 2), (2, 4), (3, 1)]


def test_terms_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, ["".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 8))], 0) for k in range(500)]
    rows += [(900, None, 0), (901, [], 0), (902, ["", None], 0), (903, ["क", "क", "x" * 5000], 0)]
    for least in (20_000, 1):
        monkeypatch.setattr(termfreq, "ROUTE", least)
        got = {r.term: (r.occurrences, r.records, r.mark) for r in termfreq.term_frequency(spark.createDataFrame(rows, LISTS), "items").collect()}
        kept = [[x for x in (r[1] or []) if x] for r in rows]
        occ, rec = Counter(x for s in kept for x in s), Counter(x for s in kept for x in set(s))
        spoken = sum(1 for s in kept if s)
        assert got == {t: (occ[t], rec[t], "rare" if rec[t] < 3 else "common" if rec[t] > 0.1 * spoken else None) for t in occ}


def test_terms_of_nothing(spark):
    assert termfreq.term_frequency(spark.createDataFrame([], LISTS), "items").count() == 0


def test_trie_bursts_and_keeps_order(monkeypatch):
    monkeypatch.setattr(termfreq, "LEAF", 4)
    trie, words = termfreq.BurstTrie(), [f"{a}{b}{c}" for a in "xyz" for b in "ab" for c in ("", "1", "12", "2")]
    for w in words * 3:
        trie.add(w, 1, 1)
    assert [(t, n) for t, n, _ in trie.walk()] == [(w, 3) for w in sorted(words)]


def test_adaptive_prefixes_bound_every_route(spark, monkeypatch):
    monkeypatch.setattr(termfreq, "SMALL", 1)
    deep = "https://www.example.org/" * 4
    terms = [f"{a}{b}{c}" for a in "ab" for b in "cdef" for c in "0123456789"] + ["a", "b", "ac"] + [f"{deep}{k:02}" for k in range(30)] + ["same"] * 20
    runs = spark.createDataFrame([(t, 1, 1) for t in terms], "term string, occurrences bigint, records bigint")
    longer = termfreq.adaptive_prefixes(runs, most=5)
    routes = {}
    for t in terms:
        p = termfreq.prefix_of(t, longer)
        assert t.startswith(p)
        routes.setdefault(p, set()).add(t)
    assert all(len(ts) <= 5 or ts == {p} for p, ts in routes.items()) and len(longer) < 20


def brute_components(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[root(a)] = root(b)
    groups = {}
    for x in list(up):
        groups.setdefault(root(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("small", [10_000, 3])
def test_components_against_union_find(spark, monkeypatch, small):
    monkeypatch.setattr(splits, "HUB", 20)
    rng = random.Random(4)
    edges = [(f"n{rng.randint(0, 150)}", f"n{rng.randint(0, 150)}") for _ in range(110)]
    edges += [(f"c{k}", f"c{k + 1}") for k in range(60)] + [("hub", f"h{k}") for k in range(80)] + [("self", "self"), ("c1", "c2")]
    df = spark.createDataFrame([*edges, ("lost", None), (None, None)], "a string, b string")
    got = {}
    for r in splits.components(df, small_graph=small).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert {frozenset(g) for g in got.values()} == brute_components(edges)


def test_components_of_nothing(spark):
    assert splits.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_splits_keep_relations_and_proportions(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [(k, f"d{rng.randint(0, 400)}" if k % 4 else "hot", f"f{rng.randint(0, 3000)}" if k % 2 else None, "clash") for k in range(4000)] + [(9000, None, None, ""), (9001, None, None, ""), (1, "d1", None, "")]
    df = spark.createDataFrame(rows, "load_id bigint, doc string, file string, split string")
    links = {"doc": F.col("doc"), "file": F.when(F.col("doc") != "hot", F.col("file"))}
    out = splits.related_splits(df, "load_id", links, {"train": 0.5, "validation": 0.25, "test": 0.25, "none": 0.0}).collect()
    assert len(out) == len(rows)
    where = {}
    for r in out:
        where.setdefault(r.component, set()).add(r.split)
    assert all(len(s) == 1 for s in where.values())
    by_row = {r.load_id: r.split for r in out}
    for key in (1, 2):
        seen = {}
        for r in rows:
            if r[key] and not (key == 2 and r[1] == "hot"):
                assert seen.setdefault(r[key], by_row[r[0]]) == by_row[r[0]]
    share = Counter(r.split for r in out)
    assert set(share) <= {"train", "validation", "test"}
    sizes = Counter(r.component for r in out)
    if max(sizes.values()) < 0.5 * len(rows):
        assert abs(share["train"] / len(rows) - 0.5) < 0.05


def test_splits_of_nothing(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([], "load_id bigint, doc string")
    assert splits.related_splits(df, "load_id", {"doc": F.col("doc")}, {"train": 1.0}).count() == 0


def test_pairs_and_classes_within_components(spark):
    rows = [(f"n{k:03}", "big" if k < 40 else f"c{k % 7}") for k in range(60)] + [("alone", "x")]
    df = spark.createDataFrame(rows, "node string, component string")
    want = {(a, b) for a, c in rows for b, e in rows if c == e and a < b}
    for hot in (1_000, 5):
        got = [tuple(r) for r in splits.pairs_within(df, "node", "component", hot).collect()]
        assert set(got) == want and len(got) == len(want)
    links = {r.node: (r.class_id, r.n_links) for r in splits.classes(df, "node", "component").collect()}
    assert links == {a: (min(b for b, e in rows if e == c), sum(e == c for _, e in rows) - 1) for a, c in rows}
