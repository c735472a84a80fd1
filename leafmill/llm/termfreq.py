"""Problem 5: frequency of every distinct value or term.

Method: burst tries.  Each worker counts into a trie whose leaves burst into sub-tries as they fill; terms travel by
adaptive prefixes, lengthened only where many terms share one; matching sub-tries of all workers meet and merge.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

#: Terms a leaf holds before it bursts, terms a worker's trie holds before it is emptied as a sorted run; rows a prefix carries at most, and, where
#: there are few, about so many prefixes as there are tasks to keep busy, of so many rows at least.
LEAF, HELD, ROUTE, SPREAD, SMALL = 512, 500_000, 500_000, 64, 20_000
_SCHEMA = "term string, occurrences bigint, records bigint"


class BurstTrie:
    """Counters by term; a leaf is a dict from suffix to counters, an inner node a dict from character to node."""

    __slots__ = ("inner", "leaf", "size")

    def __init__(self) -> None:
        self.leaf: dict[str, list[int]] | None = {}
        self.inner: dict[str, BurstTrie] = {}
        self.size = 0

    def add(self, term: str, occurrences: int, records: int) -> bool:
        """True if the term is new."""
        node, at = self, 0
        while node.leaf is None:
            node = node.inner.setdefault(term[at : at + 1], BurstTrie())
            at += 1
        rest = term[at:]
        held = node.leaf.get(rest)
        if held is not None:
            held[0] += occurrences
            held[1] += records
            return False
        node.leaf[rest] = [occurrences, records]
        if len(node.leaf) > LEAF and any(node.leaf):
            node._burst()
        self.size += 1
        return True

    def _burst(self) -> None:
        full, self.leaf = self.leaf, None
        for suffix, held in full.items():
            child = self.inner.setdefault(suffix[:1], BurstTrie())
            child.leaf[suffix[1:]] = held

    def walk(self, prefix: str = "") -> Iterator[tuple[str, int, int]]:
        """All terms in order."""
        stack: list[tuple[str, BurstTrie]] = [(prefix, self)]
        while stack:
            prefix, node = stack.pop()
            if node.leaf is None:
                stack += [(prefix + c, node.inner[c]) for c in sorted(node.inner, reverse=True)]
            else:
                for suffix in sorted(node.leaf):
                    yield prefix + suffix, *node.leaf[suffix]


def _emit(trie: BurstTrie, extra: list | None = None) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[str, int, int]] = []
    for row in trie.walk():
        rows.append(row)
        if len(rows) == 20_000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["term", "occurrences", "records"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = BurstTrie()
    for batch in batches:
        every, once = Counter(), Counter()
        for held in batch.column(0).to_pylist():
            if held:
                every.update(held)
                once.update(set(held))
        for term, n in every.items():
            trie.add(term, n, once[term])
        if trie.size > HELD:
            yield from _emit(trie)
            trie = BurstTrie()
    yield from _emit(trie)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the sub-tries of one prefix after the other; rows come sorted by prefix."""
    trie, at = BurstTrie(), None
    for batch in batches:
        for route, term, n, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if route != at:
                yield from _emit(trie)
                trie, at = BurstTrie(), route
            trie.add(term, n, m)
    yield from _emit(trie)


def prefix_of(term: str, longer: dict[str, int]) -> str:
    """The prefix a term travels by: its first character, lengthened as long as that is too heavy."""
    p = term[:1]
    while p in longer and len(p) < len(term):
        p = term[: longer[p]]
    return p


def _route(know):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longer = know.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([prefix_of(t, longer) for t in batch.column(0).to_pylist()], pa.string()), *batch.columns], names=["route", "term", "occurrences", "records"])

    return run


def _common(a: str, b: str) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def adaptive_prefixes(runs: DataFrame, most: int = ROUTE) -> dict[str, int]:
    """By each prefix that carries too many rows the length to lengthen it to, so that no prefix but a whole term carries more than ``most``.

    One count a round.  All that is under a heavy prefix lies between its least and its greatest term, so it is lengthened at once to one more than what
    these have in common, and as many rounds are made as prefixes branch, whatever they share.  The driver sees the heavy prefixes only, which
    are no more than rows/most a round.
    """
    context, longer, rows = runs.sparkSession.sparkContext, {}, runs.count()
    bar = min(most, max(SMALL, rows // SPREAD))
    while True:
        routed = runs.mapInArrow(_route(context.broadcast(dict(longer))), f"route string, {_SCHEMA}")
        counts = routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.min("term").alias("a"), F.max("term").alias("b"))
        heavy = counts.filter((F.col("n") > bar) & (F.col("b") != F.col("route"))).collect()
        if not heavy:
            return longer
        longer |= {r.route: max(_common(r.a, r.b), len(r.route)) + 1 for r in heavy}


def term_frequency(records: DataFrame, terms: str = "terms", rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """Occurrences and records of every distinct term, and its mark.

    ``records`` has one row per record and an array of strings in ``terms``; other columns are ignored.  Null and
    empty terms are not counted; a record without terms is no record here.  Result: ``term``, ``occurrences``,
    ``records``, ``mark``: 'rare' if in fewer than ``rare_below`` records, else 'common' if in more than ``common_above``
    of the records that hold any term, else null; ``too_common`` is that second test by itself.  An empty table gives no rows.
    A merging task holds no more than ROUTE terms at once, however many there are.
    """
    held = records.select(F.filter(F.col(terms), lambda x: x.isNotNull() & (x != "")).alias("t"))
    spoken = cut(held.filter(F.size("t") > 0), "terms")
    total = spoken.count()
    runs = cut(spoken.mapInArrow(_count, _SCHEMA), "tries")
    longer = adaptive_prefixes(runs, ROUTE)
    routed = runs.mapInArrow(_route(records.sparkSession.sparkContext.broadcast(longer)), f"route string, {_SCHEMA}").repartition("route").sortWithinPartitions("route")
    merged = routed.select("route", "term", "occurrences", "records").mapInArrow(_merge, _SCHEMA)
    common = F.col("records") > F.lit(common_above) * F.lit(total)
    mark = F.when(F.col("records") < rare_below, "rare").when(common, "common")
    return merged.select("term", "occurrences", "records", mark.alias("mark"), common.alias("too_common"))
