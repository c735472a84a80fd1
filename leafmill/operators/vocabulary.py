"""Terms to a canonical vocabulary: counting, near-duplicates, greedy clusters, thresholds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import cache
from itertools import chain, combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.lineage import cut
from ..plans.scan import spread
from ..plans.skew import strip

# Least count, likeness, length from which a term may be contained, characters of a form, pairs that one task decides at the end, bits of a number, pairs compared in one step.
THRESHOLD, ALIKE, CONTAINED = 3, 0.92, 5
CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
LAST_PAIRS = 500_000
HALF, PAIRS_AT_ONCE = 62, 1_000_000


def term_counts(records: DataFrame, key: str, concepts: str = "concepts") -> DataFrame:
    """(term, n): records that hold a term, terms equal but for case counted once a record under the form met first there.

    Where no key is repeated, a record's terms are told apart within its row, without sorting them all by record.
    """
    if records.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        forms = records.select(F.filter(F.transform(concepts, strip), lambda c: c != "").alias("f")).select("f", F.transform("f", F.lower).alias("l"))
        once = F.transform(F.array_distinct("l"), lambda l: F.get(F.col("f"), (F.array_position("l", l) - 1).cast("int")))
        return forms.select(F.explode(once).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = records.select(F.col(key).alias("k"), F.posexplode(concepts).alias("i", "c")).select("k", "i", strip(F.col("c")).alias("term")).filter("term <> ''")
    firsts = each.groupBy("k", F.lower("term").alias("l")).agg(F.min_by("term", "i").alias("term"))
    return firsts.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def new_terms(counts: DataFrame, structural: DataFrame) -> DataFrame:
    """Terms that are no structural entry, neither by identifier nor by display name: two anti-joins, no OR."""
    ids = structural.select(F.col("canonical_id").alias("__id")).distinct()
    names = structural.select(F.lower("display_name").alias("__n")).distinct()
    out = counts.withColumn("__id", T.canonicalize(F.col("term"))).withColumn("__n", F.lower("term"))
    return out.join(ids, "__id", "left_anti").join(names, "__n", "left_anti").select("term", "n")


def ranked(counts: DataFrame) -> DataFrame:
    """``counts`` with ``rank`` struct: more frequent terms first, then by the term."""
    return counts.withColumn("rank", F.struct((-F.col("n")).alias("m"), F.col("term").alias("t")))


def most_unmatched(both: int) -> int:
    """Characters of two forms, ``both`` long together, that may fail to match if they are more than ALIKE alike: fewer than 8 % of them, and odd as ``both`` is; below 0 if none can be alike."""
    most = (2 * both - 1) // 25
    return most - (most - both) % 2


@cache
def _parts(short: int, unmatched: int) -> list[tuple[int, int, int]]:
    """(start, length, errors) of parts of the shorter of two forms: with so many characters unmatched, one part at least has no more than its errors.

    For that errors + 1, summed, must exceed ``unmatched``.  Parts are long, so that few forms share one, and errors few, so that a part has few keys.
    """
    if unmatched <= 1:
        return [(0, short, unmatched)]
    if unmatched <= 5:
        first, last = (unmatched - 1) // 2, unmatched // 2
        end = short * 21 // 50 // 2 * 2  # terms begin alike more often than they end alike, so the end may be the shorter part
        end, start = min(end, 10) if last > 1 else end, (short - end) // 2 * 2
        return [(0, min(start, 12) if first > 1 else start, first), (short - end, end, last)]
    n = unmatched // 2 + 1
    cuts = [short * k // n for k in range(n + 1)]
    return [(a, b - a, 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def _without(s: bytes, n: int) -> set[bytes]:
    """``s`` with ``n`` of its characters left out, in every way."""
    if n == 0:
        return {s}
    if n == 1:
        return {s[:k] + s[k + 1 :] for k in range(len(s))}
    return {s[:k] + s[k + 1 : m] + s[m + 1 :] for k, m in combinations(range(len(s)), 2)}  # no part has more errors


@cache
def _lengths(size: int, shorter: bool) -> list[tuple[int, int]]:
    """(length of the shorter, characters unmatched) for every length of the other that a form of ``size`` can be alike with."""
    others = range(size, size * 6 // 5 + 2) if shorter else range(size * 5 // 6 - 1, size + 1)
    return [(min(size, o), u) for o in others if o > 0 and (u := most_unmatched(size + o)) >= max(1, abs(size - o))]


def _keys_of_shorter(f: str) -> set[int]:
    """Every part with up to its errors left out."""
    out, f = set(), f.encode()
    for short, unmatched in dict.fromkeys(_lengths(len(f), True)):
        parts = _parts(short, unmatched)
        for n, (at, size, errors) in enumerate(parts):
            for gone in range(min(errors, size) + 1):
                out |= {crc32(v, n * 31 + len(parts)) for v in _without(f[at : at + size], gone)}
    return out


def _keys_of_longer(f: str) -> set[int]:
    """What may stand in the place of every part of a shorter form, with the rest of its errors left out."""
    pieces, f = set(), f.encode()
    for short, unmatched in _lengths(len(f), False):
        parts, more = _parts(short, unmatched), len(f) - short
        lost, put = (unmatched - more) // 2, (unmatched + more) // 2  # unmatched of the shorter and of this one
        for n, (at, size, errors) in enumerate(parts):
            for gone in range(errors + 1):
                for missing in range(errors - gone + 1):
                    wide = size - missing + gone
                    places = [0] if at == 0 else [len(f) - wide] if n == len(parts) - 1 else range(max(0, at - lost), min(at + put, len(f) - wide) + 1)
                    pieces |= {(f[k : k + wide], gone, n * 31 + len(parts)) for k in places if 0 <= k <= len(f) - wide}
    return {crc32(v, salt) for piece, gone, salt in pieces for v in _without(piece, gone)}


def _held(f: str) -> tuple[int, int]:
    """The characters of a form, in two numbers with a bit for each that it holds once, twice and three times at least."""
    times: dict[str, int] = {}
    bits = 0
    for c in f:
        n = times[c] = times.get(c, -1) + 1
        if n < 3:
            bits |= 1 << (n * len(CHARACTERS) + CHARACTERS.index(c))
    return bits & (1 << HALF) - 1, bits >> HALF


def _keyed(keys: Callable[[str], set[int]], longer: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(k, f, h, i): a form's keys, doubled, and one more if they are those of a longer form; the form, and the characters it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                forms = batch.column(0).slice(start, 500)
                texts = forms.to_pylist()
                each = [keys(f) for f in texts]
                at = pa.array(np.repeat(np.arange(len(each), dtype=np.int32), [len(e) for e in each]))
                held = [_held(f) for f in texts]
                k = np.fromiter(chain.from_iterable(each), np.int64) * 2 + longer
                yield pa.RecordBatch.from_arrays([pa.array(k), forms.take(at), *(pa.array([h[n] for h in held], pa.int64()).take(at) for n in (0, 1))], names=["k", "f", "h", "i"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, y): forms that share a key, x no longer than y, of rows of ``_keyed`` in the order of k; a key's rows may lie in several batches.

    Characters that only one form holds fail to match, so pairs that differ in more of them than may are left out.
    """
    open_ = None
    for batch in chain(batches, [None]):
        rows = [x for x in (open_, batch) if x is not None]
        if not rows:
            return
        here = pa.concat_batches(rows)
        if here.num_rows == 0:
            continue
        k = here.column(0).to_numpy()
        if batch is not None:  # the last key may go on
            end = int(np.searchsorted(k, k[-1] & ~1))
            here, open_, k = here.slice(0, end), here.slice(end), k[:end]
        if len(k):
            for x, y in _pairs_within(k >> 1, k & 1 == 1, *(c.to_numpy() for c in (pc.binary_length(here.column(1)), here.column(2), here.column(3)))):
                yield pa.RecordBatch.from_arrays([here.column(1).take(pa.array(x)), here.column(1).take(pa.array(y))], names=["x", "y"])


def _pairs_within(k: np.ndarray, longer: np.ndarray, n: np.ndarray, h: np.ndarray, i: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of a shorter and a longer row with one key whose forms may be alike by lengths and characters, by PAIRS_AT_ONCE."""
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[first, len(k)])
    shorts = np.add.reduceat(~longer, first, dtype=np.int64)
    rows = np.flatnonzero(~longer)
    low, each = np.repeat(first + shorts, shorts), np.repeat(size - shorts, shorts)
    rows, low, each = rows[each > 0], low[each > 0], each[each > 0]
    upto = np.r_[0, np.cumsum(each)]
    most = np.array([most_unmatched(b) for b in range(2 * int(n.max()) + 1)])
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, "right")) - 1)
        x = np.repeat(rows[at:to], each[at:to])
        y = np.arange(len(x)) + np.repeat(low[at:to] - (upto[at:to] - upto[at]), each[at:to])
        apart = np.bitwise_count(h[x] ^ h[y])
        near = apart <= most[n[x] + n[y]]
        x, y, apart = x[near], y[near], apart[near] + np.bitwise_count(i[x[near]] ^ i[y[near]])
        more = n[y] - n[x]
        near = (more >= 0) & (np.maximum(more, apart) <= most[n[x] + n[y]])
        yield x[near], y[near]
        at = to


def _may_be_alike(x: str, y: str) -> bool:
    """By the characters between what both begin and end with: those that only one form holds there fail to match."""
    most = most_unmatched(len(x) + len(y))
    a, b = 0, 0
    short = min(len(x), len(y))
    while a < short and x[a] == y[a]:
        a += 1
    while b < short - a and x[-1 - b] == y[-1 - b]:
        b += 1
    inner, other = x[a : len(x) - b], y[a : len(y) - b]
    for c in inner:
        other = other.replace(c, "", 1)
    return 2 * len(other) + len(x) - len(y) <= most


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of forms that are alike in the order given, in either order: the ratio is not the same in both."""
    for batch in batches:
        out = []
        for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if _may_be_alike(x, y):
                out += [(a, b) for a, b in ((x, y), (y, x)) if SequenceMatcher(None, a, b).ratio() > ALIKE]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.string()) for k in (0, 1)], names=["af", "bf"])


def near_duplicates(counts: DataFrame) -> DataFrame:
    """(a, b): pairs of terms, a ranked first, that are near-duplicates.

    Equal once normalised; or one of more than five characters contained in the other; or equal but for British and
    American spelling; or more than 0.92 alike.  Each case is an equi-join on a key that is exact for it: the form
    itself, six characters of the contained one (its rarest), the form in one spelling, and a part with few errors.
    """
    base = cut(ranked(counts).withColumn("f", T.similarity_form(F.col("term"))).select("term", "f", "rank"), "terms")
    l, r = base.select(F.col("term").alias("a"), F.col("f").alias("af"), F.col("rank").alias("ar")), base.select(F.col("term").alias("b"), F.col("f").alias("bf"), F.col("rank").alias("br"))
    first = F.col("ar") < F.col("br")
    same = l.withColumn("k", T.american(F.col("af"))).join(r.withColumn("k", T.american(F.col("bf"))), "k").filter(first)
    one = [(F.col("af") == F.col("bf"))]
    for brit, amer in T.SPELLINGS:
        one += [F.replace(F.col("af"), F.lit(brit), F.lit(amer)) == F.col("bf"), F.col("af") == F.replace(F.col("bf"), F.lit(brit), F.lit(amer))]
    cond = one[0]
    for c in one[1:]:
        cond = cond | c
    same = same.filter(cond).select("a", "b")
    from .concepts import GRAM, grams

    held = base.select("term", F.explode(grams(F.col("f"))).alias("g"))
    weight = held.groupBy("g").agg(F.count(F.lit(1)).alias("w"))
    rare = held.join(base.filter(F.length("f") > CONTAINED).select("term"), "term").join(weight, "g").groupBy("term").agg(F.min_by("g", F.struct("w", "g")).alias("g"))
    inner = base.join(rare, "term").select(F.col("term").alias("x"), F.col("f").alias("xf"), F.col("rank").alias("xr"), "g")
    outer = held.join(base, "term").select(F.col("term").alias("y"), F.col("f").alias("yf"), F.col("rank").alias("yr"), "g")
    contained = inner.join(outer, "g").filter((F.col("x") != F.col("y")) & F.col("yf").contains(F.col("xf")))
    contained = contained.select(F.when(F.col("xr") < F.col("yr"), F.col("x")).otherwise(F.col("y")).alias("a"), F.when(F.col("xr") < F.col("yr"), F.col("y")).otherwise(F.col("x")).alias("b"))
    return same.unionByName(contained.select("a", "b")).unionByName(_alike_pairs(base)).distinct()


def _alike_pairs(base: DataFrame) -> DataFrame:
    """(a, b) of ``base`` (term, f, rank), a ranked first, whose forms differ and are more than ALIKE alike.

    Of two such forms so few characters fail to match that a long part of the shorter stands in the other with fewer errors
    than the whole.  Forms meet by these parts, with the errors left out on either side, so no pair is lost, and those that only share
    common words do not meet.
    """
    spark = base.sparkSession
    # Making keys and comparing cost far more than the bytes let the adaptive coalescing see, so the number of tasks is kept.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    forms = cut(base.select("f").distinct().repartition(tasks, "f"), "forms")
    side = lambda keys, longer: spread(forms).mapInArrow(_keyed(keys, longer), "k bigint, f string, h bigint, i bigint")
    keyed = side(_keys_of_shorter, False).unionByName(side(_keys_of_longer, True)).repartition(tasks, F.shiftright("k", 1)).sortWithinPartitions("k")  # one number, which is sorted by its digits
    met = keyed.mapInArrow(_meet, "x string, y string").filter((F.length("x") < F.length("y")) | (F.col("x") < F.col("y")))
    # What fails to match bounds the edit distance from above: few pairs are left and none is lost.
    most = F.expr("int((2 * (length(x) + length(y)) - 1) div 25)")
    near = met.withColumn("most", most - F.pmod(most - F.length("x") - F.length("y"), F.lit(2))).filter(F.expr("levenshtein(x, y, most) >= 0"))
    alike = near.select("x", "y").distinct().repartition(tasks, "x", "y").mapInArrow(_alike, "af string, bf string")
    l, r = base.select(F.col("term").alias("a"), F.col("f").alias("af"), F.col("rank").alias("ar")), base.select(F.col("term").alias("b"), F.col("f").alias("bf"), F.col("rank").alias("br"))
    return cut(alike, "alike").join(l, "af").join(r, "bf").filter(F.col("ar") < F.col("br")).select("a", "b")


def _beaten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms that an earlier chosen one claims, of all pairs: a term is decided when all its earlier neighbours are."""
    later: dict[str, list[str]] = {}
    waits: dict[str, int] = {}
    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            later.setdefault(a, []).append(b)
            waits[b] = waits.get(b, 0) + 1
    beaten: set[str] = set()
    ready = [a for a in later if a not in waits]
    while ready:
        a = ready.pop()
        for b in later.get(a, ()):
            waits[b] -= 1
            if a not in beaten:
                beaten.add(b)
            if not waits[b]:
                ready.append(b)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(beaten), pa.string())], names=["term"])


def cluster(counts: DataFrame) -> DataFrame:
    """(term, n, canonical): greedy stars in the order of rank: a term not yet claimed claims all its unclaimed near-duplicates.

    Not transitive.  In rounds: a term without an earlier open neighbour is chosen, and its neighbours are open no more;
    when none is left, every other term belongs to its earliest chosen neighbour.  The number of rounds is that of
    the longest chain of decisions; once LAST_PAIRS pairs of open terms or fewer are left, one task decides the rest.
    """
    counts = cut(counts.select("term", "n"), "counts")
    pairs = cut(near_duplicates(counts), "pairs")
    open_ = cut(pairs.select(F.col("a").alias("term")).unionByName(pairs.select(F.col("b").alias("term"))).distinct(), "open")
    chosen: DataFrame | None = None
    live = pairs
    while not open_.isEmpty():
        if live.count() <= LAST_PAIRS:
            beaten = live.coalesce(1).mapInArrow(_beaten, "term string")
            picked, open_ = open_.join(beaten, "term", "left_anti"), open_.limit(0)
        else:
            picked = cut(open_.join(live.select(F.col("b").alias("term")).distinct(), "term", "left_anti"), "picked")
            beaten = live.join(picked.select(F.col("term").alias("a")), "a", "left_semi").select(F.col("b").alias("term")).distinct()
            open_ = cut(open_.join(picked, "term", "left_anti").join(beaten, "term", "left_anti"), "open")
            live = cut(live.join(open_.select(F.col("term").alias("a")), "a", "left_semi").join(open_.select(F.col("term").alias("b")), "b", "left_semi"), "live")
        chosen = picked if chosen is None else chosen.unionByName(picked)
    if chosen is None:
        return counts.select("term", "n", F.col("term").alias("canonical"))
    ranks = ranked(counts).join(chosen, "term", "left_semi").select(F.col("term").alias("a"), F.col("rank").alias("ar"))
    owned = pairs.join(ranks, "a").groupBy("b").agg(F.min_by("a", "ar").alias("canonical")).select(F.col("b").alias("term"), "canonical")
    return counts.select("term", "n").join(owned, "term", "left").select("term", "n", F.coalesce("canonical", "term").alias("canonical"))


def merged_counts(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy(F.col("canonical").alias("term")).agg(F.sum("n").alias("n"))


def threshold(counts: DataFrame, least: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by count."""
    return counts.filter(F.col("n") >= least), counts.filter(F.col("n") < least)


def extend(structural: DataFrame, accepted: DataFrame) -> DataFrame:
    """(canonical_id, display_name, frequency, source): structural entries, then accepted terms of new identifiers.

    Of accepted terms with one identifier the most frequent is kept, of equals the least by the term.
    """
    new = accepted.withColumn("canonical_id", T.canonicalize(F.col("term"))).filter("canonical_id <> ''")
    best = new.groupBy("canonical_id").agg(F.min(F.struct((-F.col("n")).alias("m"), "term")).alias("b"))
    fresh = best.join(structural.select("canonical_id"), "canonical_id", "left_anti")
    old = structural.select("canonical_id", "display_name", F.col("frequency").cast("bigint").alias("frequency"), F.lit("structural").alias("source"))
    return old.unionByName(fresh.select("canonical_id", T.display_form(F.col("b.term")).alias("display_name"), (-F.col("b.m")).alias("frequency"), F.lit("extracted").alias("source")))


def build(records: DataFrame, key: str, structural: DataFrame, least: int = THRESHOLD) -> dict[str, DataFrame]:
    """vocabulary, merge_map (alias, canonical) and rejected (term, n)."""
    clustered = cut(cluster(new_terms(term_counts(records, key), structural)), "clusters")
    yes, no = threshold(merged_counts(clustered), least)
    aliases = clustered.filter("term <> canonical").select(F.col("term").alias("alias"), "canonical")
    return {"vocabulary": extend(structural, yes), "merge_map": aliases, "rejected": no.select("term", F.col("n").alias("count"))}


def spelled_alike(a: Column, b: Column) -> Column:
    """The first three cases of a near-duplicate as an expression, for pairs at hand."""
    x, y = T.similarity_form(a), T.similarity_form(b)
    contained = ((F.length(x) > CONTAINED) & y.contains(x)) | ((F.length(y) > CONTAINED) & x.contains(y))
    out = (x == y) | contained
    for brit, amer in T.SPELLINGS:
        out = out | (F.replace(x, F.lit(brit), F.lit(amer)) == y) | (x == F.replace(y, F.lit(brit), F.lit(amer)))
    return out
