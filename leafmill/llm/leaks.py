"""Problem 7: evaluation texts leaking into training text.

Method: a distributed positional inverted index.  Of the documents those postings are stored that a test item can ask
for; lists of neighbouring terms are intersected at once, as the documents are read, so the stored postings are of pairs, and those of one
document stay together, so that lists are intersected where they lie.  From the rarest test pairs on, lists are intersected with offset
adjustment (document position less item position); documents in which enough agree are read again and aligned around the place, for exact and near matches.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from .lookalike import letters

#: Words a passage has at least; rare pairs of neighbours taken from every stretch of so many words; of them so many must agree in
#: offset, up to so much drift. Two edits break four of the pairs taken from a stretch, which leaves AGREE.
PASSAGE, RAREST, AGREE, DRIFT = 12, 7, 3, 16
#: A passage may have an edit in every so many words, whatever its score.
EDITED = 8
#: Words that agree, less PENALTY for each one changed, dropped or added, that a passage of more edits must reach; a run of so
#: many words that so many items share is a stock instruction.
SCORE, PENALTY, STOCK_RUN, STOCK_ITEMS = 11, 2, 8, 4
#: Test tokens that are looked up at once; larger test sets are taken in blocks.  Documents with candidates, with these, that are broadcast; more are joined.
BLOCK_TOKENS, BROADCAST = 2_000_000, 200_000
_TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    """Words in one form, whatever their case, punctuation and coding of characters."""
    if text.isascii():
        return _TOKEN.findall(text.lower())
    return _TOKEN.findall(unicodedata.normalize("NFKC", letters(text)).casefold())


def stock_runs(rows: list[tuple[int, str]]) -> set[tuple[str, ...]]:
    """The runs of STOCK_RUN words that STOCK_ITEMS of all test items share, whichever blocks these are searched in."""
    runs: dict[tuple[str, ...], set[int]] = defaultdict(set)
    for i, text in rows:
        t = tokens(text)
        for k in range(len(t) - STOCK_RUN + 1):
            own = runs[tuple(t[k : k + STOCK_RUN])]
            if len(own) < STOCK_ITEMS:
                own.add(i)
    return {r for r, own in runs.items() if len(own) >= STOCK_ITEMS}


class _Items:
    """The test items of a block: codes of their terms, their code sequences, and which places are stock."""

    def __init__(self, rows: list[tuple[int, str]], stock: set[tuple[str, ...]]) -> None:
        self.words = {i: tokens(t) for i, t in rows}
        self.code = {w: n for n, w in enumerate(sorted({w for t in self.words.values() for w in t}), 1)}
        self.seq = {i: [self.code[w] for w in t] for i, t in self.words.items()}
        self.stock = {i: {k + d for k in range(len(t) - STOCK_RUN + 1) if tuple(t[k : k + STOCK_RUN]) in stock for d in range(STOCK_RUN)} for i, t in self.words.items()}

    def pairs(self, i: int) -> list[int | None]:
        """Neighbouring terms of an item as one number each, by the place of the first; None where stock."""
        t, stock = self.seq[i], self.stock[i]
        return [None if k in stock or k + 1 in stock else t[k] << 32 | t[k + 1] for k in range(len(t) - 1)]

    def seeds(self, seen: dict[int, int]) -> list[tuple[int, int, int]]:
        """(pair, item, place) of the rarest pairs of every stretch of PASSAGE words."""
        own = {i: self.pairs(i) for i in self.seq}
        weight = Counter(p for ps in own.values() for p in ps)
        places: dict[tuple[int, int], None] = {}
        for i, ps in own.items():
            for k in range(max(1, len(ps) - PASSAGE + 2)):
                here = [x for x in range(k, min(k + PASSAGE - 1, len(ps))) if ps[x] is not None and seen.get(ps[x], 0)]
                for x in sorted(here, key=lambda x: (seen[ps[x]] * weight[ps[x]], x))[:RAREST]:
                    places[i, x] = None
        return [(own[i][x], i, x) for i, x in places]


def least_pairs(score: int, passage: int) -> int:
    """Neighbouring pairs that stand unchanged in any passage: an edit breaks two, and long drifting passages hold as many in some part."""
    return min(score - 1, min(n - 1 - 2 * (n // EDITED) for n in range(passage, passage + EDITED)))


def _postings(know, least: int):
    """(doc_id, pairs, places) of texts with ``least`` or more asked pairs of neighbouring terms; a batch of texts is looked up at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, asked = know.value
        get = code.get
        for batch in batches:
            seqs = [[get(w, 0) for w in tokens(t)] for t in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, seqs), np.int64, len(seqs))
            flat = np.fromiter(chain.from_iterable(seqs), np.int64, int(sizes.sum()))
            if len(flat) < 2 or not len(asked):
                continue
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            doc = np.repeat(np.arange(len(seqs)), sizes)
            at = np.flatnonzero((flat[:-1] > 0) & (flat[1:] > 0) & (doc[:-1] == doc[1:]))
            pairs = flat[at] << 32 | flat[at + 1]
            hit = asked[np.minimum(np.searchsorted(asked, pairs), len(asked) - 1)] == pairs
            at, pairs = at[hit], pairs[hit]
            held = np.bincount(doc[at], minlength=len(seqs))
            keep = held[doc[at]] >= least
            at, pairs, docs = at[keep], pairs[keep], np.flatnonzero(held >= least)
            ends = pa.array(np.concatenate(([0], np.cumsum(held[docs]))).astype(np.int32))
            ids = batch.column(0).take(pa.array(docs))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array((at - starts[doc[at]]).astype(np.int32)))], names=["doc_id", "pairs", "places"])

    return run


def _intersect(know, least: int):
    """(doc_id, item_id, lo, hi): offsets at which the rarest pairs of an item agree in AGREE places, and all its pairs in ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare, every = know.value
        for batch in batches:
            rows = []
            for doc, pairs, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells: dict[tuple[int, int], set[int]] = defaultdict(set)
                for p, at in zip(pairs, places, strict=True):
                    for item, place in rare.get(p, ()):
                        off = at - place
                        cells[item, off // DRIFT * 2].add(place)
                        cells[item, (off + DRIFT // 2) // DRIFT * 2 + 1].add(place)
                asked: dict[int, set[int]] = defaultdict(set)
                for (item, cell), seen in cells.items():
                    if len(seen) >= AGREE:
                        asked[item].add(cell)
                if not asked:
                    continue
                found: dict[tuple[int, int], tuple[set[int], list[int]]] = defaultdict(lambda: (set(), []))
                for p, at in zip(pairs, places, strict=True):
                    for item, place in every.get(p, ()):
                        if item in asked:
                            off = at - place
                            for cell in (off // DRIFT * 2, (off + DRIFT // 2) // DRIFT * 2 + 1):
                                if cell in asked[item]:
                                    found[item, cell][0].add(place)
                                    found[item, cell][1].append(off)
                rows += [(doc, item, min(offs), max(offs)) for (item, _), (seen, offs) in found.items() if len(seen) >= least]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.int32()] * 2, strict=True)], names=["doc_id", "item_id", "lo", "hi"])

    return run


def align(item: list[int], window: list[int], score: int = SCORE, passage: int = PASSAGE) -> tuple[int, int, int, int, int]:
    """(score, first, last place in the item, first, last in the window) of the best stretch that is a passage, or zeros.

    Its score is the words that agree less PENALTY for each edit; it spans ``passage`` words and has that ``score``, or so few edits.
    """
    best = (0, 0, 0, 0, 0)
    blocks = [b for b in SequenceMatcher(None, item, window, autojunk=False).get_matching_blocks() if b.size]
    for k, (a0, b0, _) in enumerate(blocks):
        run, edits, a1, b1 = 0, 0, a0, b0
        for a, b, n in blocks[k:]:
            lost = max(a - a1, b - b1)
            run, edits, a1, b1 = run + n - PENALTY * lost, edits + lost, a + n, b + n
            if run > best[0] and a1 - a0 >= passage and (run >= score or edits <= (a1 - a0) // EDITED):
                best = (run, a0, a1, b0, b1)
    return best


def _verify(know, score: int, passage: int):
    """Aligns the items with the stretches of a text where they may stand."""
    least = min(score, passage - passage // EDITED)  # words that agree in any passage

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, seq, stock = know.value
        for batch in batches:
            rows = []
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = [code.get(w, 0) for w in tokens(text)]
                best: dict[int, tuple] = {}
                for i, lo, hi in sorted({(h["item_id"], h["lo"], h["hi"]) for h in places}):
                    item = [-1 if k in stock[i] else c for k, c in enumerate(seq[i])]
                    at = max(0, lo - DRIFT)
                    window = codes[at : hi + len(item) + DRIFT]
                    if (Counter(item) & Counter(window)).total() < least:
                        continue
                    found = align(item, window, score, passage)
                    if found[0] > best.get(i, (0,))[0]:
                        best[i] = (*found[:3], found[3] + at, found[4] + at)
                rows += [(doc, i, *v) for i, v in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 2 + [pa.int32()] * 5, strict=True)], names=["doc_id", "item_id", "score", "item_start", "item_stop", "doc_start", "doc_stop"])

    return run


_FOUND = "doc_id bigint, item_id bigint, score int, item_start int, item_stop int, doc_start int, doc_stop int"


def _one_block(documents: DataFrame, rows: list[tuple[int, str]], stock: set[tuple[str, ...]], score: int, passage: int, broadcast: int) -> DataFrame:
    share, items, least = documents.sparkSession.sparkContext.broadcast, _Items(rows, stock), least_pairs(score, passage)
    every: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in items.seq:
        for k, p in enumerate(items.pairs(i)):
            if p is not None:
                every[p].append((i, k))
    index = cut(documents.mapInArrow(_postings(share((items.code, np.array(sorted(every), np.int64))), least), "doc_id bigint, pairs array<bigint>, places array<int>"), "postings")
    seen = {r.pair: r.n for r in index.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()}  # no more rows than the block has pairs
    rare: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, i, k in items.seeds(seen):
        rare[p].append((i, k))
    wanted = index.mapInArrow(_intersect(share((dict(rare), dict(every))), least), "doc_id bigint, item_id bigint, lo int, hi int").distinct()
    hits = cut(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "lo", "hi")).alias("hits")), "candidates")  # the items of one document
    near = documents.join(F.broadcast(hits) if hits.count() <= broadcast else hits, "doc_id").select("doc_id", "text", "hits")
    return near.mapInArrow(_verify(share((items.code, items.seq, items.stock)), score, passage), _FOUND)


def leaks(documents: DataFrame, items: DataFrame, score: int = SCORE, passage: int = PASSAGE, block_tokens: int = BLOCK_TOKENS, broadcast: int = BROADCAST) -> DataFrame:
    """Where passages of test items stand in documents: doc_id, item_id, score, and token ranges in item and document.

    ``documents`` has ``doc_id BIGINT, text``, ``items`` ``item_id BIGINT, text``; other columns are ignored.  A row says that at least
    ``passage`` words of the item stand in the document, with no more than one edit in EDITED words, or those that agree less
    PENALTY for each edit being at least ``score``; the best place of each pair is given.  Runs of STOCK_RUN words shared by STOCK_ITEMS items are stock and match
    nothing.  Null and empty texts, and texts without doc_id, match nothing; of rows with one item_id the texts are searched as one item each
    under that id; a document repeated under one doc_id is searched once for each row.  The test set is the stated
    query set; beyond ``block_tokens`` it is searched in blocks.  Documents are read once for the postings and once more where they
    have candidates; up to ``broadcast`` such documents are told by a broadcast, more by a shuffle.
    """
    asked = [(r.item_id, r.text) for r in items.select("item_id", "text").filter("text is not null and item_id is not null").distinct().toLocalIterator()]
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null and doc_id is not null")
    blocks: list[list[tuple[int, str]]] = [[]]
    size, held = 0, set()
    for i, t in sorted(asked):
        size += len(t) // 5 + 1
        if i in held or size > block_tokens and blocks[-1]:
            blocks.append([])
            size, held = len(t) // 5 + 1, set()
        blocks[-1].append((i, t))
        held.add(i)
    stock, out = stock_runs(asked), None
    for b in blocks:
        part = _one_block(texts, b, stock, score, passage, broadcast)
        out = part if out is None else out.unionByName(part)
    best = F.max_by(F.struct(*(c.split()[0] for c in _FOUND.split(", ")[2:])), F.struct("score", -F.col("doc_start"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")
