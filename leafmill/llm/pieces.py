"""Problem 2: splitting oversized items at natural boundaries.

Method: ranges with halos.  A text is cut into ranges; each worker detects the boundaries of its range, with a halo on
either side, and follows the cuts from every place at which the range can be entered; the ranges' tables (entry,
exit, pieces) are stitched in one pass in the order of the ranges, which sums the pieces before each; then each range emits its own
pieces by offset.  Every text takes this way, whatever its length.  No step after the first holds a whole text, and files
are never read whole: ``file_ranges`` reads byte ranges.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut

#: Code points a piece holds at most, repeats at most of the piece before, and a range owns.
LIMIT, OVERLAP, RANGE = 2_000, 200, 8_192
#: Code points before a place that tell whether a sentence ends there.
LOOK = 80
_SENTENCE = re.compile(r"[.?!।…][\"'”’)\]]{0,3}[ \t\n]{1,64}(?=[^ \t\n])")
_KINDS = ("end", "paragraph", "sentence", "line", "word", "forced")
_PIECES = "kind string, id bigint, piece int, start bigint, stop bigint, cut string, text string"
_PIECE = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("cut", pa.string()), ("text", pa.string())])
_RANGES = "row bigint, kind string, id bigint, rno int, base bigint, own bigint, own_end bigint, total bigint, chunk string"
_RANGE = pa.schema([("row", pa.int64()), ("kind", pa.string()), ("id", pa.int64()), ("rno", pa.int32()), ("base", pa.int64()), ("own", pa.int64()), ("own_end", pa.int64()), ("total", pa.int64()), ("chunk", pa.string())])
_LONGS = pa.list_(pa.int64())
_TRACE = pa.schema([("row", pa.int64()), ("rno", pa.int32()), ("own_end", pa.int64()), ("first", _LONGS), ("exit", _LONGS), ("before", _LONGS), ("n", _LONGS)])
_ENTRY = pa.schema([("row", pa.int64()), ("rno", pa.int32()), ("entry", pa.int64()), ("before", pa.int64()), ("pieces", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", _LONGS: "array<bigint>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _ends(places: np.ndarray | list[int]) -> np.ndarray:
    """Sorted places between two that are never chosen."""
    return np.concatenate(([-1 << 60], np.asarray(places, np.int64), [1 << 60]))


class Boundaries:
    """The boundaries of a stretch of a text, as sorted places in offsets of the whole text.

    A place is where a piece can stop and the next text go on: ``free`` places have a blank, tab or line feed on either
    side; after an empty line, a sentence or a line is better than that.  Whether a place is any of these depends on no more
    than LOOK code points before it.
    """

    def __init__(self, chunk: str, base: int, total: int) -> None:
        codes = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank, feed = (codes == 32) | (codes == 9) | (codes == 10), codes == 10
        inner = np.flatnonzero(blank[:-1] | blank[1:]) + 1 + base
        end = base + len(codes)
        self.base, self.total = base, total
        self.free = _ends([*inner, end] if end == total else inner)
        self.starts = _ends(np.flatnonzero(blank[:-1] & ~blank[1:]) + 1 + base)
        self.sentences = _ends([m.end() + base for m in _SENTENCE.finditer(chunk)])
        self.paragraphs = _ends(np.flatnonzero(feed[:-1] & feed[1:]) + 2 + base)
        self.lines = _ends(np.flatnonzero(feed) + 1 + base)
        self.blanks = np.concatenate(([0], np.cumsum(blank)))

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Blanks in text[lo:hi]."""
        return self.blanks[np.clip(hi - self.base, 0, len(self.blanks) - 1)] - self.blanks[np.clip(lo - self.base, 0, len(self.blanks) - 1)]


def steps(b: Boundaries, at: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, kind as a place in _KINDS) of the piece that follows each cut in ``at``.

    A piece starts at the first sentence, else word, among the last ``overlap`` characters.  It stops after the last
    paragraph, else sentence, else line in the last two fifths of what it may hold, else at the last free place.  A cut is forced only if more than ``limit``
    characters from the cut before on hold no blank, tab or line feed.
    """

    def first(places: np.ndarray, least: np.ndarray) -> np.ndarray:
        return places[np.searchsorted(places, least)]

    def last(places: np.ndarray, most: np.ndarray) -> np.ndarray:
        return places[np.searchsorted(places, most, "right") - 1]

    lo = np.maximum(at - overlap, 0)
    sentence, word = first(b.sentences, lo), first(b.starts, lo)
    start = np.where(sentence < at, sentence, np.where(word < at, word, np.where(b.between(lo, at) > 0, at, lo)))
    start = np.where(at <= overlap, 0, start)
    top, low = start + limit, np.maximum(at + 1, start + limit * 3 // 5)
    stop, kind = top.copy(), np.full(len(at), 5)
    near = first(b.free, at + 1)  # a word that fits into a piece of its own
    fits = near <= at + limit
    stop, kind, start = np.where(fits, near, stop), np.where(fits, 4, kind), np.where(fits & (near > top), np.maximum(start, near - limit), start)
    free = last(b.free, top)
    stop = np.where(free > at, free, stop)
    for n, places in ((3, b.lines), (2, b.sentences), (1, b.paragraphs)):
        p = last(places, top)
        stop, kind = np.where(p >= low, p, stop), np.where(p >= low, n, kind)
    done = (b.total - start <= limit) | (stop == b.total)
    return start, np.where(done, b.total, stop), np.where(done, 0, kind)


def _ranges(limit: int, overlap: int, size: int):
    halo = limit + overlap + LOOK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row, kind, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for rno, own in enumerate(range(0, len(text), size)):
                    base = max(0, own - halo)
                    rows.append((row, kind, i, rno, base, own, min(own + size, len(text)), len(text), text[base : own + size + halo]))
                    held += len(rows[-1][-1])
                    if held > 1 << 22:
                        yield _batch(rows, _RANGE)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, _RANGE)

    return run


def trace(chunk: str, base: int, own: int, own_end: int, total: int, limit: int, overlap: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Table of a range: from which entry on, the cut at which the range is left, the start of its last piece, and its pieces.

    A range is entered at its first cut, which lies less than ``limit`` behind its start: at a free place, or where no blank
    stands among the ``limit - overlap`` characters before, as there a cut may have been forced.  Entries that go on alike make one line.
    """
    b = Boundaries(chunk, base, total)
    every = np.arange(own, own_end)
    bare = every[(b.between(np.maximum(every - limit + overlap, 0), every) == 0) | (every == 0)]
    at = np.union1d(b.free[(b.free >= own) & (b.free < own_end)], bare)
    entries = at[at < own + limit] if own else at[:1]
    if not len(entries):
        return [], [], [], []
    start, stop, _ = steps(b, at, limit, overlap)
    to, before, n = entries.copy(), np.full(len(entries), -1), np.zeros(len(entries), np.int64)
    while (open_ := (to < own_end) & (to < total)).any():
        k = np.searchsorted(at, to[open_])
        before[open_], n[open_], to[open_] = start[k], n[open_] + 1, stop[k]
    new = np.flatnonzero(np.concatenate(([True], (to[1:] != to[:-1]) | (before[1:] != before[:-1]) | (n[1:] != n[:-1]))))
    return entries[new].tolist(), to[new].tolist(), before[new].tolist(), n[new].tolist()


def _trace(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(row, rno, own_end, *trace(chunk, base, own, own_end, total, limit, overlap)) for row, rno, base, own, own_end, total, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield _batch(rows, _TRACE)

    return run


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry, start of the piece before and number of pieces before each range, from tables sorted by text and range; one range is held at a time."""
    text, at, before, pieces = None, 0, 0, 0
    for batch in batches:
        rows = []
        for row, rno, own_end, first, exit_, start, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row != text:
                text, at, before, pieces = row, 0, 0, 0
            if at >= own_end:  # the last piece reaches beyond this range
                continue
            k = bisect_right(first, at) - 1
            rows.append((row, rno, at, before, pieces))
            at, before, pieces = exit_[k], start[k], pieces + n[k]
        if rows:
            yield _batch(rows, _ENTRY)


def _emit(limit: int, overlap: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kind, i, base, own_end, total, chunk, at, before, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                b = Boundaries(chunk, base, total)
                while at < own_end and at < total:
                    start, stop, k = (int(x[0]) for x in steps(b, np.array([at]), limit, overlap))
                    s = max(start, before)
                    rows.append((kind, i, piece, s, stop, _KINDS[k], chunk[s - base : stop - base] if texts else None))
                    at, before, piece = stop, start, piece + 1
            if rows:
                yield _batch(rows, _PIECE)

    return run


def split_ranges(ranges: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, texts: bool = True) -> DataFrame:
    """Pieces of texts given as ranges (row, kind, id, rno, base, own, own_end, total, chunk); a chunk starts at ``base``.

    ``row`` tells the texts apart, whatever kind and id are.  A range must be as long as two limits at least (the last
    may be shorter), and its chunk reach one limit plus the overlap plus LOOK beyond it on either side.  ``ranges`` is read twice.
    """
    traces = ranges.select("row", "rno", "base", "own", "own_end", "total", "chunk").mapInArrow(_trace(limit, overlap), _ddl(_TRACE))
    entries = traces.repartition("row").sortWithinPartitions("row", "rno").mapInArrow(_stitch, _ddl(_ENTRY))
    joined = ranges.join(cut(entries, "entries"), ["row", "rno"]).select("kind", "id", "base", "own_end", "total", "chunk", "entry", "before", "pieces")
    return joined.mapInArrow(_emit(limit, overlap, texts), _PIECES)


def split_oversized(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, range_chars: int = RANGE, texts: bool = True) -> DataFrame:
    """Pieces of every text over ``limit`` code points, each at most ``limit`` long.

    ``items`` has ``kind STRING, id BIGINT, text STRING``; null and shorter texts, empty ones too, need no cut and give no
    row; rows are told apart by themselves, so repeated rows give repeated pieces, and null or repeated kinds and ids change nothing.
    Result: ``kind, id, piece`` (0, 1, ...), ``start`` and ``stop`` offsets, ``cut`` (how the piece ends: paragraph, sentence,
    line, word, forced, end) and ``text`` (null unless ``texts``).  Piece k+1 starts at most ``overlap`` characters before
    piece k stops, at a sentence or word where one starts there, and never before piece k.  The pieces do not depend on ``range_chars``.
    """
    if range_chars < 2 * limit or overlap * 2 > limit:
        raise ValueError("a range must hold two limits, a limit two overlaps")
    long = items.select(F.monotonically_increasing_id().alias("row"), F.col("kind").cast("string").alias("kind"), F.col("id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).filter(F.length("text") > limit)
    # The rows' numbers hold as they are written.
    return split_ranges(cut(long.mapInArrow(_ranges(limit, overlap, range_chars), _RANGES), "ranges"), limit, overlap, texts)


def file_ranges(spark: SparkSession, paths: list[str], range_bytes: int = 8 << 20, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Ranges, for ``split_ranges``, of UTF-8 files on any file system that Spark and Arrow both reach by URI; ids follow the order of ``paths``.

    Only the byte ranges with their halos are read, by the workers.  A first pass counts the characters of each byte range;
    prefix sums turn byte offsets into character offsets.  Empty files have no range.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def status(path: str):
        p = jvm.org.apache.hadoop.fs.Path(path)
        s = p.getFileSystem(conf).getFileStatus(p)
        return s.getPath().toUri().toString(), s.getLen()

    halo = 4 * (limit + overlap + LOOK)
    sizes = [status(p) for p in paths]
    files = spark.createDataFrame([(i, p, n) for i, (p, n) in enumerate(sizes) if n], "id bigint, path string, size bigint")
    parts = files.select("id", "path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / range_bytes))).alias("k"))
    parts = parts.select("id", "path", "size", F.col("k").cast("int").alias("rno"), (F.col("k") * range_bytes).alias("lo"), F.least((F.col("k") + 1) * range_bytes, "size").alias("hi"))
    # The plan's rows are small, what they stand for is not: the number of tasks is set, so that it is kept.
    ranges = sum(-(-n // range_bytes) for _, n in sizes)
    tasks = max(1, min(ranges, max(4 * spark.sparkContext.defaultParallelism, ranges // 16)))
    parts = parts.repartition(tasks, "path", "rno")

    def opened(path: str):
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path)
        return system.open_input_file(place)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path, rno, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opened(path) as f:
                    f.seek(lo)
                    data = np.frombuffer(f.read(hi - lo), np.uint8)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i], pa.int64()), "rno": pa.array([rno], pa.int32()), "chars": pa.array([int(np.count_nonzero(data & 0xC0 != 0x80))], pa.int64())})

    lengths = cut(parts.select("id", "path", "rno", "lo", "hi").mapInArrow(count, "id bigint, rno int, chars bigint"), "lengths")
    w = Window.partitionBy("id").orderBy("rno")
    placed = parts.join(lengths.withColumn("own", F.sum("chars").over(w) - F.col("chars")).withColumn("total", F.sum("chars").over(Window.partitionBy("id"))), ["id", "rno"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, i, rno, lo, hi, own, chars, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opened(path) as f:
                    f.seek(a := max(0, lo - halo))
                    left, right = f.read(lo - a), f.read(hi - lo + halo)
                start = next((k for k, x in enumerate(left[:4]) if x & 0xC0 != 0x80), 0)  # the left halo may start inside a character
                head = next((k for k, x in enumerate(right[:4]) if x & 0xC0 != 0x80), 0)  # bytes of the last character before the range
                before = (left[start:] + right[:head]).decode("utf-8", "replace")
                text = before + right[head:].decode("utf-8", "ignore")
                yield _batch([(i, "file", i, rno, own - len(before), own, own + chars, total, text)], _RANGE)

    return placed.select("path", "id", "rno", "lo", "hi", "own", "chars", "total").repartition(tasks, "path", "rno").mapInArrow(read, _RANGES)
