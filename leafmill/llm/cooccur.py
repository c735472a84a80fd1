"""Problem 1: items that appear together.

Method: items get dense 32-bit numbers; pairs are packed into 64-bit codes, which each worker gathers into runs that it sorts and
run-length counts; the runs are exchanged, merged (Spark's external row sorter spills sorted runs and merges them) and run-length counted
again; then lift and the continuity-corrected odds ratio are computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from ..plans.skew import dense_ids, hot_cold_join

#: Largest dictionary of items that is broadcast, in rows and in characters of all items; codes that a worker's run holds.
BROADCAST_ITEMS, BROADCAST_CHARS, RUN = 200_000, 8_000_000, 2_000_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run-length sums over batches sorted by code; a run may cross batches."""
    code, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, counts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        heads, sums = codes[starts], np.add.reduceat(counts, starts)
        if code is not None:
            if heads[0] == code:
                sums[0] += n
            else:
                heads, sums = np.concatenate(([code], heads)), np.concatenate(([n], sums))
        code, n = heads[-1], sums[-1]
        if len(heads) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(heads[:-1]), pa.array(sums[:-1])], names=["code", "n"])
    if code is not None:
        yield pa.RecordBatch.from_arrays([pa.array([code], pa.int64()), pa.array([n], pa.int64())], names=["code", "n"])


def _codes(numbers):
    """Sorted runs (code, n) of the pairs of each record's items, which come as strings to be numbered, or as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value if numbers is not None else None
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

        for batch in batches:
            for row in batch.column(0).to_pylist():
                ids = np.array(sorted({number[x] for x in row if x in number} if number is not None else set(row)), np.int64)
                for k in range(len(ids) - 1):  # never all pairs of a large record at once
                    held.append(ids[k] << 32 | ids[k + 1 :])
                    size += len(ids) - 1 - k
                    if size >= RUN:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return run


def count_codes(runs: DataFrame) -> DataFrame:
    """(code, n) of sorted runs (code, n): exchange, merge, run-length."""
    return runs.repartition("code").sortWithinPartitions("code").mapInArrow(_runs, "code bigint, n bigint")


def cooccurrence(records: DataFrame, items: str = "items", min_pair: int = 1, min_lift: float = 0.0, broadcast_items: int = BROADCAST_ITEMS) -> DataFrame:
    """Every pair of items held together by at least ``min_pair`` records, with how far this exceeds chance.

    ``records`` has one row per record and an array of strings in ``items``; other columns are ignored.  Repeats
    within a record count once; null and empty items, null and empty arrays hold nothing but count as records.
    Result: ``concept_a < concept_b`` (by bytes), ``n_ab``, ``n_a``, ``n_b``, ``n_records``, ``lift`` = n_ab·N/(n_a·n_b), ``odds_ratio``
    and ``log_odds`` with one half added to each cell.  An empty table gives no rows.

    ``min_pair`` and ``min_lift`` prune before pairs are made, without loss: an item in fewer than ``min_pair`` records
    has no such pair, and since n_ab ≤ min(n_a, n_b), an item in more than N/min_lift records cannot reach the lift.
    Items get dense 32-bit numbers in sorted order, once per record, before pairs are made.  A dictionary of up to ``broadcast_items``
    items, and BROADCAST_CHARS characters, is broadcast; a larger one is joined by a shuffle in which only hot items (at most 2,000) are
    broadcast.
    """
    base = cut(records.select(F.array_sort(F.array_distinct(F.filter(F.col(items), lambda x: x.isNotNull() & (x != "")))).alias("k")), "records")
    held = base.select(F.explode("k").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    total = base.count()
    kept = held.filter(F.col("n") >= min_pair)
    if min_lift > 0:
        kept = kept.filter(F.col("n") * F.lit(float(min_lift)) <= F.lit(float(total)))
    words = dense_ids(kept, "item")
    size, uses, chars = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.length("item")), F.lit(0))).first()
    if size >= 1 << 31:
        raise ValueError("more than 2^31 distinct items: raise min_pair")
    small = size <= broadcast_items and chars <= BROADCAST_CHARS
    spark = records.sparkSession
    if small:
        number = spark.sparkContext.broadcast({r.item: r.id for r in words.select("item", "id").toLocalIterator()})
        runs = base.filter(F.size("k") > 1).select("k").mapInArrow(_codes(number), "code bigint, n bigint")
    else:
        single = base.filter(F.size("k") > 1).withColumn("rid", F.monotonically_increasing_id()).select("rid", F.explode("k").alias("item"))
        ids = hot_cold_join(single, words, "item", "n", uses).groupBy("rid").agg(F.collect_list("id").alias("v"))  # the items of one record
        runs = ids.select("v").mapInArrow(_codes(None), "code bigint, n bigint")
    counted = count_codes(runs).filter(F.col("n") >= min_pair)
    names = lambda s: words.select(F.col("id").alias(s), F.col("item").alias(f"concept_{s}"), F.col("n").alias(f"n_{s}"))
    if small:
        names_a, names_b = F.broadcast(names("a")), F.broadcast(names("b"))
    else:
        names_a, names_b = names("a"), names("b")
    split = counted.select(F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), F.col("n").alias("n_ab"))
    out = split.join(names_a, "a").join(names_b, "b").withColumn("n_records", F.lit(total).cast("bigint"))
    f = lambda c: F.col(c).cast("double")
    both, only_a, only_b = f("n_ab") + 0.5, f("n_a") - f("n_ab") + 0.5, f("n_b") - f("n_ab") + 0.5
    none = f("n_records") - f("n_a") - f("n_b") + f("n_ab") + 0.5
    odds = both * none / (only_a * only_b)
    out = out.select("concept_a", "concept_b", "n_ab", "n_a", "n_b", "n_records", (f("n_ab") * f("n_records") / (f("n_a") * f("n_b"))).alias("lift"), odds.alias("odds_ratio"), F.log(odds).alias("log_odds"))
    if min_lift > 0 and float(min_lift).is_integer():
        wide = lambda c: F.col(c).cast("decimal(19,0)")
        return out.filter(wide("n_ab") * wide("n_records") >= F.lit(int(min_lift)) * (wide("n_a") * wide("n_b")))
    return out.filter(F.col("lift") >= min_lift) if min_lift > 0 else out
