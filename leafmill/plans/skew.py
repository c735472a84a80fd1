"""Joins and numbering that stay distributed when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds at least one row in so many; there can be no more hot keys than that. Shares that either side of a hot key is dealt into.
HOT_ONE_IN, SHARES = 2000, 8


def hot_cold_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, one_in: int = HOT_ONE_IN) -> DataFrame:
    """Inner join of ``left`` with ``right`` (unique in ``key``) that never sends a hot key to one task.

    ``weight`` is a column of ``right``: how many rows of ``left`` hold the key; ``total`` is their sum.  Keys with
    ``weight >= total / one_in`` number at most ``one_in`` by arithmetic, so their rows of ``right`` may be broadcast
    whatever the size of the data; all other keys are light and are shuffled.  Rows of ``left`` whose key is null or
    missing from ``right`` are dropped, as in any inner join.
    """
    bar = max(1, total // one_in)
    hot = F.broadcast(right.filter(F.col(weight) > bar))
    cold = right.filter(F.col(weight) <= bar)
    rest = left.join(hot.select(key), key, "left_anti")
    return left.join(hot, key).unionByName(rest.join(cold.hint("shuffle_merge"), key))


def grid_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, by_left: str, by_right: str, shares: int = SHARES) -> DataFrame:
    """Inner join in which the rows of a hot key meet in shares * shares tasks instead of one.

    ``hot`` holds the hot keys, in ``key``, each once; they must be few by arithmetic, as they are broadcast.  Left rows of a hot key are dealt by the
    hash of ``by_left`` and copied to the shares of the right side, right rows the other way round; so every pair meets
    once.  Dealt by hash, not at random, so a task that is run again deals alike.
    """
    flag = F.broadcast(hot.select(key, F.lit(True).alias("__hot")))
    every, own = F.sequence(F.lit(0), F.lit(shares - 1)), lambda c: F.pmod(F.xxhash64(c), F.lit(shares)).cast("int")
    cell = lambda c, here, there: F.when(F.col("__hot"), F.transform(every, lambda x: F.struct(here(own(c), x).alias("a"), there(own(c), x).alias("b")))).otherwise(F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))))
    one, two = (lambda o, x: o), (lambda o, x: x)
    dealt_left = left.join(flag, key, "left").withColumn("__c", F.explode(cell(by_left, one, two))).drop("__hot")
    dealt_right = right.join(flag, key, "left").withColumn("__c", F.explode(cell(by_right, two, one))).drop("__hot")
    return dealt_left.join(dealt_right, [key, "__c"]).drop("__c")


def dense_ids(table: DataFrame, key: str, out: str = "id") -> DataFrame:
    """Number the rows of ``table`` (unique in ``key``) 0, 1, 2 ... in the order of ``key`` without a single-task sort.

    ``table`` is range-partitioned and written once; the driver sees one count per partition and nothing else.
    """
    from .lineage import cut

    part, row = "__part", "__row"
    ranged = table.repartitionByRange(key).sortWithinPartitions(key)
    placed = cut(ranged.withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "dense")
    offset, offsets = 0, []
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part).agg(F.count(F.lit(1))).collect()):
        offsets.append((p, offset))
        offset += n
    if not offsets:
        return placed.select(*table.columns, F.lit(0).cast("bigint").alias(out))
    start = F.broadcast(table.sparkSession.createDataFrame(offsets, f"{part} int, __start bigint"))
    return placed.join(start, part).select(*table.columns, (F.col("__start") + F.col(row)).alias(out))


def strip(c: Column) -> Column:
    """Trim every Unicode blank, as ``trim`` takes only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
