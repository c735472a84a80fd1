"""Running values over the rows of a document that no single task has to see whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many tasks as there are cores, where it comes in fewer: a small file is one task however much work its rows are.

    Tables of as many splits as cores, so all large ones, are left as they are: nothing is shuffled.  Meant for scans, as
    the tasks of a plan with shuffles are known only once these have run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def running(df: DataFrame, doc: str, block: str, order: list[str], sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with running sums and running last non-null values along ``order`` within ``doc``.

    ``block`` is a non-decreasing function of ``order`` (a range of pages) that bounds how many rows a task sorts: values run
    inside a block first; what a block passes on is one row, and only those rows are run over per document.  A
    document that holds a third of all rows is so worked on by as many tasks as it has blocks.
    """
    sums, lasts = sums or {}, lasts or {}
    w = Window.partitionBy(doc, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select("*", *(F.sum(c).over(w).alias(f"__s_{k}") for k, c in sums.items()), *(F.last(c, ignorenulls=True).over(w).alias(f"__l_{k}") for k, c in lasts.items()))
    parts = df.groupBy(doc, block).agg(
        *(F.sum(c).alias(f"__s_{k}") for k, c in sums.items()),
        *(F.max(F.when(c.isNotNull(), F.struct(*order, c.alias("__v")))).getField("__v").alias(f"__l_{k}") for k, c in lasts.items()),
    )
    before = Window.partitionBy(doc).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(
        F.col(doc), F.col(block), *(F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__cs_{k}") for k in sums), *(F.last(f"__l_{k}", ignorenulls=True).over(before).alias(f"__cl_{k}") for k in lasts)
    )
    out = local.join(carry, [doc, block])
    for k in sums:
        out = out.withColumn(k, F.col(f"__s_{k}") + F.col(f"__cs_{k}"))
    for k in lasts:
        out = out.withColumn(k, F.coalesce(f"__l_{k}", f"__cl_{k}"))
    return out.drop(*(f"__{x}_{k}" for k in sums for x in ("s", "cs")), *(f"__{x}_{k}" for k in lasts for x in ("l", "cl")))
