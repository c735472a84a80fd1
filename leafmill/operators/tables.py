"""Small relational pieces of the pipelines: resuming, upserting, unions, driving by manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resume(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows not done yet; null keys are never done."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def upsert(runs: DataFrame, keys: list[str], run: str) -> DataFrame:
    """The latest version of every key, by ``run``; ties are broken by all columns, so the result is one and the same."""
    best = F.max(F.struct(run, *[c for c in runs.columns if c != run])).alias("b")
    return runs.groupBy(*keys).agg(best).select("b.*")


def by_manifest(manifest: DataFrame, pages: DataFrame, file: str = "file") -> tuple[DataFrame, DataFrame]:
    """(pages with their manifest row, manifest rows without pages): repeated manifest rows count once, the greatest title wins."""
    once = manifest.groupBy(file).agg(F.max("class_no").alias("class_no"), F.max("chapter_no").alias("chapter_no"), F.max(F.trim("chapter_title")).alias("chapter_title"))
    return pages.join(once, file), once.join(pages.select(file).distinct(), file, "left_anti")


def first_n(rows: DataFrame, order: list[str | Column], n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order`` (a processing limit the user asks for); None or 0 is no limit."""
    return rows.orderBy(*order).limit(n) if n else rows
