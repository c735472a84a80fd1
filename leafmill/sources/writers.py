"""Sinks: tables partitioned by chapter, keyed JSON, run logs, text reports; none overwrites what it reads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIST_CHARACTERS = 8_000_000


def write_chapters(rows: DataFrame, path: str, form: str = "parquet", by: tuple[str, ...] = ("class_no", "chapter_no"), mode: str = "overwrite") -> None:
    """Chunks or resources, one folder per chapter; large chapters are written by several tasks."""
    copies = rows.withColumns({f"part_{c}": F.col(c) for c in by})
    copies.write.mode(mode).partitionBy(*(f"part_{c}" for c in by)).format(form).save(path)


def write_json(rows: DataFrame, path: str, mode: str = "overwrite", per_file: int = 0) -> None:
    """JSON lines; with ``per_file`` no file holds more rows, so that with 1 every file is one object."""
    rows.write.mode(mode).option("ignoreNullFields", False).option("maxRecordsPerFile", per_file).json(path)


def write_lists(rows: DataFrame, path: str, most: int = 1000, mode: str = "overwrite") -> None:
    """Text files that each hold one JSON list of up to ``most`` rows, or of LIST_CHARACTERS; so few files are written, and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        one = lambda: pa.RecordBatch.from_arrays([pa.array(["[" + ",".join(held) + "]"], pa.string())], names=["value"])
        for batch in batches:
            for row in batch.column(0).to_pylist():
                held.append(row)
                size += len(row)
                if len(held) >= most or size >= LIST_CHARACTERS:
                    yield one()
                    held, size = [], 0
        if held:
            yield one()

    objects = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    objects.mapInArrow(run, "value string").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def write_vocabulary(tables: dict[str, DataFrame], path: str, dry_run: bool = False) -> dict[str, int]:
    """vocabulary, merge_map and rejected (most frequent first) as JSON lines; the rows of each. A dry run only counts."""
    counts = {}
    for name, df in tables.items():
        counts[name] = df.count()
        if not dry_run:
            ordered = df.orderBy(F.desc("count"), "term") if name == "rejected" else df
            ordered.write.mode("overwrite").json(f"{path}/{name}")
    return counts


def write_lines(rows: DataFrame, line: str, path: str) -> None:
    rows.select(line).write.mode("overwrite").text(path)


def append_new(rows: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose keys are not in the table at ``path`` yet; how many. This is the resumable checkpoint of a stage."""
    spark = rows.sparkSession
    try:
        fresh = rows.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        fresh = rows
    from ..plans.lineage import cut

    fresh = cut(fresh, "fresh")
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def run_log(results: DataFrame, status: str = "status") -> DataFrame:
    """One row: when, how many rows by status, and up to 100 errors as examples."""
    shown = results.filter("error is not null").select(F.struct("id", "error").alias("e")).limit(100).agg(F.collect_list("e").alias("errors"))
    counts = results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(status) == "ok").alias("ok"), F.count_if(F.col(status) == "skipped").alias("skipped"), F.count_if(F.col(status) == "error").alias("failed"))
    return counts.join(F.broadcast(shown)).withColumn("run_at", F.current_timestamp())
