"""PDF text scan; needs the optional package pdfplumber on the workers."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: Classes whose books are set in two columns.
TWO_COLUMNS = (11, 12)


def columns_text(page, two: bool) -> str:
    """Text of a page; in two columns the left half, a line feed, the right half."""
    if not two:
        return page.extract_text() or ""
    half = page.width * 0.5
    left, right = page.crop((0, 0, half, page.height)), page.crop((half, 0, page.width, page.height))
    return f"{left.extract_text() or ''}\n{right.extract_text() or ''}"


def read_pdf(spark: SparkSession, path: str, class_no: int | Column | None = None) -> DataFrame:
    """(_source_file, extraction_backend, pages, error) of PDF files; single columns are cleaned, two columns are not.

    ``class_no`` is one class for all, or a column of ``path``, as ``readers.path_metadata`` makes, so that each file is read as its class is set.
    """
    of = class_no if isinstance(class_no, Column) else F.lit(class_no)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(path)
    files = found.select("path", "content", F.coalesce(of.cast("int").isin(*TWO_COLUMNS), F.lit(False)).alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pdfplumber

        kind = pa.list_(pa.struct([("page_no", pa.int32()), ("text", pa.string()), ("markdown", pa.string()), ("equations", pa.list_(pa.string()))]))
        for batch in batches:
            for name, content, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    with pdfplumber.open(io.BytesIO(content)) as pdf:
                        pages, error = [{"page_no": n, "text": columns_text(p, two), "markdown": None, "equations": []} for n, p in enumerate(pdf.pages, 1)], None
                except Exception as e:
                    pages, error = None, str(e)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([pages], kind), pa.array([error], pa.string()), pa.array([two])], names=["_source_file", "pages", "error", "two"])

    rows = files.mapInArrow(run, "_source_file string, pages array<struct<page_no int, text string, markdown string, equations array<string>>>, error string, two boolean")
    cleaned = F.transform("pages", lambda p: p.withField("text", T.clean_science(p["text"])))
    rows = rows.withColumn("pages", F.when(F.col("two"), F.col("pages")).otherwise(cleaned)).drop("two")
    return rows.withColumn("extraction_backend", F.lit("pdfplumber"))
