"""Pages to lines, equations and block trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Pages whose lines one task may have to sort together: a block of a document is so many consecutive page numbers.
BLOCK_PAGES = 32


def pages_to_lines(pages: DataFrame, drop_page_numbers: bool = False) -> DataFrame:
    """(doc_id, block, page_no, page_seq, line_no, text): every line of every page, empty lines too.

    ``pages`` has doc_id, page_no, page_seq (orders pages of one number) and text; null text has no lines.  The
    order of a document's lines is (page_no, page_seq, line_no).
    """
    split = F.split(F.col("text"), "\n", -1)
    lines = pages.select("doc_id", F.floor(F.coalesce("page_no", F.lit(0)) / BLOCK_PAGES).cast("int").alias("block"), "page_no", "page_seq", F.posexplode_outer(split).alias("line_no", "text")).filter("line_no is not null")  # plain posexplode would split twice, once to see that there are lines
    return lines.filter(~T.is_page_number(F.col("text"))) if drop_page_numbers else lines


def pages_with_equations(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, equations) of pages that have any; of pages with one number the later wins."""
    return pages.filter(F.size("equations") > 0).groupBy("doc_id", "page_no").agg(F.max_by("equations", "page_seq").alias("equations"))


def flat_pages(extractions: DataFrame) -> DataFrame:
    """(doc_id, page_no, page_seq, text) from one row per document with an array ``pages``; equations are left behind."""
    return extractions.select("doc_id", F.posexplode("pages").alias("page_seq", "p")).select("doc_id", F.col("p.page_no").alias("page_no"), "page_seq", F.col("p.text").alias("text"))


def blank_context(lines: DataFrame) -> DataFrame:
    """``lines`` with prev_blank and next_blank; the ends of a document count as blank.

    Neighbours across pages are reached by a join of page edges, so that no document is sorted in one task.
    """
    from pyspark.sql import Window

    doc = ["doc_id", "page_no", "page_seq"]
    w = Window.partitionBy(*doc).orderBy("line_no")
    blank = T.strip(F.col("text")) == ""
    inside = lines.withColumn("__b", blank).withColumn("__p", F.lag("__b").over(w)).withColumn("__n", F.lead("__b").over(w))
    edges = inside.groupBy(*doc).agg(F.min_by("__b", "line_no").alias("first"), F.max_by("__b", "line_no").alias("last"))
    p = Window.partitionBy("doc_id").orderBy("page_no", "page_seq")
    edges = edges.select(*doc, F.lag("last").over(p).alias("__pl"), F.lead("first").over(p).alias("__nf"))
    out = inside.join(edges, doc)
    yes = F.lit(True)
    return out.select(*lines.columns, F.coalesce("__p", "__pl", yes).alias("prev_blank"), F.coalesce("__n", "__nf", yes).alias("next_blank"))
