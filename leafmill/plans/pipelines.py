"""Whole stages, each a chain of the operators: books to resources, resources to vocabulary, annotation and report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import concepts as C
from ..operators import resources as R
from ..operators import segment as S
from ..operators import stats as A
from ..operators import vocabulary as V
from ..operators.boards import OPEN, OPEN_CLASS, STATE, Board
from .lineage import cut


# What the ids of the boards' books start with.
OPEN_ID, STATE_ID = "NIOS", "MAHA"


def book(pages: DataFrame, images: DataFrame, chapters: DataFrame, board: Board, document_id: Column, merge: bool, types: dict[str, str] = R.OPEN_CHUNK_TO_TYPE) -> tuple[DataFrame, DataFrame]:
    """(resources and diagrams, quarantined resources) of all chapters at once.

    ``pages`` (doc_id, page_no, page_seq, text, equations), ``images`` (doc_id, image_id, page_no, image_path, caption),
    ``chapters`` (doc_id, source, subject, class_no, chapter_no, chapter_title); a chapter that fails validation in part
    loses only the rows in quarantine.
    """
    chunks = S.segment(pages, board, chapters)
    if merge:
        chunks = S.merge_short(chunks, page_end="max" if board.distinct_equations else "last", distinct_equations=board.distinct_equations)
    valid, bad = R.validate(R.build(chunks, document_id, pages, types))
    return R.multimodal(cut(valid, "resources"), images), bad


def open_book(pages: DataFrame, images: DataFrame, chapters: DataFrame, code: str, prefix: str = OPEN_ID) -> tuple[DataFrame, DataFrame]:
    """The open board's book: ids ``{prefix}_{code}_CHnn``, short chunks are not merged, titles are inferred where none is given."""
    named = _titled(chapters, S.infer_title(pages))
    number = chapters.select("doc_id", F.concat(F.lit(f"{prefix}_{code}_CH"), F.lpad(F.col("chapter_no").cast("string"), 2, "0")).alias("__id"))
    out, bad = book(pages, images, named, OPEN, F.lit(None).cast("string"), merge=False)
    name = lambda df: df.join(number, "doc_id", "left").withColumn("document_id", F.coalesce("__id", "document_id")).drop("__id")
    return name(out), name(bad)


def state_book(pages: DataFrame, images: DataFrame, chapters: DataFrame, code: str, prefix: str = STATE_ID) -> tuple[DataFrame, DataFrame]:
    """The state board's book: ids ``{prefix}_{code}_{class}``, short chunks are merged, titles inferred on raw pages."""
    named = _titled(chapters, S.infer_title_state(pages, chapters))
    number = chapters.select("doc_id", F.concat_ws("_", F.lit(prefix), F.lit(code), F.col("class_no").cast("string")).alias("__id"))
    out, bad = book(pages, images, named, STATE, F.lit(None).cast("string"), merge=True, types=R.CHUNK_TO_TYPE)
    name = lambda df: df.join(number, "doc_id", "left").withColumn("document_id", F.coalesce("__id", "document_id")).drop("__id")
    return name(out), name(bad)


def class_book(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """Chunks of the open board by the class-based rules: pages are preprocessed and short chunks merged."""
    return S.merge_short(S.segment(pages, OPEN_CLASS, chapters), page_end="max", distinct_equations=True)


def _titled(chapters: DataFrame, titles: DataFrame) -> DataFrame:
    given = F.nullif(F.col("chapter_title"), F.lit(""))
    return chapters.join(titles, "doc_id", "left").withColumn("chapter_title", F.coalesce(given, F.col("title"), F.lit(""))).drop("title")


def concept_pipeline(resources: DataFrame, structural: DataFrame, key: str, extractor: Callable[[], C.Annotator], annotator: Callable[[], C.Annotator], least: int = V.THRESHOLD) -> dict[str, DataFrame]:
    """extractions, vocabulary, merge_map, rejected, annotated (resources), gates: extract, build, annotate, report.

    ``resources`` is unique in ``key``.  The order of the vocabulary is structural entries by id, then extracted ones by
    frequency.
    """
    records = cut(C.extract(resources.withColumn("resource_id", F.col(key).cast("string")), extractor), "extractions")
    made = V.build(records, "resource_id", structural, least)
    vocabulary = cut(made["vocabulary"], "vocabulary")
    from .skew import dense_ids

    order = F.concat(F.when(F.col("source") == "structural", "0").otherwise("1"), F.lpad((F.lit(10**12) - F.coalesce("frequency", F.lit(0))).cast("string"), 13, "0"), F.lit("|"), F.col("canonical_id"))
    ordered = dense_ids(vocabulary.withColumn("__o", order), "__o", "vocab_ord").drop("__o")
    todo = resources.withColumn("resource_id", F.coalesce(F.col("resource_id"), F.col(key).cast("string")))
    done = cut(C.annotate(todo, ordered, key, annotator), "annotations")
    annotated = C.write_back(resources, done, key)
    return {"extractions": records, "vocabulary": vocabulary, "merge_map": made["merge_map"], "rejected": made["rejected"], "annotated": annotated, "gates": A.gates(annotated, vocabulary, strict=True)}
