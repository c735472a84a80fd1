"""Chunks to typed, identified, validated resources, and images beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.lineage import cut
from ..plans.scan import running
from ..plans.skew import strip

# Resource types, what chunk types become, and prefixes of ids.
TEXT_TYPES = ("explanation", "example", "activity", "exercise", "recall", "scientist_box", "internet_task", "mcq", "project", "summary", "callout")
NON_TEXT_TYPES = ("diagram", "table")
CHUNK_TO_TYPE = {"explanation": "explanation", "summary": "summary", "example": "example", "activity": "activity", "exercise": "exercise", "intext_question": "exercise", "recall": "recall", "scientist_box": "scientist_box", "internet_task": "internet_task", "mcq": "mcq", "project": "project", "callout": "callout"}
OPEN_CHUNK_TO_TYPE = CHUNK_TO_TYPE | {"content": "explanation", "terminal_exercise": "exercise", "answers": "explanation"}
ID_PREFIX = {"explanation": "TXT", "example": "EXP", "activity": "ACT", "exercise": "EX", "diagram": "IMG", "table": "TBL", "recall": "RCL", "scientist_box": "SCI", "internet_task": "INT", "mcq": "MCQ", "project": "PRJ", "summary": "SUM", "callout": "CLT"}

RESOURCE_COLUMNS = ("document_id", "resource_id", "resource_type", "class_no", "subject", "chapter_no", "chapter_title", "section", "subsection", "page_start", "page_end", "text", "image_path", "image_caption", "description", "summary", "concepts", "figure_references", "has_equation")
Handler = Callable[[DataFrame], DataFrame]


def lookup(c: Column, table: dict[str, str], default: str) -> Column:
    pairs = [F.lit(x) for k, v in table.items() for x in (k, v)]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(default)) if pairs else F.lit(default)


def map_chunk_type(c: Column, table: dict[str, str] = CHUNK_TO_TYPE) -> Column:
    """Resource type of a chunk type; explanation for null and unknown ones."""
    return lookup(c, table, "explanation")


def id_prefix(c: Column) -> Column:
    return lookup(c, ID_PREFIX, "TXT")


def number_ids(rows: DataFrame, doc: str = "doc_id", seq: str = "chunk_seq") -> DataFrame:
    """``rows`` with resource_id ``PREFIX_cc_CHcc_slug_nnn``; nnn counts per document, class, chapter, slug and prefix in the order of ``seq``.

    Counted before validation, so dropped rows leave gaps.  The count runs in blocks of ``seq``, so one document's
    hot section is not sorted in one task.
    """
    group = F.concat_ws("\x1f", F.col(doc), F.coalesce(F.col("class_no").cast("string"), F.lit("")), F.coalesce(F.col("chapter_no").cast("string"), F.lit("")), T.section_slug(F.col("section_no"), F.col("section")), id_prefix(F.col("resource_type")))
    keyed = rows.withColumn("__g", group).withColumn("__k", F.floor(F.col(seq) / 4096))
    numbered = running(keyed, "__g", "__k", [seq], sums={"__n": F.lit(1)})
    two = lambda c: T.padded(F.coalesce(F.col(c), F.lit(0)), 2)
    rid = F.concat(id_prefix(F.col("resource_type")), F.lit("_"), two("class_no"), F.lit("_CH"), two("chapter_no"), F.lit("_"), T.section_slug(F.col("section_no"), F.col("section")), F.lit("_"), T.padded(F.col("__n"), 3))
    return numbered.withColumn("resource_id", rid).drop("__g", "__k", "__n")


def pages_of(rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``rows`` once per page from page_start to page_end; none where the range is empty or unknown."""
    return rows.filter(F.col("page_start") <= F.col("page_end")).withColumn("page_no", F.explode(F.sequence("page_start", "page_end")))


def has_equation(chunks: DataFrame, pages: DataFrame | None, doc: str = "doc_id", seq: str = "chunk_seq") -> DataFrame:
    """``chunks`` with has_equation: some page of the range has equations; without ``pages`` the text looks like one.

    The range becomes an equi-join on pages, so no nested loop is planned; only keys travel.
    """
    if pages is None:
        return chunks.withColumn("has_equation", T.looks_like_equation(F.col("text")))
    known = pages.filter(F.size("equations") > 0).select(F.col(doc), "page_no").distinct()
    hit = pages_of(chunks.select(doc, seq, "page_start", "page_end"), doc).join(known, [doc, "page_no"], "left_semi").select(doc, seq).distinct().withColumn("__e", F.lit(True))
    return chunks.join(hit, [doc, seq], "left").withColumn("has_equation", F.coalesce("__e", F.lit(False))).drop("__e")


def build(chunks: DataFrame, document_id: Column, pages: DataFrame | None = None, types: dict[str, str] = CHUNK_TO_TYPE, class_no: int | None = None, handlers: dict[str, Handler] | None = None) -> DataFrame:
    """Resources of all chunks, not yet validated: the 19 columns with doc_id and chunk_seq.

    Missing class numbers become ``class_no``, missing chapter numbers 0.  ``handlers`` maps a resource type to a
    transform that makes the rows of that type instead of the default; non-text types without one are dropped.
    """
    given = chunks.withColumn("class_no", F.coalesce("class_no", F.lit(class_no).cast("int"))).withColumn("chapter_no", F.coalesce("chapter_no", F.lit(0)))
    typed = cut(number_ids(cut(given.withColumn("resource_type", map_chunk_type(F.col("chunk_type"), types)), "typed")), "numbered")
    typed = has_equation(typed, pages)
    handlers = handlers or {}
    null = F.lit(None).cast("string")
    kept = typed.filter(F.col("resource_type").isin([t for t in TEXT_TYPES if t not in handlers]))
    out = kept.select(
        "doc_id", "chunk_seq", document_id.alias("document_id"), "resource_id", "resource_type", "class_no", "subject", "chapter_no", "chapter_title", "section", "subsection", "page_start", "page_end", "text",
        null.alias("image_path"), null.alias("image_caption"), null.alias("description"), null.alias("summary"), F.array().cast("array<string>").alias("concepts"), "figure_references", "has_equation",
    )
    for t, handler in handlers.items():
        out = out.unionByName(handler(typed.filter(F.col("resource_type") == t).withColumn("document_id", document_id)), allowMissingColumns=True)
    return out


def errors(rows: DataFrame) -> Column:
    """The validation errors of a resource, as an array; empty if it is valid."""
    t, page = F.col("resource_type"), F.col("page_end") < F.col("page_start")
    known = F.coalesce(t.isin(*TEXT_TYPES, *NON_TEXT_TYPES), F.lit(False))
    no_text = ~F.coalesce(t.isin(*NON_TEXT_TYPES), F.lit(False)) & (F.coalesce(strip(F.col("text")), F.lit("")) == "")
    no_image = (t == "diagram") & (F.coalesce("image_path", F.lit("")) == "")
    cases = ((~known, "invalid resource_type"), (no_text, "empty text"), (no_image, "no image_path"), (page, "page_end before page_start"))
    return F.filter(F.array(*(F.when(c, m) for c, m in cases)), lambda e: e.isNotNull())


def validate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined); quarantined rows carry ``errors``."""
    checked = rows.withColumn("errors", errors(rows))
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def image_contexts(resources: DataFrame, images: DataFrame, doc: str, seq: str, context: list[str]) -> DataFrame:
    """``images`` with struct ``ctx`` of ``context`` columns: of the first resource, by ``seq``, on the image's page, else of the document.

    First-match is an aggregate (partial before the shuffle), not a window, and the range an equi-join on pages.
    """
    held = F.struct(*context).alias("ctx")
    first = pages_of(resources.select(doc, seq, "page_start", "page_end", *[c for c in context if c not in (doc, seq, "page_start", "page_end")]), doc)
    on_page = first.groupBy(doc, "page_no").agg(F.min_by(held, seq).alias("c1"))
    fallback = resources.groupBy(doc).agg(F.min_by(held, seq).alias("c2"))
    return images.join(on_page, [doc, "page_no"], "left").join(fallback, doc, "left").withColumn("ctx", F.coalesce("c1", "c2")).drop("c1", "c2")


def diagrams(resources: DataFrame, images: DataFrame, doc: str = "doc_id", seq: str = "chunk_seq") -> DataFrame:
    """One diagram resource per image; class 12 and chapter 0 where the document has no resource."""
    context = ["document_id", "class_no", "subject", "chapter_no", "chapter_title", "section", "subsection"]
    placed = image_contexts(resources, images, doc, seq, context)
    c = lambda k: F.col(f"ctx.{k}")
    class_no, chapter = F.coalesce(c("class_no"), F.lit(12)), F.coalesce(c("chapter_no"), F.lit(0))
    rid = F.concat(F.lit("IMG_"), T.padded(class_no, 2), F.lit("_CH"), T.padded(chapter, 2), F.lit("_"), T.image_number(F.col("image_id")))
    null, none = F.lit(None).cast("string"), F.array().cast("array<string>")
    return placed.select(
        doc, c("document_id").alias("document_id"), rid.alias("resource_id"), F.lit("diagram").alias("resource_type"), class_no.alias("class_no"), c("subject").alias("subject"), chapter.alias("chapter_no"),
        F.coalesce(c("chapter_title"), F.lit("")).alias("chapter_title"), c("section").alias("section"), c("subsection").alias("subsection"), F.col("page_no").alias("page_start"), F.col("page_no").alias("page_end"), null.alias("text"),
        "image_path", F.col("caption").alias("image_caption"), null.alias("description"), null.alias("summary"), none.alias("concepts"), none.alias("figure_references"), F.lit(False).alias("has_equation"),
    )


def multimodal(resources: DataFrame, images: DataFrame, doc: str = "doc_id", seq: str = "chunk_seq") -> DataFrame:
    """Resources and their diagrams; ``part`` 0 for resources, 1 for diagrams, as resources come first."""
    both = resources.withColumn("part", F.lit(0)).unionByName(diagrams(resources, images, doc, seq).withColumn("part", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("figure_references", F.coalesce("figure_references", F.array().cast("array<string>")))
