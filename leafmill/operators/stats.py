"""Coverage statistics and quality gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import strip

# Upper ends of the frequency classes, and the gates.
CLASSES = (1, 2, 3, 5, 10, 20, 50)
COVERAGE, MOST_ZERO, MOST_UNUSED, LEAST_AVERAGE = 0.95, 10.0, 30.0, 2.0


def annotated(strict: bool = False) -> Column:
    """Whether a resource is annotated: it has a list of concepts, or, strictly, one that is not empty."""
    return F.coalesce(F.size("concepts") > 0, F.lit(False)) if strict else F.col("concepts").isNotNull()


def concept_frequency(resources: DataFrame) -> DataFrame:
    """(concept, n): every occurrence counts, repeats in a resource too."""
    return resources.select(F.explode("concepts").alias("concept")).filter("concept is not null").groupBy("concept").agg(F.count(F.lit(1)).alias("n"))


def frequency_classes(frequency: DataFrame) -> DataFrame:
    """(lo, hi, concepts): how many concepts occur between lo and hi times; the last class has no end; all classes are given."""
    edges = [(a + 1, b) for a, b in zip((0, *CLASSES), CLASSES, strict=False)] + [(CLASSES[-1] + 1, None)]
    inside = lambda a, b: (F.col("n") >= a) & ((F.col("n") <= b) if b else F.lit(True))
    one = frequency.agg(*(F.count_if(inside(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(edges)))
    rows = [F.struct(F.lit(a).cast("bigint").alias("lo"), F.lit(b).cast("bigint").alias("hi"), F.col(f"c{i}").alias("concepts")) for i, (a, b) in enumerate(edges)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def singletons(frequency: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(concept, display_name) of concepts that occur once; the concept itself where the vocabulary lacks it."""
    names = vocabulary.select(F.col("canonical_id").alias("concept"), "display_name")
    return frequency.filter("n = 1").join(names, "concept", "left").select("concept", F.coalesce("display_name", "concept").alias("display_name"))


def top_concepts(frequency: DataFrame, vocabulary: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent concepts (a report of k rows), with display name, source ('?' where unknown) and a bar."""
    names = vocabulary.select(F.col("canonical_id").alias("concept"), "display_name", "source")
    top = frequency.orderBy(F.desc("n"), "concept").limit(k)
    bar = F.repeat(F.lit("█"), F.least(F.floor(F.col("n") / 2), F.lit(30)).cast("int"))
    return top.join(names, "concept", "left").select("concept", "n", F.coalesce("display_name", "concept").alias("display_name"), F.coalesce("source", F.lit("?")).alias("source"), bar.alias("bar"))


def per_resource(resources: DataFrame, strict: bool = False) -> DataFrame:
    """One row: mean (2 places, half to even), least, most concepts of annotated resources, and how many have none."""
    n = F.size("concepts")
    return resources.filter(annotated(strict)).agg(F.bround(F.avg(n), 2).alias("mean"), F.min(n).alias("least"), F.max(n).alias("most"), F.count_if(n == 0).alias("zero"))


def _coverage(resources: DataFrame, *keys: Column, strict: bool = False) -> DataFrame:
    yes = annotated(strict)
    rows = resources.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(yes).alias("annotated"), F.sum(F.when(yes, F.size("concepts")).otherwise(0)).alias("concepts"))
    percent = 100 * F.col("annotated") / F.col("total")
    return rows.withColumn("percent", percent).withColumn("average", F.col("concepts") / F.greatest("annotated", F.lit(1))).drop("concepts")


def coverage_by_type(resources: DataFrame, strict: bool = False) -> DataFrame:
    return _coverage(resources, F.coalesce("resource_type", F.lit("unknown")).alias("resource_type"), strict=strict)


def coverage_by_subject(resources: DataFrame, strict: bool = False) -> DataFrame:
    name = F.concat(F.lit("Class "), F.coalesce(F.col("class_no").cast("string"), F.lit("?")), F.lit(" "), F.coalesce("subject", F.lit("?")))
    return _coverage(resources, name.alias("class_subject"), strict=strict).drop("average")


def overview(resources: DataFrame, vocabulary: DataFrame, strict: bool = False) -> DataFrame:
    """One row of counts of resources and of vocabulary entries."""
    r = resources.agg(F.count(F.lit(1)).alias("total"), F.count_if(annotated(strict)).alias("annotated"), F.count_if(F.coalesce(strip(F.col("summary")), F.lit("")) == "").alias("no_summary"))
    v = vocabulary.agg(F.count(F.lit(1)).alias("vocabulary"), F.count_if(F.col("source") == "extracted").alias("extracted"))
    percent = 100 * F.col("annotated") / F.greatest("total", F.lit(1))
    return r.join(F.broadcast(v)).select("total", "annotated", (F.col("total") - F.col("annotated")).alias("unannotated"), "no_summary", percent.alias("percent"), "vocabulary", "extracted")  # one row each


def unused(vocabulary: DataFrame, frequency: DataFrame) -> DataFrame:
    return vocabulary.join(frequency.select(F.col("concept").alias("canonical_id")), "canonical_id", "left_anti").select("canonical_id", "display_name", "source")


def extraction_quality(records: DataFrame) -> DataFrame:
    """One row: records, empty ones, mean concepts."""
    n = F.coalesce(F.size("concepts"), F.lit(0))
    return records.agg(F.count(F.lit(1)).alias("records"), F.count_if(n <= 0).alias("empty"), F.avg(F.greatest(n, F.lit(0))).alias("average"))


def gates(resources: DataFrame, vocabulary: DataFrame, strict: bool = False) -> DataFrame:
    """One row: the four gates and whether all hold."""
    yes, n = annotated(strict), F.size("concepts")
    r = resources.agg(F.count(F.lit(1)).alias("t"), F.count_if(yes).alias("a"), F.count_if(yes & (n == 0)).alias("z"), F.bround(F.avg(F.when(yes, n)), 2).alias("m"))
    free = unused(vocabulary, concept_frequency(resources)).agg(F.count(F.lit(1)).alias("u"))
    v = vocabulary.agg(F.count(F.lit(1)).alias("v"))
    one = r.join(F.broadcast(free)).join(F.broadcast(v))  # one row each
    more = lambda a, b: F.col(a) / F.greatest(b, F.lit(1))
    out = one.select(
        (more("a", "t") >= COVERAGE).alias("coverage"), (100 * more("z", "a") < MOST_ZERO).alias("zero"), (100 * more("u", "v") < MOST_UNUSED).alias("unused"), (F.coalesce("m", F.lit(0.0)) >= LEAST_AVERAGE).alias("average")
    )
    return out.withColumn("all_pass", F.col("coverage") & F.col("zero") & F.col("unused") & F.col("average"))


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    """(column, n), most frequent first."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def leaks(chunks: DataFrame, headers: list[str], text: str = "text") -> DataFrame:
    """Rows whose text contains any of the running headers, with the first one found."""
    found = F.coalesce(*(F.when(F.col(text).contains(h), F.lit(h)) for h in headers))
    return chunks.withColumn("leak", found).filter("leak is not null")


def mentions(chunks: DataFrame, heading: str, name: str, text: str, word: str, width: int = 50) -> DataFrame:
    """Rows whose heading contains ``name`` or whose first ``width`` characters contain ``word``."""
    return chunks.filter(F.coalesce(F.col(heading).contains(name), F.lit(False)) | F.coalesce(F.substring(text, 1, width).contains(word), F.lit(False)))


def contiguity(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, pages, contiguous): whether page numbers are 1 to n without gap or repeat; counted, not collected."""
    per = pages.groupBy(doc).agg(F.count(F.lit(1)).alias("pages"), F.countDistinct("page_no").alias("d"), F.min("page_no").alias("lo"), F.max("page_no").alias("hi"))
    whole = (F.col("lo") == 1) & (F.col("hi") == F.col("pages")) & (F.col("d") == F.col("pages"))
    return per.select(doc, "pages", F.coalesce(whole, F.lit(False)).alias("contiguous"))


def document_flags(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, has_equations, has_tables) over a document's pages."""
    return pages.groupBy(doc).agg(F.bool_or(F.coalesce(F.size("equations") > 0, F.lit(False))).alias("has_equations"), F.bool_or(F.coalesce("has_tables", F.lit(False))).alias("has_tables"))


def audit_lines(chunks: DataFrame) -> DataFrame:
    """Fixed-width lines of an audit: type, section, subsection, pages."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return chunks.select("doc_id", "chunk_seq", F.format_string("%3d %-18s %-8s %-10s %4s-%-4s", F.col("chunk_seq"), s("chunk_type"), s("section_no"), s("subsection_no"), s("page_start"), s("page_end")).alias("line"))


def previews(chunks: DataFrame, k: int = 5, width: int = 120) -> DataFrame:
    """The first ``width`` characters of the first ``k`` chunks of each document: a report of k rows a document."""
    return chunks.filter(F.col("chunk_seq") <= k).select("doc_id", "chunk_seq", "chunk_type", F.substring(F.regexp_replace("text", "\n", " "), 1, width).alias("preview"))
