"""Scans: extraction, image, resource, vocabulary and manifest files, found by path and checked by schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.resources import RESOURCE_COLUMNS

_TYPES = {"int": T.IntegerType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType())}


def _schema(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(k, _TYPES.get(v, T.StringType())) for k, v in kinds.items()])


PAGE = _schema(page_no="int", text="", markdown="", equations="strings", _extraction_method="")
EXTRACTION = _schema(extraction_backend="", language="", has_equations="boolean", has_tables="boolean", source_pdf="").add("pages", T.ArrayType(PAGE))
IMAGES = _schema(image_id="", page_no="int", image_path="", caption="")
MANIFEST = _schema(file="", class_no="int", chapter_no="int", chapter_title="")
_KINDS = {"class_no": "int", "chapter_no": "int", "page_start": "int", "page_end": "int", "concepts": "strings", "figure_references": "strings", "has_equation": "boolean"}
RESOURCE = _schema(**{c: _KINDS.get(c, "") for c in RESOURCE_COLUMNS})
ENTRY = "map<string, struct<display_name: string, frequency: int, source: string>>"

# Names of subjects by their code in paths, and the pattern of a chapter's folder.
SUBJECTS = {"BIO": "Biology", "PHY": "Physics", "CHEM": "Chemistry"}
CHAPTER = r"(?i)(chapter|lesson)[\s\-]*\d+$"


def _json(spark: SparkSession, schema: T.StructType, path: str | list[str], glob: str = "*.json") -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    reader = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    rows = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(path).withColumn("_source_file", F.col("_metadata.file_path"))
    # The mark of a broken record may not be read alone, so a column of the data is read with it.
    some = F.coalesce(F.length(F.col(schema.fields[0].name).cast("string")), F.lit(0)) >= 0
    return rows.withColumn("_bad", F.when(some, F.col("_bad")))


def read_extractions(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row per readable document, quarantined rows with a reason): broken JSON, or no pages."""
    rows = _json(spark, EXTRACTION, path)
    reason = F.when(F.col("_bad").isNotNull(), "broken json").when(F.coalesce(F.size("pages"), F.lit(0)) <= 0, "no pages")
    rows = rows.withColumn("reason", reason)
    full = rows.filter("reason is null").drop("reason", "_bad")
    defaults = full.withColumn("has_equations", F.coalesce("has_equations", F.lit(False))).withColumn("has_tables", F.coalesce("has_tables", F.lit(False))).withColumn("extraction_backend", F.coalesce("extraction_backend", F.lit("unknown")))
    return defaults, rows.filter("reason is not null").select("_source_file", "reason")


def pages_of(extractions: DataFrame, doc: str = "_source_file") -> DataFrame:
    """(doc_id, page_no, page_seq, text, equations)."""
    return extractions.select(F.col(doc).alias("doc_id"), F.posexplode("pages").alias("page_seq", "p")).select("doc_id", F.col("p.page_no").alias("page_no"), "page_seq", F.coalesce("p.text", F.lit("")).alias("text"), F.coalesce("p.equations", F.array().cast("array<string>")).alias("equations"))


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per image, files of none give none; broken files are left out."""
    return _json(spark, IMAGES, path).filter("_bad is null and image_id is not null").drop("_bad")


def read_resources(spark: SparkSession, path: str | list[str], include: list[str] | None = None, glob: str = "*.json") -> DataFrame:
    """Resources of all files under ``path``, whether a file holds a list or one object, with ``_source_file`` and defaults.

    ``include`` keeps files whose path contains any of the strings, ``glob`` those of a name; broken files are left out.
    """
    rows = _json(spark, RESOURCE, path, glob).filter("_bad is null").drop("_bad")
    if include:
        keep = F.lit(False)
        for s in include:
            keep = keep | F.col("_source_file").contains(s)
        rows = rows.filter(keep)
    none = F.array().cast("array<string>")
    return rows.withColumn("concepts", F.coalesce("concepts", none)).withColumn("figure_references", F.coalesce("figure_references", none)).withColumn("has_equation", F.coalesce("has_equation", F.lit(False)))


def read_keyed(spark: SparkSession, path: str, value: str = ENTRY, key: str = "canonical_id") -> DataFrame:
    """Rows of a file that is one JSON object of keyed structs, with ``vocab_ord``, the place in the file."""
    kinds = value if value.startswith("map<") else f"map<string, {value}>"
    held = spark.read.text(path, wholetext=True).select(F.from_json("value", kinds).alias("m"))
    return held.select(F.posexplode(F.map_entries("m")).alias("vocab_ord", "e")).select(F.col("e.key").alias(key), "vocab_ord", "e.value.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def is_image_file(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"([^/]+)$", 1)).contains("image")


def chapter_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """(dir, text_file, image_file): the first text and the first image file, by name, of every folder; hidden files are none."""
    p, name = F.col(path), F.regexp_extract(F.col(path), r"([^/]+)$", 1)
    seen = paths.filter(name.endswith(".json") & ~name.startswith(".")).select(F.regexp_extract(p, r"^(.*)/[^/]+$", 1).alias("dir"), p.alias("p"))
    return seen.groupBy("dir").agg(F.min(F.when(~is_image_file(F.col("p")), F.col("p"))).alias("text_file"), F.min(F.when(is_image_file(F.col("p")), F.col("p"))).alias("image_file"))


def is_chapter_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/?$", 1).rlike(CHAPTER)


def chapter_order(path: Column) -> Column:
    """First number in a folder's name, by which chapters are ordered."""
    return F.regexp_extract(F.regexp_extract(path, r"([^/]+)/?$", 1), r"(\d+)", 1).try_cast("int")


def chapter_number(path: Column) -> Column:
    """Last number in a folder's name."""
    return F.regexp_extract(path, r"(\d+)\D*$", 1).try_cast("int")


def path_metadata(path: Column) -> dict[str, Column]:
    """subject_code, subject, class_no (default 11) and chapter_no (default 1) of .../CODE/class/chapter; null for shorter paths."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    long = F.size(parts) >= 4
    digits = lambda c, d: F.coalesce(F.regexp_replace(c, r"[^\d]", "").try_cast("int"), F.lit(d))
    code = F.upper(F.element_at(parts, -3))
    named = F.create_map(*(F.lit(x) for k, v in SUBJECTS.items() for x in (k, v)))
    return {"subject_code": F.when(long, code), "subject": F.when(long, F.coalesce(named[code], code)), "class_no": F.when(long, digits(F.element_at(parts, -2), 11)), "chapter_no": F.when(long, digits(F.element_at(parts, -1), 1))}


def folders_allowed(paths: DataFrame, path: str, folders: list[str]) -> DataFrame:
    """Files that lie under any of the named folders."""
    keep = F.lit(False)
    for f in folders:
        keep = keep | F.array_contains(F.split(F.col(path), "/"), f)
    return paths.filter(keep)


def mirrored(path: Column, source: str, target: str, suffix: str = ".json") -> Column:
    """Output path of an input: the same place below ``target``."""
    return F.concat(F.lit(target.rstrip("/")), F.regexp_replace(F.expr(f"substring({_sql(path)}, {len(source.rstrip('/')) + 1})"), r"\.[^./]+$", suffix))


def _sql(c: Column) -> str:
    return c._jc.toString()


#: A backend reads a path into extractions.
Backend = Callable[[SparkSession, str], DataFrame]


class Backends:
    """Extraction backends by name; names are trimmed and lower-cased, unknown ones are a ValueError."""

    def __init__(self) -> None:
        self._by_name: dict[str, Backend] = {}

    def register(self, name: str, backend: Backend) -> None:
        self._by_name[name.strip().lower()] = backend

    def available(self) -> list[str]:
        return sorted(self._by_name)

    def create(self, name: str) -> Backend:
        key = name.strip().lower()
        if key not in self._by_name:
            raise ValueError(f"unknown backend {name!r}; there are {self.available()}")
        return self._by_name[key]


def default_backends() -> Backends:
    from .pdf import read_pdf

    out = Backends()
    out.register("precomputed", lambda spark, path: read_extractions(spark, path)[0])
    out.register("pdfplumber", read_pdf)
    out.register("marker", read_layout)
    return out


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Extractions of rendered layout trees, one JSON file per document."""
    from ..operators.layout import layout_to_extractions

    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return layout_to_extractions(raw.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("tree"))).withColumnRenamed("doc_id", "_source_file")
