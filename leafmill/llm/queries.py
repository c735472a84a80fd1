"""Queries of the operators of this subpackage over the tables of TESTDATA.md, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import lineage
from . import canon, cooccur, leaks, lookalike, mixing, pieces, scanfix, splits, termfreq
from .base import concept_keys, current_resources, document_key, table

PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def _current_keys(spark: SparkSession, d: str) -> DataFrame:
    return current_resources(table(spark, d, "resources"), "concepts").select(concept_keys(F.col("concepts")).alias("keys"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of keys together in 5 or more current resources, 8 or more times as often as by chance."""
    return cooccur.cooccurrence(_current_keys(spark, d), "keys", min_pair=5, min_lift=8).select("concept_a", "concept_b")


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every pair with its counts, lift and odds ratio."""
    out = cooccur.cooccurrence(_current_keys(spark, d), "keys")
    return out.select("concept_a", "concept_b", "n_ab", "n_a", "n_b", "n_records", F.round("lift", 6).alias("lift"), F.round("odds_ratio", 6).alias("odds_ratio"))


def _oversized(spark: SparkSession, d: str) -> DataFrame:
    pages, resources = table(spark, d, "page_data"), table(spark, d, "resources")
    return pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "text").unionByName(resources.select(F.lit("resource").alias("kind"), F.col("load_id").alias("id"), "text"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized texts and whether a piece had to be cut where the writing does not allow it."""
    out = pieces.split_oversized(_oversized(spark, d), texts=False).groupBy("kind", "id").agg(F.max((F.col("cut") == "forced").cast("int")).alias("forced"))
    return out.select(F.col("kind").alias("item_kind"), F.col("id").alias("item_id"), F.when(F.col("forced") == 1, "forced").otherwise("natural").alias("cut"))


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_oversized(_oversized(spark, d))


def p2_files(spark: SparkSession, d: str) -> DataFrame:
    """All texts written to files, and these cut by byte ranges: characters of the files, and whether every piece holds them whole and within the limit."""
    folder = lineage.scratch(spark, "texts")
    _oversized(spark, d).filter("text is not null").select("text").write.text(folder)
    out = pieces.split_ranges(pieces.file_ranges(spark, lineage.files(spark, folder), range_bytes=1 << 20))
    whole = F.length("text") == F.col("stop") - F.col("start")
    by_file = out.groupBy("id").agg(F.max("stop").alias("n"), F.bool_and(whole & (F.length("text") <= pieces.LIMIT)).alias("fit"))
    return by_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("characters"), F.coalesce(F.bool_and("fit"), F.lit(True)).alias("fit"))


def _repaired(spark: SparkSession, d: str, texts: bool) -> DataFrame:
    titles = table(spark, d, "resources").select("chapter_title").unionByName(table(spark, d, "manifest").select("chapter_title"))
    pages, resources = table(spark, d, "page_data"), table(spark, d, "resources")
    paged = pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "text", F.coalesce("source_pdf", "document_id").alias("doc"))
    items = paged.unionByName(resources.select(F.lit("resource").alias("kind"), F.col("load_id").alias("id"), "text", F.coalesce("source_file", "document_id").alias("doc")))
    return scanfix.repair_scans(items, titles, texts=texts)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of noise by text."""
    return _repaired(spark, d, False).select(F.col("kind").alias("item_kind"), F.col("id").alias("item_id"), F.explode("noise").alias("noise"))


def p3_texts(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d, True)


def _links() -> dict:
    chapter = F.concat_ws("\x1e", "source_file", F.col("chapter_no").cast("string"))
    return {"document": document_key(F.col("document_id")), "chapter": F.when(F.col("source_file").isNotNull() & F.col("chapter_no").isNotNull(), chapter)}


def _related_documents(spark: SparkSession, d: str) -> DataFrame:
    """(document_id, component) of the document keys."""
    links = _links()
    rows = table(spark, d, "resources").select(*(c.alias(k) for k, c in links.items())).distinct()
    tagged = [F.concat(F.lit(f"{i}\x1f"), F.col(k)) for i, k in enumerate(links)]
    parts = splits.components(splits.link_edges(rows.select(F.filter(F.array(*tagged), lambda x: x.isNotNull()).alias("nodes"))))
    return lineage.cut(parts.filter(F.col("node").startswith("0\x1f")).select(F.expr("substring(node, 3)").alias("document_id"), "component"), "documents")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of document keys that must share a split."""
    return splits.pairs_within(_related_documents(spark, d), "document_id", "component")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row a document key: the least key it must share a split with, and the number of others."""
    return splits.classes(_related_documents(spark, d), "document_id", "component")


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    """Rows by split."""
    dealt = splits.related_splits(table(spark, d, "resources"), "load_id", _links(), PROPORTIONS)
    return dealt.select("load_id", "split")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys too rare or too common."""
    out = termfreq.term_frequency(_current_keys(spark, d), "keys")
    marks = F.filter(F.array(F.when(F.col("records") < 3, "rare"), F.when(F.col("too_common"), "common")), lambda m: m.isNotNull())
    return out.select(F.col("term").alias("concept"), F.explode(marks).alias("mark"))


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    out = termfreq.term_frequency(_current_keys(spark, d), "keys")
    return out.select(F.col("term").alias("concept"), "occurrences", F.col("records").alias("resources"), "mark")


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    return canon.map_to_list(table(spark, d, "resources"), "load_id", "concepts", table(spark, d, "vocab"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Free-typed forms and the entries they mean."""
    return _mapped(spark, d).filter("how = 'repaired'").select("load_id", F.col("value").alias("concept"), "canonical_id")


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Strings that mean no entry, with the rows that hold them."""
    return _mapped(spark, d).filter("how = 'none'").groupBy(F.col("value").alias("concept")).agg(F.count(F.lit(1)).alias("n_rows"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the test items of which they hold a passage."""
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_item")).select("doc_id", "item_id")


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources too small for their share."""
    return _mix(spark, d).shares.filter("short").select("source")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Wanted, budgeted and actual shares by source."""
    return _mix(spark, d).shares


def p8_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Budgets and what was mixed by domain, language and source."""
    return _mix(spark, d).leaves


def p8_selection(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix and how often each is taken."""
    return _mix(spark, d).selection


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that read the same but are stored differently."""
    return lookalike.lookalike_pairs(table(spark, d, "documents"))


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row a document that looks like another: its class and number of links."""
    return lookalike.lookalike_groups(table(spark, d, "documents"))


def p9_texts(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.canonical_texts(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in (p1_found, p1_pairs, p2_found, p2_pieces, p2_files, p3_found, p3_texts, p4_found, p4_classes, p4_splits, p5_found, p5_counts, p6_found, p6_unmatched, p7_found, p8_found, p8_shares, p8_leaves, p8_selection, p9_found, p9_classes, p9_texts)}


_KEY = r"nullif(regexp_replace(regexp_replace(regexp_replace(replace(lower(regexp_replace(x, '^\s+|\s+$', '', 'g')), '-', ' '), '[^a-z0-9\s]', '', 'g'), '^\s+|\s+$', '', 'g'), '\s+', '_', 'g'), '')"
_CURRENT = rf"""
dk AS (SELECT *, upper(regexp_replace(document_id, '^\s+|\s+$', '', 'g')) AS doc FROM resources),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc, resource_id, CASE WHEN doc IS NULL THEN load_id END ORDER BY extracted_at DESC NULLS LAST, load_id DESC) AS rk FROM dk),
cur AS (SELECT load_id, list_filter(list_transform(coalesce(concepts, []), lambda x: {_KEY}), lambda k: k IS NOT NULL) AS keys FROM ranked WHERE rk = 1),
held AS (SELECT load_id, unnest(keys) AS k FROM cur),
one AS (SELECT DISTINCT load_id, k FROM held),
single AS (SELECT k, count(*) AS n FROM one GROUP BY k),
total AS (SELECT count(*) AS n, count(*) FILTER (WHERE len(keys) > 0) AS spoken FROM cur),
pairs AS (SELECT a.k AS a, b.k AS b, count(*) AS n FROM one a JOIN one b ON a.load_id = b.load_id AND a.k < b.k GROUP BY a.k, b.k)"""
_PAIR_ROWS = "FROM pairs p JOIN single x ON x.k = p.a JOIN single y ON y.k = p.b CROSS JOIN total t"
_RUN = r"list_max(list_transform(regexp_split_to_array(text, '[ \t\n]'), lambda w: length(w)))"
_BOTH = "SELECT 'page' AS item_kind, page_id AS item_id, text FROM page_data UNION ALL SELECT 'resource', load_id, text FROM resources"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"WITH {_CURRENT} SELECT p.a AS concept_a, p.b AS concept_b {_PAIR_ROWS} WHERE p.n >= 5 AND p.n * t.n >= 8 * x.n * y.n",
        "p1_pairs": f"WITH {_CURRENT} SELECT p.a AS concept_a, p.b AS concept_b, p.n AS n_ab, x.n AS n_a, y.n AS n_b, t.n AS n_records, round(p.n::DOUBLE * t.n / (x.n::DOUBLE * y.n), 6) AS lift, round((p.n + 0.5::DOUBLE) * (t.n - x.n - y.n + p.n + 0.5::DOUBLE) / ((x.n - p.n + 0.5::DOUBLE) * (y.n - p.n + 0.5::DOUBLE)), 6) AS odds_ratio {_PAIR_ROWS}",
        "p2_found": f"SELECT item_kind, item_id, CASE WHEN {_RUN} > 2000 THEN 'forced' ELSE 'natural' END AS cut FROM ({_BOTH}) WHERE length(text) > 2000",
        "p2_files": f"SELECT sum(length(text) + 1)::BIGINT AS characters, true AS fit FROM ({_BOTH}) WHERE text IS NOT NULL",
        "p4_found": r"""WITH RECURSIVE r AS (SELECT DISTINCT upper(regexp_replace(document_id, '^\s+|\s+$', '', 'g')) AS d, CASE WHEN source_file IS NOT NULL AND chapter_no IS NOT NULL THEN source_file || '|' || chapter_no END AS f FROM resources WHERE document_id IS NOT NULL),
e AS (SELECT DISTINCT a.d AS a, b.d AS b FROM r a JOIN r b ON a.f = b.f AND a.d <> b.d),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT a AS document_id_a, b AS document_id_b FROM reach WHERE a < b""",
        "p4_classes": r"""WITH RECURSIVE r AS (SELECT DISTINCT upper(regexp_replace(document_id, '^\s+|\s+$', '', 'g')) AS d, CASE WHEN source_file IS NOT NULL AND chapter_no IS NOT NULL THEN source_file || '|' || chapter_no END AS f FROM resources WHERE document_id IS NOT NULL),
every AS (SELECT DISTINCT d FROM r),
e AS (SELECT d AS a, d AS b FROM every UNION SELECT a.d AS a, b.d AS b FROM r a JOIN r b ON a.f = b.f),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT a AS document_id, min(b) AS class_id, count(*) - 1 AS n_links FROM reach GROUP BY a""",
        "p5_found": f"WITH {_CURRENT} SELECT k AS concept, 'rare' AS mark FROM single WHERE n < 3 UNION ALL SELECT k, 'common' FROM single, total t WHERE single.n > 0.1 * t.spoken",
        "p5_counts": f"WITH {_CURRENT}, occ AS (SELECT k, count(*) AS n FROM held GROUP BY k) SELECT o.k AS concept, o.n AS occurrences, s.n AS resources, CASE WHEN s.n < 3 THEN 'rare' WHEN s.n > 0.1 * t.spoken THEN 'common' END AS mark FROM occ o JOIN single s ON s.k = o.k CROSS JOIN total t",
    }
