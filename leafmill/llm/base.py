"""Keys and row choices shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.skew import strip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def concept_key(c: Column) -> Column:
    """Concept key of TESTDATA.md; null for null, empty and keyless strings."""
    kept = strip(F.regexp_replace(F.replace(F.lower(strip(c)), F.lit("-"), F.lit(" ")), r"(?U)[^a-z0-9\s]", ""))
    return F.nullif(F.regexp_replace(kept, r"(?U)\s+", "_"), F.lit(""))


def concept_keys(c: Column) -> Column:
    """All keys of an array of strings, repeats kept; an empty array for null."""
    return F.coalesce(F.filter(F.transform(c, concept_key), lambda k: k.isNotNull()), F.array().cast("array<string>"))


def document_key(c: Column) -> Column:
    return F.upper(strip(c))


def current_resources(resources: DataFrame, *columns: str) -> DataFrame:
    """Current resources of TESTDATA.md with the asked columns.

    A row with null ``document_id`` stands for itself: it partitions by its own ``load_id``, so such rows never meet
    in one group.  A null ``resource_id`` is one value among others.  Of rows equal in ``extracted_at`` and
    ``load_id`` one is kept; a null ``extracted_at`` loses to any other.
    """
    dk = document_key(F.col("document_id"))
    own = resources.select(*(F.col(c).alias(f"v_{c}") for c in columns), dk.alias("g_doc"), F.col("resource_id").alias("g_res"), F.when(dk.isNull(), F.col("load_id")).alias("g_row"), F.col("extracted_at").alias("o_at"), F.col("load_id").alias("o_load"))
    w = Window.partitionBy("g_doc", "g_res", "g_row").orderBy(F.col("o_at").desc_nulls_last(), F.col("o_load").desc_nulls_last())
    return own.withColumn("o_rank", F.row_number().over(w)).filter("o_rank = 1").select(*(F.col(f"v_{c}").alias(c) for c in columns))
