"""Reading lists of concepts out of what a model wrote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.skew import strip


def concept_list(raw: Column, distinct: bool = False) -> Column:
    """The strings of the first bracketed JSON array in ``raw``; empty for null, no array, or broken JSON.

    Fences are dropped; members that are no strings are left out, not converted.  With ``distinct`` strings are
    trimmed, empty ones dropped, and of those equal but for case the first is kept.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r"```(?:json)?\s*", ""), "```", "")
    found = F.regexp_extract(bare, r"(?s)(\[.*?\])", 1)
    variants = F.try_variant_get(F.try_parse_json(F.nullif(found, F.lit(""))), "$", "array<variant>")
    texts = F.filter(F.transform(variants, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))), lambda s: s.isNotNull())
    texts = F.coalesce(texts, F.array().cast("array<string>"))
    if not distinct:
        return texts
    trimmed = F.filter(F.transform(texts, strip), lambda s: s != "")
    return F.filter(trimmed, lambda s, i: F.array_position(F.transform(trimmed, F.lower), F.lower(s)) == i + 1)


def accepted(raw: Column, candidates: Column) -> Column:
    """Strings of the model's list that are among ``candidates`` but for case, in the candidates' spelling, in the model's order, repeats kept.

    Of candidates equal but for case the last is the spelling taken.
    """
    lowered = F.transform(candidates, F.lower)
    last = lambda t: F.element_at(F.filter(candidates, lambda c: F.lower(c) == t), -1)
    return F.transform(F.filter(F.transform(concept_list(raw), lambda s: F.lower(strip(s))), lambda t: F.array_contains(lowered, t)), last)
