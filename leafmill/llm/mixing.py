"""Problem 8: mixing sources to target weights.

Method: hierarchical budgeting.  Wanted shares go down a tree domain - language - source, in which a source has a leaf in
each domain and language that it holds texts of; what a leaf cannot give is asked of its siblings before its ancestors; each leaf then gives
whole epochs and a token-prefix of one more, in an order drawn from the seed.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut

#: Ranks of a public byte-level tokenizer, and the splitting pattern it is published with (a fixed value).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents that a hash range of the drawn order holds about, and leaves that the tree may have.
RANGE_ROWS, MOST_LEAVES = 50_000, 1_000_000
#: Tokens below which a shortage is rounding.
ROUNDING = 1e-3


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, columns: list[str], text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``columns`` of every row with ``tokens``, the length of its text in tokens; null and empty text count 0."""
    kept = documents.select(*columns, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(tokenizer)
        for batch in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*columns, "tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, tokens bigint")


def budget(leaves: dict[tuple[str, ...], tuple[float, float]], amount: float, depth: int = 0) -> dict[tuple[str, ...], float]:
    """What each leaf gives of ``amount``; ``leaves`` maps a path to (weight, capacity).

    At each node the amount is shared among the children by weight; a child takes no more than its leaves hold, and
    what it leaves is shared among its siblings again, so a shortage goes up only when its whole subtree is used up.
    """
    if not leaves:
        return {}
    groups: dict[str, dict[tuple[str, ...], tuple[float, float]]] = {}
    for path, v in leaves.items():
        groups.setdefault(path[depth], {})[path] = v
    hold = {g: (sum(w for w, _ in v.values()), sum(c for w, c in v.values() if w > 0)) for g, v in groups.items()}
    given, free, rest = dict.fromkeys(groups, 0.0), {g for g in groups if hold[g][0] > 0}, amount
    while free and rest > 1e-9:
        unit = rest / sum(hold[g][0] for g in free)
        full = {g for g in free if given[g] + unit * hold[g][0] >= hold[g][1]}
        if not full:
            for g in free:
                given[g] += unit * hold[g][0]
            break
        for g in full:
            rest -= hold[g][1] - given[g]
            given[g] = hold[g][1]
        free -= full
    out: dict[tuple[str, ...], float] = {}
    for g, v in groups.items():
        out |= {next(iter(v)): given[g]} if len(v) == 1 else budget(v, given[g], depth + 1)
    return out


class Mix(NamedTuple):
    """What ``mix`` gives."""

    shares: DataFrame
    leaves: DataFrame
    selection: DataFrame


_LEAF = "leaf int, source string, domain string, lang string, target_share double, max_repeats int, leaf_tokens bigint, wanted_tokens double, unplaced_tokens double, budget_tokens double, full int, rest bigint"


def _plan(cells: list, whole: float) -> list[tuple]:
    """A row of _LEAF for each (source, share, repeats, domain, lang, tokens); a source's share is dealt to its leaves by their tokens."""
    size: dict[str, int] = {}
    for c in cells:
        size[c.source] = size.get(c.source, 0) + (c.n or 0)
    tree = {(c.domain or "", c.lang or "", c.source): (c.share * ((c.n or 0) / size[c.source] if size[c.source] else 1.0), float(c.repeats * (c.n or 0))) for c in cells}
    given = budget(tree, whole)
    rows = []
    for k, c in enumerate(cells):
        path = (c.domain or "", c.lang or "", c.source)
        weight, capacity = tree[path]
        have, gives = c.n or 0, given[path]
        full = min(c.repeats, int(gives // have)) if have else 0
        rest = round(gives - full * have) if full < c.repeats else 0
        rows.append((k, c.source, c.domain, c.lang, c.share, c.repeats, have, weight * whole, max(0.0, weight * whole - capacity), gives, full, rest))
    return rows


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, total: int | None = None, seed: int = 0, most_leaves: int = MOST_LEAVES, range_rows: int = RANGE_ROWS) -> Mix:
    """(shares, leaves, selection) of a mix as large as all documents, or of ``total`` tokens.

    ``documents`` has doc_id, text, source, lang, subject; ``targets`` has source, target_share, max_repeats, one row per
    source (the first by share and repeats counts if there are more).  Sources are compared as stored; documents of
    null or unlisted sources, and of share 0 or null, are not taken, but count in the total.  A leaf of the tree is a domain (subject,
    trimmed and lower-cased), language and source; its weight is the part of the source's share that it holds of the source's tokens.

    leaves: source, domain, lang, target_share, max_repeats, leaf_tokens, wanted_tokens (its own part of the target), unplaced_tokens (of
    these, what its texts do not hold even when repeated as often as they may be), budget_tokens (what the tree asks of it),
    mixed_tokens.  A listed source without documents is one leaf of null domain and language.
    shares, summed from them by source: source, target_share, max_repeats, source_tokens, wanted_tokens, budget_tokens, mixed_tokens,
    actual_share, short (the tree could not place its target in its leaves).
    selection: doc_id, source, tokens, times (whole epochs plus one if in the prefix of the last), for every document taken
    at least once.  A document whose tokens cross the end of the prefix is taken if more
    than half of it lies before, so that leaves are over their budgets as often as under.  Empty documents or targets give no selection.

    The leaves are planned on the driver: they are as many as there are combinations of a listed source with its domains and languages, and more than
    ``most_leaves`` are an error.  A leaf's order is cut into hash ranges of about ``range_rows`` documents; sums of ranges say in which one
    its prefix ends, and only that one is sorted.
    """
    spark = documents.sparkSession
    counted = cut(token_counts(documents, ["doc_id", "source", "lang", "subject"], tokenizer=tokenizer), "tokens")
    named = counted.select("doc_id", "source", "tokens", F.nullif(F.lower(F.trim("subject")), F.lit("")).alias("domain"), F.nullif("lang", F.lit("")).alias("lang"))
    goals = targets.filter("source is not null").groupBy("source").agg(F.max(F.struct(F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(0)).alias("repeats"))).alias("t"))
    goals = goals.select("source", "t.share", "t.repeats")
    sizes = named.groupBy("source", "domain", "lang").agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("docs"))
    found = goals.join(sizes, "source", "left").orderBy("source", "domain", "lang").limit(most_leaves + 1).collect()
    if len(found) > most_leaves:
        raise ValueError(f"more than {most_leaves} combinations of domain, language and source")
    whole = total if total is not None else counted.agg(F.sum("tokens")).first()[0] or 0
    plan = spark.createDataFrame(_plan(found, float(whole)), _LEAF)
    buckets = 1 << max(0, (max((c.docs or 0 for c in found), default=0) // range_rows)).bit_length()
    h = F.xxhash64(F.lit(seed), "full", "doc_id")
    bucket = F.shiftrightunsigned("h", 65 - buckets.bit_length()).cast("int") if buckets > 1 else F.lit(0)
    asked = F.broadcast(plan.filter("full > 0 or rest > 0").select("leaf", F.col("source").alias("s"), F.col("domain").alias("d"), F.col("lang").alias("l"), "full", "rest"))
    at = (F.col("source") == F.col("s")) & F.col("domain").eqNullSafe(F.col("d")) & F.col("lang").eqNullSafe(F.col("l"))
    taken = named.join(asked, at).select("doc_id", "source", "tokens", "leaf", "full", "rest").withColumn("h", h).withColumn("bucket", bucket)
    sums = taken.filter("rest > 0").groupBy("leaf", "bucket", "rest").agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    last = sums.withColumn("before", before).filter("before < rest").groupBy("leaf").agg(F.max(F.struct("bucket", "before")).alias("e")).select("leaf", F.col("e.bucket").alias("edge"), F.col("e.before").alias("before"))
    placed = taken.join(F.broadcast(last), "leaf", "left")  # no more rows than leaves
    ahead = placed.filter(F.col("bucket") < F.coalesce("edge", F.lit(-1))).withColumn("part", F.lit(1))
    behind = placed.filter(F.col("bucket") > F.coalesce("edge", F.lit(-1))).withColumn("part", F.lit(0))
    inside = placed.filter(F.col("bucket") == F.col("edge"))
    run = F.sum("tokens").over(Window.partitionBy("leaf").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    inside = inside.withColumn("part", (F.col("before") + run + F.col("tokens") / 2 < F.col("rest")).cast("int"))
    chosen = cut(ahead.unionByName(behind).unionByName(inside).select("doc_id", "source", "tokens", (F.col("full") + F.col("part")).alias("times"), "leaf").filter("times > 0"), "selection")
    mixed = chosen.groupBy("leaf").agg(F.sum(F.col("tokens") * F.col("times")).alias("mixed_tokens"))
    leaves = plan.join(mixed, "leaf", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    sum_ = lambda c, name: F.sum(c).alias(name)
    shares = leaves.groupBy("source").agg(F.first("target_share").alias("target_share"), F.first("max_repeats").alias("max_repeats"), sum_("leaf_tokens", "source_tokens"), sum_("wanted_tokens", "wanted_tokens"), sum_("budget_tokens", "budget_tokens"), sum_("mixed_tokens", "mixed_tokens"), (F.sum("unplaced_tokens") > ROUNDING).alias("short"))
    all_mixed = chosen.agg(F.sum(F.col("tokens") * F.col("times"))).first()[0] or 0
    share = F.when(F.lit(all_mixed) > 0, F.col("mixed_tokens") / F.lit(all_mixed)).otherwise(F.lit(0.0))
    shares = shares.select("source", "target_share", "max_repeats", "source_tokens", "wanted_tokens", "budget_tokens", "mixed_tokens", share.alias("actual_share"), "short")
    return Mix(shares, leaves.select("source", "domain", "lang", "target_share", "max_repeats", "leaf_tokens", "wanted_tokens", "unplaced_tokens", "budget_tokens", "mixed_tokens"), chosen.drop("leaf"))
