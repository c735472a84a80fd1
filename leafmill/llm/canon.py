"""Problem 6: mapping free-entered values to a canonical list.

Method: token-level repair.  Every distinct token is joined with the tokens of the reference list through the deletions
they share and weighed by edit distance; the corrected tokens of a value lead to the complete entries they can make up,
which soft TF-IDF ranks; a value is mapped if one entry accounts for all its words and leads.  Words that only frame entries
('what is ...', '... etc.') are learned from the values themselves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from ..plans.skew import hot_cold_join
from .base import concept_key
from .lookalike import canonical

#: Edits allowed to a value; lead in soft TF-IDF of the entry meant; what running words together counts for, in edits.
EDITS, LEAD, JOINED = 2, 0.004, 0.25
#: A word that is none of the list's frames entries if, in this share of the distinct values that hold it beside words of the list, these exactly name an entry,
#: so many different ones at least; most such words that are broadcast (more are joined).
FRAMED, FRAMES, MOST_FRAMING = 0.5, 3, 100_000
# Words that link the words of a name and say nothing about which entry is meant.
LINKING = ("of", "the", "a", "an", "and", "in", "for")
# Characters that scanners take for letters, and strings read or spelt as others.
MISREAD = {"0": "o", "1": "l", "5": "s", "|": "l", "!": "i", "8": "b", "6": "b", "9": "g"}
MERGED = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("f", "ph"))


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, or most + 1 if it is more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def deletions(word: str, most: int) -> set[str]:
    return {"".join(word[i] for i in keep) for d in range(min(most, len(word) - 1) + 1) for keep in combinations(range(len(word)), len(word) - d)}


def words(text: str) -> list[str]:
    """Lower-case words of a value in one form; a possessive s is dropped, an abbreviation keeps its point."""
    plain = unicodedata.normalize("NFKC", canonical(text)).lower().replace("’", "'")
    plain = re.sub(r"'[s5]\b", "", re.sub(r"\b[s5]'(?=\s|$)", "s", plain))
    return re.findall(r"[a-z0-9|!']+\.?", re.sub(r"[!?.,;:]+$", lambda m: "." if m[0] == "." and len(plain.split()) < 2 else "", plain.strip()))


def _allowed(n: int) -> int:
    return 0 if n < 3 else 1 if n < 4 else 2


def forms(token: str, longest: int) -> dict[str, float]:
    """What a token may have been before it was scanned or typed, with what that costs; nothing longer than any token of the list could be made of."""
    whole = token.rstrip(".").replace("'", "")
    out = {whole: 0.0}
    scanned = "".join(MISREAD.get(c, c) for c in whole)
    out.setdefault(scanned, 0.5)
    for a, b in MERGED:
        for k in range(len(scanned)) if len(scanned) <= longest + EDITS + 1 else ():
            if scanned.startswith(a, k):
                out.setdefault(scanned[:k] + b + scanned[k + len(a) :], 1.0)
    return out


def repair_cost(told: dict[str, float], meant: str) -> float | None:
    """Edits from a token's forms to a token of the list; None if there are too many."""
    best = None
    for form, paid in told.items():
        most = min(_allowed(len(form) + 1), EDITS)
        if (best is None or paid < best) and (n := osa(form, meant, most)) <= most and (best is None or n + paid < best):
            best = n + paid
    return best


def cut_cost(token: str, meant: str) -> float | None:
    """What it costs to take a token for a cut-off ``meant``; None if it cannot be one."""
    whole = token.rstrip(".").replace("'", "")
    if not (len(whole) >= 3 and meant.startswith(whole) and len(meant) > len(whole)) or not (token.endswith(".") or len(whole) >= 4):
        return None
    more = len(meant) - len(whole)
    return 0.5 if token.endswith(".") else 1.0 + 0.1 * more if more > 1 else 1.0


def idle(word: str) -> bool:
    """A linking word, or such a word with a slip."""
    w = word.rstrip(".")
    return w in LINKING or len(w) < 4 and any(osa(w, x, 1) <= 1 for x in ("of", "the"))


def assign(told: list[dict[str, float]], bag: list[str]) -> dict[int, str] | None:
    """For every word its own token of the entry, with the least edits; None if that cannot be within EDITS."""
    best: tuple[float, dict[int, str]] | None = None

    def go(k: int, left: list[str], cost: float, chosen: dict[int, str]) -> None:
        nonlocal best
        if cost > EDITS or best is not None and cost >= best[0]:
            return
        if k == len(told):
            best = cost, chosen
            return
        for n, t in enumerate(left):
            if t in told[k]:
                go(k + 1, left[:n] + left[n + 1 :], cost + told[k][t], {**chosen, k: t})

    go(0, bag, 0.0, {})
    return best[1] if best else None


def soft_tfidf(told: list[dict[str, float]], chosen: dict[int, str], idf: dict[str, float]) -> float:
    """Cosine of value and entry by the weights of their tokens, each pair of tokens counting by its likeness."""
    whole = sum(idf[t] ** 2 for t in chosen.values()) or 1.0
    return sum(idf[t] ** 2 * (1 - min(told[k][t] / (len(t) + 1), 1.0)) for k, t in chosen.items()) / whole


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)


_S, _F, _L = pa.string(), pa.float64(), pa.int64()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, bag, run): the words of a name but linking ones, sorted, and all its words run together."""
    for batch in batches:
        rows = []
        for cid, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            parts = [w.rstrip(".") for w in words(name)]
            rows.append((cid, sorted(w for w in parts if w not in LINKING), "".join(parts)))
        yield _batch(rows, [_S, pa.list_(_S), _S], ["entry", "bag", "run"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([words(v) for v in batch.column(1).to_pylist()], pa.list_(_S))], names=["vid", "value", "n", "words"])


def _gaps(kind: str, longest: int):
    """(gap, what): the keys under which a token or run is found: kind 't' and 'r' index those of the list, kind 'T' and 'R' ask for them."""

    def keys(x: str) -> set[str]:
        if kind == "r":
            return {"r" + d for d in deletions(x, 1)}
        if kind == "R":
            return {"r" + d for d in deletions(x, 1)} if 5 <= len(x) <= longest + 1 else set()
        if kind == "t":
            return {"t" + d for d in deletions(x, _allowed(len(x)))} | {"p" + x[:k] for k in range(3, len(x))}
        whole, out = x.rstrip(".").replace("'", ""), set()
        for form in forms(x, longest):
            most = min(_allowed(len(form) + 1), EDITS)
            if len(form) <= longest + most:
                out |= {"t" + d for d in deletions(form, most)}
        if len(whole) < longest and (x.endswith(".") or len(whole) >= 4):
            out.add("p" + whole)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(0).to_pylist():
                rows += [(g, x) for g in keys(x)]
                if len(rows) > 50_000:
                    yield _batch(rows, [_S, _S], ["gap", "what"])
                    rows = []
            yield _batch(rows, [_S, _S], ["gap", "what"])

    return run


def _weigh(longest: int):
    """(token, meant, edits, cut) of the pairs that are near enough, by edits or as a cut-off word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, {}
        for batch in batches:
            rows = []
            for token, meant in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if token != last:
                    last, told = token, forms(token, longest)
                edits, cut_off = repair_cost(told, meant), cut_cost(token, meant)
                if edits is not None or cut_off is not None:
                    rows.append((token, meant, edits, cut_off))
            yield _batch(rows, [_S, _S, _F, _F], ["token", "meant", "edits", "cut"])

    return run


def _told(row: list[dict], framing: set[str]) -> tuple[list[str], list[dict[str, float]] | None]:
    """(all words but framing ones, repairs of each word that counts); None if a word that counts has no repair, or none counts."""
    core = [x for x in sorted(row, key=lambda x: x["pos"]) if x["word"].rstrip(".") not in framing]
    told = [{f["meant"]: f["edits"] for f in x["fixes"]} for x in core if x["word"].rstrip(".") not in LINKING and (x["fixes"] or not idle(x["word"]))]
    return [x["word"] for x in core], told if told and all(told) else None


def _asks(know):
    """(vid, key, told, short): by which token, and how many words, entries are looked up that the repaired words may make up; and runs of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        framing = know.value
        for batch in batches:
            rows = []
            for vid, row, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                core, told = _told(row, framing if framing is not None else set(own or ()))
                short = len(core) == 1 and len(core[0]) < 5  # too short to tell by two edits
                if told:
                    held = {f["meant"]: f["held"] for x in row for f in x["fixes"]}
                    rarest = min(told, key=lambda r: (sum(held[t] for t in r), sorted(r)))
                    flat = [[{"meant": t, "edits": c} for t, c in sorted(r.items())] for r in told]
                    rows += [(vid, f"{len(told)} {t}", flat, short) for t in rarest]
                if core:
                    runs = {"".join(w.rstrip(".").replace("'", "") for w in ws) for ws in (core, [x["word"] for x in sorted(row, key=lambda x: x["pos"])])}
                    rows += [(vid, "r" + r, None, short) for r in runs if len(r) >= 5]
            yield _batch(rows, [_L, _S, pa.list_(pa.list_(pa.struct([("meant", _S), ("edits", _F)]))), pa.bool_()], ["vid", "key", "told", "short"])

    return run


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vid, score, edits, entry) of a value and an entry that all its words can make up."""
    for batch in batches:
        rows = []
        for vid, told, short, entry, bag in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            repairs = [{f["meant"]: f["edits"] for f in r} for r in told]
            chosen = assign(repairs, [x["t"] for x in bag])
            if chosen is not None:
                edits = sum(repairs[k][t] for k, t in chosen.items())
                if edits <= (1 if short else EDITS):
                    rows.append((vid, soft_tfidf(repairs, chosen, {x["t"]: x["idf"] for x in bag}), edits, entry))
        yield _batch(rows, [_L, _F, _F, _S], ["vid", "score", "edits", "entry"])


def _rank_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for vid, asked, short, entry, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            edits = osa(asked, name, 1) + JOINED
            if edits <= (1 if short else 1 + JOINED):
                rows.append((vid, 1 - edits / (len(name) + 1), edits, entry))
        yield _batch(rows, [_L, _F, _F, _S], ["vid", "score", "edits", "entry"])


_RANKED = "vid bigint, score double, edits double, entry string"


def _weighted(asks: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Inner join of many ``asks`` with ``known``, unique in ``key``, of which some may be asked for by a large share."""
    weight = cut(known.join(asks.groupBy(key).agg(F.count(F.lit(1)).alias("__w")), key), "weighed")
    return hot_cold_join(asks, weight, key, "__w", weight.agg(F.sum("__w")).first()[0] or 0).drop("__w")


def _framing(told: DataFrame, bags: DataFrame) -> DataFrame:
    """(word): words that mostly stand beside the exact words of a whole entry, where no repair of theirs would make up another entry with these."""
    bare = lambda x: F.rtrim(x["word"], F.lit("."))
    exact = lambda x: F.exists(x["fixes"], lambda f: (f["edits"] == 0) & (f["meant"] == bare(x)))
    rest = F.filter(F.transform(F.filter("words", exact), bare), lambda w: ~w.isin(*LINKING))
    others = F.filter("words", lambda x: ~exact(x) & ~bare(x).isin(*LINKING))
    each = told.select("vid", rest.alias("rest"), F.explode(others).alias("x")).filter(F.size("rest") > 0)
    names = lambda more: F.array_join(F.array_sort(F.concat(F.col("rest"), more)), " ")
    alone = F.struct(F.lit(True).alias("alone"), names(F.array().cast("array<string>")).alias("names"))
    repaired = F.transform(F.col("x.fixes"), lambda f: F.struct(F.lit(False).alias("alone"), names(F.array(f["meant"])).alias("names")))
    tried = each.select("vid", bare(F.col("x")).alias("word"), F.explode(F.concat(F.array(alone), repaired)).alias("t")).select("vid", "word", "t.alone", "t.names").join(bags, "names", "left")
    seen = tried.groupBy("vid", "word").agg((F.coalesce(F.bool_or(F.col("alone") & F.col("whole")), F.lit(False)) & ~F.coalesce(F.bool_or(~F.col("alone") & F.col("whole")), F.lit(False))).alias("framed"), F.max(F.when(F.col("alone"), F.col("names"))).alias("names"))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("framed").alias("framed"), F.count_distinct(F.when(F.col("framed"), F.col("names"))).alias("entries"))
    # A word alone in its value frames nothing, but neither does it tell against framing; it is not counted.
    return counts.filter((F.col("framed") >= F.lit(FRAMED) * F.col("n")) & (F.col("entries") >= FRAMES)).select("word")


def match_values(values: DataFrame, entries: DataFrame, most_framing: int = MOST_FRAMING) -> DataFrame:
    """(value, n, canonical_id, edits) of distinct ``values`` (value, n): the one entry meant, or null.

    ``entries`` has canonical_id and display_name, distinct and not null.  Both sides are joined: distinct tokens with the
    list's tokens by shared deletions, values with their tokens' repairs, and with entries by their rarest repaired token and
    number of words.  The list may be of any length.
    """
    spark = values.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = cut(entries.mapInArrow(_entries, "entry string, bag array<string>, run string"), "entries")
    number = listed.count()
    single = listed.select("entry", F.explode(F.array_distinct("bag")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("held"))
    tokens = cut(single.withColumn("idf", F.log(F.lit(1.0) + F.lit(float(number)) / F.col("held"))), "listed")
    longest, longest_run = (x or 0 for x in (tokens.agg(F.max(F.length("t"))).first()[0], listed.agg(F.max(F.length("run"))).first()[0]))

    # The number of tasks is kept where comparing costs far more than the bytes let the adaptive coalescing see.
    free = cut(values.repartition(tasks, "value").select(F.monotonically_increasing_id().alias("vid"), "value", "n").mapInArrow(_words, "vid bigint, value string, n bigint, words array<string>"), "values")
    said = free.select("vid", F.posexplode("words").alias("pos", "word"))
    distinct = cut(said.groupBy("word").agg(F.count(F.lit(1)).alias("uses")), "tokens")
    gap = "gap string, what string"
    index = tokens.select("t").mapInArrow(_gaps("t", longest), gap).select("gap", F.col("what").alias("meant"))
    asked = distinct.filter(~F.rtrim("word", F.lit(".")).isin(*LINKING)).select("word").repartition(tasks, "word").mapInArrow(_gaps("T", longest), gap).select("gap", F.col("what").alias("token"))
    near = asked.join(index, "gap").select("token", "meant").distinct().repartition(tasks, "token").sortWithinPartitions("token").mapInArrow(_weigh(longest), "token string, meant string, edits double, cut double")
    held = near.join(tokens.select(F.col("t").alias("meant"), "held"), "meant")
    itself = F.replace(F.rtrim("token", F.lit(".")), F.lit("'"), F.lit("")) == F.col("meant")
    fixes = held.groupBy("token").agg(F.collect_list(F.struct("meant", "edits", "cut", "held")).alias("f"), F.bool_or(itself).alias("known"))  # list tokens within two edits of one token
    # A word of the list is not a cut-off one.
    cost = lambda x: F.when(F.col("known"), x["edits"]).otherwise(F.least(x["edits"], x["cut"]))
    fixes = fixes.select(F.col("token").alias("word"), F.filter(F.transform("f", lambda x: F.struct(x["meant"].alias("meant"), cost(x).alias("edits"), x["held"].alias("held"))), lambda x: x["edits"].isNotNull()).alias("fixes"))
    none = F.array().cast("array<struct<meant: string, edits: double, held: bigint>>")
    meant = cut(distinct.join(fixes, "word", "left").select("word", "uses", F.coalesce("fixes", none).alias("fixes")), "repairs")
    uses = meant.agg(F.sum("uses")).first()[0] or 0
    told = hot_cold_join(said, meant, "word", "uses", uses).groupBy("vid").agg(F.collect_list(F.struct("pos", "word", "fixes")).alias("words"))  # the words of one value
    told = cut(told, "told")

    bags = listed.select(F.array_join("bag", " ").alias("names"), F.lit(True).alias("whole")).filter("names <> ''").distinct()
    framing = cut(_framing(told, bags), "framing")
    if framing.count() <= most_framing:
        know, own = {r.word for r in framing.collect()}, F.lit(None).cast("array<string>")
        framed = told.select("vid", "words", own.alias("own"))
    else:
        know = None
        pairs = told.select("vid", F.explode(F.array_distinct(F.transform("words", lambda x: F.rtrim(x["word"], F.lit("."))))).alias("word"))
        mine = _weighted(pairs, framing, "word").groupBy("vid").agg(F.collect_list("word").alias("own"))
        framed = told.join(mine, "vid", "left").select("vid", "words", "own")
    asks = cut(framed.mapInArrow(_asks(spark.sparkContext.broadcast(know)), "vid bigint, key string, told array<array<struct<meant: string, edits: double>>>, short boolean"), "asks")

    weighed = listed.select("entry", F.size("bag").alias("size"), F.posexplode("bag").alias("k", "t")).join(tokens.select("t", "idf"), "t")
    weighed = weighed.groupBy("entry", "size").agg(F.array_sort(F.collect_list(F.struct("t", "idf"))).alias("bag"))
    posted = weighed.select(F.explode(F.array_distinct(F.transform("bag", lambda x: x["t"]))).alias("t"), "size", "entry", "bag")
    postings = posted.groupBy(F.concat_ws(" ", F.col("size").cast("string"), "t").alias("key")).agg(F.collect_list(F.struct("entry", "bag")).alias("e"))  # entries of one token and length
    bagged = _weighted(asks.filter("told is not null"), postings, "key").select("vid", "told", "short", F.explode("e").alias("e")).select("vid", "told", "short", "e.entry", "e.bag")
    by_words = bagged.mapInArrow(_rank, _RANKED)
    runs = asks.filter("told is null").select("vid", F.substring("key", 2, 1 << 30).alias("asked"), "short")
    ask_gaps = runs.select("asked").distinct().mapInArrow(_gaps("R", longest_run), gap).select("gap", F.col("what").alias("asked"))
    run_index = listed.select("run").filter("run <> ''").distinct().mapInArrow(_gaps("r", longest_run), gap).select("gap", F.col("what").alias("run"))
    met = ask_gaps.join(run_index, "gap").select("asked", "run").distinct().join(listed.select("run", "entry"), "run")
    by_runs = runs.join(met, "asked").select("vid", "asked", "short", "entry", "run").mapInArrow(_rank_runs, _RANKED)
    ranked = by_words.unionByName(by_runs).groupBy("vid", "entry").agg(F.max_by(F.struct("score", "edits"), F.struct("score", -F.col("edits"))).alias("s"))
    best = ranked.groupBy("vid").agg(F.max(F.struct(F.col("s.score").alias("score"), F.col("s.edits").alias("edits"), "entry")).alias("one"), F.sort_array(F.collect_list("s.score"), asc=False).alias("scores"))  # entries within two edits of one value
    clear = F.when((F.size("scores") < 2) | (F.get("scores", F.lit(0)) - F.get("scores", F.lit(1)) >= LEAD), F.col("one"))
    chosen = best.select("vid", clear.alias("one")).filter("one is not null")
    return free.select("vid", "value", "n").join(chosen, "vid", "left").select("value", "n", F.col("one.entry").alias("canonical_id"), F.col("one.edits").alias("edits"))


def map_to_list(rows: DataFrame, row_id: str, values: str, entries: DataFrame, most_framing: int = MOST_FRAMING) -> DataFrame:
    """(row_id, value, canonical_id, how, edits): every distinct value of every row with the entry it means.

    ``rows`` holds an array of strings in ``values``; ``entries`` has canonical_id and display_name.  ``how`` is 'key' where the
    value's concept key is a canonical_id, 'repaired' where it is a free-typed form of just one entry, and 'none',
    with null canonical_id, where it means no entry or cannot be told: these are the unmatched to report.  A value means the entry of
    greatest soft TF-IDF among those that account for all its words, framing ones aside, within two edits, if it leads by LEAD; words run
    together count as well.  Null values are left out; the empty string and keyless strings are 'none'.  Repeated rows give
    repeated results.  Distinct values are matched once, whatever their number of rows.
    """
    known = entries.select("canonical_id", "display_name").filter("canonical_id is not null and display_name is not null").distinct()
    held = rows.select(F.col(row_id).alias("rid"), F.explode(F.array_distinct(F.filter(F.col(values), lambda x: x.isNotNull()))).alias("value"))
    ids = entries.select(F.col("canonical_id").alias("key")).filter("key is not null").distinct()
    counted = cut(held.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("key", concept_key(F.col("value"))), "values")
    exact = counted.join(ids, "key").select("value", "n", F.col("key").alias("canonical_id"), F.lit("key").alias("how"), F.lit(0.0).alias("edits"))
    matched = match_values(counted.join(ids, "key", "left_anti").select("value", "n"), known, most_framing)
    how: Column = F.when(F.col("canonical_id").isNull(), "none").otherwise("repaired")
    meant = cut(exact.unionByName(matched.select("value", "n", "canonical_id", how.alias("how"), "edits")), "meanings")
    total = meant.agg(F.sum("n")).first()[0] or 0
    return hot_cold_join(held, meant, "value", "n", total).select(F.col("rid").alias(row_id), "value", "canonical_id", "how", "edits")
