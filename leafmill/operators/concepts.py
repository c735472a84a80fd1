"""What a model reads, what it is asked, and what is made of its answers."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.concept_lists import accepted, concept_list
from ..plans.skew import strip

# Types read for concepts, types never read, types whose summary is read first, least length, candidates shown, known terms shown; entries of a vocabulary that workers are handed.
READ_TYPES = ("explanation", "example", "recall", "callout", "activity", "internet_task", "scientist_box")
SKIPPED_TYPES = ("diagram", "exercise", "mcq")
SUMMARY_TYPES = ("explanation", "example", "activity")
LEAST, CANDIDATES, KNOWN = 40, 40, 150
LISTED = 20_000

#: Turns a prompt into an answer; called once per row, on the workers.
Annotator = Callable[[str], str]


def content() -> Column:
    """What is read of a resource: by type the summary, text or caption of 40 characters or more, cleaned; else null."""
    enough = lambda c: F.when(F.length(strip(F.col(c))) >= LEAST, strip(F.col(c)))
    reliable = F.coalesce(F.col("resource_type").isin(*SUMMARY_TYPES), F.lit(False))
    chosen = F.when(reliable, F.coalesce(enough("summary"), enough("text"))).otherwise(F.coalesce(enough("text"), enough("image_caption")))
    return F.when(chosen.isNotNull(), T.clean_content(chosen))


def skip_reason() -> Column:
    """Why a resource is not read: no_resource_id, type_skipped, no_content; null if it is."""
    t = F.coalesce(F.col("resource_type"), F.lit(""))
    return F.when(F.coalesce("resource_id", F.lit("")) == "", "no_resource_id").when(t.isin(*SKIPPED_TYPES) | ~t.isin(*READ_TYPES), "type_skipped").when(content().isNull(), "no_content")


def readable(resources: DataFrame) -> DataFrame:
    return resources.filter(skip_reason().isNull()).withColumn("content", content())


def skip_counts(resources: DataFrame) -> DataFrame:
    """One row: how many were skipped for each reason, and kept."""
    r = resources.select(skip_reason().alias("r"))
    return r.agg(*(F.count_if(F.col("r") == k).alias(k) for k in ("no_resource_id", "type_skipped", "no_content")), F.count_if(F.col("r").isNull()).alias("kept"))


def unannotated() -> Column:
    """No concepts yet, an id, and a summary that is not blank."""
    return (F.coalesce("resource_id", F.lit("")) != "") & (F.coalesce(F.size("concepts"), F.lit(0)) <= 0) & (F.coalesce(strip(F.col("summary")), F.lit("")) != "")


def optional_line(label: str, c: str) -> Column:
    return F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{label}: "), F.col(c), F.lit("\n"))).otherwise("")


def about() -> Column:
    """The lines of a prompt that say what the resource is; section and subsection only where there are any."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.concat(F.lit("Subject: "), value("subject"), F.lit("\nClass: "), value("class_no"), F.lit("\nChapter: "), value("chapter_title"), F.lit("\n"), optional_line("Section", "section"), optional_line("Subsection", "subsection"), F.lit("Type: "), value("resource_type"), F.lit("\n"))


def extraction_prompt(passage: Column, known: list[str] | None = None) -> Column:
    """Asks for three to eight concepts of a passage as a JSON array; ``known`` terms are listed, sorted, 150 at most."""
    terms = "Terms already known, to be preferred:\n" + "".join(f"- {k}\n" for k in sorted(known)[:KNOWN]) if known else ""
    equation = F.concat(F.lit("Has equation: "), F.when(F.col("has_equation"), "yes").otherwise("no"), F.lit("\n"))
    return F.concat(about(), equation, F.lit(terms), F.lit("Passage:\n"), passage, F.lit("\nName three to eight scientific concepts of the passage as a JSON array of strings, and nothing else."))


def annotation_prompt(candidates: Column) -> Column:
    """Asks which of the candidates a summary treats, as a JSON array."""
    listed = F.array_join(F.transform(candidates, lambda c: F.concat(F.lit("- "), c)), "\n")
    return F.concat(about(), F.lit("Summary:\n"), F.coalesce(strip(F.col("summary")), F.lit("")), F.lit("\nCandidates:\n"), listed, F.lit("\nName the candidates that the summary treats as a JSON array of strings, and nothing else."))


def ask(rows: DataFrame, prompt: str, annotator: Callable[[], Annotator], pause: float = 0.0) -> DataFrame:
    """``rows`` with ``answer`` and ``error``; ``annotator`` is called once per task and makes what answers.

    An answer that fails is an error of its row, with null answer, not of the job.  Rows pass by Arrow batches.  ``pause``
    seconds lie between the answers of one task, for services that ask for it.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", answer string, error string"
    names = [*rows.columns, "answer", "error"]
    at = names.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reply, asked = None, False
        for batch in batches:
            reply = reply or annotator()
            answers, failed = [], []
            for p in batch.column(at).to_pylist():
                if pause and asked:
                    time.sleep(pause)
                asked = True
                try:
                    answers.append(reply(p))
                    failed.append(None)
                except Exception as e:
                    answers.append(None)
                    failed.append(str(e))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string()), pa.array(failed, pa.string())], names=names)

    return rows.mapInArrow(run, schema)


def extract(resources: DataFrame, annotator: Callable[[], Annotator]) -> DataFrame:
    """Concept records of the readable resources: nine columns, and error."""
    asked = ask(readable(resources).withColumn("prompt", extraction_prompt(F.col("content"))), "prompt", annotator)
    return asked.select("resource_id", "document_id", "resource_type", "subject", "class_no", "chapter_no", "chapter_title", "section", concept_list(F.col("answer"), distinct=True).alias("concepts"), "error")


def resource_text() -> Column:
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("chapter_title", "section", "subsection", "summary")]
    return F.concat_ws(" ", *parts)


def candidates(resources: DataFrame, vocabulary: DataFrame, key: str, most: int = CANDIDATES) -> DataFrame:
    """(key, rank, canonical_id, display_name, score): the vocabulary entries most likely to be meant by each resource.

    Score: words of the name among the resource's words, and 5 if the name stands in its text.  Ranked by score, then
    ``vocab_ord``; filled up to ``most`` with structural entries by frequency (score 0).  ``vocabulary`` has canonical_id,
    display_name, frequency, source, vocab_ord; ``key`` is unique.

    A vocabulary of up to LISTED entries is handed to the workers, who rank each text where it lies, so nothing is shuffled;
    a larger one is joined by its words.
    """
    entries = vocabulary.select("canonical_id", "display_name", "source", "frequency", "vocab_ord", F.lower("display_name").alias("n"), T.word_set(F.col("display_name")).alias("v"))
    listed = entries.limit(LISTED + 1).collect()
    if len(listed) <= LISTED:
        return _ranked_in_place(resources, listed, key, most)
    return _ranked_by_joins(resources, vocabulary, key, most)


def _ranked_in_place(resources: DataFrame, listed: list[Row], key: str, most: int) -> DataFrame:
    """``candidates`` in one pass over the texts: names are looked up by their words, and by their first characters at every place of a text."""
    listed = sorted(listed, key=lambda r: (r.vocab_ord, r.canonical_id))
    by_word, by_start = defaultdict(list), defaultdict(list)
    for o, r in enumerate(listed):
        for x in r.v:
            by_word[x].append(o)
        if r.n:
            by_start[r.n[:GRAM]].append((o, r.n))
    by_word, by_start = dict(by_word), dict(by_start)
    widths = sorted({len(g) for g in by_start})
    structural = sorted((o for o, r in enumerate(listed) if r.source == "structural"), key=lambda o: (-(listed[o].frequency or 0), o))[: 2 * most]
    ids, names = [r.canonical_id for r in listed], [r.display_name for r in listed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ids, all_names = pa.array(ids, pa.string()), pa.array(names, pa.string())
        for batch in batches:
            at, ranks, entries, scores = [], [], [], []
            for k, (t, words) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                found: dict[int, int] = {}
                for x in words:
                    for o in by_word.get(x, ()):
                        found[o] = found.get(o, 0) + 1
                stand = set()
                for width in widths:
                    for g in {t[i : i + width] for i in range(len(t) - width + 1)} & by_start.keys():
                        stand.update(o for o, n in by_start[g] if n in t)
                for o in stand:
                    found[o] = found.get(o, 0) + 5
                top = sorted(found.items(), key=lambda e: (-e[1], e[0]))[:most]
                if len(top) < most:
                    top += [(o, 0) for o in structural if o not in found][: most - len(top)]
                at += [k] * len(top)
                ranks += range(1, len(top) + 1)
                entries += [o for o, _ in top]
                scores += [s for _, s in top]
            which = pa.array(entries, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(ranks, pa.int32()), all_ids.take(which), all_names.take(which), pa.array(scores, pa.int64())], names=[key, "rank", "canonical_id", "display_name", "score"])

    texts = resources.select(F.col(key), F.lower(resource_text()).alias("t"), T.word_set(resource_text()).alias("w"))
    return texts.mapInArrow(run, f"`{key}` {texts.schema[key].dataType.simpleString()}, rank int, canonical_id string, display_name string, score bigint")


def _ranked_by_joins(resources: DataFrame, vocabulary: DataFrame, key: str, most: int) -> DataFrame:
    """``candidates`` for a vocabulary of any size.

    Both parts are equi-joins on words, as a name that stands in a text shares its first word unless that word is cut:
    names are therefore also tried where a word of the text contains theirs.
    """
    texts = resources.select(F.col(key).alias("k"), F.lower(resource_text()).alias("t"), T.word_set(resource_text()).alias("w"))
    vocab = vocabulary.select("canonical_id", "display_name", "vocab_ord", F.lower("display_name").alias("n"), T.word_set(F.col("display_name")).alias("v"))
    by_word = texts.select("k", F.explode("w").alias("x")).join(vocab.select("canonical_id", F.explode("v").alias("x")), "x").groupBy("k", "canonical_id").agg(F.count(F.lit(1)).alias("overlap"))
    inside = texts.select("k", "t", F.explode(grams(F.col("t"))).alias("g")).join(vocab.filter(F.length("n") >= GRAM).select("canonical_id", "n", F.substring("n", 1, GRAM).alias("g")), "g").filter(F.col("t").contains(F.col("n"))).select("k", "canonical_id").distinct()
    tiny = vocab.filter((F.length("n") < GRAM) & (F.length("n") > 0)).select("canonical_id", F.col("n").alias("g"))
    short = inside.limit(0)
    for width in sorted(r[0] for r in tiny.select(F.length("g")).distinct().collect()):  # fewer than GRAM lengths
        short = short.unionByName(texts.select("k", F.explode(grams(F.col("t"), width)).alias("g")).join(tiny, "g").select("k", "canonical_id"))
    short = short.distinct()
    verbatim = inside.unionByName(short).withColumn("boost", F.lit(5))
    scored = by_word.join(verbatim, ["k", "canonical_id"], "full").select("k", "canonical_id", (F.coalesce("overlap", F.lit(0)) + F.coalesce("boost", F.lit(0))).alias("score"))
    named = scored.join(vocab.select("canonical_id", "display_name", "vocab_ord"), "canonical_id")
    top = named.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("score"), "vocab_ord"))).filter(F.col("rank") <= most)
    fill = vocabulary.filter("source = 'structural'").orderBy(F.coalesce("frequency", F.lit(0)).desc(), "vocab_ord").limit(2 * most)
    fill = fill.select("canonical_id", "display_name", F.row_number().over(Window.orderBy(F.coalesce("frequency", F.lit(0)).desc(), "vocab_ord")).alias("fr"))
    have = top.groupBy("k").agg(F.count(F.lit(1)).alias("have"), F.collect_set("canonical_id").alias("ids"))
    lacking = texts.select("k").join(have, "k", "left").select("k", F.coalesce("have", F.lit(0)).alias("have"), F.coalesce("ids", F.array().cast("array<string>")).alias("ids")).filter(F.col("have") < most)
    list_ = fill.agg(F.array_sort(F.collect_list(F.struct("fr", "canonical_id", "display_name"))).alias("f"))  # at most 2 * most entries
    padded = lacking.join(F.broadcast(list_)).select("k", "have", F.slice(F.filter("f", lambda e: ~F.array_contains(F.col("ids"), e["canonical_id"])), 1, most).alias("f"))
    padded = padded.select("k", "have", F.posexplode("f").alias("i", "e")).filter(F.col("have") + F.col("i") < most)
    padded = padded.select("k", F.col("e.canonical_id").alias("canonical_id"), F.col("e.display_name").alias("display_name"), F.lit(0).cast("bigint").alias("score"), (F.col("have") + F.col("i") + 1).cast("int").alias("rank"))
    both = top.select("k", "canonical_id", "display_name", F.col("score").cast("bigint").alias("score"), "rank").unionByName(padded)
    return both.select(F.col("k").alias(key), "rank", "canonical_id", "display_name", "score")


GRAM = 6


def grams(c: Column, n: int = GRAM) -> Column:
    """Distinct substrings of ``n`` characters; empty for null and shorter strings."""
    several = F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(F.length(c) >= n, F.array_distinct(several)).otherwise(F.array().cast("array<string>"))


def annotate(resources: DataFrame, vocabulary: DataFrame, key: str, annotator: Callable[[], Annotator], most: int = CANDIDATES) -> DataFrame:
    """(key, concepts, concepts_raw, error) of the unannotated resources: canonical ids and names chosen from the candidates."""
    todo = resources.filter(unannotated())
    shown = candidates(todo, vocabulary, key, most).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "display_name"))), lambda x: x["display_name"]).alias("shown"))
    asked = ask(todo.join(shown, key).withColumn("prompt", annotation_prompt(F.col("shown"))).select(key, "shown", "prompt"), "prompt", annotator)
    names = accepted(F.col("answer"), F.col("shown"))
    return asked.select(key, F.transform(names, T.canonicalize).alias("concepts"), names.alias("concepts_raw"), "error")


def write_back(resources: DataFrame, annotated: DataFrame, key: str) -> DataFrame:
    """A new version of ``resources`` with the concepts of ``annotated`` where there are any."""
    new = annotated.select(key, F.col("concepts").alias("__c"), F.col("concepts_raw").alias("concepts_raw"))
    return resources.join(new, key, "left").withColumn("concepts", F.coalesce("__c", "concepts")).drop("__c")


def stub_annotator() -> Annotator:
    """A deterministic stand-in for a model: names the listed candidates whose words all stand in the passage, else capitalised words."""
    import json
    import re

    def reply(prompt: str) -> str:
        body = prompt.lower().partition("summary:\n")[2].partition("\ncandidates:\n")
        if body[1]:
            names = re.findall(r"^- (.+)$", prompt.partition("\nCandidates:\n")[2], re.M)
            return json.dumps([n for n in names if n.lower() in body[0]])
        passage = prompt.partition("Passage:\n")[2].rpartition("\nName three")[0]
        return json.dumps(list(dict.fromkeys(re.findall(r"\b[a-z]{9,}\b", passage)))[:8])

    return reply
