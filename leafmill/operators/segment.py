"""Cutting documents into typed chunks.

The parsers' mutable mode has a closed form: a soft mark counts unless the last hard mark is a suppressing one, so the
mode is a running last value and the chunk number a running sum.  Both run inside blocks of pages; what a block hands on is one
row; and all that belongs to a chunk from its start on is run over its parts, of which there are as many as chunks and blocks, not over lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.lineage import cut
from ..plans.scan import running, spread
from ..plans.skew import strip
from .boards import HEADINGS, LOWER, NOT_HEADINGS, Board
from .lines import blank_context, pages_to_lines, pages_with_equations

ORDER = ["page_no", "page_seq", "line_no"]
SHORT, MERGE = 30, 80


def _either(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def _started(lines: DataFrame, board: Board, inline: bool) -> DataFrame:
    """``lines`` with starts, kind, keep and, where a section starts, one and two (section and subsection); part: starts so far in the block."""
    s = strip(F.col("text"))
    number, title = F.regexp_extract(s, board.section, 1), F.regexp_extract(s, board.section, 2)
    base = lines.withColumn("__s", s).withColumn("__no", F.nullif(F.regexp_replace(number, r"\.$", ""), F.lit(""))).withColumn("__title", T.per_word_capitals(title) if board.title_capitals else strip(title))
    first = lambda marks: reduce(lambda rest, m: F.when(F.col("__s").rlike(m[0]), m[1]).otherwise(rest), reversed(marks), F.lit(None))
    plain = first([(m.pattern, F.lit(k)) for k, m in enumerate(board.marks) if m.within is None]).cast("int")
    inner = first([(m.pattern, F.lit(k)) for k, m in enumerate(board.marks) if m.within is not None]).cast("int")
    trigger = first([(p, F.lit(k)) for p, k in board.inline] if inline else []).cast("string")
    # Lines are classified once and written: what blocks hand on is read from there as well.
    base = cut(base.withColumn("__mark", plain).withColumn("__inside", inner).withColumn("__inline", trigger).drop("__s"), "lines")
    kinds, section = F.array(*(F.lit(m.kind) for m in board.marks)), F.col("__no").isNotNull()
    kind = F.get(kinds, F.col("__mark"))
    w = Window.partitionBy("doc_id", "block").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = base.groupBy("doc_id", "block")
    if board.sticky:
        stuck = F.coalesce(kind == board.sticky, F.lit(False)).cast("int")
        carry = blocks.agg(F.sum(stuck).alias("__b")).select("doc_id", "block", F.coalesce(F.sum("__b").over(before), F.lit(0)).alias("__b"))
        was = F.col("__b") + F.sum(stuck).over(w) - stuck > 0
        how = F.when(section & ~F.col("__was"), "section").when(F.col("__mark").isNotNull(), "mark").when(F.col("__was") & F.col("__inside").isNotNull(), "inside").when(~F.col("__was") & F.col("__inline").isNotNull(), "inline")
        typed = base.join(carry, ["doc_id", "block"]).withColumn("__was", was).withColumn("__how", how)
        keep = F.col("__how").isNull() | (F.col("__how") == "inline")
    else:
        # A section outranks marks wherever it counts; a hard section always does, a soft one unless it is suppressed.
        is_hard = F.coalesce(F.col("__mark").isin([k for k, m in enumerate(board.marks) if m.hard and m.within is None]), F.lit(False))
        hard = F.when(section, F.lit("section")).when(is_hard, kind) if board.section_hard else F.when(is_hard & ~section, kind)
        last = F.max(F.when(hard.isNotNull(), F.struct(*ORDER, hard.alias("v")))).getField("v")
        carry = blocks.agg(last.alias("__b")).select("doc_id", "block", F.last("__b", ignorenulls=True).over(before).alias("__b"))
        off = F.coalesce(F.col("__base").isin(list(board.suppress)), F.lit(False))
        within = _either([(F.col("__base") == m.within) & (F.col("__inside") == k) for k, m in enumerate(board.marks) if m.within])
        how = F.when(section if board.section_hard else section & ~off, "section").when(hard.isNotNull(), "hard").when(F.col("__mark").isNotNull() & ~is_hard & ~off, "soft").when(F.coalesce(within, F.lit(False)), "inside")
        typed = base.join(carry, ["doc_id", "block"]).withColumn("__base", F.coalesce(F.last(hard, ignorenulls=True).over(w), "__b")).withColumn("__how", how)
        keep = F.col("__how").isNull() | (F.col("__how") == "inside") | (F.col("__how").isin("hard", "soft") & F.coalesce(F.col("__mark").isin([k for k, m in enumerate(board.marks) if m.keep]), F.lit(False)))
    how = F.col("__how")
    started = F.when(how == "section", board.default).when(how == "inside", F.get(kinds, F.col("__inside"))).when(how == "inline", F.col("__inline")).when(how.isNotNull(), kind)
    named = F.struct(F.col("__no").alias("no"), F.col("__title").alias("title"))
    unnamed = F.struct(F.lit(None).cast("string").alias("no"), F.lit(None).cast("string").alias("title"))
    one = F.when((how == "section") & (T.dots(F.col("__no")) == 1), named)
    two = F.when(how == "section", F.when(T.dots(F.col("__no")) == 2, named).otherwise(unnamed))
    flagged = typed.select(*lines.columns, how.isNotNull().alias("starts"), started.alias("kind"), keep.alias("keep"), one.alias("one"), two.alias("two"))
    return flagged.withColumn("part", F.sum(F.col("starts").cast("int")).over(w))


def _numbered(parts: DataFrame, board: Board) -> DataFrame:
    """``parts`` (doc_id, block, part, kind, one, two), read twice, with chunk, mode and sections; part 0 of a block goes on with the chunk before."""
    spans = parts.withColumn("__span", F.floor(F.col("block") / 64))
    out = running(spans, "doc_id", "__span", ["block", "part"], sums={"chunk": (F.col("part") > 0).cast("int")}, lasts={"__m": F.col("kind"), "__o": F.col("one"), "__t": F.col("two")})
    mode = F.coalesce("__m", F.lit(board.default))
    for a, b in board.rename.items():
        mode = F.when(mode == a, b).otherwise(mode)
    return out.drop("__span").withColumn("mode", mode).withColumn("section_no", F.col("__o.no")).withColumn("section", F.col("__o.title")).withColumn("subsection_no", F.col("__t.no")).withColumn("subsection", F.col("__t.title")).drop("__m", "__o", "__t")


_KEYS = ["doc_id", "block", "part"]
_SECTIONS = ["mode", "section_no", "section", "subsection_no", "subsection"]


def _start(c: str) -> Column:
    """A value of the line that starts a part."""
    return F.max(F.when(F.col("starts"), F.col(c))).alias(c)


def mark_lines(lines: DataFrame, board: Board, inline: bool = True) -> DataFrame:
    """``lines`` with chunk (number), mode, starts, keep, section_no, section, subsection_no, subsection.

    Line for line what the boards' parsers do; inline triggers of the state board are matched at the start of their own line, which
    keeps the trigger line's text (the reference's buffer search loses it).
    """
    marked = cut(_started(lines, board, inline), "marked")
    parts = cut(marked.groupBy(*_KEYS).agg(_start("kind"), _start("one"), _start("two")), "parts")
    told = _numbered(parts, board).select(*_KEYS, "chunk", *_SECTIONS)
    return marked.join(told, _KEYS).select(*lines.columns, "chunk", "mode", "starts", "keep", *_SECTIONS[1:])


def raw_chunks(lines: DataFrame, board: Board, inline: bool = True) -> DataFrame:
    """One row per chunk number: text cleaned, page_start, page_end, mode, section columns; empty text where no line is kept.

    ``page_end`` is the page of the line that starts the next chunk, as the parsers flush only then; the last chunk
    ends on the last line's page.  Lines are brought together by blocks of pages once; their parts of chunks make up the chunks.
    """
    at = F.struct(*ORDER)
    held = F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct(*ORDER, "text"))))
    parts = _started(lines, board, inline).groupBy(*_KEYS).agg(held.alias("l"), F.min_by("page_no", at).alias("page_start"), F.max_by("page_no", at).alias("last_page"), _start("kind"), _start("one"), _start("two"))
    text = F.when(F.size("l") > 0, F.array_join(F.transform("l", lambda x: x["text"]), "\n"))
    return _joined(_numbered(cut(parts.withColumn("text", text).drop("l"), "parts"), board), board.clean)


def _joined(parts: DataFrame, clean) -> DataFrame:
    """Chunks of numbered parts (doc_id, block, part, chunk, text, page_start, last_page, sections)."""
    place = F.struct("block", "part")
    # The page on which a chunk starts ends the chunk before.
    ends = F.when(F.col("part") > 0, F.array(F.col("chunk"), F.col("chunk") - 1)).otherwise(F.array(F.col("chunk")))
    told = parts.select("*", F.explode(ends).alias("__c"))
    own = F.col("__c") == F.col("chunk")
    mine = lambda c: F.when(own, F.col(c))
    out = told.groupBy("doc_id", F.col("__c").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(own & F.col("text").isNotNull(), F.struct("block", "part", "text")))), lambda x: x["text"]), "\n").alias("text"),
        F.min_by(mine("page_start"), F.when(own, place)).alias("page_start"),
        F.max_by(mine("last_page"), F.when(own, place)).alias("last_page"),
        F.max(F.when(~own, F.col("page_start"))).alias("next_page"),
        *(F.max(mine(c)).alias(c) for c in _SECTIONS),
    )
    # Chunk 0 is what stands before the first start; there may be nothing.
    return out.filter("page_start is not null").select("doc_id", "chunk", "page_start", F.coalesce("next_page", "last_page").alias("page_end"), *_SECTIONS, clean(F.col("text")).alias("text"))


def segment(pages: DataFrame, board: Board, chapters: DataFrame, least: int = SHORT) -> DataFrame:
    """Chunks of every document: chunk_id, metadata, text, equations, page range, figure references.

    ``pages`` has doc_id, page_no, page_seq, text, equations; ``chapters`` one row per doc_id with source, subject, class_no, chapter_no,
    chapter_title.  Chunks whose cleaned text is under ``least`` characters are dropped before they are numbered.
    Documents without a row in ``chapters`` give no chunks.
    """
    return _segment(spread(pages), board, chapters, least)


def _segment(pages: DataFrame, board: Board, chapters: DataFrame, least: int = SHORT) -> DataFrame:
    ready = pages.withColumn("text", board.preprocess(F.col("text"))) if board.preprocess else pages
    # Filtered after the cut: pushed below it, the condition would clean every text a second time.
    kept = cut(raw_chunks(pages_to_lines(ready, drop_page_numbers=True), board), "chunks").filter(F.length(F.trim("text")) >= least)
    numbered = running(kept.withColumn("block", F.floor(F.col("chunk") / 1024).cast("int")), "doc_id", "block", ["chunk"], sums={"n": F.lit(1)})
    equations = pages_with_equations(pages).select("doc_id", F.col("page_no").alias("page_end"), "equations")
    out = numbered.join(equations, ["doc_id", "page_end"], "left").join(chapters, "doc_id")
    part = F.regexp_replace(F.coalesce("section_no", F.lit("intro")), r"\.", "_")
    if board.name == "national":
        cid = F.format_string("sci_%02d_ch%02d_s%s_%d", F.coalesce("class_no", F.lit(0)), F.coalesce("chapter_no", F.lit(0)), part, F.col("n"))
    else:
        cid = F.format_string("%s_%s_ch%02d_s%s_%d", F.lower("source"), F.substring(F.lower("subject"), 1, 3), F.coalesce("chapter_no", F.lit(0)), part, F.col("n"))
    figures = T.figure_references(F.col("text")) if board.figures else F.array().cast("array<string>")
    return out.select(
        "doc_id", F.col("n").alias("chunk_seq"), cid.alias("chunk_id"), "source", "class_no", "subject", "chapter_no", "chapter_title", "section", "section_no", "subsection", "subsection_no",
        F.col("mode").alias("chunk_type"), "text", F.coalesce("equations", F.array().cast("array<string>")).alias("equations"), "page_start", "page_end", figures.alias("figure_references"),
    )


def merge_short(chunks: DataFrame, least: int = MERGE, page_end: str = "last", distinct_equations: bool = False) -> DataFrame:
    """Chunks under ``least`` characters appended to the chunk before; the first of a document is never appended.

    Columns of the head stay; text is joined by a blank line; ``page_end`` is the last part's or, with 'max', the greatest.
    With ``distinct_equations`` a merged chunk has the sorted distinct equations of its parts, else the head's.  Only
    the chunk's own length counts, whatever its type.
    """
    chunks = cut(chunks, "chunks")
    head = (F.col("chunk_seq") == F.col("__first")) | (F.length("text") >= least)
    firsts = chunks.groupBy("doc_id").agg(F.min("chunk_seq").alias("__first"))
    blocked = chunks.join(firsts, "doc_id").withColumn("block", F.floor(F.col("chunk_seq") / 1024).cast("int"))
    grouped = running(blocked, "doc_id", "block", ["chunk_seq"], sums={"__g": head.cast("int")})
    end = F.max("page_end") if page_end == "max" else F.max_by("page_end", "chunk_seq")
    others = [c for c in chunks.columns if c not in ("doc_id", "text", "page_end", "equations")]
    parts = F.array_sort(F.collect_list(F.struct("chunk_seq", "text", "equations")))
    out = grouped.groupBy("doc_id", "__g").agg(*(F.min_by(c, "chunk_seq").alias(c) for c in others), end.alias("page_end"), parts.alias("__p"))
    every = F.array_sort(F.array_distinct(F.flatten(F.transform("__p", lambda p: p["equations"]))))
    equations = F.when(F.size("__p") > 1, every).otherwise(F.get("__p", F.lit(0))["equations"]) if distinct_equations else F.get("__p", F.lit(0))["equations"]
    return out.withColumn("text", F.array_join(F.transform("__p", lambda p: p["text"]), "\n\n")).withColumn("equations", equations).select(*chunks.columns)


def headings_lower(lines: DataFrame) -> DataFrame:
    """``lines`` of the lower classes, footers dropped, with ``heading``: set like a heading and with a blank line beside it."""
    kept = blank_context(lines.filter(~T.is_footer(F.col("text"))))
    s = strip(F.col("text"))
    shape = _either([s.rlike(p) for p in HEADINGS]) & ~_either([s.rlike("(?i)" + p) for p in NOT_HEADINGS])
    return kept.withColumn("heading", F.length(s).between(3, 80) & (F.col("prev_blank") | F.col("next_blank")) & shape)


def segment_headings(pages: DataFrame, chapters: DataFrame, least: int = SHORT) -> DataFrame:
    """Chunks of the lower classes: a heading starts a chunk of explanation; short text is carried into the next one."""
    return _segment_headings(spread(pages), chapters, least)


def _segment_headings(pages: DataFrame, chapters: DataFrame, least: int = SHORT) -> DataFrame:
    title = F.when(F.col("heading"), F.struct(F.lit(None).cast("string").alias("no"), strip(F.col("text")).alias("title")))
    null = F.lit(None).cast("string")
    w = Window.partitionBy("doc_id", "block").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    marked = headings_lower(pages_to_lines(pages)).select("doc_id", "block", *ORDER, "text", F.col("heading").alias("starts"), title.alias("one"), F.sum(F.col("heading").cast("int")).over(w).alias("part"))
    at = F.struct(*ORDER)
    held = F.array_sort(F.collect_list(F.when(~F.col("starts"), F.struct(*ORDER, "text"))))
    parts = marked.groupBy(*_KEYS).agg(held.alias("l"), F.min_by("page_no", at).alias("page_start"), F.max_by("page_no", at).alias("last_page"), _start("one"))
    text = F.when(F.size("l") > 0, F.array_join(F.transform("l", lambda x: x["text"]), "\n"))
    parts = cut(parts.select(*_KEYS, "page_start", "last_page", null.alias("kind"), "one", F.lit(None).cast("struct<no: string, title: string>").alias("two"), text.alias("text")), "parts")
    raw = cut(_joined(_numbered(parts, LOWER), lambda c: c), "chunks")
    # A chunk too short for itself is carried on: chunks are grouped from the first after the last long enough one.
    sized = raw.withColumn("__long", F.length(F.trim(T.clean_science(F.col("text")))) >= least).withColumn("block", F.floor(F.col("chunk") / 1024).cast("int"))
    grouped = running(sized, "doc_id", "block", ["chunk"], sums={"__done": F.col("__long").cast("int")}).withColumn("__g", F.col("__done") - F.col("__long").cast("int"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "text")))
    joined = grouped.groupBy("doc_id", "__g").agg(F.max_by("section", "chunk").alias("section"), F.max_by("page_start", "chunk").alias("page_start"), F.max_by("page_end", "chunk").alias("page_end"), parts.alias("p"))
    texts = cut(joined.withColumn("text", T.clean_science(F.array_join(F.transform("p", lambda x: x["text"]), "\n"))), "chunks").filter(F.length(F.trim("text")) >= least)
    numbered = running(texts.withColumn("block", F.floor(F.col("__g") / 1024).cast("int")), "doc_id", "block", ["__g"], sums={"n": F.lit(1)}).join(chapters, "doc_id")
    cid = F.format_string("sci_%02d_ch%02d_%s_%d", F.coalesce("class_no", F.lit(0)), F.coalesce("chapter_no", F.lit(0)), T.word_slug(F.coalesce("section", F.lit("intro"))), F.col("n"))
    none = F.array().cast("array<string>")
    return numbered.select(
        "doc_id", F.col("n").alias("chunk_seq"), cid.alias("chunk_id"), "source", "class_no", "subject", "chapter_no", "chapter_title", "section", null.alias("section_no"), null.alias("subsection"), null.alias("subsection_no"),
        F.lit("explanation").alias("chunk_type"), "text", none.alias("equations"), "page_start", "page_end", none.alias("figure_references"),
    )


def parse_national(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """Chunks by class: 10 to 12 by numbered sections, 8 and 9 by headings, merged; any other class is an error when run."""
    classed = spread(pages).join(chapters.select("doc_id", F.col("class_no").alias("__c")), "doc_id")
    bad = F.when(F.col("__c").isin(8, 9, 10, 11, 12), F.col("__c")).otherwise(F.raise_error(F.concat(F.lit("unsupported class: "), F.coalesce(F.col("__c").cast("string"), F.lit("null")))).cast("int"))
    checked = classed.withColumn("__c", bad)
    from .boards import NATIONAL

    upper = _segment(checked.filter(F.col("__c") >= 10).drop("__c"), NATIONAL, chapters)
    lower = _segment_headings(checked.filter(F.col("__c") < 10).drop("__c"), chapters)
    return merge_short(upper.unionByName(lower))


def infer_title(pages: DataFrame) -> DataFrame:
    """(doc_id, title): the first line of the first page set in capitals, title-cased; empty if there is none."""
    from ..functions.python import title_case

    first = pages.groupBy("doc_id").agg(F.min_by("text", F.struct("page_no", "page_seq")).alias("text"))
    caps = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), strip), lambda x: x.rlike(r"(?U)^[A-Z][A-Z0-9\s,\(\)\-\/]{8,80}$") & ~x.rlike(r"^MODULE\s*-"))
    return first.select("doc_id", title_case(F.coalesce(F.get(caps, F.lit(0)), F.lit(""))).alias("title"))


def infer_title_general(pages: DataFrame, given: Column | None = None) -> DataFrame:
    """(doc_id, title): capitals, else 'N. Title', else the line after 'N.', else the first line; never an introduction.

    ``given`` is the title where nothing is found.
    """
    from ..functions.python import title_case

    first = pages.groupBy("doc_id").agg(F.min_by("text", F.struct("page_no", "page_seq")).alias("text"))
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), strip), lambda x: x != "")
    based = first.withColumn("l", lines)
    plain = lambda x: ~F.lower(x).contains("introduction")

    def found(x: Column, i: Column) -> Column:
        after = F.get(F.col("l"), i + 1)
        dotted = strip(F.regexp_extract(x, r"(?dU)^\d{1,2}\.\s+(.{4,80})$", 1))
        caps = x.rlike(r"(?U)^[A-Z][A-Z0-9\s,\(\)\-\/]{8,80}$") & ~x.rlike(r"^MODULE\s*-")
        return F.when(caps, x).when((dotted != "") & plain(dotted), dotted).when(x.rlike(r"^\d{1,2}\.$") & F.length(after).between(4, 80) & plain(after), after)

    hits = F.filter(F.transform("l", found), lambda x: x.isNotNull())
    naked = F.when(F.get("l", F.lit(0)).rlike(r"^\d{1,2}\.?$") & (F.size("l") > 1), F.get("l", F.lit(1))).otherwise(F.get("l", F.lit(0)))
    fallback = F.when(F.length(naked).between(4, 100) & plain(naked), naked)
    title = title_case(F.coalesce(F.get(hits, F.lit(0)), fallback))
    return based.select("doc_id", F.coalesce(title, given if given is not None else F.lit("")).alias("title"))


def infer_title_state(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """(doc_id, title) for the state board: known titles first; titles that are only headings of boxes give the empty string."""
    from .boards import KNOWN_TITLES, NO_TITLES

    known = F.create_map(*(x for k, v in KNOWN_TITLES.items() for x in (F.lit("|".join(map(str, k))), F.lit(v))))
    key = F.concat_ws("|", "subject", F.coalesce(F.col("class_no"), F.lit(11)).cast("string"), F.col("chapter_no").cast("string"))
    out = infer_title_general(pages).join(chapters.select("doc_id", "subject", "class_no", "chapter_no"), "doc_id")
    found = F.when(F.lower("title").isin(list(NO_TITLES)), F.lit("")).otherwise(F.col("title"))
    return out.select("doc_id", F.coalesce(known[key], found).alias("title"))
