"""SQL that checks segmentation, cleaning and building, made of the boards' own patterns.

It says what the parsers do with windows over whole documents, as small tables allow; the operators run block-wise.
Back-references, which the checking engine lacks, are spelt out character by character.
"""

from __future__ import annotations

from ..functions import text as T
from ..operators import resources as R
from ..operators.boards import HEADINGS, KNOWN_TITLES, NO_TITLES, NOT_HEADINGS, Board

#: Lines put into the pages of the queries, so that every mark of every board occurs: one in so many lines is replaced.
EVERY = 61
# Lines as they start blocks in the books of each board.
MARK_LINES = {
    "open": ("INTEXT QUESTIONS 2.1", "TERMINAL EXERCISE", "WHAT YOU HAVE LEARNT", "ANSWERS TO INTEXT QUESTIONS", "OBJECTIVES", "Example 3.2 Find the reading", "2.4 Second Unit", "2.4.1 Part of it", "MODULE - 3", "Intext  Questions"),
    "national": ("SUMMARY", "KEY POINTS", "EXERCISES", "QUESTIONS", "IN-TEXT QUESTIONS", "Example 4.1 Work it out", "Activity 2.3 Take it along", "1. State the reason", "3.2 second unit of it", "3.2.1 its part", "Reprint 2025-26", "12  Science", "What You Have Learnt"),
    "state": ("Can you recall?", "Can you tell?", "Think about it", "Use your brain power", "Do you know?", "Internet my friend", "Find out", "Know the scientist", "Do you know that it melts", "www Internet my friend at home", "1.2 A Unit", "1.2.3 Its Part", "Std. XI Physics", "the Kev to a meaninaful text ))", "Fig. 1.4 shows it"),
    "sticky": ("Exercises", "Multiple choice", "Q. 2. Answer in brief", "Project work"),
}
_RUNS = [chr(n) for n in range(32, 127)] + ["\t", "…", "–", "—", "।", "•"]


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(pattern: str, flags: str = "") -> str:
    """A pattern in the engine's dialect; blanks and digits mean the same in all test tables."""
    for f in ("(?dU)", "(?U)", "(?d)"):
        pattern = pattern.replace(f, "")
    return quoted(flags + pattern.replace("(?id)", "(?i)"))


def drop(x: str, pattern: str, by: str = "''", flags: str = "") -> str:
    return f"regexp_replace({x}, {_re(pattern, flags)}, {by}, 'g')"


def strip(x: str) -> str:
    return drop(x, r"^\s+|\s+$")


def spaced(x: str) -> str:
    for c in _RUNS:
        x = f"regexp_replace({x}, {quoted(('[' + chr(92) + c + ']' if not c.isalnum() and c.isascii() and c != chr(9) else c) + '{4,}')}, {quoted(chr(92) * 2 if c == chr(92) else c)}, 'g')"
    return drop(drop(x, r"[ \t]+", "' '"), r"\n{3,}", "chr(10) || chr(10)")


def clean_base(x: str) -> str:
    return strip(drop(spaced(f"coalesce({x}, '')"), r"([A-Za-z]+)-\n([a-z]+)", r"'\1\2' || chr(10)"))


def clean_module(x: str) -> str:
    x = spaced(f"coalesce({x}, '')")
    for p in T.MODULE_HEADERS:
        x = drop(x, p, flags="(?m)")
    return strip(drop(drop(x, r"^\s*\d{1,3}\s*$", flags="(?m)"), r"\n{3,}", "chr(10) || chr(10)"))


def clean_science(x: str) -> str:
    x = spaced(f"coalesce({x}, '')")
    for p in T.SCIENCE_MARKS:
        x = drop(x, p)
    return strip(x)


def preprocess_module(x: str) -> str:
    x = clean_base(x)
    for p in T.MODULE_HEADERS:
        x = drop(x, p, flags="(?m)")
    return clean_base(x)


def preprocess_state(x: str) -> str:
    x = clean_base(x)
    for p in T.STATE_HEADERS:
        x = drop(x, p, flags="(?mi)")
    x = drop(x, r"[^\x00-\x7F°“”‘’–—]", "' '")
    for p, by in T.CORRECTIONS:
        x = drop(x, p, quoted(by))
    return clean_base(x)


CLEAN = {"open": clean_module, "open_class": clean_base, "national": clean_science, "state": clean_base}
PREPROCESS = {"open_class": preprocess_module, "state": preprocess_state}


def marked_text(x: str, row: str, lines: tuple[str, ...]) -> str:
    """Text ``x`` with one line in so many replaced by a mark, by the number of its row and line."""
    case = " ".join(f"WHEN {k} THEN {quoted(line)}" for k, line in enumerate(lines))
    return f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l, i: CASE ({row} * 7 + i - 1) % {EVERY} {case} ELSE l END), chr(10))"


def pages(lines: tuple[str, ...]) -> str:
    return f"pages AS (SELECT source_pdf AS doc_id, page_no, page_id AS page_seq, {marked_text('text', 'page_id', lines)} AS text, coalesce(equations, []) AS equations FROM page_data)"


def lookup(x: str, table: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {quoted(default)} END"


def chapters(subjects: dict[str, str], name: str = "chapters") -> str:
    return rf"""names AS (SELECT DISTINCT doc_id, regexp_replace(doc_id, '\.pdf$', '') AS name FROM pages),
{name} AS (SELECT doc_id, upper(split_part(name, '_', 1)) AS source, {lookup("split_part(name, '_', 2)", subjects, "General")} AS subject,
  coalesce(try_cast(nullif(regexp_extract(name, '_(\d{{1,2}})_', 1), '') AS INT), 12) AS class_no, coalesce(try_cast(nullif(regexp_extract(name, '_ch(\d+)', 1), '') AS INT), 0) AS chapter_no, coalesce(t.title, '') AS chapter_title
  FROM names LEFT JOIN (SELECT file, max(trim(chapter_title)) AS title FROM manifest GROUP BY file) t ON t.file = name || '_resources.json')"""


_DOC = "PARTITION BY doc_id ORDER BY page_no, page_seq, line_no"
_RUN = f"OVER ({_DOC} ROWS UNBOUNDED PRECEDING)"


def _first(pairs: list[tuple[str, str]], x: str = "s") -> str:
    """The value of the first pattern that matches."""
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, {_re(p)}) THEN {v}" for p, v in pairs) + " END" if pairs else "NULL"


def _lines(board: Board) -> str:
    text = PREPROCESS[board.name]("text") if board.name in PREPROCESS else "text"
    title = "array_to_string(list_transform(regexp_split_to_array({t}, '\\s+'), lambda w: upper(w[1]) || lower(substr(w, 2))), ' ')" if board.title_capitals else "{t}"
    title = title.format(t=strip(f"regexp_extract(s, {_re(board.section)}, 2)"))
    plain = [(m.pattern, quoted(str(k))) for k, m in enumerate(board.marks) if m.within is None]
    inner = [(m.pattern, quoted(str(k))) for k, m in enumerate(board.marks) if m.within is not None]
    return f"""ready AS (SELECT doc_id, page_no, page_seq, {text} AS text FROM pages),
split AS (SELECT doc_id, page_no, page_seq, unnest(range(len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM ready),
lines AS (SELECT *, {strip("line")} AS s FROM split WHERE NOT regexp_matches({strip("line")}, '^\\d{{1,3}}$')),
told AS (SELECT *, nullif(regexp_replace(regexp_extract(s, {_re(board.section)}, 1), '\\.$', ''), '') AS no, {title} AS title, {_first(plain)} AS mark, {_first(inner)} AS inside, {_first([(p, quoted(k)) for p, k in board.inline])} AS inline FROM lines)"""


def _kind(board: Board, c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{m.kind}'" for k, m in enumerate(board.marks)) + " END"


def _ids(c: str, ids: list[int]) -> str:
    return f"coalesce({c} IN ({', '.join(quoted(str(k)) for k in ids)}), false)" if ids else "false"


def marked(board: Board) -> str:
    """CTEs up to ``marked``: every line with its chunk number, mode and section."""
    if board.sticky:
        how = f"""how AS (SELECT *, coalesce(sum(CASE WHEN {_kind(board, 'mark')} = '{board.sticky}' THEN 1 ELSE 0 END) OVER ({_DOC} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS was FROM told),
typed AS (SELECT *, CASE WHEN no IS NOT NULL AND NOT was THEN 'section' WHEN mark IS NOT NULL THEN 'mark' WHEN was AND inside IS NOT NULL THEN 'inside' WHEN NOT was AND inline IS NOT NULL THEN 'inline' END AS how FROM how),
kinds AS (SELECT *, CASE how WHEN 'section' THEN '{board.default}' WHEN 'mark' THEN {_kind(board, 'mark')} WHEN 'inside' THEN {_kind(board, 'inside')} WHEN 'inline' THEN inline END AS kind, how IS NULL OR how = 'inline' AS keep FROM typed)"""
    else:
        hard = _ids("mark", [k for k, m in enumerate(board.marks) if m.hard and m.within is None])
        keeps = _ids("mark", [k for k, m in enumerate(board.marks) if m.keep])
        first = f"CASE WHEN no IS NOT NULL THEN 'section' WHEN {hard} THEN {_kind(board, 'mark')} END" if board.section_hard else f"CASE WHEN {hard} AND no IS NULL THEN {_kind(board, 'mark')} END"
        off = f"coalesce(base IN ({', '.join(map(quoted, board.suppress))}), false)"
        within = " OR ".join(f"coalesce(base = '{m.within}' AND inside = '{k}', false)" for k, m in enumerate(board.marks) if m.within) or "false"
        section = "no IS NOT NULL" if board.section_hard else f"no IS NOT NULL AND NOT {off}"
        how = f"""hard AS (SELECT *, {first} AS hard FROM told),
how AS (SELECT *, last_value(hard IGNORE NULLS) {_RUN} AS base FROM hard),
typed AS (SELECT *, CASE WHEN {section} THEN 'section' WHEN hard IS NOT NULL THEN 'hard' WHEN mark IS NOT NULL AND NOT {hard} AND NOT {off} THEN 'soft' WHEN {within} THEN 'inside' END AS how FROM how),
kinds AS (SELECT *, CASE WHEN how = 'section' THEN '{board.default}' WHEN how IN ('hard', 'soft') THEN {_kind(board, 'mark')} WHEN how = 'inside' THEN {_kind(board, 'inside')} END AS kind, how IS NULL OR how = 'inside' OR (how IN ('hard', 'soft') AND {keeps}) AS keep FROM typed)"""
    mode = f"coalesce(last_value(kind IGNORE NULLS) {_RUN}, '{board.default}')"
    mode = f"CASE {mode} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in board.rename.items()) + f" ELSE {mode} END" if board.rename else mode
    part = lambda c, n: f"last_value(CASE WHEN how = 'section' AND length(no) - length(replace(no, '.', '')) = {n} THEN {c} END IGNORE NULLS) {_RUN}"
    two = lambda c: f"(last_value(CASE WHEN how = 'section' THEN CASE WHEN length(no) - length(replace(no, '.', '')) = 2 THEN {{'x': {c}}} ELSE {{'x': NULL::VARCHAR}} END END IGNORE NULLS) {_RUN}).x"
    return f"""{_lines(board)},
{how},
marked AS (SELECT doc_id, page_no, page_seq, line_no, line, keep, kind, sum(CASE WHEN how IS NOT NULL THEN 1 ELSE 0 END) {_RUN} AS chunk, {mode} AS mode, {part('no', 1)} AS section_no, {part('title', 1)} AS section, {two('no')} AS subsection_no, {two('title')} AS subsection FROM kinds)"""


_CHUNK_ID = "format('{0}{1}_ch{2:02d}_s{3}_{4}', "


def chunks(board: Board, name: str = "chunks", least: int = 30) -> str:
    """CTEs up to ``name``, the chunks as the operator gives them; ``pages`` and ``chapters`` come before."""
    at = "(page_no, page_seq, line_no)"
    last = ", ".join(f"arg_max({{'x': {c}}}, {at}).x AS {c}" for c in ("mode", "section_no", "section", "subsection_no", "subsection"))
    raw = f"""{marked(board)},
grouped AS (SELECT doc_id, chunk, coalesce(string_agg(line, chr(10) ORDER BY page_no, page_seq, line_no) FILTER (WHERE keep), '') AS text, arg_min(page_no, {at}) AS page_start, arg_max(page_no, {at}) AS last_page, {last} FROM marked GROUP BY doc_id, chunk),
ended AS (SELECT *, coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY chunk), last_page) AS page_end FROM grouped),
cleaned AS (SELECT * EXCLUDE (text), {CLEAN[board.name]('text')} AS text FROM ended),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk) AS n FROM cleaned WHERE length(trim(text)) >= {least}),
formulas AS (SELECT doc_id, page_no, arg_max(equations, page_seq) AS equations FROM pages WHERE len(equations) > 0 GROUP BY doc_id, page_no)"""
    start = "'sci_' || lpad(class_no::VARCHAR, 2, '0')" if board.name == "national" else "lower(source) || '_' || substr(lower(subject), 1, 3)"
    cid = f"{start} || '_ch' || lpad(chapter_no::VARCHAR, 2, '0') || '_s' || replace(coalesce(section_no, 'intro'), '.', '_') || '_' || n"
    figures = r"list_sort(list_distinct(regexp_extract_all(text, '(?i)(?:Fig\.|Fig\s|Figure)\s*(\d+\.\d+[a-zA-Z]?)', 1)))" if board.figures else "[]::VARCHAR[]"
    return f"""{raw},
{name} AS (SELECT numbered.doc_id, n AS chunk_seq, {cid} AS chunk_id, source, class_no, subject, chapter_no, chapter_title, section, section_no, subsection, subsection_no, mode AS chunk_type, text, coalesce(formulas.equations, []) AS equations, page_start, page_end, {figures} AS figure_references
  FROM numbered JOIN chapters USING (doc_id) LEFT JOIN formulas ON formulas.doc_id = numbered.doc_id AND formulas.page_no = numbered.page_end)"""


def lower_chunks(name: str = "lower_chunks", least: int = 30) -> str:
    """CTEs up to ``name``: chunks of the lower classes, by headings; ``pages``, ``chapters`` and what ``chunks`` defines come before."""
    footer = " OR ".join(f"regexp_matches(s, {_re(p, '(?i)')})" for p in T.FOOTER_LINES)
    shape = " OR ".join(f"regexp_matches(s, {_re(p)})" for p in HEADINGS)
    none = " OR ".join(f"regexp_matches(s, {_re(p, '(?i)')})" for p in NOT_HEADINGS)
    at, w = "(page_no, page_seq, line_no)", f"({_DOC})"
    return f"""l_split AS (SELECT doc_id, page_no, page_seq, unnest(range(len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM pages),
l_lines AS (SELECT * FROM (SELECT *, {strip('line')} AS s FROM l_split) WHERE NOT ({footer})),
l_beside AS (SELECT *, coalesce(lag(s = '') OVER {w}, true) OR coalesce(lead(s = '') OVER {w}, true) AS beside FROM l_lines),
l_heads AS (SELECT *, beside AND length(s) BETWEEN 3 AND 80 AND ({shape}) AND NOT ({none}) AS heading FROM l_beside),
l_marked AS (SELECT *, sum(heading::INT) {_RUN} AS chunk, last_value(CASE WHEN heading THEN s END IGNORE NULLS) {_RUN} AS section FROM l_heads),
l_raw AS (SELECT doc_id, chunk, coalesce(string_agg(line, chr(10) ORDER BY page_no, page_seq, line_no) FILTER (WHERE NOT heading), '') AS text, arg_min(page_no, {at}) AS page_start, arg_max(page_no, {at}) AS last_page, arg_max({{'x': section}}, {at}).x AS section FROM l_marked GROUP BY doc_id, chunk),
l_ended AS (SELECT *, coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY chunk), last_page) AS page_end, length(trim({clean_science('text')})) >= {least} AS long FROM l_raw),
l_done AS (SELECT *, coalesce(sum(long::INT) OVER (PARTITION BY doc_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM l_ended),
l_joined AS (SELECT doc_id, g, arg_max({{'x': section}}, chunk).x AS section, arg_max(page_start, chunk) AS page_start, arg_max(page_end, chunk) AS page_end, {clean_science("string_agg(text, chr(10) ORDER BY chunk)")} AS text FROM l_done GROUP BY doc_id, g),
l_numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS n FROM l_joined WHERE length(trim(text)) >= {least}),
{name} AS (SELECT doc_id, n AS chunk_seq, 'sci_' || lpad(class_no::VARCHAR, 2, '0') || '_ch' || lpad(chapter_no::VARCHAR, 2, '0') || '_' || lower(substr(regexp_replace(coalesce(section, 'intro'), '[^a-zA-Z0-9_]+', '_', 'g'), 1, 30)) || '_' || n AS chunk_id,
  source, class_no, subject, chapter_no, chapter_title, section, NULL::VARCHAR AS section_no, NULL::VARCHAR AS subsection, NULL::VARCHAR AS subsection_no, 'explanation' AS chunk_type, text, []::VARCHAR[] AS equations, page_start, page_end, []::VARCHAR[] AS figure_references FROM l_numbered JOIN chapters USING (doc_id))"""


def merged(source: str, name: str, least: int = 80, most_page: bool = False, distinct: bool = False) -> str:
    """CTE ``name``: chunks shorter than ``least`` appended to the one before."""
    heads = "doc_id, chunk_seq, chunk_id, source, class_no, subject, chapter_no, chapter_title, section, section_no, subsection, subsection_no, chunk_type".split(", ")
    held = ", ".join(f"arg_min({{'x': {c}}}, chunk_seq).x AS {c}" for c in [*heads[1:], "figure_references"])
    own = "arg_min(equations, chunk_seq)"
    equations = f"CASE WHEN count(*) > 1 THEN list_sort(list_distinct(flatten(list(equations)))) ELSE {own} END" if distinct else own
    end = "max(page_end)" if most_page else "arg_max(page_end, chunk_seq)"
    return f"""{name}_g AS (SELECT *, sum((chunk_seq = first OR length(text) >= {least})::INT) OVER (PARTITION BY doc_id ORDER BY chunk_seq ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, min(chunk_seq) OVER (PARTITION BY doc_id) AS first FROM {source})),
{name} AS (SELECT doc_id, {held}, string_agg(text, chr(10) || chr(10) ORDER BY chunk_seq) AS text, {equations} AS equations, arg_min(page_start, chunk_seq) AS page_start, {end} AS page_end FROM {name}_g GROUP BY doc_id, g)"""


def built(source: str, name: str, types: dict[str, str], document_id: str) -> str:
    """CTE ``name``: the valid resources of chunks, all 19 columns with doc_id and chunk_seq."""
    slug = "coalesce(nullif(regexp_replace(regexp_replace(coalesce(nullif(section_no, ''), nullif(section, ''), 'X'), '[^a-zA-Z0-9]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'X')"
    return f"""{name}_t AS (SELECT *, {lookup('chunk_type', types, 'explanation')} AS resource_type, CASE WHEN regexp_matches({slug}, '^[0-9]') THEN 'S' || {slug} ELSE {slug} END AS slug FROM {source}),
{name}_p AS (SELECT *, {lookup('resource_type', R.ID_PREFIX, 'TXT')} AS prefix FROM {name}_t),
{name}_n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, class_no, chapter_no, slug, prefix ORDER BY chunk_seq) AS k FROM {name}_p),
{name} AS (SELECT doc_id, chunk_seq, {document_id} AS document_id, printf('%s_%02d_CH%02d_%s_%03d', prefix, class_no, chapter_no, slug, k) AS resource_id, resource_type, class_no, subject, chapter_no, chapter_title, section, subsection, page_start, page_end, text,
  NULL::VARCHAR AS image_path, NULL::VARCHAR AS image_caption, NULL::VARCHAR AS description, NULL::VARCHAR AS summary, []::VARCHAR[] AS concepts, figure_references, EXISTS (SELECT 1 FROM pages q WHERE q.doc_id = r.doc_id AND len(q.equations) > 0 AND q.page_no BETWEEN r.page_start AND r.page_end) AS has_equation
  FROM {name}_n r WHERE {strip('text')} <> '' AND page_start <= page_end)"""


def titled(inferred: str) -> str:
    """CTE ``chapters`` from ``given``: the title inferred where none is given."""
    return f"""{inferred},
chapters AS (SELECT given.* EXCLUDE (chapter_title), coalesce(nullif(chapter_title, ''), t.title, '') AS chapter_title FROM given LEFT JOIN inferred t USING (doc_id))"""


def title_case(x: str) -> str:
    return rf"array_to_string(list_transform(string_split({x}, ''), lambda c, i: CASE WHEN i = 1 OR NOT regexp_matches(substr({x}, i - 1, 1), '\p{{L}}') THEN upper(c) ELSE lower(c) END), '')"


def inferred_caps() -> str:
    """CTEs up to ``inferred``: the first line of the first page that is set in capitals."""
    return rf"""t_first AS (SELECT doc_id, arg_min({{'t': text}}, (page_no, page_seq)).t AS text FROM pages GROUP BY doc_id),
t_lines AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {strip('x')}), lambda x: regexp_matches(x, '^[A-Z][A-Z0-9\s,\(\)\-\/]{{8,80}}$') AND NOT regexp_matches(x, '^MODULE\s*-')) AS l FROM t_first),
inferred AS (SELECT doc_id, {title_case("coalesce(l[1], '')")} AS title FROM t_lines)"""


def inferred_general(name: str = "inferred") -> str:
    """CTEs up to ``name``: capitals, else a numbered title, else the line after a number, else the first line."""
    return rf"""t_first AS (SELECT doc_id, arg_min({{'t': text}}, (page_no, page_seq)).t AS text FROM pages GROUP BY doc_id),
t_lines AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i, l FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM t_first)),
t_told AS (SELECT *, regexp_matches(x, '^[A-Z][A-Z0-9\s,\(\)\-\/]{{8,80}}$') AND NOT regexp_matches(x, '^MODULE\s*-') AS caps, {strip("regexp_extract(x, '^[0-9][0-9]?[.]" + chr(92) + "s+(.+)$', 1)")} AS dotted, l[i + 2] AS after FROM t_lines),
t_hit AS (SELECT doc_id, arg_min(CASE WHEN caps THEN x WHEN length(dotted) BETWEEN 4 AND 80 AND NOT contains(lower(dotted), 'introduction') THEN dotted ELSE after END, i) AS t FROM t_told
  WHERE caps OR (length(dotted) BETWEEN 4 AND 80 AND NOT contains(lower(dotted), 'introduction')) OR (regexp_matches(x, '^\d{{1,2}}\.$') AND length(after) BETWEEN 4 AND 80 AND NOT contains(lower(after), 'introduction')) GROUP BY doc_id),
t_top AS (SELECT doc_id, CASE WHEN regexp_matches(l[1], '^\d{{1,2}}\.?$') AND len(l) > 1 THEN l[2] ELSE l[1] END AS t FROM t_lines WHERE i = 0),
t_named AS (SELECT f.doc_id, coalesce(h.t, CASE WHEN length(p.t) BETWEEN 4 AND 100 AND NOT contains(lower(p.t), 'introduction') THEN p.t END) AS t FROM t_first f LEFT JOIN t_hit h USING (doc_id) LEFT JOIN t_top p USING (doc_id)),
{name} AS (SELECT doc_id, coalesce({title_case('t')}, '') AS title FROM t_named)"""


def inferred_state() -> str:
    """CTEs up to ``inferred``: known titles first; none where only the heading of a box was found. ``given`` comes before."""
    known = " ".join(f"WHEN subject = {quoted(s)} AND class_no = {c} AND chapter_no = {n} THEN {quoted(t)}" for (s, c, n), t in KNOWN_TITLES.items())
    return f"""{inferred_general('found')},
inferred AS (SELECT f.doc_id, CASE {known} WHEN lower(title) IN ({', '.join(map(quoted, NO_TITLES))}) THEN '' ELSE title END AS title FROM found f JOIN given USING (doc_id))"""


def images() -> str:
    return r"""files AS (SELECT document_id, chapter_no, min(file) AS file FROM manifest GROUP BY document_id, chapter_no),
images AS (SELECT row_number() OVER () AS k, regexp_replace(f.file, '_resources\.json$', '.pdf') AS doc_id, image_id, page_no, image_path, caption FROM image_meta JOIN files f USING (document_id, chapter_no))"""


def multimodal(source: str, name: str, document_id: str) -> str:
    """CTE ``name``: resources (part 0) and the diagrams of ``images`` (part 1) with the context of the first resource on their page, else of their document."""
    number = "regexp_replace(coalesce(i.image_id, '000'), '[^0-9]', '', 'g')"
    pad = lambda x, n: f"CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END"
    ctx = "{'class_no': class_no, 'subject': subject, 'chapter_no': chapter_no, 'chapter_title': chapter_title, 'section': section, 'subsection': subsection, 'd': 1}"
    return f"""m_page AS (SELECT i.k, arg_min({ctx.replace("'class_no': class_no", "'class_no': r.class_no")}, r.chunk_seq) AS c FROM images i JOIN {source} r ON r.doc_id = i.doc_id AND i.page_no BETWEEN r.page_start AND r.page_end GROUP BY i.k),
m_doc AS (SELECT doc_id, arg_min({ctx}, chunk_seq) AS c FROM {source} GROUP BY doc_id),
m_images AS (SELECT i.*, coalesce(p.c, d.c) AS c FROM images i LEFT JOIN m_page p USING (k) LEFT JOIN m_doc d ON d.doc_id = i.doc_id),
{name} AS (SELECT 0 AS part, * FROM {source} UNION ALL BY NAME SELECT 1 AS part, i.doc_id, {document_id} AS document_id, 'IMG_' || {pad('coalesce(i.c.class_no, 12)::VARCHAR', 2)} || '_CH' || {pad('coalesce(i.c.chapter_no, 0)::VARCHAR', 2)} || '_' || {pad(number, 3)} AS resource_id, 'diagram' AS resource_type,
  coalesce(i.c.class_no, 12) AS class_no, i.c.subject AS subject, coalesce(i.c.chapter_no, 0) AS chapter_no, coalesce(i.c.chapter_title, '') AS chapter_title, i.c.section AS section, i.c.subsection AS subsection, i.page_no AS page_start, i.page_no AS page_end, i.image_path, i.caption AS image_caption, []::VARCHAR[] AS concepts, []::VARCHAR[] AS figure_references, false AS has_equation
  FROM m_images i LEFT JOIN chapters h ON h.doc_id = i.doc_id)"""
