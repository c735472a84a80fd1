"""Segmentation against independent folds, and the cases every segmenter needs."""

import random
import re

import pytest

from leafmill.functions import text as T
from leafmill.operators import lines as L
from leafmill.operators import segment as S
from leafmill.operators.boards import BOARDS, NATIONAL, OPEN, STATE

PAGES = "doc_id string, page_no int, page_seq bigint, text string, equations array<string>"
CHAPTERS = "doc_id string, source string, subject string, class_no int, chapter_no int, chapter_title string"
BODY = "this body line is long enough to be kept as a chunk of its own"


def frame(spark, docs):
    rows = [(d, p, p, "\n".join(lines), [f"e{p}"] if p % 2 else []) for d, pages in docs.items() for p, lines in pages]
    return spark.createDataFrame(rows, PAGES)


def chapters(spark, docs, class_no=12):
    return spark.createDataFrame([(d, "NIOS", "Physics", class_no, 1, "T") for d in docs], CHAPTERS)


OPEN_LINES = {"1.1 Physical World": "section", "1.1.1 Sub Part": "section", "INTEXT QUESTIONS 1.1": "intext_question", "TERMINAL EXERCISE": "terminal_exercise", "WHAT YOU HAVE LEARNT": "summary", "ANSWERS TO INTEXT QUESTIONS": "answers", "OBJECTIVES": "objectives", "Example 1.2": "example", BODY: None, "": None, "short": None}


def fold_open(pages):
    """The parser's loop with a mutable mode, written anew: [(mode, section_no, subsection_no, lines, start, end)]."""
    out, mode, sec, sub, held, start, end = [], "content", None, None, [], pages[0][0], pages[0][0]

    def flush():
        if len("\n".join(held).strip()) >= 30:
            out.append((mode, sec, sub, "\n".join(held), start, end))
        held.clear()

    for no, lines in pages:
        for s in lines:
            end = no
            kind = OPEN_LINES[s]
            if kind == "example" and mode in ("terminal_exercise", "answers"):
                kind = None
            if kind is None:
                held.append(s)
                continue
            flush()
            start = no
            if kind == "section":
                mode, n = "content", s.split()[0]
                if n.count(".") == 1:
                    sec, sub = n, None
                else:
                    sub = n
            else:
                mode = kind
                if kind in ("answers", "example"):
                    held.append(s)
    flush()
    return out


def test_open_board_against_the_fold(spark):
    rng = random.Random(1)
    docs = {f"d{k}": [(p, [rng.choice(list(OPEN_LINES)) for _ in range(rng.randint(1, 8))]) for p in range(1, rng.randint(2, 80))] for k in range(12)}
    got = {}
    for r in S.segment(frame(spark, docs), OPEN, chapters(spark, docs)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for d, pages in docs.items():
        rows = sorted(got.get(d, []), key=lambda r: r.chunk_seq)
        want = fold_open(pages)
        assert [(r.chunk_type, r.section_no, r.subsection_no, r.page_start, r.page_end) for r in rows] == [(m, a, b, s, e) for m, a, b, _, s, e in want]
        assert [r.equations for r in rows] == [[f"e{e}"] if e % 2 else [] for *_, e in want]
        assert [r.chunk_id for r in rows] == [f"nios_phy_ch01_s{(a or 'intro').replace('.', '_')}_{n}" for n, (_, a, *_) in enumerate(want, 1)]


NATIONAL_LINES = {"1.1 physical WORLD": "section", "SUMMARY": "summary", "EXERCISES": "exercise", "QUESTIONS": "intext_question", "see Example 1.2 here": "example", "Activity 3.1": "activity", "1. A body moves": "question", BODY: None, "": None}


def test_national_board_against_the_fold(spark):
    rng = random.Random(2)
    docs = {f"d{k}": [(p, [rng.choice(list(NATIONAL_LINES)) for _ in range(rng.randint(1, 8))]) for p in range(1, 40)] for k in range(8)}
    rows = {}
    for r in S.mark_lines(L.pages_to_lines(frame(spark, docs)), NATIONAL).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for d, pages in docs.items():
        mode, chunk, want = "explanation", 0, []
        for _, lines in pages:
            for s in lines:
                kind = NATIONAL_LINES[s]
                if mode == "exercise" and kind in ("section", "example", "activity"):
                    kind = "question" if re.match(r"\s*\d+\.\d+\b", s) else None
                if kind == "question":
                    kind = "exercise" if mode == "exercise" else None
                if kind:
                    chunk, mode = chunk + 1, "explanation" if kind == "section" else kind
                want.append((chunk, mode))
        got = sorted(rows[d], key=lambda r: (r.page_no, r.page_seq, r.line_no))
        assert [(r.chunk, r.mode) for r in got] == want


def test_state_board(spark):
    lines = ["1.1 Living World", BODY, "Can you recall?", BODY, "Do you know? " + BODY, BODY, "Know the scientist", BODY, "Exercises", BODY, "1.2 Not A Section", BODY, "Multiple choice questions", BODY, "Answer the following", BODY, "Project", BODY, "Find out", BODY]
    docs = {"d": [(1, lines)]}
    out = sorted(S.segment(frame(spark, docs), STATE, chapters(spark, docs)).collect(), key=lambda r: r.chunk_seq)
    assert [r.chunk_type for r in out] == ["explanation", "recall", "callout", "scientist_box", "exercise", "mcq", "exercise", "project", "activity"]
    assert out[2].text.startswith("Do you know?") and "1.2 Not A Section" in out[4].text
    assert {r.section_no for r in out} == {"1.1"}


def test_page_quirks(spark):
    docs = {"d": [(1, ["12", BODY]), (3, ["1.1 Next", "tiny"]), (4, ["1.2 Third", BODY])]}
    out = sorted(S.segment(frame(spark, docs), OPEN, chapters(spark, docs)).collect(), key=lambda r: r.chunk_seq)
    assert [(r.page_start, r.page_end, r.chunk_seq) for r in out] == [(1, 3, 1), (4, 4, 2)]
    assert out[0].equations == ["e3"] and "12" not in out[0].text.split("\n")


def test_merge_short(spark):
    rows = [("d", k, t, k, [f"e{k}", "e"]) for k, t in enumerate(["a" * 10, "b" * 90, "c" * 79, "d" * 5, "e" * 80, "f"], 1)] + [("x", 7, "solo", 9, None)]
    df = spark.createDataFrame(rows, "doc_id string, chunk_seq bigint, text string, page_end int, equations array<string>")
    out = {(r.doc_id, r.chunk_seq): r for r in S.merge_short(df, distinct_equations=True).collect()}
    assert set(out) == {("d", 1), ("d", 2), ("d", 5), ("x", 7)}
    assert out["d", 2].text == "b" * 90 + "\n\n" + "c" * 79 + "\n\n" + "d" * 5 and out["d", 2].page_end == 4
    assert out["d", 2].equations == ["e", "e2", "e3", "e4"] and out["d", 1].equations == ["e1", "e"]


def test_headings_of_lower_classes(spark):
    lines = ["Light And Shadow", "", BODY, BODY, "", "Tiny Part", "", "short", "", "Next Part", "", BODY, "Activity 5", "", "Science 12", BODY]
    docs = {"d": [(1, lines)]}
    out = sorted(S.parse_national(frame(spark, docs), chapters(spark, docs, 8)).collect(), key=lambda r: r.chunk_seq)
    assert [r.section for r in out] == ["Light And Shadow", "Next Part"] and "short" in out[1].text and "Science 12" not in out[1].text
    assert out[0].chunk_id == "sci_08_ch01_light_and_shadow_1"


def test_unsupported_class(spark):
    docs = {"d": [(1, [BODY])]}
    with pytest.raises(Exception, match="unsupported class"):
        S.parse_national(frame(spark, docs), chapters(spark, docs, 7)).collect()


def test_titles(spark):
    text = "MODULE - 1\nNEWTON'S LAWS\nUNITS, DIMENSIONS AND VECTORS\nbody"
    df = frame(spark, {"d": [(1, text.split("\n")), (2, ["OTHER TITLE HERE"])], "e": [(1, ["1.", "Living World"])], "f": [(1, ["2. The Cell Unit"])], "g": [(1, ["Introduction: x"])], "h": [(1, ["7", "Naked first line"])]})
    assert {r.doc_id: r.title for r in S.infer_title(df).collect()} == {"d": "Units, Dimensions And Vectors", "e": "", "f": "", "g": "", "h": ""}
    got = {r.doc_id: r.title for r in S.infer_title_general(df).collect()}
    assert got == {"d": "Units, Dimensions And Vectors", "e": "Living World", "f": "The Cell Unit", "g": "", "h": "Naked First Line"}


def test_no_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    for board in BOARDS.values():
        assert S.segment(empty, board, chapters(spark, ["d"])).count() == 0
    null = spark.createDataFrame([("d", 1, 1, None, None)], PAGES)
    assert S.segment(null, OPEN, chapters(spark, ["d"])).count() == 0


def python_module(text):
    text = re.sub(r"(.)\1{3,}", r"\1", text)
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text))
    for p in T.MODULE_HEADERS:
        text = re.sub(p, "", text, flags=re.M)
    text = re.sub(r"^\s*\d{1,3}\s*$", "", text, flags=re.M)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def test_cleaning_against_python(spark):
    rng = random.Random(4)
    parts = ["a", "....", "-----", " ", "\t", "\n", "\n\n\n\n", "MODULE - 1", "MODULE - 2 Units", "12", "exam-\nple", "Motion, Force and Energy", "é", "\xa0", "Fig. 1.2a"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["", "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("id", "t", T.clean_module(df.t).alias("m"), T.clean_base(df.t).alias("b")).collect():
        assert r.m == python_module(r.t)
        b = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", re.sub(r"(.)\1{3,}", r"\1", r.t)))
        assert r.b == re.sub(r"([A-Za-z]+)-\n([a-z]+)", r"\1\2\n", b).strip()
