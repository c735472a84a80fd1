"""What distinguishes the textbook boards, as data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from ..functions import text as T


@dataclass(frozen=True)
class Mark:
    """A line that starts a block: its pattern, the kind it starts, and how it behaves.

    hard: always starts a block; else only where the last hard mark is not in the board's ``suppress``.  keep: the
    line is part of the block.  within: starts a block only after a hard mark of that kind.
    """

    pattern: str
    kind: str
    hard: bool = True
    keep: bool = False
    within: str | None = None


@dataclass(frozen=True)
class Board:
    """Patterns and rules of a board; ``section`` has the groups number and title."""

    name: str
    section: str
    marks: tuple[Mark, ...]
    clean: Callable[[Column], Column]
    preprocess: Callable[[Column], Column] | None = None
    section_hard: bool = True
    suppress: tuple[str, ...] = ()
    sticky: str | None = None  # after the first mark of this kind sections and inline marks are off for good
    default: str = "content"
    rename: dict[str, str] = field(default_factory=dict)
    title_capitals: bool = False
    figures: bool = False
    inline: tuple[tuple[str, str], ...] = ()
    distinct_equations: bool = False


# The lines that start blocks in the books of each board.
OPEN = Board(
    name="open",
    section=r"(?d)^(\d{1,2}\.\d{1,2}(?:\.\d{1,2})?\.?)\s+([A-Za-z].+?)\s*$",
    marks=(
        Mark(r"(?i)^INTEXT\s+QUESTIONS?\s*[\d\.]*\s*$", "intext_question"),
        Mark(r"(?i)^TERMINAL\s+EXERCISE\s*$", "terminal_exercise"),
        Mark(r"(?i)^WHAT\s+YOU\s+HAVE\s+LEARNT\s*$", "summary"),
        Mark(r"(?i)^ANSWERS?\s+TO\s+", "answers", keep=True),
        Mark(r"(?i)^OBJECTIVES\s*$", "objectives"),
        Mark(r"(?i)^Example\s+\d+[\.\d]*", "example", hard=False, keep=True),
    ),
    clean=T.clean_module,
    suppress=("terminal_exercise", "answers"),
)
OPEN_CLASS = Board(name="open_class", section=OPEN.section, marks=OPEN.marks, clean=T.clean_base, preprocess=T.preprocess_module, suppress=OPEN.suppress, distinct_equations=True)
NATIONAL = Board(
    name="national",
    section=r"(?d)^(\d+\.\d+(?:\.\d+)?)\s+(.+?)\s*$",
    marks=(
        Mark(r"(?i)^(?:SUMMARY|WHAT\s+YOU\s+HAVE\s+LEARNT|KEY\s+POINTS)\s*$", "summary"),
        Mark(r"(?i)^EXERCISES?\s*$", "exercise"),
        Mark(r"(?i)^(?:IN[\s\-]?TEXT\s+QUESTIONS?|QUESTIONS?)\s*$", "intext_question"),
        Mark(r"(?id)^\s*.*?Example\s+\d+(?:\.\d+)*", "example", hard=False, keep=True),
        Mark(r"(?i)^Activity\s+\d+[\.\d]*", "activity", hard=False, keep=True),
        Mark(r"^\s*\d+\.\d+\b|^\d+[\.\)]\s+[A-Z]", "exercise", hard=False, keep=True, within="exercise"),
    ),
    clean=T.clean_science,
    section_hard=False,
    suppress=("exercise",),
    default="explanation",
    title_capitals=True,
)
STATE = Board(
    name="state",
    section=r"(?d)^(\d{1,2}\.\d{1,2}(?:\.\d{1,2})?)\s+([A-Za-z].+?)\s*$",
    marks=(
        Mark(r"(?i)^Can\s+you\s+recall\s*\??\s*$", "recall"),
        Mark(r"(?i)^Can\s+you\s+tell\s*\??\s*$", "recall"),
        Mark(r"(?i)^Think\s+about\s+it\s*\??\s*$", "recall"),
        Mark(r"(?i)^Use\s+your\s+brain\s+power\s*\??\s*$", "recall"),
        Mark(r"(?i)^Do\s+you\s+know\s*\??\s*$", "callout"),
        Mark(r"(?i)^Internet\s+my\s+friend\s*\??\s*$", "internet_task"),
        Mark(r"(?i)^Find\s+out\s*\??\s*$", "activity"),
        Mark(r"(?i)^Know\s+the\s+scientists?\s*$", "scientist_box"),
        Mark(r"(?i)^Exercises?\s*$", "exercise"),
        Mark(r"(?i)^(?:Q\.\s*\d+\.\s*)?(?:multiple\s+choice|choose\s+the\s+correct)", "mcq", within="exercise"),
        Mark(r"(?i)^(?:Q\.\s*\d+\.\s*)?(?:answer\s+the\s+following|answer\s+in\s+brief|write\s+short\s+notes)", "exercise", within="exercise"),
        Mark(r"(?i)^(?:project|project\s+work)\s*$", "project", within="exercise"),
    ),
    clean=T.clean_base,
    preprocess=T.preprocess_state,
    sticky="exercise",
    rename={"content": "explanation"},
    figures=True,
    inline=(
        (r"(?i)^\s*Can\s+you\s+recall\s*\??", "recall"),
        (r"(?i)^\s*Can\s+you\s+tell\s*\??", "recall"),
        (r"(?i)^\s*Think\s+about\s+it\s*\??", "recall"),
        (r"(?i)^\s*Use\s+your\s+brain\s+power\s*\??", "recall"),
        (r"(?i)^\s*Do\s+you\s+know\s*\??", "callout"),
        (r"(?i)^\s*(?:www\s+)?Internet\s+my\s+friend", "internet_task"),
    ),
    distinct_equations=True,
)
#: The lower classes have headings for marks; see ``segment.headings_lower``.
LOWER = Board(name="lower", section=OPEN.section, marks=(), clean=T.clean_science, default="explanation")
BOARDS = {b.name: b for b in (OPEN, OPEN_CLASS, NATIONAL, STATE)}

# Titles of chapters whose extraction lacks them, titles that are none, and headings of the lower classes.
KNOWN_TITLES = {("Physics", 11, 8): "Sound", ("Physics", 11, 11): "Electric Current Through Conductors", ("Physics", 11, 12): "Magnetism", ("Physics", 11, 13): "Electromagnetic Waves and Communication System", ("Physics", 11, 14): "Semiconductors"}
NO_TITLES = ("can you recall?", "introduction:", "introduction", "can you tell?", "p", "std. xi")
HEADINGS = (r"^[A-Z][A-Z\s\(\)\-\/]{4,60}$", r"^[A-Z][a-zA-Z\s\(\)\-\/]{4,60}$")
NOT_HEADINGS = (r"^Dear Young Scientists", r"^Happy", r"^Write it here", r"^Probe and ponder", r"^Pause and Ponder", r"^Ready to Go Beyond", r"^Meet a Scientist", r"^Threads of Curiosity", r"^Next Level Up", r"^Activity \d+", r"^Example \d+", r"^Answer")
