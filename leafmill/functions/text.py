"""Cleaning, normalising and detecting, as expressions that stay inside code generation.

Patterns carry ``(?U)`` where the semantics ask for Unicode blanks and digits and ``(?d)`` where only a line feed ends
a line.  Every function maps null to null unless it says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.skew import strip

# Running headers and footers by board.
MODULE_HEADERS = (r"^MODULE\s*-\s*\d+\s*$", r"^MODULE\s*-\s*\d+\s+.+$", r"^Motion,\s+Force\s+and\s+Energy\s*$", r"^Units,\s+Dimensions\s+and\s+Vectors\s*$", r"^Units\.\s+Dimensions\s+and\s+Vectors\s*$")
STATE_HEADERS = (r"^Maharashtra\s*State\s*Bureau.*$", r"^Std\.\s*XI\b.*$", r"^Std\.\s*XII\b.*$")
STATE_KEPT = r"[^\x00-\x7F°“”‘’–—]"  # what becomes a blank
SCIENCE_MARKS = (r"Reprint \d{4}-\d{2,4}", r"Chapter-\d+\.indd.*", r"(?m)\d+\s+Science\s*$", r"(?m)^Science\s+\d+\s*$")
FOOTER_LINES = (r"^Chemical Reactions and Equations\s*\d*$", r"^Science\s*$", r"^\d+\s+Science\s*$", r"^Science\s+\d+\s*$", r"^Reprint \d{4}", r"^Chapter-\d+\.indd", r"^Curiosity.*Grade \d+", r"^Exploration\|Grade \d+", r"^Chapter \d+.*World of Science", r"^\s*\d{1,3}\s*$")
# Corrections of known misreadings, in the order in which they apply.
CORRECTIONS = ((r"\)\)+\s*", ""), (r"\(\(+\s*", ""), (r"(?m)^www\s+", ""), (r"\bKev\b", "Key"), (r"(?i)\bmeaninaful\b", "meaningful"), (r"(?i)\btransperent\b", "transparent"), (r"(?i)\bformaledehyde\b", "formaldehyde"), (r"(?i)\bexsitu\b", "ex-situ"), (r"(?m)^\s*\d{1,3}\s*$", ""))
# British and American spellings taken as one.
SPELLINGS = (("centre", "center"), ("colour", "color"), ("fibre", "fiber"))
PAGE_NUMBER = r"(?U)^\s*\d{1,3}\s*$"


def _drop(c: Column, patterns: tuple[str, ...], flags: str = "(?dU)") -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, flags + p, ""), patterns, c)


def _spaced(c: Column) -> Column:
    """Runs of four or more of a character made one, blanks one, blank lines at most one."""
    c = F.regexp_replace(c, r"(?d)(.)\1{3,}", "$1")
    return F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")


def clean_module(c: Column) -> Column:
    """Cleaning for books with module banners; null gives the empty string."""
    c = _drop(_spaced(F.coalesce(c, F.lit(""))), MODULE_HEADERS, "(?dmU)")
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?dmU)^\s*\d{1,3}\s*$", ""), r"\n{3,}", "\n\n"))


def clean_science(c: Column) -> Column:
    """Cleaning for the single-subject science books; null gives the empty string."""
    return strip(_drop(_spaced(F.coalesce(c, F.lit(""))), SCIENCE_MARKS))


def clean_base(c: Column) -> Column:
    """Spacing, and words broken by a hyphen at a line's end joined; null gives the empty string."""
    return strip(F.regexp_replace(_spaced(F.coalesce(c, F.lit(""))), r"([A-Za-z]+)-\n([a-z]+)", "$1$2\n"))


def clean_content(c: Column, most: int = 1500) -> Column:
    """Light cleaning of what a model reads, cut at ``most`` characters; null gives the empty string."""
    c = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")
    return F.substring(strip(F.regexp_replace(c, r"(?dmU)^\s*\d{1,3}\s*$", "")), 1, most)


def preprocess_module(c: Column) -> Column:
    return clean_base(_drop(clean_base(c), MODULE_HEADERS, "(?dmU)"))


def preprocess_state(c: Column) -> Column:
    c = _drop(clean_base(c), STATE_HEADERS, "(?dmiU)")
    # The same as STATE_KEPT by itself; the plain range is tried first, as that takes a fifteenth of the time (0.65 s instead of 10 s for 60,000 texts).
    c = F.regexp_replace(c, r"[^\x00-\x7F](?<![°“”‘’–—])", " ")
    return clean_base(reduce(lambda x, p: F.regexp_replace(x, "(?dU)" + p[0], p[1]), CORRECTIONS, c))


def is_page_number(line: Column) -> Column:
    return strip(line).rlike(PAGE_NUMBER)


def is_footer(line: Column) -> Column:
    s = strip(line)
    return reduce(lambda a, b: a | b, (s.rlike("(?i)" + p) for p in FOOTER_LINES))


def dots(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))


def per_word_capitals(c: Column) -> Column:
    """First letter of every blank-separated word upper, the rest lower; runs of blanks become one."""
    return F.initcap(F.regexp_replace(strip(c), r"(?U)\s+", " "))


def canonicalize(c: Column) -> Column:
    """Identifier of a concept: ``Newton's First Law`` gives ``newtons_first_law``."""
    t = F.replace(F.replace(F.lower(strip(c)), F.lit("'"), F.lit("")), F.lit("-"), F.lit(" "))
    return F.regexp_replace(strip(F.regexp_replace(t, r"(?U)[^a-z0-9\s]", "")), r"(?U)\s+", "_")


def display_form(c: Column) -> Column:
    """Words capitalised, all-capital words of two letters or more kept."""
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    keep = lambda w: F.when((F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) > 1), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000))))
    return F.array_join(F.transform(words, keep), " ")


def similarity_form(c: Column) -> Column:
    """What near-duplicates are compared by: lower case, letters, digits and spaces."""
    return F.regexp_replace(F.replace(F.lower(c), F.lit("'s"), F.lit("s")), r"[^a-z0-9 ]", "")


def american(c: Column) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), SPELLINGS, c)


def word_set(c: Column) -> Column:
    """Distinct lower-case words of three letters or more; empty for null."""
    words = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("([a-zA-Z]+)"), 1)
    return F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= 3), F.lower))


def figure_references(c: Column) -> Column:
    """Sorted distinct numbers of the figures a text refers to; empty for null."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?i)(?:Fig\.|Fig\s|Figure)\s*(\d+\.\d+[a-zA-Z]?)"), 1)))


def looks_like_equation(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?d)\$.*?\$|\\frac|\\sum|\\int|\\sqrt|=\s*\d")


def word_slug(c: Column, most: int = 30) -> Column:
    return F.lower(F.substring(F.regexp_replace(c, r"(?U)\W+", "_"), 1, most))


def section_slug(section_no: Column, section: Column) -> Column:
    """Part of a resource's id: section number, else title, else X; S before a digit; X for one without letters or digits."""
    chosen = F.coalesce(F.nullif(section_no, F.lit("")), F.nullif(section, F.lit("")), F.lit("X"))
    slug = F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(chosen, "[^a-zA-Z0-9]", "_"), "^_+|_+$", ""), F.lit("")), F.lit("X"))
    return F.when(slug.rlike("^[0-9]"), F.concat(F.lit("S"), slug)).otherwise(slug)


def padded(c: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer strings stay whole."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def image_number(c: Column) -> Column:
    """Digits of an image id, three at least; 000 for null."""
    return padded(F.regexp_replace(F.coalesce(c, F.lit("000")), "[^0-9]", ""), 3)


# Tags that end a line, and entities, in markup of layout blocks.
CLOSING = r"</(p|div|h[1-6]|li|tr|td|th)>"
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "))
