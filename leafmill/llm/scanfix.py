"""Problem 3: noise in text from scanned pages.

Method: a frequency lexicon of the whole corpus; a symmetric-delete index over it yields correction candidates for
every distinct token; a weighted edit distance with confusion pairs, frequency, and the words on either side wherever there is more than one candidate,
pick the repair.  Lines are told apart by form, by the titles in the tables, and by how they recur within documents.
"""

from __future__ import annotations

import math
import re
from collections import ChainMap, Counter, defaultdict
from collections.abc import Iterator, Mapping
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from ..plans.skew import hot_cold_join

# What scanners read for what was printed.
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("|", "l"), ("|", "i"), ("!", "i"), ("!", "l"), ("5", "s"), ("$", "s"), ("6", "b"), ("6", "h"), ("8", "b"), ("9", "g"), ("9", "q"), ("2", "z"),
    ("rn", "m"), ("nn", "m"), ("cl", "d"), ("vv", "w"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("h", "ti"), ("m", "rn"), ("d", "cl"), ("n", "ri"), ("u", "ii"), ("w", "vv"), ("m", "ni"), ("hi", "tu"), ("r!", "n"), ("!i", "u"), ("i!", "u"), ("c|", "d"), ("c1", "d"),
    ("c", "e"), ("e", "c"), ("b", "h"), ("h", "b"), ("t", "f"), ("f", "t"), ("l", "i"), ("i", "l"), ("u", "v"), ("v", "u"), ("o", "c"), ("c", "o"), ("t", "l"), ("l", "t"), ("i", "t"), ("t", "i"),
    ("ä", "a"), ("ö", "o"), ("ü", "u"), ("ë", "e"), ("ï", "i"), ("á", "a"), ("à", "a"), ("é", "e"), ("è", "e"), ("ó", "o"), ("ò", "o"), ("í", "i"), ("ì", "i"), ("ç", "c"), ("ñ", "n"),
)
MARKS = "-‐¬\xad"
#: Lines that may stand between the halves of a broken word, and two: page numbers, titles and data are left out before.
REACH = 5
#: A word of the lexicon occurs LEAST times, and a repair is so many times as frequent (see ``candidates``); where the lexicon is too large to broadcast, words that make
#: up at least SHARE of all words (at most 1/SHARE) still are, and the others are joined.
SHARE, LEAST, RATIO = 2e-6, 5, 15
#: Cost of a confusion and most cost of a repair; what a tenfold frequency in distinct texts, and tenfold company by the words beside it, make up for.
CONFUSED, MOST, FREQUENT, CONTEXT = 0.3, 0.95, 0.15, 0.3
#: Texts in which a line recurs to be a running title, in documents that hold it in TWICE of their texts; part of its texts that these are.
RECURS, TWICE, MOSTLY = 5, 2, 0.5
#: Most words, repairs, titles, or pairs of neighbours, and characters of them, that are broadcast; most repeated texts told by their hashes.
BROADCAST, BROADCAST_CHARS, REPEATED = 200_000, 8_000_000, 1_000_000
#: Longer words are looked up by pieces of so many characters instead of by deletions; lines of data are no longer than DATA_LINE.
LONG, GRAM, DATA_LINE = 32, 4, 90

_SMALL = "of|and|the|in|for|on|to|a|an"
_TITLE = re.compile(rf"(?=.*[A-Za-z])(?:[^a-z\sऀ-ॿ][^\sऀ-ॿ]*|l[a-z]\S*|{_SMALL})(?:[ \t]+(?:[^a-z\sऀ-ॿ][^\sऀ-ॿ]*|l[a-z]\S*|{_SMALL}))*")
_PAGENO = re.compile(r"[-–—~.·*|\[(<=]*\s*(?:page|pg\.?|p\.)?\s*(?:\d{1,5}|(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3}))\s*(?:(?:of|/)\s*\d{1,5})?\s*[-–—~.·*|\])>=]*", re.I)
_HEADING = re.compile(r"\d+(?:\.\d+)+\.?\s")
_DATA = re.compile(r"(?:[^\d\s:]*\s)?[^:]*\d\s*:\s*[\d.]+.*|[\d.,\s]+")
_EDGES = ".,;:?()[]{}\"'“”‘’–—"
_BROKEN = re.compile(r"\S+[-‐¬\xad][ \t]*\n\s*\S+")
_WORDY = re.compile(r"[A-Za-zÀ-ɏ]")
_ACCENTS = {a: b for a, b in CONFUSIONS if len(a) == 1 and not a.isascii()}
_FOLD = str.maketrans(_ACCENTS | {"0": "o", "1": "i", "|": "i", "!": "i", "l": "i", "5": "s", "9": "g", "6": "b", "h": "b", "e": "c", "t": "f"})
_JOINT = (("rn", "m"), ("ni", "m"), ("ci", "d"), ("vv", "w"), ("ri", "n"), ("ii", "u"))
_WORD_FOLD = str.maketrans(_ACCENTS | {"0": "o", "1": "l", "|": "l", "!": "i", "5": "s", "9": "g", "6": "b", "8": "b"})
_WORD_JOINT = (("c|", "d"), ("cl", "d"), *_JOINT[:2], *_JOINT[3:])
_UNIT = re.compile(r"\d[\d.]*\s+\S{1,4}$")


def skeleton(line: str) -> str:
    """A title without page number and numbering, the same for all misreadings by the common confusions."""
    s = re.sub(r"\s+", " ", line.strip().lower())
    s = re.sub(r"^\d{1,5}[.|]? +(?=\D)|(?<=\S) *\| *\d{1,5}$|(?<=\D) +\d{1,5}$", "", s)
    s = re.sub(r"^(?:ch.pt.r|unit|less.n) [\dil|]+ ?[:.–-]? ?", "", s)
    s = re.sub(r"(?<![a-z])\d+(?![a-z])", "#", s).translate(_FOLD)
    for a, b in _JOINT:
        s = s.replace(a, b)
    return s


def _title_like(s: str) -> bool:
    return 4 <= len(s) and s[-1] not in ".?!,;:।" and _TITLE.fullmatch(s) is not None and not _HEADING.match(s) and _PAGENO.fullmatch(s) is None and not _DATA.fullmatch(s) and not _UNIT.search(s)


def plain(token: str) -> str:
    """A token as it is looked up: without marks at its ends, in lower case."""
    t = token.strip(_EDGES)
    if t[-1:] == "!" and t[:-1].isalpha():
        t = t[:-1] if len(t) > 1 else t
    return t.lower()


def _gather(words: bool, lines: bool):
    """(what, key, doc, n, d) of texts (text, doc, rows): times a word is seen in all rows, and in distinct texts; texts of a document in which a line set like a title stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, more, titles = Counter(), Counter(), Counter()
        for batch in batches:
            for text, doc, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lines:
                    titles.update((k, doc) for k in {skeleton(s) for s in {s for s in map(str.strip, text.split("\n")) if s and _title_like(s)}})
                if words:
                    tokens = (_BROKEN.sub(" ", text) if "\n" in text else text).split()
                    raw.update(tokens)
                    for t in tokens if rows > 1 else ():
                        more[t] += rows - 1
            if len(raw) + len(titles) > 500_000:
                yield from _flush(raw, more, titles)
                raw, more, titles = Counter(), Counter(), Counter()
        yield from _flush(raw, more, titles)

    return run


_GATHERED = "what string, key string, doc string, n bigint, d bigint"


def _flush(raw: Counter, more: Counter, titles: Counter) -> Iterator[pa.RecordBatch]:
    made: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for t, n in raw.items():
        if _WORDY.search(t):
            both = made[plain(t)]
            both[0] += n + more[t]
            both[1] += n
    rows = [("w", k, None, n, d) for k, (n, d) in made.items() if len(k) > 1] + [("h", k, doc, n, n) for (k, doc), n in titles.items()]
    for k in range(0, len(rows), 50_000):
        a, b, c, d, e = zip(*rows[k : k + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c, pa.string()), pa.array(d, pa.int64()), pa.array(e, pa.int64())], names=["what", "key", "doc", "n", "d"])


def merged(word: str) -> str:
    """A word with misread joints and signs made letters, so that few deletions lead from a misreading to the word."""
    word = word.translate(_WORD_FOLD)
    for a, b in _WORD_JOINT:
        word = word.replace(a, b)
    return word


def gaps(word: str, listed: bool) -> set[str]:
    """What a word is found by: what is left of it, its joint letters made one, when up to two characters are taken out.

    A repair makes three confusions at most, which touch six pieces at most, so longer words share one of their eight or more
    pieces of GRAM characters; those of the lexicon give all places of such pieces.
    """
    m = merged(word)
    out = set()
    if len(m) <= LONG + 4 * listed:
        most = 1 if len(m) < 5 else 2
        out = {"".join(m[i] for i in keep) for d in range(min(most, len(m) - 1) + 1) for keep in combinations(range(len(m)), len(m) - d)}
    if len(m) > LONG - 4 * listed:
        out |= {"\x00" + m[k : k + GRAM] for k in range(0, len(m) - GRAM + 1, 1 if listed else GRAM)}
    return out


def _deletions(what: str):
    """(gap, word, n, d) of lexicon words, or of words that are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(g, word, n, once) for word, n, once in zip(*(c.to_pylist() for c in batch.columns), strict=True) for g in gaps(word, what == "meant")]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["gap", f"{what}", f"{what}_n", f"{what}_d"])

    return run


_BY_READ: dict[str, list[str]] = defaultdict(list)
for _a, _b in CONFUSIONS:
    _BY_READ[_a].append(_b)


def distance(read: str, meant: str, most: float = MOST) -> float:
    """Weighted edit distance from what is read to what was meant; more than ``most`` is given as 9."""
    inf, m = 9.0, len(meant)
    table = [[inf] * (m + 1) for _ in range(len(read) + 1)]
    table[0][0] = 0.0
    for i in range(len(read) + 1):
        row, low = table[i], inf
        for j in range(max(0, i - 4), min(m, i + 4) + 1):  # a confusion moves by one at most, and there are three at most
            c = row[j]
            if c > most:
                continue
            low = min(low, c)
            if i < len(read):
                if j < m and read[i] == meant[j]:
                    table[i + 1][j + 1] = min(table[i + 1][j + 1], c)
                for width in (1, 2):
                    for to in _BY_READ.get(read[i : i + width], ()):
                        if len(read[i : i + width]) == width and meant.startswith(to, j):
                            table[i + width][j + len(to)] = min(table[i + width][j + len(to)], c + CONFUSED)
    return table[-1][m] if table[-1][m] <= most else inf


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(*row, d) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) if (d := distance(row[0], row[2])) <= MOST]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()], strict=True)], names=["read", "read_n", "meant", "meant_n", "meant_d", "cost"])


def candidates(words: DataFrame, least: int) -> DataFrame:
    """(read, read_n, meant, meant_n, meant_d, cost) for words ``(key, n, d)``: a lexicon word near enough and frequent enough.

    It is RATIO times as frequent in distinct texts; or in all rows, where the form read does not itself stand LEAST times, and
    more often, in distinct texts.  A form with signs or digits, that are in no lexicon word, need only be no more frequent.
    """
    good = words.filter((F.col("n") >= least) & F.col("key").rlike(r"^[a-z]+(['-][a-z]+)*$"))
    index = good.select("key", "n", "d").mapInArrow(_deletions("meant"), "gap string, meant string, meant_n bigint, meant_d bigint")
    # The words are few bytes, their deletions many: the number of tasks is kept.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = words.filter(F.col("key").rlike(r"[a-zÀ-ɏ]")).select("key", "n", "d").repartition(tasks, "key").mapInArrow(_deletions("read"), "gap string, read string, read_n bigint, read_d bigint")
    n, d, m, e = (F.col(c) for c in ("read_n", "read_d", "meant_n", "meant_d"))
    signs = F.col("read").rlike(r"[0-9|!$]") & ((m >= n) | (e >= d))
    frequent = (e >= F.lit(RATIO) * d) | (m >= F.lit(RATIO) * n) & ((d < F.lit(LEAST)) | (d <= e)) | signs
    near = asked.join(index, "gap").filter(frequent & (F.col("read") != F.col("meant")))
    return near.select("read", "read_n", "meant", "meant_n", "meant_d").distinct().mapInArrow(_weigh, "read string, read_n bigint, meant string, meant_n bigint, meant_d bigint, cost double")


def _cased(token: str, p: str, to: str) -> str | None:
    """``token`` with ``to`` in place of its plain form ``p``, set in capitals as that is."""
    at = token.lower().find(p)
    if at < 0:
        return None
    old = token[at : at + len(p)]
    new = to.upper() if old.isupper() and len(old) > 1 and old.isalpha() else to.capitalize() if old[:1].isupper() else to
    return token[:at] + new + token[at + len(p) :]


class Repairer:
    """What one worker knows: repairs by word, words in competition, lexicon, running titles."""

    def __init__(self, repairs: dict[str, str], rivals: dict[str, list[tuple[str, float]]], pairs: dict[tuple[str, str], int], lexicon: Mapping[str, int], titles: set[str]) -> None:
        self.repairs, self.rivals, self.pairs, self.lexicon, self.titles = repairs, rivals, pairs, lexicon, titles
        self.memo: dict[str, str | None] = {}
        self.asked: set[tuple[str, str]] | None = None

    def word(self, token: str) -> str | None:
        """The repaired token, or None if it stands as it is."""
        try:
            return self.memo[token]
        except KeyError:
            pass
        p = plain(token)
        to = self.repairs.get(p)
        out = None if to is None else _cased(token, p, to)
        if len(self.memo) < 500_000:
            self.memo[token] = out
        return out

    def line(self, words: list[str]) -> bool:
        """Repairs the words in place; True if any was misread."""
        found, before, w = False, "", ""
        for k, now in enumerate(words):
            before, w = w, now
            to = self.word(w)
            if to is not None:
                p = plain(w)
                if p in self.rivals:
                    left, right = plain(words[k - 1]) if k else "", plain(words[k + 1]) if k + 1 < len(words) else ""
                    if self.asked is not None:
                        lefts = {left, *(v for v, _ in self.rivals.get(plain(before), ()))}
                        self.asked |= {x for v, _ in self.rivals[p] for x in ((v, right), *((a, v) for a in lefts))}
                    company = lambda v: self.pairs.get((left, v), 0) + self.pairs.get((v, right), 0)  # noqa: B023, E731 - called at once
                    best = min(self.rivals[p], key=lambda x: (x[1] - CONTEXT * math.log10(1 + company(x[0])), x))[0]
                    to = _cased(w, p, best) or to
                words[k] = to
                found = True
        return found

    def asks(self, text: str) -> set[tuple[str, str]]:
        """The pairs of neighbours whose counts ``clean`` may look up, whichever of the words in competition it takes."""
        words = {*text.split(), *(x for a, b in _broken(text.split("\n")) for x in (a + b, f"{a}-{b}"))}
        if not any(self.word(t) is not None and plain(t) in self.rivals for t in words):
            return set()
        self.asked = set()
        self.clean(text)
        asked, self.asked = self.asked, None
        return asked

    def joins(self, a: str, mark: str, b: str) -> bool:
        """Whether a mark at a line's end does not belong to the word."""
        a, b = plain(a), plain(b)
        if not a or not b or not a[-1].isalpha() or not b[0].isalpha():
            return False
        if mark in "¬\xad":
            return True
        whole, parted = a + b, f"{a}-{b}"
        j, h = (self.lexicon.get(self.repairs.get(x, x), 0) for x in (whole, parted))
        if j or h:
            return j >= h
        return not (a in self.lexicon and b in self.lexicon)

    def clean(self, text: str) -> tuple[set[str], str]:
        """Kinds of noise in a text, and the text as paragraphs."""
        noise: set[str] = set()
        lines: list[tuple[str, list[str]]] = []  # body, apart (heading, data) or blank, with words
        for line in text.split("\n"):
            s = line.strip()
            if not s:
                lines.append(("blank", []))
            elif _PAGENO.fullmatch(s):
                noise.add("pageno")
            elif _title_like(s) and skeleton(s) in self.titles:
                noise.add("header")
            elif len(s) <= DATA_LINE and (_HEADING.match(s) or _DATA.fullmatch(s) or _UNIT.search(s) and _TITLE.fullmatch(s)):
                lines.append(("apart", s.split()))
            else:
                lines.append(("body", s.split()))
        for k, (kind, words) in enumerate(lines):
            if kind != "body" or not words or words[-1][-1] not in MARKS or len(words[-1]) < 2:
                continue
            n = next((n for n in range(k + 1, min(k + REACH, len(lines))) if lines[n][0] == "body" and lines[n][1]), None)
            if n is None:
                continue
            a, mark, b = words[-1][:-1], words[-1][-1], lines[n][1][0]
            if self.joins(a, mark, b):
                noise.add("hyphen")
                words[-1] = a + b
                del lines[n][1][0]
            elif b[:1].isalpha():
                words[-1] = a + "-" + b
                del lines[n][1][0]
        out: list[str] = []
        run: list[str] = []
        for kind, words in [*lines, ("blank", [])]:
            if kind == "body":
                if self.line(words):
                    noise.add("chars")
                run += words
                continue
            if run:
                out.append(" ".join(run))
                run = []
            if kind == "apart":
                out.append(" ".join(words))
        return noise, "\n\n".join(out)


def _apply(know, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(*know.value)
        for batch in batches:
            kinds, ids = batch.column(0), batch.column(1)
            noise, made = [], []
            for t in batch.column(2).to_pylist():
                n, c = repairer.clean(t) if t else ((), t)
                noise.append(sorted(n))
                made.append(c if texts else None)
            yield pa.RecordBatch.from_arrays([kinds, ids, pa.array(noise, pa.list_(pa.string())), pa.array(made, pa.string())], names=["kind", "id", "noise", "text"])

    return run


def _pairs(wanted: set[str] | None):
    """(k, n): neighbours of which one is wanted, or all neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[tuple[str, str]] = Counter()
        memo: dict[str, str] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = [memo[t] if t in memo else memo.setdefault(t, plain(t)) for t in text.split()]
                count.update((a, b) for a, b in zip(words, words[1:], strict=False) if wanted is None or a in wanted or b in wanted)
                if len(memo) > 500_000:
                    memo.clear()
                if len(count) > 500_000:
                    yield _counted(count)
                    count.clear()
        yield _counted(count)

    return run


def _counted(count: Counter[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_pair(*p) for p in count], pa.string()), pa.array(list(count.values()), pa.int64())], names=["k", "n"])


def _pair(a: str, b: str) -> str:
    """The key of a pair of neighbours, which hold no blanks."""
    return f"p{a} {b}"


def _asks(know):
    """(k, kind, id): the pairs of neighbours that a text may need to know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Repairer(*know.value) if know is not None else None
        for batch in batches:
            keys, kinds, ids = [], [], []
            own = batch.column(3).to_pylist() if r is None else [None] * len(batch)
            for kind, i, text, o in zip(*(batch.column(c).to_pylist() for c in range(3)), own, strict=True):
                asked = (r or _own_repairer(o, {})).asks(text)
                keys += [_pair(*p) for p in asked]
                kinds += [kind] * len(asked)
                ids += [i] * len(asked)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(kinds, pa.string()), pa.array(ids, pa.int64())], names=["k", "kind", "id"])

    return run


def best_repairs(weighed: DataFrame) -> DataFrame:
    """(key, meant, rivals, n, meant_d): the repair of every misreading, and all that compete for it with their scores; a misreading is nobody's repair."""
    reads = weighed.select(F.col("read").alias("meant")).distinct()
    sound = weighed.join(reads, "meant", "left_anti").withColumn("score", F.col("cost") - F.lit(FREQUENT) * F.log10("meant_d"))
    ranked = sound.groupBy("read").agg(F.max("read_n").alias("n"), F.array_sort(F.collect_list(F.struct("score", (-F.col("meant_n")).alias("m"), "meant", "meant_d"))).alias("c"))  # the lexicon words near one word
    first = F.get("c", F.lit(0))
    rivals = F.transform("c", lambda x: F.struct(x["meant"].alias("meant"), x["score"].alias("score")))
    return ranked.select(F.col("read").alias("key"), first["meant"].alias("meant"), F.when(F.size("c") > 1, rivals).alias("rivals"), "n", first["meant_d"].alias("meant_d"))


def _broken(lines: list[str]) -> Iterator[tuple[str, str]]:
    """The halves of every word that may be broken over a line end, whichever of the next lines turn out to be noise."""
    for k, line in enumerate(lines):
        line = line.rstrip()
        if not line or line[-1] not in MARKS:
            continue
        counted = 0
        for after in lines[k + 1 :]:
            s = after.strip()
            counted += not (s and (_PAGENO.fullmatch(s) or _title_like(s)))
            if s:
                yield line.split()[-1][:-1], s.split()[0]
            if counted >= REACH:
                break


def _needs(safe: set[str]):
    """(k, kind, id): what a text may need to know, its words and counts of broken ones but the safe ones, and its lines set like titles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, kinds, ids = [], [], []
            for kind, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                broken = set(_broken(text.split("\n")))
                halves = {(plain(a), plain(b)) for a, b in broken}
                words = {*map(plain, {*text.split(), *(x for a, b in broken for x in (a + b, f"{a}-{b}"))}), *(x for a, b in halves for x in (a + b, f"{a}-{b}"))}
                asked = {"w" + p for p in words if p not in safe and _WORDY.search(p)}
                asked |= {"c" + x for a, b in halves if a and b for x in (a, b, a + b, f"{a}-{b}") if x not in safe}
                asked |= {"h" + skeleton(x) for x in map(str.strip, text.split("\n")) if x and _title_like(x)}
                keys += asked
                kinds += [kind] * len(asked)
                ids += [i] * len(asked)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(kinds, pa.string()), pa.array(ids, pa.int64())], names=["k", "kind", "id"])

    return run


def _own_repairer(own: list[dict] | None, lexicon: dict[str, int]) -> Repairer:
    """One that knows the lexicon and what comes along with a row."""
    by: dict[str, list[tuple[str, dict]]] = defaultdict(list)
    for x in own or ():
        by[x["k"][0]].append((x["k"][1:], x))
    counts = {x["meant"]: x["n"] for _, x in by["w"]} | {k: x["n"] for k, x in by["c"]}
    pairs = {tuple(k.split(" ")): x["n"] for k, x in by["p"]}
    return Repairer({k: x["meant"] for k, x in by["w"]}, {k: [(r["meant"], r["score"]) for r in x["rivals"]] for k, x in by["w"] if x["rivals"]}, pairs, ChainMap(counts, lexicon), {k for k, _ in by["h"]})


def _apply_own(know, texts: bool):
    """As ``_apply``, but with the repairs and titles that come along with each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = know.value
        for batch in batches:
            noise, made = [], []
            for t, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                n, c = _own_repairer(own, lexicon).clean(t) if t else ((), t)
                noise.append(sorted(n))
                made.append(c if texts else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(noise, pa.list_(pa.string())), pa.array(made, pa.string())], names=["kind", "id", "noise", "text"])

    return run


_FIXED = "kind string, id bigint, noise array<string>, text string"


def _within(frame: DataFrame, key: str, rows: int) -> bool:
    """Whether a frame is small enough to be broadcast."""
    n, chars = frame.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(key)), F.lit(0))).first()
    return n <= rows and chars <= BROADCAST_CHARS


def distinct_texts(body: DataFrame, repeated: int = REPEATED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(single, again, held) of ``body`` (text, doc): texts that stand once (text, doc, rows), others (text, doc, rows) with null doc, and the others by document.

    Only texts whose hash comes again travel; which hashes do is broadcast while they are no more than ``repeated``, else joined.
    """
    hashed = body.select("text", "doc", F.xxhash64("text").alias("h"))
    twice = cut(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "repeated")
    known = F.broadcast(twice) if twice.count() <= repeated else twice
    more = hashed.join(known, "h", "left_semi")
    again = cut(more.groupBy("text").agg(F.count(F.lit(1)).alias("rows")), "again")
    one = F.lit(1).cast("bigint").alias("rows")
    return hashed.join(known, "h", "left_anti").select("text", "doc", one), again.select("text", F.lit(None).cast("string").alias("doc"), "rows"), more.select("text", "doc").distinct().select("text", "doc", one)


def repair_scans(items: DataFrame, titles: DataFrame, texts: bool = True, share: float = SHARE, least: int = LEAST, recurs: int = RECURS, broadcast: int = BROADCAST) -> DataFrame:
    """(kind, id, noise, text) of every row: the kinds of noise found and the text as clean running paragraphs.

    ``items`` has ``kind STRING, id BIGINT, text STRING`` and may have ``doc STRING``, the document of each text (else each kind is
    one); ``titles`` one column of known chapter, subject or book titles.  ``noise`` is a sorted array of 'chars', 'header',
    'hyphen', 'pageno'.  Null text stays null and empty text empty, with empty noise; repeated rows are repaired each; texts are taken
    whole.  Headings with section numbers and lines of data, of DATA_LINE characters at most, stay on lines of their own.  A line is a running title if it is set
    like one and is a known title, or runs through documents: it stands in ``recurs`` distinct texts or more of documents that
    each hold it in TWICE or more of theirs, and these are MOSTLY of all that hold it.  So neither more text nor other documents make a
    title of a line.  Words in scripts without case are not repaired; words and titles may be of any length.

    All counts are of all texts, of words both in rows and in distinct texts, so that many copies of one text neither make
    its misreadings words nor keep them from repair.  The lexicon, repairs, running titles and the counts of those neighbours that texts ask for
    are broadcast while there are no more than ``broadcast`` of each; beyond that each text is joined with those it
    needs, and only the words that make up at least ``share`` of all are broadcast, so their number is bounded.
    """
    spark = items.sparkSession
    doc = F.col("doc").cast("string") if "doc" in items.columns else F.lit(None).cast("string")
    base = items.select(F.col("kind").cast("string").alias("kind"), F.col("id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"), F.coalesce(doc, F.col("kind").cast("string"), F.lit("")).alias("doc"))
    body = base.filter("text is not null and text <> ''")
    single, again, held = distinct_texts(body.select("text", "doc"))
    once = single.select("text").unionByName(again.select("text"))
    gathered = single.mapInArrow(_gather(True, True), _GATHERED).unionByName(again.mapInArrow(_gather(True, False), _GATHERED)).unionByName(held.mapInArrow(_gather(False, True), _GATHERED))
    stats = cut(gathered.groupBy("what", "key", "doc").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "lexicon")
    base, body = base.drop("doc"), body.drop("doc")
    words = stats.filter("what = 'w'")
    total = words.agg(F.sum("n")).first()[0] or 0
    bar = max(least, int(total * share))
    sound = words.filter(F.col("n") >= least)
    repairs = cut(best_repairs(candidates(words, least)), "repairs")
    known = titles.select(F.col(titles.columns[0]).cast("string").alias("t")).filter("trim(t) <> ''").distinct()

    def bones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([skeleton(t) for t in batch.column(0).to_pylist()], pa.string())], names=["key"])

    lines = stats.filter("what = 'h'").groupBy("key").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("n") >= TWICE, F.col("n"))), F.lit(0)).alias("runs"))
    named = known.mapInArrow(bones, "key string").filter("key <> ''").distinct()
    runs = (F.col("runs") >= recurs) & (F.col("runs") >= F.lit(MOSTLY) * F.col("n"))
    running = cut(lines.filter(runs).unionByName(lines.filter(~runs).join(named, "key", "left_semi")).select("key", "n"), "titles")
    rivals = repairs.filter("rivals is not null")
    if all(_within(x, "key", broadcast) for x in (repairs, running, sound)):
        lexicon = {r.key: r.d for r in sound.select("key", "d").toLocalIterator()}
        fixes = repairs.select("key", "meant", "rivals").collect()
        own = {r.key: r.meant for r in fixes}, {r.key: [(x.meant, x.score) for x in r.rivals] for r in fixes if r.rivals}
        heads = {r.key for r in running.select("key").collect()}
        pairs: dict[tuple[str, str], int] | None = {}
        if own[1]:
            asked = body.mapInArrow(_asks(spark.sparkContext.broadcast((*own, {}, lexicon, heads))), "k string, kind string, id bigint").select("k").distinct()
            seen = once.mapInArrow(_pairs({v for r in own[1].values() for v, _ in r}), "k string, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
            met = cut(seen.join(asked, "k", "left_semi"), "pairs")
            pairs = {tuple(r.k[1:].split(" ")): r.n for r in met.toLocalIterator()} if _within(met, "k", broadcast) else None
        if pairs is not None:
            return base.mapInArrow(_apply(spark.sparkContext.broadcast((*own, pairs, lexicon, heads)), texts), _FIXED)
    lexicon = {r.key: r.d for r in words.filter(F.col("n") >= bar).select("key", "d").toLocalIterator()}
    misread = {r.key for r in repairs.filter(F.col("n") >= bar).select("key").toLocalIterator()}  # words of the lexicon
    needs = cut(body.mapInArrow(_needs(set(lexicon) - misread), "k string, kind string, id bigint"), "needs")
    none = F.lit(None).cast("string").alias("meant"), F.lit(None).cast("array<struct<meant: string, score: double>>").alias("rivals")
    table = repairs.select(F.concat(F.lit("w"), "key").alias("k"), "meant", "rivals", F.col("meant_d").alias("n"))
    table = table.unionByName(running.select(F.concat(F.lit("h"), "key").alias("k"), *none, "n")).unionByName(sound.filter(F.col("n") < bar).select(F.concat(F.lit("c"), "key").alias("k"), *none, F.col("d").alias("n")))
    found = cut(_known(needs, table), "known")
    if not rivals.isEmpty():
        asked = cut(_with_own(body, found).filter("own is not null").mapInArrow(_asks(None), "k string, kind string, id bigint"), "asked")
        seen = once.mapInArrow(_pairs(None), "k string, n bigint").join(asked.select("k").distinct(), "k", "left_semi").groupBy("k").agg(F.sum("n").alias("n"))
        found = found.unionByName(_known(asked, seen.select("k", *none, "n")))
    return _with_own(base, found).mapInArrow(_apply_own(spark.sparkContext.broadcast(lexicon), texts), _FIXED)


def _known(needs: DataFrame, table: DataFrame) -> DataFrame:
    """What texts need, with what ``table`` knows of it; keys that many texts need stay spread."""
    weight = needs.groupBy("k").agg(F.count(F.lit(1)).alias("weight"))
    weighed = cut(table.join(weight, "k"), "weighed")
    return hot_cold_join(needs, weighed, "k", "weight", weighed.agg(F.sum("weight")).first()[0] or 0).drop("weight")


def _with_own(base: DataFrame, found: DataFrame) -> DataFrame:
    own = found.groupBy("kind", "id").agg(F.collect_set(F.struct("k", "meant", "rivals", "n")).alias("own"))  # what one text needs
    own = own.select(F.col("kind").alias("k1"), F.col("id").alias("k2"), "own")
    return base.join(own, base["kind"].eqNullSafe(own["k1"]) & base["id"].eqNullSafe(own["k2"]), "left").select("kind", "id", "text", "own")
