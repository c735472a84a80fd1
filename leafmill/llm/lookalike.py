"""Problem 9: visually identical text with different characters.

Method: quick-check properties.  A table of unstable characters, derived from Unicode properties, isolates the
segments that can change; only those are normalised, each together with the character it leans on, and spliced
back into the unchanged text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from ..plans.skew import HOT_ONE_IN, grid_join, hot_cold_join

# Letters of other scripts that are printed like a Latin letter.
GREEK_CAPITALS = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϺ", "ABEZHIKMNOPTYXCM", strict=True))
GREEK_SMALL = dict(zip("ονϲϳ", "ovcj", strict=True))
CYRILLIC_CAPITALS = dict(zip("АВЕЅІЈКМНОРСТХҮԌԜԚҺ", "ABESIJKMHOPCTXYGWQh", strict=True))
CYRILLIC_SMALL = dict(zip("аеоорсухѕіјһԁԛԝү", "aeoopcyxsijhdqwy", strict=True))
LATIN_SHAPES = {"ɡ": "g", "ɑ": "a"}
ARMENIAN = {"ո": "n", "օ": "o", "Տ": "S", "ս": "u", "հ": "h"}
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏚᏙᏞᏟᏢᏦᏴ", "DRTAJEWMHGZSVLCPKB", strict=True))
DESERET = dict(zip("𐐄𐐕𐐛𐐠𐐬𐐽𐑈", "OCLSocs", strict=True))
LYCIAN = dict(zip("𐊂𐊆𐊇𐊐𐊒𐊕𐊖𐊗", "BEFXOPST", strict=True))
SIGNS = {"µ": "μ", "‐": "-", "‑": "-", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "Ⅰ": "I", "Ⅴ": "V", "Ⅹ": "X", "Ⅼ": "L", "Ⅽ": "C", "Ⅾ": "D", "Ⅿ": "M"}
# Sequences of Devanagari letters that are printed like one letter.
VOWELS = {"अा": "आ", "अॅ": "ॲ", "अॆ": "ऄ", "अॉ": "ऑ", "अॊ": "ऒ", "अो": "ओ", "अौ": "औ", "अऺ": "ॳ", "अऻ": "ॴ", "अॏ": "ॵ", "अॖ": "ॶ", "अॗ": "ॷ", "आॅ": "ऑ", "आॆ": "ऒ", "आे": "ओ", "आै": "औ", "आऺ": "ॴ", "उु": "ऊ", "एॅ": "ऍ", "एॆ": "ऎ", "एे": "ऐ", "र्इ": "ई"}
#: Rows from which a key can be hot.
HOT = 10_000
VIRAMA = 9  # combining class; joiners after such a sign change what is printed


@cache
def _tables() -> tuple[re.Pattern[str], dict[int, str | None]]:
    """(unstable segments, folding of single characters), from Unicode properties and the lists above."""
    fold: dict[int, str | None] = {}
    unstable: list[str] = []
    for n in [*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]:  # no character elsewhere is unstable
        c = chr(n)
        kind, tag = unicodedata.category(c), unicodedata.decomposition(c).partition(">")[0]
        if kind == "Zs":
            fold[n] = " "
        elif kind == "Cf" or 0xFE00 <= n <= 0xFE0F or n in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164):
            fold[n] = None
        elif tag in ("<wide", "<narrow") or 0xFB00 <= n <= 0xFB06 and n != 0xFB05:
            fold[n] = unicodedata.normalize("NFKC", c)
        if n in fold or unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c) or 0x1100 <= n < 0x1200:
            unstable.append(c)
    for table in (GREEK_CAPITALS, GREEK_SMALL, CYRILLIC_CAPITALS, CYRILLIC_SMALL, LATIN_SHAPES, ARMENIAN, LISU, CHEROKEE, DESERET, LYCIAN, SIGNS):
        for c, to in table.items():
            if c != to:
                fold[ord(c)] = to
                unstable.append(c)
    ranges, codes = [], sorted({ord(c) for c in unstable})
    at = 0
    while at < len(codes):
        end = at
        while end + 1 < len(codes) and codes[end + 1] == codes[end] + 1:
            end += 1
        ranges.append(f"\\U{codes[at]:08x}-\\U{codes[end]:08x}")
        at = end + 1
    return re.compile(f"[{''.join(ranges)}]+"), fold


@lru_cache(100_000)
def _segment(text: str) -> str:
    fold = _tables()[1]
    while True:  # what is taken out can bring marks together; a second round is rare
        out: list[str] = []
        for c in unicodedata.normalize("NFC", text):
            if c in "\u200c\u200d" and out and out[-1] and unicodedata.combining(out[-1][-1]) == VIRAMA:
                out.append(c)
            elif kept := fold.get(ord(c), c):
                out.append(kept)
        made = unicodedata.normalize("NFC", "".join(out))
        if made == text:
            return made
        text = made


_BEYOND = re.compile(r"[^\x00-\x7f]+")  # where alone unstable characters are
_VOWELS = re.compile("[अआउए][\u093a\u093b\u093e\u0941\u0945-\u094c\u094f\u0956\u0957]|र्इ")
_BLANKS = re.compile(r"[ \t]+(?=\n)|[ \t]{2,}|\t|\r\n?|[ \t]+\Z|\A[ \t]+|(?<=\n)[ \t]+")


def letters(text: str) -> str:
    """``canonical`` but for the blanks: unstable segments, each with the character before it, in one form."""
    if text.isascii():
        return text
    out, done, unstable = [], 0, _tables()[0]
    for run in _BEYOND.finditer(text):
        for m in unstable.finditer(text, run.start(), run.end()):
            at = max(m.start() - 1, done)
            out += (text[done:at], _segment(text[at : m.end()]))
            done = m.end()
    out.append(text[done:])
    made = "".join(out)
    if not unicodedata.is_normalized("NFC", made):  # a mark at a segment's end may lean further back than its segment
        made = unicodedata.normalize("NFC", made)
    while (one := _VOWELS.sub(lambda m: VOWELS.get(m[0], m[0]), made)) != made:
        made = one
    return made


def canonical(text: str) -> str:
    """One form for all texts that read the same on paper, and for no others.

    Widths of letters and blanks, invisible characters, ways of coding an accent, ligatures and look-alike letters of
    other scripts are made one, and so are Devanagari vowels written as several signs; case, accents, raised digits, marks, styled
    letters (bold, script, sans-serif) and line breaks stay.  Look-alike letters are those of the lists above; all of Unicode's planes
    are looked through for the rest.
    """
    text = letters(text)
    if text[:1] in (" ", "\t") or text[-1:] in (" ", "\t") or any(x in text for x in ("  ", "\t", "\r", " \n", "\n ")):
        text = _BLANKS.sub(lambda m: "\n" if m[0][0] == "\r" else "" if m.end() == len(text) or m.start() == 0 or text[m.start() - 1] == "\n" or text[m.end()] in "\n\r" else " ", text)
    return text


def _canonical_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [None if t is None else canonical(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["id", "canonical"])


def canonical_texts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, canonical) for every row; null text stays null, empty text empty."""
    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(_canonical_batches, f"id {kind}, canonical string").select(F.col("id").alias(doc_id), "canonical")


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, raw, made = [], [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if t is not None:
                ids.append(i)
                raw.append(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                made.append(hashlib.blake2b(canonical(t).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(made, pa.binary()), pa.array(raw, pa.binary())], names=["id", "form", "raw"])


def lookalike_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, form, raw): 128-bit digests of the canonical and of the stored text; rows with null text are left out."""
    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("t")).mapInArrow(_key_batches, f"id {kind}, form binary, raw binary").select(F.col("id").alias(doc_id), "form", "raw")


def _stored(documents: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(keyed, many): digests by document, and the stored texts (form, raw, n, first, v, docs, least) of forms with more than one."""
    keyed = cut(lookalike_classes(documents, doc_id, text), "forms")
    forms = cut(keyed.groupBy("form", "raw").agg(F.count(F.lit(1)).alias("n"), F.min(doc_id).alias("first")), "stored")
    several = forms.groupBy("form").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("docs"), F.min("first").alias("least")).filter("v > 1")
    return keyed, cut(forms.join(several, "form"), "variants")


def _held(keyed: DataFrame, many: DataFrame, doc_id: str) -> DataFrame:
    """Documents of forms with more than one stored text, with what ``many`` says of theirs."""
    total = many.agg(F.sum("n")).first()[0] or 0
    return hot_cold_join(keyed.select("raw", doc_id), many.drop("form", "first"), "raw", "n", total)


def lookalike_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links): of every document that looks like another but is stored differently, the least document of its class and how many such others there are.

    One row a document, however large its class.  Null text is in no class; copies alone make none.
    """
    keyed, many = _stored(documents, doc_id, text)
    return _held(keyed, many, doc_id).select(doc_id, F.col("least").alias("class_id"), (F.col("docs") - F.col("n")).alias("n_links"))


def lookalike_pairs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents whose stored texts differ but read the same on paper.

    Stored forms are paired first, documents only then, so a class of nothing but exact copies makes no pair and no
    work, however large it is.  Forms of ``hot`` stored texts and stored texts of ``hot`` documents or more, and no less than one in HOT_ONE_IN of all, are
    dealt over a grid of tasks.  Two empty texts are copies; null text pairs with nothing.
    """
    keyed, many = _stored(documents, doc_id, text)
    held = cut(_held(keyed, many, doc_id).select("raw", doc_id), "held")
    texts, docs = many.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    wide = many.filter(F.col("v") >= max(hot, texts // HOT_ONE_IN)).select("form").distinct()
    large = many.filter(F.col("n") >= max(hot, docs // HOT_ONE_IN)).select("raw")
    one, two = many.select("form", F.col("raw").alias("ra")), many.select("form", F.col("raw").alias("rb"))
    pairs = grid_join(one, two, "form", wide, "ra", "rb").filter("ra < rb").select("ra", "rb")
    ids: Column = F.col(doc_id)
    left = grid_join(pairs, held.select(F.col("raw").alias("ra"), ids.alias("i")), "ra", large.select(F.col("raw").alias("ra")), "rb", "i")
    both = grid_join(left.select("rb", "i"), held.select(F.col("raw").alias("rb"), ids.alias("j")), "rb", large.select(F.col("raw").alias("rb")), "i", "j")
    return both.select(F.least("i", "j").alias("doc_id_a"), F.greatest("i", "j").alias("doc_id_b"))
