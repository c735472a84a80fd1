"""Pieces, scan repair, look-alikes, leaks, values and mixes on small cases."""

import math
import random
import unicodedata
from types import SimpleNamespace

import numpy as np
import pytest

from leafmill.llm import canon, leaks, lookalike, mixing, pieces, scanfix

TEXTS = "kind string, id bigint, text string, piece string, cut string"


def long_texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 12)))
    prose = "".join(word() + rng.choice([" ", " ", " ", ". ", "\n", "\n\n", "? "]) for _ in range(4000))
    run = "x" * 2500
    return [prose, prose[:2001], run, prose[:1900] + run + " " + prose[:900], "y" * 2000 + " z", prose[:50] + "w" * 1990 + " " + prose[:3000], " " * 2500, "अ " * 1500, prose[:1000] + "v" * 9000 + prose[:1000]]


def check_pieces(text, rows, limit=2000, overlap=200):
    rows = sorted(rows, key=lambda r: r.piece)
    assert [r.piece for r in rows] == list(range(len(rows)))
    assert rows[0].start == 0 and rows[-1].stop == len(text)
    for a, b in zip(rows, rows[1:], strict=False):
        assert a.start <= b.start <= a.stop < b.stop and a.stop - b.start <= overlap
    for r in rows:
        assert 0 < len(r.text) <= limit and r.text == text[r.start : r.stop]
        if r.cut not in ("forced", "end"):
            assert text[r.stop - 1] in " \t\n" or text[r.stop] in " \t\n"
    runs = max(map(len, text.replace("\t", " ").replace("\n", " ").split(" ")))
    assert any(r.cut == "forced" for r in rows) == (runs > limit)


@pytest.mark.parametrize("size", [65_536, 8_192, 4_000])
def test_pieces(spark, size):
    texts = long_texts()
    rows = [("t", k, t, "p", "c") for k, t in enumerate(texts)] + [("t", 90, None, "", ""), ("t", 91, "", "", ""), ("t", 92, "short", "", "")]
    got = {}
    for r in pieces.split_oversized(spark.createDataFrame(rows, TEXTS), range_chars=size).collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == set(range(len(texts)))
    for k, t in enumerate(texts):
        check_pieces(t, got[k])


def test_ranges_give_the_same_pieces(spark):
    df = spark.createDataFrame([("t", k, t, "", "") for k, t in enumerate(long_texts())], TEXTS)
    whole = sorted(map(tuple, pieces.split_oversized(df).collect()))
    assert sorted(map(tuple, pieces.split_oversized(df, range_chars=4_000).collect())) == whole
    assert sorted(map(tuple, pieces.split_oversized(df, range_chars=7_777).collect())) == whole


def test_texts_are_told_apart_by_themselves(spark):
    a, b = ("".join(random.Random(k).choice(["word ", "end. ", "\n\n", "verylongword" * 9]) for _ in range(3000)) for k in (7, 8))
    rows = [(None, 1, a), ("t", None, a), (None, None, b), ("t", 5, a), ("t", 5, b), ("t", 5, b)]
    out = pieces.split_oversized(spark.createDataFrame([(*r, "", "") for r in rows], TEXTS), range_chars=4_000).collect()
    whole = lambda t: sum(1 for _ in pieces.split_oversized(spark.createDataFrame([("t", 1, t, "", "")], TEXTS)).collect())
    n, m = whole(a), whole(b)
    count = lambda *key: sum((r.kind, r.id) == key for r in out)
    assert (count(None, 1), count("t", None), count(None, None), count("t", 5)) == (n, n, m, n + 2 * m)


def test_ranges_of_random_texts():
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["x" * rng.randint(1, 60), " ", "  ", ". ", "\n", "\n\n", '?" ', "अ", "  \n" * rng.randint(1, 40)]) for _ in range(rng.randint(1, 300)))
        limit, overlap = rng.choice([(50, 10), (40, 20), (20, 0), (100, 30)])
        runs = []
        for size in (10**6, 2 * limit, 2 * limit + 7, 5 * limit):
            halo, at, before, piece, seen = limit + overlap + pieces.LOOK, 0, 0, 0, []
            for own in range(0, len(text), size):
                base, end = max(0, own - halo), min(own + size, len(text))
                chunk = text[base : own + size + halo]
                first, exits, starts, n = pieces.trace(chunk, base, own, end, len(text), limit, overlap)
                if at >= end:
                    continue
                k, b = pieces.bisect_right(first, at) - 1, pieces.Boundaries(chunk, base, len(text))
                told = exits[k], starts[k], piece + n[k]
                while at < end:
                    s, e, kind = (int(x[0]) for x in pieces.steps(b, np.array([at]), limit, overlap))
                    seen.append(SimpleNamespace(piece=piece, start=max(s, before), stop=e, cut=pieces._KINDS[kind], text=text[max(s, before) : e]))
                    at, before, piece = e, s, piece + 1
                assert told == (at, before, piece)
            runs.append(seen)
        if len(text) > limit:
            check_pieces(text, runs[0], limit, overlap)
        assert all(r == runs[0] for r in runs)


def test_pieces_of_files(spark, tmp_path):
    text = "".join(random.Random(2).choice(["नमस्ते ", "word ", "é", "end. ", "\n\n", "tail "]) for _ in range(9000))
    (tmp_path / "a.txt").write_text(text, encoding="utf-8")
    ranges = pieces.file_ranges(spark, [str(tmp_path / "a.txt")], range_bytes=20_000)
    check_pieces(text, pieces.split_ranges(ranges).collect())


def test_no_pieces_of_nothing(spark):
    assert pieces.split_oversized(spark.createDataFrame([], TEXTS)).count() == 0


def test_canonical_forms():
    c = lookalike.canonical
    assert c("ｗｉｄｅ　Ａ１") == "wide A1"
    assert c("café") == c("café") != c("cafe")
    assert c("pаypаl") == "paypal" and c("Κ") == c("K") == "K"
    assert c("a​b\xadc⁠d﻿") == "abcd"
    assert c("ofﬁce ﬃ") == "office ffi"
    assert c("10\xa0kg") == c("10 kg") == c("10  kg") == "10 kg"
    assert c("m²") != c("m2") and c("Ω") == c("Ω") and c("µ") == c("μ")
    assert c("ज़") == c("ज़")
    assert c("क्‍ष") != c("क्ष")  # a joiner after a virama changes the print
    assert c("क‍ख") == c("कख")
    assert c("ẹ́") == c("ẹ́") == c("ẹ́")
    assert c("अा") == c("आ") == "आ" and c("अॉ") == c("आॅ") == "ऑ" and c("एे") == "ऐ" and c("अब") == "अब"
    assert c("\U00010404\U00010415") == "OC" and c("ꓢꓳ") == "SO" and c("\U0001d400") == "\U0001d400"
    assert c("\U000e0041a") == "a" and c("\U0002f800") == c("\u4e3d")
    assert c("") == "" and c("plain") == "plain" and c("a \n b\r\nc ") == "a\nb\nc"
    long = ("x" * 99 + "́ ") * 1000
    assert c(c(long)) == c(long)


def test_canonical_is_stable_and_agrees_with_whole_normalisation():
    rng = random.Random(3)
    pool = "abẹ́́̀क़़्‍‌ｆﬁµ²A \n 가각ō̄"
    for _ in range(3000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        once = lookalike.canonical(t)
        assert lookalike.canonical(once) == once
        assert lookalike.canonical(unicodedata.normalize("NFD", t)) == lookalike.canonical(unicodedata.normalize("NFC", t))


def test_lookalike_pairs(spark):
    rows = [(1, "same a"), (2, "same а"), (3, "same a"), (4, "other"), (5, None), (6, ""), (7, ""), (8, "same A"), (9, "ｓame a")] + [(100 + k, "copy") for k in range(50)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, form string, raw string")
    assert {tuple(r) for r in lookalike.lookalike_pairs(df).collect()} == {(1, 2), (2, 3), (1, 9), (2, 9), (3, 9)}
    assert {tuple(r) for r in lookalike.lookalike_pairs(df, hot=1).collect()} == {(1, 2), (2, 3), (1, 9), (2, 9), (3, 9)}
    assert {tuple(r) for r in lookalike.lookalike_groups(df).collect()} == {(1, 1, 2), (2, 1, 3), (3, 1, 2), (9, 1, 3)}
    assert lookalike.lookalike_pairs(df.limit(0)).count() == lookalike.lookalike_groups(df.limit(0)).count() == 0
    out = {r.doc_id: r.canonical for r in lookalike.canonical_texts(df).collect()}
    assert out[5] is None and out[6] == "" and out[2] == "same a"


def test_leaks(spark):
    item = "Suppose that Quill swaps the candle for 679 g of charged marble: which gearwheel stalls earlier than the silver kettle?"
    other = "Rank by mass the hollow prism, frosty cork and the nimble acorn that Jomo weighed at noon beside the canal."
    stock = "Choose the correct option and justify it in one word only now. "
    items = [(1, item), (2, other), (3, None), (4, "")] + [(10 + k, stock + w) for k, w in enumerate(["alpha beta", "gamma delta", "epsilon zeta", "eta theta", "iota kappa"])]
    filler = "the measured pattern spreads slowly while a student writes down what is seen in the evening of the second day. "
    changed = item.replace("charged", "heavy").replace("679 g ", "")
    docs = [
        (1, filler + item + filler, "a"),
        (2, filler + item.upper().replace(" ", "\n"), "b"),
        (3, filler + changed, "c"),
        (4, filler + " ".join(item.split()[:8]), "d"),
        (5, None, "e"),
        (6, "", "f"),
        (7, filler + stock, "g"),
        (8, filler + " ".join(other.split()[3:17]) + filler, "h"),
        (9, filler * 300 + item.replace("a", "а"), "i"),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    it = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, doc_id int")
    found = {(r.doc_id, r.item_id) for r in leaks.leaks(df, it).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (8, 2), (9, 1)}
    blocks = {(r.doc_id, r.item_id) for r in leaks.leaks(df, it, block_tokens=10).collect()}
    assert {p for p in blocks if p[1] < 10} == found
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(df, it, broadcast=0).collect()} == found
    assert leaks.leaks(df.limit(0), it).count() == 0
    assert leaks.leaks(df, it.limit(0)).count() == 0


def test_short_edited_leaks(spark):
    item = "quill swaps candle marble gearwheel stalls kettle prism cork acorn canal sledge walnut lantern pebble thimble".split()
    filler = "the measured pattern spreads slowly while a student writes".split()
    cases = {1: (12, [5]), 2: (13, [10]), 3: (12, [1]), 4: (16, [5, 10]), 5: (16, [3, 6, 9]), 6: (11, [])}
    docs = [(k, " ".join(filler + ["heavy" if n in at else w for n, w in enumerate(item[:size])] + filler)) for k, (size, at) in cases.items()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    assert {r.doc_id for r in leaks.leaks(df, it).collect()} == {1, 2, 3, 4}


def test_planted_passages_with_edits_are_found(spark):
    """Passages of 12 words or more, with an edit inside in every eight words at most, among words of the same vocabulary."""
    rng = random.Random(12)
    words = ["".join(rng.choice("bcdfgklmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(400)]
    items = {i: [rng.choice(words) for _ in range(rng.randint(14, 60))] for i in range(60)}
    docs, want = [], set()
    for k in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if k % 4:
            i = rng.randrange(60)
            size = rng.randint(12, len(items[i]))
            at = rng.randint(0, len(items[i]) - size)
            passage = items[i][at : at + size]
            for _ in range(rng.randint(0, size // 8)):
                n = rng.randint(1, len(passage) - 2)
                passage[n : n + rng.randint(0, 1)] = rng.choice([[], ["zzword"]])
            edits = size - sum((b.size for b in leaks.SequenceMatcher(None, items[i][at : at + size], passage, autojunk=False).get_matching_blocks()))
            text[10:10] = passage
            if edits <= size // 8 and len(passage) <= size + size // 8:
                want.add((k, i))
        docs.append((k, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    it = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in leaks.leaks(df, it).collect()}
    assert len(want) > 250 and len(want & found) >= 0.99 * len(want), sorted(want - found)[:5]
    assert len(found - want) <= 3


def test_stock_instructions_are_the_same_in_any_blocks(spark):
    stock = "choose the correct option and justify it in one word only now "
    items = [(k, stock + f"about thing{k} that matters") for k in range(4)]
    docs = spark.createDataFrame([(1, "filler " + stock + "filler"), (2, items[2][1])], "doc_id bigint, text string")
    whole = leaks.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert leaks.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_tokens=10).collect() == whole == []
    same = [*items[:3], (3, items[3][1]), (3, "another text under the same id")]
    assert leaks.leaks(docs, spark.createDataFrame(same, "item_id bigint, text string")).collect() == []


ENTRIES = [("axial_reagent", "Axial Reagent"), ("reagent", "Reagent"), ("dual_elasticity", "Dual Elasticity"), ("rate_of_forced_osmosis", "Rate Of Forced Osmosis"), ("isomer_efficiency", "Isomer Efficiency"), ("lomasts_law", "Lomast's Law"), ("forced_osmosis", "Forced Osmosis"), ("mitosis", "Mitosis"), ("meiosis", "Meiosis")]


TYPED = [
    ("Axial Reagnet", "axial_reagent"), ("reagent, axial", "axial_reagent"), ("Reagent (Axial)", "axial_reagent"), ("activ eelasticity", None), ("axialreagent", "axial_reagent"), ("axia lreagent", "axial_reagent"),
    ("What is dual elasticity?", "dual_elasticity"), ("Clual Elasticity", "dual_elasticity"), ("dua1 elasticity", "dual_elasticity"), ("rate of forced osrnosis", "rate_of_forced_osmosis"), ("Rape f forced osmosis", "rate_of_forced_osmosis"),
    ("efficiency (isomer)", "isomer_efficiency"), ("law of Lomast", "lomasts_law"), ("reagents", "reagent"), ("dual elasticіty", "dual_elasticity"), ("mitoosis", "mitosis"), ("me1osis", "meiosis"), ("axial balcony", None), ("see above", None), ("", None), ("???", None), ("12", None), ("x" * 5000, None), ("mtosis meosis", None), ("axi. reagent", "axial_reagent"),
    ("what is " * 30 + "dual elasticity", "dual_elasticity"),
]
#: Values that show which words only frame entries.
FRAMES = [f"what is {name}" for name in ("axial reagent", "reagent", "mitosis", "meiosis", "forced osmosis")]


def typed(spark, values, entries, **how):
    df = spark.createDataFrame([(1, list(dict.fromkeys([*values, *FRAMES])))], "load_id bigint, concepts array<string>")
    return {r.value: r.canonical_id for r in canon.map_to_list(df, "load_id", "concepts", spark.createDataFrame(entries, "canonical_id string, display_name string"), **how).collect()}


@pytest.mark.parametrize("most", [1_000, 0])
def test_free_typed_values(spark, most):
    got = typed(spark, [t for t, _ in TYPED], ENTRIES, most_framing=most)
    assert {t: got[t] for t, _ in TYPED} == dict(TYPED)


def test_long_values_and_tokens(spark):
    token = "pneumono" * 6
    name = " ".join(f"{a}{b}word" for a in "bcdfghk" for b in "aeiouy")
    entries = [*ENTRIES, ("long_token", f"{token} Disease"), ("long_name", name)]
    values = [f"{token[:-1]} disease", f"disease {token}", name.replace("bayword", "baywrd").replace("beword", "bewrd"), "x" * 5000]
    got = typed(spark, values, entries)
    assert [got[v] for v in values] == ["long_token", "long_token", "long_name", None]


def test_weights_of_tokens_decide_between_entries_at_equal_edits(spark):
    common = [(f"law_{w}", f"Law {w}") for w in ("gorvan", "heltic", "jundar", "kessim", "lubrin", "nordal", "ostrum")]
    entries = [*common, ("law_pravit", "Law Pravit"), ("lax_pravit", "Lax Pravit")]
    assert canon.osa("lab", "law", 2) == canon.osa("lab", "lax", 2) == 1
    assert typed(spark, ["lab pravit"], entries)["lab pravit"] == "law_pravit"
    entries = [(i.replace("law", "theory"), n.replace("Law", "Theory")) for i, n in common] + [("theory_pravit", "Theory Pravit"), ("theorx_pravit", "Theorx Pravit")]
    assert canon.osa("theorz", "theory", 2) == canon.osa("theorz", "theorx", 2) == 1
    assert typed(spark, ["theorz pravit"], entries)["theorz pravit"] == "theory_pravit"


def test_typed_values_against_all_entries(spark):
    """Every value against every entry, token by token, without index, join or framing."""
    rng = random.Random(4)
    names = ["Axial Reagent", "Dual Elasticity", "Rate Of Forced Osmosis", "Isomer Efficiency", "Mitosis", "Meiosis", "Thermal Axial Membrane", "Forced Valency", "Valency"]
    entries = [(canon.re.sub(r"\W+", "_", n.lower()), n) for n in names]
    values = set()
    for _ in range(250):
        w = list(rng.choice(names).lower())
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "e", "1", w[k] * 2])
        values.add("".join(w))
    bags = {cid: sorted(x for x in canon.words(n) if x not in canon.LINKING) for cid, n in entries}
    held = {t: sum(t in b for b in bags.values()) for b in bags.values() for t in b}
    idf, longest = {t: math.log(1 + len(bags) / n) for t, n in held.items()}, max(map(len, held))
    want = {}
    for v in values:
        parts, told = canon.words(v), []
        for w in parts:
            if w.rstrip(".") in canon.LINKING:
                continue
            known = w.rstrip(".") in held
            costs = {t: (canon.repair_cost(canon.forms(w, longest), t), None if known else canon.cut_cost(w, t)) for t in held}
            fixes = {t: min(x for x in c if x is not None) for t, c in costs.items() if c != (None, None)}
            if fixes or not canon.idle(w):
                told.append(fixes)
        short, found = len(parts) == 1 and len(parts[0]) < 5, {}
        for cid, bag in bags.items():
            if told and len(bag) == len(told) and (chosen := canon.assign(told, bag)) is not None and sum(told[k][t] for k, t in chosen.items()) <= (1 if short else 2):
                found[cid] = canon.soft_tfidf(told, chosen, idf)
            run, name = "".join(w.rstrip(".").replace("'", "") for w in parts), "".join(w.rstrip(".") for w in canon.words(dict(entries)[cid]))
            if len(run) >= 5 and (n := canon.osa(run, name, 1) + canon.JOINED) <= (1 if short else 1 + canon.JOINED):
                found[cid] = max(found.get(cid, 0), 1 - n / (len(name) + 1))
        top = sorted(found.items(), key=lambda x: -x[1])
        want[v] = top[0][0] if top and (len(top) < 2 or top[0][1] - top[1][1] >= canon.LEAD) else None
    df = spark.createDataFrame([(v, 1) for v in values], "value string, n bigint")
    got = {r.value: r.canonical_id for r in canon.match_values(df, spark.createDataFrame(entries, "canonical_id string, display_name string")).collect()}
    assert got == want and sum(x is not None for x in want.values()) > 60


def test_map_to_list(spark):
    rows = [(1, ["Axial Reagent", "axial reagnet", "axial reagnet", None, "", "kite"]), (2, None), (3, []), (4, ["axial reagnet"]), (4, ["axial reagnet"])]
    df = spark.createDataFrame([(i, c, "v") for i, c in rows], "load_id bigint, concepts array<string>, value string")
    entries = spark.createDataFrame([*ENTRIES, (None, None), ENTRIES[0]], "canonical_id string, display_name string")
    got = [(r.load_id, r.value, r.canonical_id, r.how) for r in canon.map_to_list(df, "load_id", "concepts", entries).collect()]
    one = (4, "axial reagnet", "axial_reagent", "repaired")
    assert sorted((r for r in got if r[0] == 1), key=str) == sorted([(1, "Axial Reagent", "axial_reagent", "key"), (1, "axial reagnet", "axial_reagent", "repaired"), (1, "", None, "none"), (1, "kite", None, "none")], key=str)
    assert [r for r in got if r[0] == 4] == [one, one] and not [r for r in got if r[0] in (2, 3)]
    assert canon.map_to_list(df.limit(0), "load_id", "concepts", entries).count() == 0
    assert {r.how for r in canon.map_to_list(df, "load_id", "concepts", entries.limit(0)).collect()} == {"none"}


def test_osa_and_deletions():
    assert canon.osa("abcd", "abdc", 2) == 1 and canon.osa("abc", "abc", 2) == 0 and canon.osa("abcdef", "x", 2) == 3
    assert canon.deletions("abc", 1) == {"abc", "ab", "ac", "bc"}


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_scan_repair(spark, broadcast):
    good = "the plotted graph shows how the small fragment of the reading settles before the evening and the colour-shift remains constant while the surface changes"
    body = [("page", k, good, "x") for k in range(60)]
    noisy = [
        (100, "the pl0tted graph sbows the srnall fragment\nof the reading settles", {"chars"}),
        (101, "the plotted graph shows the frag-\nment of the reading", {"hyphen"}),
        (102, "the colour-\nshift remains constant", set()),
        (103, "the small reading set¬\n- 12 -\ntles before the evening", {"hyphen", "pageno"}),
        (104, "Membrane And Synapse | 44\nthe small reading settles", {"header"}),
        (105, "3.2 Membrane\n43   82   89\nReading 4: 58 K\nthe small reading", set()),
        (106, "xxiv\nthe small reading", {"pageno"}),
        (107, "", set()),
        (109, "OPEN B0ARD\nthe small reading", {"header"}),
    ]
    boards = [("resource", 200 + k, f"Open Board\nthe small reading {k} settles", "x") for k in range(6)]
    rows = [*body, *(("page", i, t, "x") for i, t, _ in noisy), ("page", 108, None, "x"), *boards, ("page", 101, noisy[1][1], "x")]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, noise string")
    titles = spark.createDataFrame([("Membrane And Synapse ",), (None,), ("",)], "t string")
    got = {}
    for r in scanfix.repair_scans(df, titles, broadcast=broadcast).collect():
        got.setdefault((r.kind, r.id), []).append(r)
    for i, _, kinds in noisy:
        assert set(got["page", i][0].noise) == kinds, i
    assert len(got["page", 101]) == 2 and got["page", 108][0].text is None and got["page", 107][0].text == ""
    assert got["page", 100][0].text == "the plotted graph shows the small fragment of the reading settles"
    assert got["page", 103][0].text == "the small reading settles before the evening"
    assert got["page", 102][0].text == "the colour-shift remains constant"
    assert got["page", 105][0].text == "3.2 Membrane\n\n43 82 89\n\nReading 4: 58 K\n\nthe small reading"
    assert scanfix.repair_scans(df.limit(0), titles.limit(0), broadcast=broadcast).count() == 0


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_scan_repair_knows_rare_words(spark, broadcast):
    rare = ["a flat ground", "some fiat money", "the membrane grew", "a cross-hatch and the shift"]
    rows = [("page", k, "the plotted graph shows how the small fragment settles before the evening", "x") for k in range(300)]
    rows += [("page", 1000 + k, rare[k % 4], "x") for k in range(160)]
    rows += [("page", 2000, "a f1at ground", "x"), ("page", 2001, "some f1at money", "x"), ("page", 2002, "the mernbrane grew", "x"), ("page", 2003, "a cross-\nhatch and", "x")]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, noise string")
    out = scanfix.repair_scans(df, spark.createDataFrame([], "t string"), share=0.02, broadcast=broadcast).filter("id >= 2000")
    want = {2000: (["chars"], "a flat ground"), 2001: (["chars"], "some fiat money"), 2002: (["chars"], "the membrane grew"), 2003: ([], "a cross-hatch and")}
    assert {r.id: (r.noise, r.text) for r in out.collect()} == want


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_scan_repair_of_a_text_that_holds_a_third_of_all_rows(spark, broadcast):
    hot = "the srnall fragment was sca1ed here"
    rows = [("page", k, f"reading {k} of the small fragment", "x") for k in range(100)] + [("page", 100 + k, f"figure {k} is scaled", "x") for k in range(6)]
    rows += [("page", 1000 + k, hot, "x") for k in range(2000)]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, noise string")
    out = scanfix.repair_scans(df, spark.createDataFrame([], "t string"), broadcast=broadcast)
    got = {(r.id >= 1000, tuple(r.noise), r.text if r.id >= 1000 else "") for r in out.collect()}
    assert got == {(True, ("chars",), "the small fragment was scaled here"), (False, (), "")}


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_scan_repair_of_a_misread_compound_broken_at_its_hyphen(spark, broadcast):
    rows = [("page", k, f"reading {k} of the colour-shift remains", "x") for k in range(40)]
    rows += [("page", 100, "the c0lour-shift remains", "x"), ("page", 101, "the c0lour-\nshift remains", "x")]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, noise string")
    out = scanfix.repair_scans(df, spark.createDataFrame([], "t string"), broadcast=broadcast).filter("id >= 100").collect()
    assert {(tuple(r.noise), r.text) for r in out} == {(("chars",), "the colour-shift remains")} and len(out) == 2


def test_running_titles_recur_within_documents(spark):
    rows = [("page", k, f"Red Kettle\nreading {k} of the small fragment" if k % 80 == 0 else f"reading {k} of the small fragment", f"book{k}") for k in range(400)]
    rows += [("page", 1000 + k, f"Blue Lantern\nnote {k} about the evening", f"own{k // 3}") for k in range(6)] + [("page", 1006, "Blue Lantern\nthe last note", "elsewhere")]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, doc string")
    out = scanfix.repair_scans(df, spark.createDataFrame([], "t string")).collect()
    assert {r.id for r in out if "header" in r.noise} == set(range(1000, 1007))


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_scan_repair_of_long_words_and_of_capitals_in_context(spark, broadcast):
    long = "electroencephalographically" * 3
    rows = [("page", k, f"{long} seen {k}", "x") for k in range(30)] + [("page", 100 + k, f"an old farm {k} stood", "x") for k in range(60)] + [("page", 200 + k, f"the new form {k} fills", "x") for k in range(60)]
    rows += [("page", 1000, long.replace("electro", "e1ectro", 1) + " seen", "x"), ("page", 1001, "an old F0rm stood", "x"), ("page", 1002, "the new F0rm fills", "x"), ("page", 1003, "an old f0rm stood", "x")]
    rows += [("page", 300 + k, f"the f0rm {k}", "x") for k in range(3)]
    df = spark.createDataFrame(rows, "kind string, id bigint, text string, noise string")
    twice = df.unionByName(spark.createDataFrame([("page", 5000 + k, f"quite unrelated words {k % 7} fill this text", "x") for k in range(400)], df.schema))
    for items in (df, twice):
        out = {r.id: (r.noise, r.text) for r in scanfix.repair_scans(items, spark.createDataFrame([], "t string"), broadcast=broadcast).filter("id between 1000 and 1003").collect()}
        assert out[1000] == (["chars"], f"{long} seen") and out[1002] == (["chars"], "the new Form fills")
        assert out[1001][0] == out[1003][0] == ["chars"] and out[1001][1].lower() == out[1003][1]


def test_gaps_of_long_words_meet():
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choice("abcdefghiklmnorstuv") for _ in range(rng.randint(40, 80)))
        read = word
        for _ in range(3):
            a, b = rng.choice(scanfix.CONFUSIONS)
            at = read.find(b)
            read = read[:at] + a + read[at + len(b) :] if at >= 0 else read
        if scanfix.distance(read, word) < 9:
            assert scanfix.gaps(read, False) & scanfix.gaps(word, True), (read, word)


def test_weighted_distance():
    d = scanfix.distance
    assert d("srnall", "small") == pytest.approx(0.3) and d("pl0ttecl", "plotted") == pytest.approx(0.6)
    assert d("small", "small") == 0 and d("smell", "smalls") > 1


def test_budget_goes_to_siblings_first():
    leaves = {("a", "en", "x"): (0.5, 10.0), ("a", "en", "y"): (0.2, 1000.0), ("b", "en", "z"): (0.3, 1000.0), ("b", "en", "none"): (0.0, 1000.0)}
    got = mixing.budget(leaves, 100.0)
    assert got[("a", "en", "x")] == pytest.approx(10) and got[("a", "en", "y")] == pytest.approx(60) and got[("b", "en", "z")] == pytest.approx(30) and got[("b", "en", "none")] == 0
    short = mixing.budget({("a", "en", "x"): (0.5, 10.0), ("b", "en", "z"): (0.5, 1000.0)}, 100.0)
    assert short[("a", "en", "x")] == pytest.approx(10) and short[("b", "en", "z")] == pytest.approx(90)
    assert mixing.budget({}, 5.0) == {}


def test_mix(spark):
    rng = random.Random(6)
    docs = [(k, " ".join(["word"] * rng.randint(5, 60)), "big" if k % 3 else "small" if k % 6 else "tiny", "en", "Bio") for k in range(900)]
    docs += [(1000, None, "big", None, None), (1001, "free words", None, "en", "x"), (1002, "un listed", "other", "en", "x"), (1003, "", "big", "en", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string, subject string")
    goals = spark.createDataFrame([("big", 0.6, 4), ("small", 0.3, 4), ("tiny", 0.05, 1), ("absent", 0.05, 8), ("off", 0.0, 2), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    shares, leaves, chosen = mixing.mix(df, goals)
    by = {r.source: r for r in shares.collect()}
    assert by["absent"].short and not by["off"].short and not by["big"].short
    assert set(by) == {"big", "small", "tiny", "absent", "off"}
    for s in ("big", "small"):
        assert by[s].mixed_tokens == pytest.approx(by[s].budget_tokens, abs=80)
    rows = chosen.collect()
    assert all(1 <= r.times <= 4 for r in rows) and {r.source for r in rows} == {"big", "small", "tiny"}
    assert sum(r.actual_share for r in by.values()) == pytest.approx(1)
    assert sorted(map(tuple, mixing.mix(df, goals).selection.collect())) == sorted(map(tuple, rows))
    assert mixing.mix(df.limit(0), goals).selection.count() == 0 and mixing.mix(df, goals.limit(0)).selection.count() == 0
    assert sorted((r.doc_id, r.times) for r in mixing.mix(df, goals, range_rows=20).selection.collect()) != [] and sum(r.mixed_tokens for r in leaves.collect()) == sum(r.tokens * r.times for r in rows)


def test_mix_of_one_source_in_two_languages(spark):
    rng = random.Random(9)
    docs = [(k, " ".join(["word"] * rng.randint(5, 60)), "both" if k % 2 else "only", "hi" if k % 6 == 1 else "en", "Bio") for k in range(1200)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string, subject string")
    goals = spark.createDataFrame([("both", 0.7, 2), ("only", 0.3, 1)], "source string, target_share double, max_repeats int")
    for rows in (50_000, 40):
        shares, leaves, _ = mixing.mix(df, goals, range_rows=rows)
        by = {(r.source, r.lang): r for r in leaves.collect()}
        assert set(by) == {("both", "hi"), ("both", "en"), ("only", "en")}
        assert by["both", "hi"].wanted_tokens / by["both", "en"].wanted_tokens == pytest.approx(by["both", "hi"].leaf_tokens / by["both", "en"].leaf_tokens)
        assert all(abs(r.mixed_tokens - r.budget_tokens) < 61 for r in by.values()) and not any(r.short for r in shares.collect())
    tight = mixing.mix(df, spark.createDataFrame([("both", 0.9, 1), ("only", 0.1, 1)], "source string, target_share double, max_repeats int"))
    by, leaf = {r.source: r for r in tight.shares.collect()}, {(r.source, r.lang): r for r in tight.leaves.collect()}
    assert by["both"].short and not by["only"].short and leaf["both", "hi"].unplaced_tokens > 0
    assert by["only"].budget_tokens == pytest.approx(by["only"].source_tokens)  # its siblings' shortage
    with pytest.raises(ValueError):
        mixing.mix(df, goals, most_leaves=2)
