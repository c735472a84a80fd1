"""Resources, images, vocabulary, candidates, lists, statistics, sources and streaming."""

import json
import random
from difflib import SequenceMatcher
from zlib import crc32

import pyarrow as pa
from pyspark.sql import functions as F

from leafmill.functions import concept_lists, text as T
from leafmill.functions.python import similarity, title_case
from leafmill.operators import concepts as C
from leafmill.operators import layout, resources as R, stats as A, tables as B, vocabulary as V
from leafmill.plans.scan import running
from leafmill.plans.skew import dense_ids, hot_cold_join
from leafmill.sources import readers, writers
from leafmill.streaming.incremental import follow

CHUNK = "doc_id string, chunk_seq bigint, chunk_type string, class_no int, subject string, chapter_no int, chapter_title string, section string, section_no string, subsection string, text string, equations array<string>, page_start int, page_end int, figure_references array<string>"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_running_equals_a_plain_window(spark):
    rng = random.Random(1)
    rows = [("h" if k % 3 else f"d{k % 5}", k, rng.choice([None, "a", "b"]), rng.randint(0, 3)) for k in range(500)]
    df = spark.createDataFrame(rows, "doc string, seq int, v string, n int").withColumn("block", F.floor(F.col("seq") / 7).cast("int"))
    got = {r.seq: (r.s, r.l) for r in running(df, "doc", "block", ["seq"], sums={"s": F.col("n")}, lasts={"l": F.col("v")}).collect()}
    state = {}
    for d, k, v, n in rows:
        s, last = state.get(d, (0, None))
        state[d] = (s + n, v or last)
        assert got[k] == state[d]


def test_dense_ids_and_hot_join(spark):
    words = spark.createDataFrame([(w, 1) for w in "the quick brown fox jumps over lazy dogs".split()], "w string, n long").repartition(5)
    assert [r.w for r in dense_ids(words, "w").orderBy("id").collect()] == sorted(r.w for r in words.collect())
    assert sorted(r.id for r in dense_ids(words, "w").collect()) == list(range(8))
    left = spark.createDataFrame([("hot", k) for k in range(50)] + [("cold", 1), (None, 2), ("gone", 3)], "k string, v int")
    right = spark.createDataFrame([("hot", 50, "x"), ("cold", 1, "y")], "k string, n long, z string")
    assert hot_cold_join(left, right, "k", "n", 51, one_in=10).groupBy("z").count().orderBy("z").collect() == [("x", 50), ("y", 1)]


def test_identifiers_and_forms(spark):
    f = lambda fn, s: one(spark, fn(F.lit(s)))
    assert f(T.canonicalize, " Newton's First-Law (2nd) ") == "newtons_first_law_2nd"
    assert f(T.display_form, "  DNA  double helix aTP ") == "DNA Double Helix Atp"
    assert f(T.image_number, "IMG_1234") == "1234" and f(T.image_number, "IMG_7") == "007"
    assert one(spark, T.section_slug(F.lit("4.2"), F.lit(None))) == "S4_2" and one(spark, T.section_slug(F.lit(None), F.lit("--"))) == "X"
    assert f(T.figure_references, "See Fig. 2.1, figure 1.3a and Fig 2.1") == ["1.3a", "2.1"]
    assert f(T.word_set, "The the An atom's") == ["the", "atom"]
    assert layout._plain("<p>a &lt; b</p><li>c</li>d<br/>e", False) == "a < b\nc\nd\ne"
    df = spark.createDataFrame([("NEWTON'S LAWS-OF (MOTION) 2nd", "alkali metals", "alkaline metals"), (None, None, "x")], "t string, a string, b string")
    r = df.select(title_case("t").alias("t"), similarity("a", "b").alias("s")).collect()
    assert r[0].t == "Newton'S Laws-Of (Motion) 2Nd" and abs(r[0].s - SequenceMatcher(None, "alkali metals", "alkaline metals").ratio()) < 1e-9 and r[1].t is None


def chunks(spark):
    base = ("Physics", 1, "T")
    rows = [
        ("d", 1, "content", None, *base, "Intro", "1.1", None, "text one", [], 1, 2, []),
        ("d", 2, "terminal_exercise", 12, *base, "Intro", "1.1", None, "ask", [], 2, 3, []),
        ("d", 3, "nonsense", 12, *base, "Intro", "1.1", None, "  ", [], 3, 2, []),
        ("d", 4, "content", 12, *base, None, None, None, "last", [], 4, 4, []),
    ]
    return spark.createDataFrame(rows, CHUNK)


def test_build_and_validate(spark):
    pages = spark.createDataFrame([("d", 3, ["x=1"]), ("d", 9, [])], "doc_id string, page_no int, equations array<string>")
    built = R.build(chunks(spark), F.lit("DOC"), pages, R.OPEN_CHUNK_TO_TYPE, class_no=11)
    good, bad = R.validate(built)
    assert [(r.resource_id, r.resource_type, r.has_equation) for r in good.orderBy("chunk_seq").collect()] == [("TXT_11_CH01_S1_1_001", "explanation", False), ("EX_12_CH01_S1_1_001", "exercise", True), ("TXT_12_CH01_X_001", "explanation", False)]
    assert bad.first().errors == ["empty text", "page_end before page_start"]
    handled = R.build(chunks(spark), F.lit("DOC"), None, R.OPEN_CHUNK_TO_TYPE, handlers={"exercise": lambda df: df.select("doc_id", "chunk_seq", "document_id", F.lit("mine").alias("resource_id"), "resource_type")})
    assert handled.filter("resource_id = 'mine'").count() == 1


def test_images(spark):
    res = R.validate(R.build(chunks(spark), F.lit("DOC"), None, R.OPEN_CHUNK_TO_TYPE))[0]
    images = spark.createDataFrame([("d", "IMG_1", 2, "p/1.png", None), ("d", "IMG_1234", 77, "p/2.png", "c"), ("z", None, 1, "p/3.png", None), ("d", "IMG_9", None, "p/4.png", None)], "doc_id string, image_id string, page_no int, image_path string, caption string")
    got = {r.image_path: r for r in R.diagrams(res, images).collect()}
    assert got["p/1.png"].resource_id == "IMG_12_CH01_001" or got["p/1.png"].resource_id.endswith("_001")
    assert got["p/1.png"].section == "Intro" and got["p/2.png"].resource_id.endswith("_1234") and got["p/3.png"].resource_id == "IMG_12_CH00_000" and got["p/4.png"].page_start is None
    assert R.multimodal(res, images).filter("figure_references is null").count() == 0


def test_concept_lists(spark):
    cases = {'```json\n["A", "b ", 1, null, {"x": 2}, "a"]\n```': ["A", "b ", "a"], "sure: [\"x\"] and [\"y\"]": ["x"], "none": [], "[broken": [], '["open", ]': [], "[]": [], None: []}
    for raw, want in cases.items():
        assert one(spark, concept_lists.concept_list(F.lit(raw))) == want, raw
    assert one(spark, concept_lists.concept_list(F.lit('["A", "b ", " ", "a"]'), distinct=True)) == ["A", "b"]
    assert one(spark, concept_lists.accepted(F.lit('["static FRICTION ", "x", "Static Friction"]'), F.array(F.lit("Static Friction"), F.lit("Force")))) == ["Static Friction", "Static Friction"]


def brute_near(a, b):
    import re

    x, y = (re.sub(r"[^a-z0-9 ]", "", t.lower().replace("'s", "s")) for t in (a, b))
    if x == y or (len(x) > 5 and x in y) or (len(y) > 5 and y in x):
        return True
    if any(x.replace(p, q) == y or x == y.replace(p, q) for p, q in T.SPELLINGS):
        return True
    return SequenceMatcher(None, x, y).ratio() > 0.92


def test_near_duplicates_and_clusters(spark):
    rng = random.Random(5)
    stems = ["centre of mass", "alkali metals", "photosynthesis reaction", "magnetic field lines", "colour of light", "law of motion"]
    terms = set()
    for s in stems:
        terms.add(s)
        for _ in range(12):
            t = list(s)
            for _ in range(rng.randint(1, 2)):
                k = rng.randrange(len(t))
                t[k : k + 1] = rng.choice(["", rng.choice("abcs"), t[k] * 2])
            terms.add("".join(t))
    terms |= {"center of mass", "color of light", "mass", "metals", "Alkali-Metals", "law", "laws of motion"}
    counts = {t: rng.randint(1, 9) for t in terms if t.strip()}
    order = sorted(counts, key=lambda t: (-counts[t], t))
    df = spark.createDataFrame(list(counts.items()), "term string, n long")
    pairs = {(r.a, r.b) for r in V.near_duplicates(df).collect()}
    assert pairs == {(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if brute_near(a, b)}
    canon = {}
    for t in order:
        if t not in canon:
            canon[t] = t
            for o in order:
                if o not in canon and ((t, o) in pairs or (o, t) in pairs):
                    canon[o] = t
    assert {r.term: r.canonical for r in V.cluster(df).collect()} == canon


def test_vocabulary(spark):
    recs = spark.createDataFrame([(k, ["Static Friction", "static friction", "Torque ", "New Term"]) for k in range(3)] + [(9, ["new term", None, ""]), (10, None)], "id int, concepts array<string>")
    structural = spark.createDataFrame([("torque", "Torque", 5, "structural")], "canonical_id string, display_name string, frequency int, source string")
    assert {(r.term, r.n) for r in V.term_counts(recs, "id").collect()} == {("Static Friction", 3), ("Torque", 3), ("New Term", 3), ("new term", 1)}
    out = V.build(recs, "id", structural)
    assert {(r.canonical_id, r.display_name, r.frequency, r.source) for r in out["vocabulary"].collect()} == {("torque", "Torque", 5, "structural"), ("static_friction", "Static Friction", 3, "extracted"), ("new_term", "New Term", 4, "extracted")}
    assert out["rejected"].count() == 0 and [tuple(r) for r in out["merge_map"].collect()] == [("new term", "New Term")]


def test_candidates(spark):
    vocab = spark.createDataFrame([(f"c{k}", n, k, "structural" if k % 2 else "extracted", k) for k, n in enumerate(["Static Friction", "Friction", "ion", "Normal Force", "Quark", "Lepton"])], "canonical_id string, display_name string, frequency int, source string, vocab_ord int")
    rows = spark.createDataFrame([(1, "Laws", None, None, "Static friction acts with force on ions"), (2, None, None, None, None)], "id int, chapter_title string, section string, subsection string, summary string")
    got = {}
    for r in C.candidates(rows, vocab, "id", most=5).collect():
        got.setdefault(r.id, []).append((r["rank"], r.canonical_id, r.score))
    assert sorted(got[1]) == [(1, "c0", 7), (2, "c1", 6), (3, "c2", 5), (4, "c3", 1), (5, "c5", 0)]
    assert [c for _, c, _ in sorted(got[2])] == ["c5", "c3", "c1"]


def test_annotation_and_write_back(spark):
    vocab = spark.createDataFrame([("static_friction", "Static Friction", 3, "structural", 0), ("torque", "Torque", 2, "structural", 1)], "canonical_id string, display_name string, frequency int, source string, vocab_ord int")
    rows = spark.createDataFrame([("a", "A", None, None, "Static friction holds.", [], "explanation", 11, "P"), ("b", None, None, None, None, ["x"], "recall", 11, "P")], "resource_id string, chapter_title string, section string, subsection string, summary string, concepts array<string>, resource_type string, class_no int, subject string")
    done = C.annotate(rows, vocab, "resource_id", C.stub_annotator)
    assert [tuple(r) for r in done.collect()] == [("a", ["static_friction"], ["Static Friction"], None)]
    assert {r.resource_id: r.concepts for r in C.write_back(rows, done, "resource_id").collect()} == {"a": ["static_friction"], "b": ["x"]}

    def failing():
        def reply(prompt):
            raise RuntimeError("no model")

        return reply

    assert C.annotate(rows, vocab, "resource_id", failing).first().error == "no model"


def test_layout_tree(spark):
    tree = {"metadata": {"language": "en", "page_stats": [{"page_id": 0, "text_extraction_method": "pdftext"}]}, "children": [{"id": "/page/0/Page/1", "children": [{"block_type": "PageHeader", "html": "<p>head</p>"}, {"block_type": "Group", "children": [{"block_type": "Text", "html": "<p>one</p>"}, {"block_type": "Equation", "html": "<math>x=1</math>"}, {"block_type": "Equation", "html": "<math>x=1</math>"}]}, {"block_type": "Table", "html": "<li>q</li>"}]}]}
    deep = {"children": [{"children": []}]}
    node = deep["children"][0]
    for _ in range(300):
        node["children"] = [{"children": []}]
        node = node["children"][0]
    df = spark.createDataFrame([("a", json.dumps(tree)), ("b", "{broken"), ("c", json.dumps(deep))], "doc_id string, tree string")
    got = {r.doc_id: r for r in layout.layout_to_extractions(df).collect()}
    assert got["a"].pages[0].text == "one\nx=1\nx=1\nq" and got["a"].pages[0].equations == ["x=1"] and got["a"].has_tables and got["a"].pages[0]["_extraction_method"] == "pdftext"
    assert got["b"].pages is None and got["b"].error and got["c"].pages[0].text == ""


def test_statistics(spark):
    df = spark.createDataFrame([("a", "mcq", 11, "P", ["x", "x", "y"], None), ("b", "mcq", 11, "P", [], " "), ("c", None, None, None, None, "s")], "id string, resource_type string, class_no int, subject string, concepts array<string>, summary string")
    vocab = spark.createDataFrame([("x", "X", "structural"), ("z", "Z", "extracted")], "canonical_id string, display_name string, source string")
    freq = A.concept_frequency(df)
    assert {r.concept: r.n for r in freq.collect()} == {"x": 2, "y": 1}
    assert [(r.lo, r.concepts) for r in A.frequency_classes(freq).collect()][:3] == [(1, 1), (2, 1), (3, 0)]
    assert A.per_resource(df).first().asDict() == {"mean": 1.5, "least": 0, "most": 3, "zero": 1}
    assert {r.resource_type: (r.total, r.annotated, r.average) for r in A.coverage_by_type(df).collect()} == {"mcq": (2, 2, 1.5), "unknown": (1, 0, 0.0)}
    assert [r.class_subject for r in A.coverage_by_subject(df).orderBy("class_subject").collect()] == ["Class 11 P", "Class ? ?"]
    assert [r.canonical_id for r in A.unused(vocab, freq).collect()] == ["z"] and A.overview(df, vocab).first().no_summary == 2
    assert not A.gates(df, vocab).first().all_pass and A.gates(df.limit(0), vocab).first().all_pass is False
    pages = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", None)], "doc_id string, page_no int")
    assert {r.doc_id: r.contiguous for r in A.contiguity(pages).collect()} == {"a": True, "b": False, "c": False}


def test_upsert_and_manifest(spark):
    runs = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x"), ("b", 1, "x")], "k string, run int, v string")
    assert {(r.k, r.v) for r in B.upsert(runs, ["k"], "run").collect()} == {("a", "new"), ("b", "x")}
    manifest = spark.createDataFrame([("f", 11, 1, "T "), ("f", 11, 1, None), ("gone", 12, 2, "U")], "file string, class_no int, chapter_no int, chapter_title string")
    there, missing = B.by_manifest(manifest, spark.createDataFrame([("f", "p")], "file string, text string"))
    assert there.first().chapter_title == "T" and [r.file for r in missing.collect()] == ["gone"]


def test_sources_sinks_and_stream(spark, tmp_path):
    src = tmp_path / "in" / "BIO" / "class11" / "chapter_01"
    src.mkdir(parents=True)
    (src / "text.json").write_text(json.dumps({"pages": [{"page_no": 1, "text": "a\nb", "equations": ["e"]}]}))
    (src / "bad.json").write_text("{nope")
    (src / "empty.json").write_text(json.dumps({"pages": []}))
    good, bad = readers.read_extractions(spark, str(tmp_path / "in"))
    assert readers.pages_of(good).first().text == "a\nb" and {r.reason for r in bad.collect()} == {"broken json", "no pages"}
    images = tmp_path / "img"
    images.mkdir()
    (images / "x_images.json").write_text(json.dumps([{"image_id": "IMG_001", "page_no": 1, "image_path": "p"}]))
    (images / "y_images.json").write_text("[]")
    assert [r.image_id for r in readers.read_images(spark, str(images)).collect()] == ["IMG_001"]
    (tmp_path / "v.json").write_text(json.dumps({"b": {"display_name": "B", "frequency": 2}, "a": {"display_name": "A", "frequency": 1, "source": "extracted"}}))
    assert [(r.canonical_id, r.vocab_ord) for r in readers.read_keyed(spark, str(tmp_path / "v.json")).collect()] == [("b", 0), ("a", 1)]
    paths = spark.createDataFrame([("/x/BIO/class11/chapter_01/t.json",), ("/x/BIO/class11/chapter_01/t_images.json",), ("/x/BIO/class11/chapter_01/.h.json",)], "path string")
    assert [(r.text_file[-6:], r.image_file[-13:]) for r in readers.chapter_files(paths).collect()] == [("t.json", "t_images.json")]
    meta = readers.path_metadata(F.lit("/x/BIO/class11/chapter_07"))
    assert spark.range(1).select(*(c.alias(k) for k, c in meta.items())).first().asDict() == {"subject_code": "BIO", "subject": "Biology", "class_no": 11, "chapter_no": 7}
    assert one(spark, readers.is_chapter_dir(F.lit("/a/Lesson-12"))) and one(spark, readers.chapter_number(F.lit("/a/Lesson-12"))) == 12
    assert readers.default_backends().available() == ["marker", "pdfplumber", "precomputed"]
    res = tmp_path / "res"
    res.mkdir()
    (res / "a.json").write_text(json.dumps([{"resource_id": "r1", "document_id": "d"}, {"resource_id": "r2"}]))
    (res / "b.json").write_text(json.dumps({"resource_id": "r3"}))
    assert {r.resource_id for r in readers.read_resources(spark, str(res)).collect()} == {"r1", "r2", "r3"} and readers.read_resources(spark, str(res), ["b.json"]).count() == 1
    rows = spark.createDataFrame([("k1", 11, 1), ("k2", 11, 2)], "k string, class_no int, chapter_no int")
    writers.write_chapters(rows, str(tmp_path / "out"))
    assert (tmp_path / "out" / "part_class_no=11" / "part_chapter_no=2").exists()
    assert writers.append_new(rows, str(tmp_path / "app"), ["k"]) == 2 and writers.append_new(rows, str(tmp_path / "app"), ["k"]) == 0
    stream = tmp_path / "stream"
    stream.mkdir()
    run = lambda: follow(spark, str(stream), str(tmp_path / "seen"), str(tmp_path / "state"), lambda df: readers.pages_of(df).select("doc_id", "page_no", "text"), ["doc_id", "page_no"]).awaitTermination(60)
    (stream / "one.json").write_text(json.dumps({"pages": [{"page_no": 1, "text": "x"}]}))
    run()
    (stream / "two.json").write_text(json.dumps({"pages": [{"page_no": 1, "text": "y"}]}))
    run()
    assert spark.read.parquet(str(tmp_path / "seen")).count() == 2


def test_content_and_skips(spark):
    long = "s" * 50
    rows = [("a", "explanation", None, long, None), ("b", "explanation", "t" * 45, "x", None), ("c", "recall", None, long, "c" * 40), ("d", "diagram", long, long, long), (None, "recall", long, None, None), ("e", "recall", " ", None, "short")]
    df = spark.createDataFrame(rows, "resource_id string, resource_type string, text string, summary string, image_caption string")
    assert [r.c[0] if r.c else None for r in df.select(C.content().alias("c")).collect()] == ["s", "t", "c", "s", "s", None]
    assert C.skip_counts(df).first().asDict() == {"no_resource_id": 1, "type_skipped": 1, "no_content": 1, "kept": 3}


def test_whole_pipelines(spark):
    from leafmill.plans import pipelines as P

    body = "a body line that is long enough to be kept as one chunk of the book and not merged into another"
    pages = spark.createDataFrame([("d", 1, 1, f"MOTION AND FORCE\n1.1 Rest\n{body}", ["e"]), ("d", 2, 2, f"Example 1.1\n{body}\nCan you recall?\n{body}", [])], "doc_id string, page_no int, page_seq bigint, text string, equations array<string>")
    chapters = spark.createDataFrame([("d", "NIOS", "Physics", 11, 3, "")], "doc_id string, source string, subject string, class_no int, chapter_no int, chapter_title string")
    images = spark.createDataFrame([("d", "IMG_007", 2, "p.png", None)], "doc_id string, image_id string, page_no int, image_path string, caption string")
    out, bad = P.open_book(pages, images, chapters, "PHY")
    rows = {r.resource_id: r for r in out.collect()}
    assert set(rows) == {"TXT_11_CH03_S1_1_001", "EXP_11_CH03_S1_1_001", "IMG_11_CH03_007"} and {r.document_id for r in rows.values()} == {"NIOS_PHY_CH03"}
    assert rows["TXT_11_CH03_S1_1_001"].chapter_title == "Motion And Force" and rows["TXT_11_CH03_S1_1_001"].has_equation and bad.count() == 0
    state, _ = P.state_book(pages, images, chapters, "PHY")
    assert {r.resource_type for r in state.collect()} == {"explanation", "recall", "diagram"} and state.filter("document_id = 'MAHA_PHY_11'").count() == state.count()
    assert P.class_book(pages, chapters).count() == 2

    summary = "photosynthesis needs chlorophyll and sunlight in the chloroplast of leaves"
    res = spark.createDataFrame([(f"r{k}", "explanation", None, summary, None, [], "T", None, None, 11, "Bio", False, "d", 1) for k in range(3)], "resource_id string, resource_type string, text string, summary string, image_caption string, concepts array<string>, chapter_title string, section string, subsection string, class_no int, subject string, has_equation boolean, document_id string, chapter_no int")
    structural = spark.createDataFrame([("sunlight", "Sunlight", 4, "structural")], "canonical_id string, display_name string, frequency int, source string")
    got = P.concept_pipeline(res, structural, "resource_id", C.stub_annotator, C.stub_annotator)
    assert {r.canonical_id for r in got["vocabulary"].collect()} == {"sunlight", "photosynthesis", "chlorophyll", "chloroplast"}
    assert all(set(r.concepts) == {"sunlight", "photosynthesis", "chlorophyll", "chloroplast"} for r in got["annotated"].collect())
    assert got["gates"].first().coverage


def test_cuts_can_be_cleaned(spark):
    import os

    from leafmill.plans import lineage

    df = lineage.cut(spark.range(5), "t")
    folder = lineage._root(spark).removeprefix("file://")
    assert df.count() == 5 and os.path.isdir(folder)
    lineage.clean(spark)
    assert not os.path.exists(folder)


def test_grid_join_meets_every_pair_once(spark):
    from leafmill.plans.skew import grid_join

    left = spark.createDataFrame([("h", k) for k in range(40)] + [("c", 1), ("d", 2), (None, 3)], "key string, l int")
    right = spark.createDataFrame([("h", k) for k in range(30)] + [("c", 7), ("c", 8), ("e", 9)], "key string, r int")
    got = [(r.key, r.l, r.r) for r in grid_join(left, right, "key", spark.createDataFrame([("h",)], "key string"), "l", "r").collect()]
    assert sorted(got) == sorted([("h", a, b) for a in range(40) for b in range(30)] + [("c", 1, 7), ("c", 1, 8)])


def test_pdf_pages_by_the_class_of_their_file(spark, tmp_path, monkeypatch):
    """A stand-in for the optional package, on the workers' path."""
    from leafmill.sources import pdf, readers

    (tmp_path / "lib").mkdir()
    (tmp_path / "lib" / "pdfplumber.py").write_text(
        "class Page:\n    width, height = 100, 10\n    def __init__(self, t): self.t = t\n    def extract_text(self): return self.t\n    def crop(self, box): return Page(f'{self.t}@{int(box[0])}')\n"
        "class Pdf:\n    def __init__(self, f):\n        b = f.read().decode()\n        if b == 'bad': raise ValueError('broken')\n        self.pages = [Page(t) for t in b.split('|')]\n    def __enter__(self): return self\n    def __exit__(self, *a): return False\n"
        "def open(f): return Pdf(f)\n"
    )
    for at, content in (("BIO/class11/chapter1/a.pdf", "one|two"), ("BIO/class9/chapter2/b.pdf", "xxxxxx  y"), ("BIO/class9/chapter3/c.pdf", "bad")):
        (tmp_path / "books" / at).parent.mkdir(parents=True)
        (tmp_path / "books" / at).write_text(content)
    spark.sparkContext.addPyFile(str(tmp_path / "lib" / "pdfplumber.py"))
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    got = {r._source_file[-5:]: r for r in pdf.read_pdf(spark, str(tmp_path / "books"), readers.path_metadata(folder)["class_no"]).collect()}
    assert [p.text for p in got["a.pdf"].pages] == ["one@0\none@50", "two@0\ntwo@50"] and [p.text for p in got["b.pdf"].pages] == ["x y"]
    assert got["c.pdf"].pages is None and got["c.pdf"].error == "broken"


def test_answers_with_pauses_and_errors(spark):
    def annotator():
        def reply(p):
            if p == "bad":
                raise RuntimeError("no answer")
            return p.upper()

        return reply

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "prompt string").coalesce(1)
    got = [(r.answer, r.error) for r in C.ask(df, "prompt", annotator, pause=0.01).collect()]
    assert sorted(got, key=str) == sorted([("A", None), (None, "no answer"), ("C", None)], key=str)


def test_candidates_are_ranked_without_a_shuffle(spark, monkeypatch):
    rng = random.Random(3)
    words = "force static friction ion normal quark field magnetic of the law newton's energy".split()
    vocab = spark.createDataFrame([(f"c{k}", " ".join(rng.choices(words, k=rng.randint(1, 3))).title(), rng.choice([None, 1, 2]), rng.choice(["structural", "extracted"]), k) for k in range(60)] + [("e", "", 1, "structural", 60), ("n", None, 2, "structural", 61)], "canonical_id string, display_name string, frequency int, source string, vocab_ord int")
    text = lambda n: " ".join(rng.choices(words + ["frictions", "Iodine", "É"], k=n))
    rows = spark.createDataFrame([(k, text(2), None, "", text(rng.randint(0, 12))) for k in range(40)] + [(99, None, None, None, None)], "id int, chapter_title string, section string, subsection string, summary string")
    got = C.candidates(rows, vocab, "id", most=30)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(C, "LISTED", 3)
    joined = C.candidates(rows, vocab, "id", most=30)
    assert got.schema.simpleString() == joined.schema.simpleString() and sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))


def test_filled_candidates_come_in_one_pass(spark):
    vocab = spark.createDataFrame([(f"c{k:02d}", n, f, "structural", k) for k, (n, f) in enumerate([("Torque", 2), ("Heat", None), ("Ion", 9), ("Field", 9)])], "canonical_id string, display_name string, frequency int, source string, vocab_ord int")
    rows = spark.createDataFrame([(1, None, None, None, "the heat of it"), (2, None, None, None, "")], "id int, chapter_title string, section string, subsection string, summary string")
    got = C.candidates(rows, vocab, "id", most=3)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, 1, "c01", "Heat", 6), (1, 2, "c02", "Ion", 0), (1, 3, "c03", "Field", 0), (2, 1, "c02", "Ion", 0), (2, 2, "c03", "Field", 0), (2, 3, "c00", "Torque", 0)]


def some_terms(rng):
    stems = ["woven basket plan", "woven tramway set", "portable telescope night", "constant of surface excretion", "mass", "field"]
    terms = {f"{rng.choice(stems)} {rng.choice('abc')}{rng.randint(0, 99)}" for _ in range(90)} | {f"{a} and {b} {rng.choice(stems)}" for a in stems[:4] for b in stems[2:4]}
    for t in sorted(terms)[::3]:
        k = rng.randrange(len(t))
        terms.add(t[:k] + rng.choice(["", "x", t[k] * 2]) + t[k + 1 :])
    return {t: rng.randint(1, 9) for t in sorted(terms)}


def test_alike_terms_of_one_make_do_not_all_meet(spark):
    """Terms that share their words but not their numbers are compared with few others, and no pair is lost."""
    rng = random.Random(11)
    counts = some_terms(rng)
    order = sorted(counts, key=lambda t: (-counts[t], t))
    pairs = {(r.a, r.b) for r in V.near_duplicates(spark.createDataFrame(list(counts.items()), "term string, n long")).collect()}
    assert pairs == {(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if brute_near(a, b)}
    made = [f"{a} {n} type {c}{k}" for a in ("woven", "painted", "rustic") for n in ("basket", "tramway", "notebook") for c in "abcdefgh" for k in range(1000, 9000, 137)]
    shorter, longer = {}, {}
    for t in made:
        for held, keys in ((shorter, V._keys_of_shorter(t)), (longer, V._keys_of_longer(t))):
            for k in keys:
                held[k] = held.get(k, 0) + 1
    assert sum(n * longer.get(k, 0) for k, n in shorter.items()) / len(made) < 2000  # of 4,248 others


def test_clusters_are_the_same_in_rounds_and_in_one_task(spark, monkeypatch):
    counts = some_terms(random.Random(4))
    df = spark.createDataFrame(list(counts.items()), "term string, n long")
    pairs = {(r.a, r.b) for r in V.near_duplicates(df).collect()}
    canon = {}
    for t in sorted(counts, key=lambda t: (-counts[t], t)):
        if t not in canon:
            canon |= {o: t for o in counts if o not in canon and (o == t or (t, o) in pairs)}
    for most in (V.LAST_PAIRS, 0):
        monkeypatch.setattr(V, "LAST_PAIRS", most)
        assert {r.term: r.canonical for r in V.cluster(df).collect()} == canon


def test_resources_in_lists_are_few_files_and_read_back_whole(spark, tmp_path):
    rows = [(f"r{k}", "d", None if k % 3 else f'a "line"\nand more {k}', ["x", None] if k % 2 else None, True, k) for k in range(25)]
    df = spark.createDataFrame(rows, "resource_id string, document_id string, text string, concepts array<string>, has_equation boolean, page_start int").coalesce(2)
    writers.write_lists(df, str(tmp_path / "lists"), most=10)
    assert len(list((tmp_path / "lists").glob("part-*"))) <= 4
    got = readers.read_resources(spark, str(tmp_path / "lists"), glob="part-*").select(*df.columns).collect()
    assert sorted(map(tuple, got)) == sorted((*r[:3], r[3] or [], *r[4:]) for r in rows)


def test_merge_map_counts_terms_once(spark, monkeypatch):
    recs = spark.createDataFrame([(1, ["static friction", "torque"]), (2, ["static frictions"]), (3, ["static friction"])], "id int, concepts array<string>")
    structural = spark.createDataFrame([("torque", "Torque", 5, "structural")], "canonical_id string, display_name string, frequency int, source string")
    cuts, cut = [], V.cut
    monkeypatch.setattr(V, "cut", lambda df, name="cut": cuts.append(name) or cut(df, name))
    assert [tuple(r) for r in V.build(recs, "id", structural)["merge_map"].collect()] == [("static frictions", "static friction")]
    assert cuts.count("counts") == 1 and "picked" not in cuts


def test_forms_that_share_a_key_are_compared_in_arrays(spark):
    """A crowded key is met in few batches of pairs, of which only those that may be alike are made rows, whatever batches it lies in."""
    forms = [f"evening almanac set {c}{n}" for c in "ab" for n in range(1000, 4000, 29)] + ["evening almanac", "evening almanac set b10000"]
    keyed = lambda longer: pa.Table.from_batches(V._keyed(lambda f: {len(f) // 99, crc32(f[-1:].encode())}, longer)([pa.record_batch({"f": forms})]))
    rows = pa.concat_tables([keyed(False), keyed(True)]).sort_by("k")
    bound = lambda x, y: sum(abs(min(x.count(c), 3) - min(y.count(c), 3)) for c in V.CHARACTERS)
    want = {(x, y) for x in forms for y in forms if len(x) <= len(y) and max(len(y) - len(x), bound(x, y)) <= V.most_unmatched(len(x) + len(y))}
    for size in (10_000, 501, 37):
        got = [p for b in V._meet(iter(rows.to_batches(max_chunksize=size))) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert set(got) == want and len(want) < len(forms) ** 2 / 2
    assert all(V._may_be_alike(x, y) for x, y in want if SequenceMatcher(None, x, y).ratio() > V.ALIKE) and not V._may_be_alike(forms[0], "evening almanac set b2345")


def test_terms_of_unrepeated_keys_are_counted_without_sorting(spark):
    rows = [(1, ["Ion", " ion", "ION", None, "", " "]), (2, ["ion", "Heat"]), (None, ["heat", "Ion"]), (3, None), (4, [])]
    df = lambda rows: spark.createDataFrame(rows, "k int, concepts array<string>")
    got = V.term_counts(df(rows), "k")
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [("Heat", 1), ("Ion", 2), ("heat", 1), ("ion", 1)]
    again = V.term_counts(df([*rows, (4, ["x"]), (4, ["X", "y"])]), "k")
    assert sum(r.n for r in again.collect()) == 7
    assert sorted(map(tuple, V.term_counts(df([*rows, (4, [])]), "k").collect())) == sorted(map(tuple, got.collect()))
