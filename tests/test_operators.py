"""Operators on small hand-made frames."""

import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from foliospark.functions import classify, text
from foliospark.plans import catalog, structure  # noqa: F401
from foliospark.operators import clusters, lines, parts, toc, tokens, vote
from foliospark.sources import layout, readers, sinks
from foliospark.streaming import ingest


def values(spark, cells, fn):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_names(spark):
    assert values(spark, ["Big Corp, Inc.", "__x", None], text.slug) == ["big_corp_inc_", "x", None]
    assert values(spark, ["Rentable Square Feet", " Foot!"], text.standard_name) == ["rentable_sq_ft", "ft"]
    assert values(spark, ["one_two_three", "one"], text.camel_case) == ["oneTwoThree", "one"]
    assert values(spark, ["mid-term", "a--b", "tenant's", "Ist", "end-"], text.normal_token) == [["mid", "term"], ["a", "b"], ["tenant"], ["1st"], ["end-"]]


def test_numbers(spark):
    assert values(spark, ["IV", "xii", "XL", "VL", "q"], text.roman_value) == [4, 12, 11, 6, None]
    assert values(spark, ["TWENTY-TWO", "ninth", "NONSENSE"], text.word_number) == [22, 9, None]
    assert values(spark, ["3.14.2", "(a)", "IX.", "12"], text.section_value) == [2, 1, 9, 12]
    assert values(spark, ["1.2", "(iv)", "B.", "word"], text.numeral_style) == ["decimal_pair", "roman_small_paren", "letter_capital", "none"]
    assert values(spark, ["Rent ... 12", "Terms iv", "nothing"], text.page_reference) == [12, 4, None]
    assert values(spark, [" 12ab", "x"], text.leading_int) == [12, 0]
    d = spark.sql("select 0 y, 3 m, cast(null as int) d").select(text.partial_date(F.col("y"), F.col("m"), F.col("d")).alias("p")).first().p
    assert (d.date, d.no_year, d.no_month, d.no_day) == (date(1970, 3, 1), True, False, True)


def test_headers(spark):
    assert values(spark, ["BASE RENT AND TERM Tenant pays", "Plain words"], text.caps_header) == ["BASE RENT AND TERM", "Plain words"]
    assert values(spark, ["Base rent. Tenant pays", "Ab"], text.sentence_header) == ["Base rent", "Ab"]
    assert values(spark, ["<p>a<b>c</b></p>"], text.strip_tags) == ["<p>ac</p>"]


def test_categories(spark):
    cells = ["10:30", "1/2/2020", "$1,200.50", "5'6\"", "7\"", "8'", "1,200sf", "1999", "90210", "3.5", "4th", "(iv)", "AB-12", "word"]
    want = ["HOUR", "DATE", "PRICE", "FOOTINCH", "INCH", "FOOT", "SF", "YEAR", "ZIPCODE", "DECNUM", "ORDINAL", "NUMERATION", "MODEL", "NONE"]
    assert values(spark, cells, classify.token_category) == want
    assert values(spark, ["runs in the", "Section", "ends."], classify.dangles) == [True, False, False]


def test_overlap_is_symmetric(spark):
    df = spark.sql("select 0 x1, 10 x2, 0 y1, 10 y2, 5 u1, 20 u2, 5 v1, 7 v2")
    a, b = {c: F.col(c) for c in ("x1", "x2", "y1", "y2")}, dict(zip(("x1", "x2", "y1", "y2"), map(F.col, ("u1", "u2", "v1", "v2")), strict=True))
    r = df.select(text.overlap_area(a, b).alias("p"), text.overlap_area(b, a).alias("q")).first()
    assert r.p == r.q == 10


OCR = {
    "DocumentMetadata": {"Pages": 1},
    "Blocks": [
        {"BlockType": "LINE", "Confidence": 99.0, "Text": "Hello world", "Id": "l", "Ids": ["w1", "w2"], "Page": 1, "Geometry": {"Polygon": [{"X": 0.1, "Y": 0.2}, {"X": 0.3, "Y": 0.2}, {"X": 0.3, "Y": 0.25}, {"X": 0.1, "Y": 0.25}]}},
        {"BlockType": "WORD", "Confidence": 98.0, "Text": "Hello", "Id": "w1", "Page": 1, "Geometry": {"Polygon": [{"X": 0.1, "Y": 0.2}, {"X": 0.2, "Y": 0.2}, {"X": 0.2, "Y": 0.25}, {"X": 0.1, "Y": 0.25}]}},
        {"BlockType": "WORD", "Confidence": 97.0, "Text": "world", "Id": "w2", "Page": 1, "Geometry": {"Polygon": [{"X": 0.21, "Y": 0.2}, {"X": 0.3, "Y": 0.2}, {"X": 0.3, "Y": 0.25}, {"X": 0.21, "Y": 0.25}]}},
    ],
}


def test_ocr_readers(spark):
    raw = spark.createDataFrame([(1, json.dumps(OCR)), (2, "{broken"), (3, None)], "doc_id long, json string")
    words = readers.ocr_words(raw).orderBy("at").collect()
    assert [(w.doc_id, w.text, w.x1, w.x2, w.y1, w.y2) for w in words] == [(1, "Hello", 1000, 2000, 2000, 2500), (1, "world", 2100, 3000, 2000, 2500)]
    assert [(r.nth, r.text) for r in readers.words_of_lines(raw).orderBy("nth").collect()] == [(0, "Hello"), (1, "world")]
    other = {"pages": [{"width": 1, "height": 1, "blocks": [{"paragraphs": [{"words": [{"boundingBox": {"normalizedVertices": [{"x": 0.1, "y": 0.1}, {"x": 0.2, "y": 0.1}, {"x": 0.2, "y": 0.2}]}, "symbols": [{"text": "H"}, {"text": "i"}], "confidence": 0.987}]}]}]}]}
    assert [(r.text, r.conf, r.x2) for r in readers.other_engine_words(spark.createDataFrame([(1, json.dumps(other))], "doc_id long, json string")).collect()] == [("Hi", 98, 2000)]
    assert readers.page_count(spark.createDataFrame([("Pages: 12",), ("none",)], "value string")).select("pages").collect() == [(12,), (None,)]


def test_dictionary_and_index(spark, tmp_path):
    (tmp_path / "dict").write_text("1\t10\trent\n2\t20\trent\n3\t5\ta\n4\t7\tx9\n5\t50\t__TOTAL_WORDS__\n")
    assert [tuple(r) for r in readers.read_dictionary(spark, str(tmp_path / "dict")).collect()] == [("rent", 10, 0.2)]  # the lower id stands
    names = [c.split()[0] for c in readers.INDEX_SCHEMA.split(", ")]
    row = lambda **k: tuple(k.get(n, "t" if n in ("title", "section", "header") else 0) for n in names)
    df = spark.createDataFrame([row(seq=1, line=1, level=2), row(seq=2, line=1, level=2), row(seq=3, line=2, level=10), row(seq=4, line=3, level=3)], readers.INDEX_SCHEMA).coalesce(1)
    sinks.write_index(df, str(tmp_path / "index"))
    assert sorted(r.seq for r in readers.read_index(spark, str(tmp_path / "index")).collect()) == [1, 4]


def test_replacing_documents_twice_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([(i, j, "x") for i in range(5) for j in range(3)], "doc_id long, sn int, text string")
    for _ in range(2):
        sinks.replace_documents(df, str(tmp_path / "t"), buckets=4)
        assert spark.read.parquet(str(tmp_path / "t")).count() == 15


def test_split_sections(spark):
    html = '<DIV class="H1" lev="1" sec="1." name="Rent">Own <b>text</b><DIV lev="2" sec="(a)" name="Base">Inner</DIV> more<DIV lev="9">deep</DIV></DIV>'
    got = readers.split_sections(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).orderBy("nth").collect()
    assert [(r.level, r.sec, r.name, r.text) for r in got] == [(1, "1.", "Rent", "Own text more"), (2, "(a)", "Base", "Inner")]


def test_window_operators_ignore_input_order(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(900))), (2, None), (3, "A B")], "doc_id long, text string")
    t = layout.tokens_from_text(docs)
    plain, mixed = lines.paragraphs(layout.blocks(t)), lines.paragraphs(layout.blocks(t.orderBy(F.rand(1))))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, mixed.collect()))


def test_pieces_and_split_words(spark):
    t = spark.createDataFrame([(1, 0, '"Hello,', 0, 70), (1, 1, "(a)", 80, 110), (1, 2, "regula-", 120, 190), (1, 3, "tion", 200, 240)], "doc_id long, sn int, text string, x1 int, x2 int")
    got = tokens.token_pieces(t).orderBy("sn", "piece").collect()
    assert [(r.sn, r.text, r.x1) for r in got if r.sn < 2] == [(0, '"', 0), (0, "Hello", 10), (0, ",", 60), (1, "(a)", 80)]
    words = spark.createDataFrame([("regulation",)], "word string")
    assert [r.text for r in tokens.join_split_words(t.where("sn > 1"), words).orderBy("sn").collect()] == ["regulation"]


def test_vote(spark):
    a = spark.createDataFrame([(1, 1, 0, "Rent", 90, 0, 100, 0, 50), (1, 1, 1, "regulation", 90, 200, 400, 0, 50)], "doc_id long, page int, sn int, text string, conf int, x1 int, x2 int, y1 int, y2 int")
    b = spark.createDataFrame([(1, 1, 0, "rent", 80, 5, 105, 0, 50), (1, 1, 1, "regu", 80, 200, 290, 0, 50), (1, 1, 2, "lation", 80, 300, 400, 0, 50)], a.schema)
    pairs = vote.overlapping_pairs(a, b)
    assert {(r.sn_a, r.sn_b) for r in vote.greedy_matches(pairs).collect()} == {(0, 0), (1, 2)}
    assert [(r.text, r.joined) for r in vote.juxtaposed(a.where("sn = 1"), pairs).collect()] == [("regulation", "regulation")]
    kinds = spark.createDataFrame([("a", "a"), ("A", "a"), ("a.", "a"), ("house", "mouse"), ("cat", "dog"), (None, "x")], "p string, q string")
    assert [r.k for r in kinds.select(vote.discrepancy(F.col("p"), F.col("q")).alias("k")).collect()] == ["SAME", "CAPITAL", "NONALNUM", "SIMILAR", "DIFFERENT", "A_MISSING"]


def test_clusters_do_not_depend_on_order(spark):
    pairs = [(1, 1, 2), (1, 2, 3), (1, 5, 6), (2, 9, 8)]
    want = {(1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 5, 5), (1, 6, 5), (2, 8, 8), (2, 9, 8)}
    for p in (pairs, pairs[::-1]):
        assert set(map(tuple, clusters.document_clusters(spark.createDataFrame(p, "doc_id long, a int, b int")).collect())) == want


def test_table_of_contents(spark):
    lines_ = ["1. Rent. Tenant pays.", "(a) Base rent", "(b) Extra rent", "2. Term", "(a) Start", "(b) End", "3. Notices", "No heading here"]
    df = spark.createDataFrame([(7, i, 1, t) for i, t in enumerate(lines_)], "doc_id long, para_no int, page int, text string")
    got = {r.para_no: r for r in toc.build(df).collect()}
    assert [got[p].level for p in (0, 1, 3, 6)] == [2, 3, 2, 2]
    assert got[1].parent == got[0].item and got[0].header == "Rent" and got[0].end_para == 2


def test_parts(spark):
    df = spark.createDataFrame([(1, 0, "THIS AGREEMENT is made as of today by and between us"), (1, 1, "WHEREAS we agree"), (1, 9, "IN WITNESS WHEREOF"), (1, 12, "rent")], "doc_id long, para_no int, text string")
    labels = parts.label_paragraphs(df)
    assert {(r.para_no, r.label) for r in labels.collect()} == {(0, "preamble"), (1, "recitals"), (9, "signature")}
    assert parts.intervals(labels).count() == 3
    marks = spark.createDataFrame([(1, 2, "start"), (1, 8, "end"), (2, 1, "start"), (2, 90, "end")], "doc_id long, para_no int, mark string")
    assert [tuple(r) for r in parts.recitals(marks).collect()] == [(1, 2, 8)]


def test_streaming_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "doc_id long, text string"
    for n, word in enumerate(("one two", "three")):
        (src / f"{n}.json").write_text(json.dumps({"doc_id": 1, "text": word}) + "\n")
        ingest.ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), schema, layout.tokens_from_text).awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 3 and [r.text for r in ingest.latest(rows).collect()] == ["three"]


@pytest.mark.parametrize("name", ["ocr_line_scan", "ocr_word_scan", "ocr_membership", "applied_votes", "engine_vote", "inserted_tokens", "split_distances", "voted_scan", "joined_split_words", "footer_pairs", "paragraph_pages", "paged_paragraphs", "marked_headers", "paragraph_tallies"])
def test_words_stay_with_their_document(spark, name):
    """The texts are dealt by document; no exchange by page, line, block or word follows."""
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)}
    assert keys == {"doc_id"}


def test_paragraphs_are_made_ready_once(spark):
    rows = spark.createDataFrame([(1, 1, "Made and entered into, located at -- "), (1, 2, "..."), (1, 3, None)], "doc_id long, para_no int, text string")
    found = parts.label_paragraphs(rows)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert {(r.para_no, r.label) for r in found.collect()} == {(1, "preamble")}
    assert [r[0] for r in rows.select(classify.phrase_text(F.col("text"))).collect()] == ["Made and entered into located at ", " ", None]


def test_lengths_of_vectors_are_taken_once(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 1.0]), (51, [0.0, 2.0]), (52, None)], "vec_id long, embedding array<double>")
    found = parts.top_similar(rows.where("vec_id % 50 = 0"), rows, k=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert [x.count("aggregate(") for x in plan if " AS score" in x] == [1]
    assert [(r.query, r.vec_id, r["rank"]) for r in found.orderBy("query", "rank").collect()] == [(0, 50, 1), (0, 51, 2), (50, 0, 1), (50, 51, 2)]
