"""Page scores, titles, lookups and text functions on small hand-made frames."""

from pyspark.sql import functions as F

from foliospark.functions import classify, text
from foliospark.operators import lookups, parts, scores, toc
from foliospark.sources import readers, sinks

LINE = "doc_id int, page int, line int, text string, center int, n_words int, n_first_cap int"


def words(spark, lines, page=1):
    """Tokens of lines, ten a line at most, all of them centred alike."""
    rows, sn = [], 0
    for n, line in enumerate(lines):
        for k, w in enumerate(line.split()):
            rows.append((1, page, n, sn, w, 4400 + 200 * k, 4400 + 200 * k + 190))
            sn += 1
    return spark.createDataFrame(rows, "doc_id int, page int, line int, sn int, text string, x1 int, x2 int")


def values(spark, cells, fn):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_page_references(spark):
    cells = ["", "12", "iv", "I", "I2", "Iv", "12a", "0", None]
    assert values(spark, cells, text.page_type) == [0, 2, 1, 2, 2, 1, 4, 2, 4]
    assert values(spark, cells, text.page_value) == [0, 12, 4, 1, 12, 4, 0, 1, 0]


def test_unescape(spark):
    cells = ["caf\\u00e9", 'say \\"no\\"', 'bare " quote', "two\nlines", "broken \\x", "", None]
    assert values(spark, cells, text.unescape) == ["café", 'say "no"', 'bare " quote', "two\nlines", "broken \\x", "", None]


def test_distances(spark):
    rows = [("Word.", "word"), ("same", "same"), ("abc", "axc"), (None, "a")]
    got = spark.createDataFrame(rows, "a string, b string").select(text.split_distance(F.col("a"), F.col("b")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [(2, 1, 1, 0), (0, 0, 0, 0), (1, 0, 0, 1), (None, None, None, None)]


def test_forms(spark):
    assert values(spark, ["a/b/c.pdf", "none"], lambda c: text.after_last(c, "/")) == ["/c.pdf", ""]
    assert values(spark, ["", None, "x"], text.or_placeholder) == ["-", "-", "x"]
    assert values(spark, ["<SPAN a><span><p>", ""], lambda c: text.count_tags(c, "span")) == [2, 0]
    assert values(spark, ["base RENT due"], text.title_case) == ["Base Rent Due"]
    assert values(spark, ["NET lease", "other"], lambda c: text.prefix_class(c, {"net": "n"}, "o")) == ["n", "o"]
    assert values(spark, ["in presence of: Witness", "Witnesseth that"], lambda c: classify.phrase_score(c, "signature")) == [10, 0]


def test_marks_and_scores(spark):
    t = words(spark, ["1.1 Rent 12", "Section 3 Term iv", "body of it", "By: Name Title Date Witness"])
    marks = {r.line: (r.toc_item, r.page_ref, r.item_value, r.ref_value) for r in scores.marked_lines(t).collect()}
    assert marks == {0: (1, 1, 1, 12), 1: (1, 1, 0, 0), 2: (0, 0, 0, 0), 3: (0, 0, 0, 0)}
    s = scores.document_scores(scores.marked_lines(t)).first()
    assert s.sig_score == 10 + 10 + 150 + 5 * 3
    report = scores.contents_report(scores.marked_lines(t)).first()
    assert (report.n_items, report.n_lines, report.is_contents) == (2, 4, False)
    assert scores.document_scores(scores.marked_lines(t.limit(0))).count() == 0


def test_lease_titles(spark):
    t = words(spark, ["LEASE AGREEMENT", "TERMS OF LEASE", "LEASE DATA", "plain words", "RULES AND REGULATIONS", "ASSIGNMENT OF LEASE"])
    assert {r.line: r.n_title for r in scores.lease_titles(t, 40).collect()} == {0: 2, 4: 1}  # line 5 is too deep


def test_exhibit_headings(spark):
    rows = [(1, 1, 0, "EXHIBIT A", 5000, 2, 2), (1, 1, 1, "Rules of the House", 5050, 4, 2), (1, 1, 2, "far aside", 7000, 2, 0), (1, 1, 3, "Second Floor", 4990, 2, 2), (1, 2, 0, "Schedule", None, 1, 1)]
    got = scores.exhibit_headings(spark.createDataFrame(rows, LINE)).collect()
    assert {(r.page, r.heading) for r in got} == {(1, "EXHIBIT A Rules of the House Second Floor"), (2, "Schedule")}


def test_paragraph_scores(spark):
    cols = "doc_id int, para_no int, page int, n_chars int, toc_item int, page_ref int, item_value int, ref_value int, headed int"
    rows = [(1, 0, 1, 10, 0, 0, 0, 0, 1), (1, 1, 1, 20, 1, 1, 1, 4, 0), (1, 2, 1, 40, 1, 1, 2, 5, 0), (1, 3, 1, 300, 1, 0, 9, 0, 0)]
    assert [r.score for r in scores.paragraph_scores(spark.createDataFrame(rows, cols)).orderBy("para_no").collect()] == [300, 20, 25, -25]


def test_contents_flags(spark):
    items = spark.createDataFrame([(1, k, p) for k, p in enumerate([1, 1, 2, 13])], "doc_id int, para_no int, page int")
    runs = spark.createDataFrame([(1, 1, 1), (1, 13, 14)], "doc_id int, first_page int, last_page int")
    flags = lambda n: [r.in_contents for r in scores.contents_flags(items, runs, spark.createDataFrame([(1, n)], "doc_id int, n_pages int")).orderBy("para_no").collect()]
    assert flags(20) == [False, True, False, False]
    assert flags(91) == [False, True, False, True]
    assert flags(4) == [False] * 4


def test_places(spark):
    t = spark.createDataFrame([(1, 0, 0, 1, 0, 10, 10), (1, 4, 1, 1, 0, 20, 10), (1, 9, 2, 1, 1, 10, 30)], "doc_id int, loc int, sn int, page int, line int, x1 int, y1 int")
    asked = spark.createDataFrame([(1, 0), (1, 8), (1, 8), (1, 99), (2, 5)], "doc_id int, offset int")
    assert sorted((r.offset, r.sn) for r in lookups.at_offsets(t, asked).collect()) == [(0, 0), (8, 1), (8, 1), (99, 2)]
    tokens = spark.createDataFrame([(1, b, s) for s, b in enumerate([0, 0, 1, 2])], "doc_id int, block int, sn int")
    order = spark.createDataFrame([(1, 0, 2), (1, 1, 1), (1, 2, 0)], "doc_id int, block int, place int")
    dropped = spark.createDataFrame([(1, 1)], "doc_id int, block int")
    assert {r.sn: r.place for r in lookups.word_places(tokens, order, dropped).collect()} == {0: 1, 1: 2, 2: -3, 3: 0}


def test_inserted_and_labels(spark):
    cols = "doc_id int, sn int, text string, y1 int"
    base = spark.createDataFrame([(1, 0, "a", 100), (1, 2, "c", 120), (1, 4, "e", 900)], cols)
    extra = spark.createDataFrame([(1, 1, "b", 110), (1, 3, "d", 130), (1, 5, "f", 910)], cols)
    assert [r.text for r in lookups.inserted_tokens(base, extra).orderBy("place").collect()] == ["a", "b", "c", "e", "f"]
    labels = spark.createDataFrame([(1, 2), (1, 4)], "doc_id int, sn int")
    assert [r.text for r in lookups.label_tokens(base, labels).orderBy("place").collect()] == ["a", "RF1", "c", "RF2", "e"]


def brute_headers(rows, most=2):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    plain = lambda s: "".join(c for c in s[:41] if c.isascii() and c.isalnum())
    out = set()
    for key, i, a in rows:
        found = []
        for other, j, b in rows:
            if other != key or j <= i or min(len(plain(a)), len(plain(b))) <= most:
                continue
            d, e = distance(plain(a).lower(), plain(b).lower()), distance(plain(a), plain(b))
            if d <= most:
                found.append((d + e, j, d, e))
        if found:
            _, j, d, e = min(found)
            out.add((key, i, j, d, e))
    return out


def test_near_headers(spark):
    import random

    r = random.Random(5)
    texts = []
    for _ in range(120):
        base = "".join(r.choice("abAB .") for _ in range(r.choice([1, 3, 4, 6, 9, 14])))
        texts += [base] * r.choice([1, 1, 2])
        texts.append(base[: len(base) // 2] + r.choice("abx") + base[len(base) // 2 + r.choice([0, 1]) :])
    r.shuffle(texts)
    rows = [(k % 2, k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (0, 9999, None)], "source int, item int, header string")
    got = lookups.near_headers(df, "source").collect()
    assert {tuple(x) for x in got} == brute_headers(rows) and len(got) == len({(x.source, x.i) for x in got})


def test_sequence_tree(spark):
    spans = spark.createDataFrame([(1, 1, 0, 100), (1, 2, 10, 50), (1, 3, 20, 30), (1, 4, 60, 70), (1, 5, 200, 210)], "doc_id int, seq int, first int, last int")
    roots = spark.createDataFrame([(1, 1)], "doc_id int, seq int")
    tree = toc.sequence_tree(toc.span_relations(spans, ["doc_id"]), roots, ["doc_id"])
    assert {(r.seq, r.parent, r.level) for r in tree.collect()} == {(1, None, 2), (2, 1, 3), (3, 2, 4), (4, 1, 3)}


def test_paths_and_upserts(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "doc int, folder int")
    folders = spark.createDataFrame([(1, 7, None), (2, 7, "GBR")], "folder int, org int, v string")
    orgs = spark.createDataFrame([(7, "CAN")], "org int, v string")
    out = parts.coalesced_path(rows, [(folders, "folder", "v"), (orgs, "org", "v")], "country", "USA")
    assert {(r.doc, r.country) for r in out.collect()} == {(1, "CAN"), (2, "GBR"), (3, "USA")}
    cols = "k int, v string, at int"
    old, new = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, None, 1)], cols), spark.createDataFrame([(1, "c", 1), (2, "d", 4)], cols)
    assert {(r.k, r.v) for r in sinks.upserted(old, new, ["k"], "at").collect()} == {(1, "c"), (2, "b"), (3, None)}


def test_parts_of_a_result(spark, tmp_path):
    for doc, part, body in (("d1", "1.json", '{"Blocks": []}'), ("d1", "2.json", '{"Blocks": ['), ("d2", "1.json", "{}")):
        (tmp_path / doc).mkdir(exist_ok=True)
        (tmp_path / doc / part).write_text(body)
    got = readers.read_ocr_parts(spark, str(tmp_path))
    rows = got.withColumn("ok", text.balanced(F.col("json"))).select("doc_id", "part", "ok").collect()
    assert sorted(map(tuple, rows)) == [("d1", "1.json", True), ("d1", "2.json", False), ("d2", "1.json", True)]
    assert readers.ocr_words(got).count() == 0


def test_headers_and_marks(spark):
    cells = ["Terms of the Lease shall be", "plain words", "OF Rent", "", None]
    assert values(spark, cells, text.capital_head) == ["Terms of the Lease", "", "OF Rent", "", None]
    rows = spark.createDataFrame([(1, 0, "Base Rent is due", "Base Rent"), (1, 1, "no header", ""), (1, 2, "other", "Base")], "doc_id int, para_no int, text string, header string")
    assert [r.html for r in sinks.marked_headers(rows).orderBy("para_no").collect()] == ['<MARK class="toc_header">Base Rent</MARK> is due', "no header", "other"]


def test_pages_of_html(spark):
    rows = spark.createDataFrame([(1, 2, 5, "a <b> c"), (1, 2, 6, "two\nlines"), (1, 3, 7, "")], "doc_id int, page int, para_no int, text string")
    back = readers.paged_paragraphs(sinks.paragraph_html(rows)).collect()
    assert sorted(map(tuple, back)) == [(1, 2, 5, "a <b> c"), (1, 2, 6, "two\nlines"), (1, 3, 7, "")]


def test_json_of_pages(spark):
    rows = [(1, 1, 0, 0, "Say", 10, 20, 5, 9, 61), (1, 1, 0, 1, '"so"', 30, 40, 5, 9, 62), (1, 2, 1, 2, "é", 1, 2, 3, 4, 63)]
    t = spark.createDataFrame(rows, "doc_id int, page int, line int, sn int, text string, x1 int, x2 int, y1 int, y2 int, conf int")
    raw = sinks.ocr_json(t)
    got = readers.ocr_words(raw).select("id", "page", "text", "x1", "x2", "y1", "y2").collect()
    assert sorted(map(tuple, got)) == [("w0", 1, "Say", 10, 20, 5, 9), ("w1", 1, '"so"', 30, 40, 5, 9), ("w2", 2, "é", 1, 2, 3, 4)]
    assert sorted((r.line_id, r.word_id, r.nth) for r in readers.words_of_lines(raw).collect()) == [("l0", "w0", 0), ("l0", "w1", 1), ("l1", "w2", 0)]
