"""Preamble decisions against a plain version, document values and label spans on hand-made rows."""

import random

from foliospark.operators import preambles as p


def plain(marks, items, lengths):
    """By the words of the docstring, one document."""
    marks = sorted(marks)
    items = sorted(items)
    runs = []
    for k, (at, name) in enumerate(marks):
        if name == "Preamble":
            if k and marks[k - 1][1] == "Preamble" and at - marks[k - 1][0] <= 5:
                runs[-1][1] = k
            else:
                runs.append([k, k])
    out = []
    for f, e in runs:
        first, last = marks[f][0], marks[e][0]
        before = marks[f - 1] if f else None
        after = marks[e + 1] if e + 1 < len(marks) else None
        behind = next((x for x in items if x[0] > last), None)
        recitals = after is not None and after[1] in ("Recitals", "Table_Of_Contents") and after[0] - last < 10
        item = behind is not None and behind[0] - last < 10 and behind[1] in (1, 9)
        sound = behind is not None and behind[2] >= 2 and behind[3] - behind[2] >= 2
        if sound or not (recitals or item):
            continue
        out.append(("REC", first, max(after[0] - 1, last)) if recitals else ("TOC", first, behind[0] - 1))
        if not items or first <= items[0][0]:
            continue
        start = items[0][0]
        per = sum(lengths[x] for x in range(start, first)) / (first - start)
        count = lambda x: sum(i[0] <= x for i in items)
        done = False
        if before is not None and count(before[0]) < 100 and first > before[0]:
            density = (count(first) - count(before[0])) / (first - before[0])
            if per < 90 and density > 0.4 or per < 60 and density > 0.3:
                out.append(("REM_TOC", before[0], first - 1))
                done = True
        if not done and count(first) > 11 and count(first) / first > 0.7 and per < 50 and items[0][1] in (1, 9):
            out.append(("REM_TOC", start, first - 1))
    return out


def test_decisions_equal_the_plain_version(spark):
    rnd = random.Random(4)
    docs = {}
    for d in range(150):
        n = rnd.randint(5, 60)
        free = rnd.sample(range(1, n + 1), n)
        marks = [(free.pop(), rnd.choice(["Preamble", "Preamble", "Recitals", "Table_Of_Contents", "Sigblock"])) for _ in range(rnd.randint(0, min(6, len(free))))]
        size = rnd.randint(3, 9)
        items = [(free.pop(), rnd.choice([1, 1, 2, 9, 4]), rnd.randint(0, size - 1), size) for _ in range(rnd.randint(0, len(free)))]
        docs[d] = marks, items, {x: rnd.choice([20, 45, 100]) for x in range(1, n + 1)}
    marks = spark.createDataFrame([(d, *m) for d, x in docs.items() for m in x[0]], "doc_id long, para_no int, name string")
    items = spark.createDataFrame([(d, *i) for d, x in docs.items() for i in x[1]], "doc_id long, para_no int, enum int, nth int, n int")
    paragraphs = spark.createDataFrame([(d, *q) for d, x in docs.items() for q in x[2].items()], "doc_id long, para_no int, length int")
    found = p.decide_preambles(marks, items, paragraphs).cache()
    got = sorted(map(tuple, found.collect()))
    want = sorted((d, *r) for d, x in docs.items() for r in plain(*x))
    assert got == want and {r[1] for r in want} == {"REC", "TOC", "REM_TOC"}
    gone = {r[0] for r in want if r[1] == "REM_TOC"}
    assert sorted(map(tuple, p.after_removed_contents(found).collect())) == [r for r in want if r[1] != "REM_TOC" and r[0] in gone]
    assert p.decide_preambles(marks.where("false"), items, paragraphs).count() == 0


def test_document_values(spark):
    documents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None), (6, "zz")], "doc_id long, folder_id string")
    folders = spark.createDataFrame([("a", "p", None), ("b", "p", None), ("c", "q", None), ("d", "r", None), ("p", None, "o"), ("q", None, "o"), ("r", None, None)], "id string, parent_id string, org_id string")
    assigned = spark.createDataFrame([("a", None, "FRA"), ("a", None, "DEU"), ("p", None, "GBR"), (None, "o", "ESP")], "folder_id string, org_id string, country string")
    assert {r.doc_id: r.country for r in p.document_values(documents, folders, assigned).collect()} == {1: "DEU", 2: "GBR", 3: "ESP", 4: "USA", 5: "USA", 6: "USA"}


def test_label_spans(spark):
    rows = spark.createDataFrame([(1, '<b><span id="sp_4">Base</span> <span id=sp_5>Rent</span></b>'), (2, "no spans"), (3, ""), (4, None)], "id int, html string")
    got = {r.id: tuple(r)[1:] for r in p.label_spans(rows, ["id"]).collect()}
    assert got[1] == ("Base Rent", 2, 2, 4, 5) and got[2] == ("no spans", 2, 0, None, None) and got[3] == ("", 0, 0, None, None) and got[4][0] is None
