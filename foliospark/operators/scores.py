"""Marks of lines and the page scores that rest on them; titles, exhibit headings and paragraph scores.

Scores are whole numbers: quotients are cut towards zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify, text
from .pages import count_if, line_stats

#: Where a line counts as centred, in ten-thousandths of the page's width.
CENTER, LEFT = (4750, 5250), 1667
WIDE_CENTER, WIDE_LEFT = (4583, 8917), (2000, 10000)
FAR_LEFT = 2333
#: What a line of a table of contents begins and ends with.
ITEM_START = r"^(Exhibit|Schedule|Section|Article|EXHIBIT|SCHEDULE|SECTION|ARTICLE|[0-9]+\.|[a-zA-Z]\.|\([A-Za-z0-9]{1,2}\)|[0-9LlIO]{1,2}[.,][0-9LlIO]{1,2}([^A-Za-z0-9]|$))"
REFERENCE_END = r"^([0-9]{1,3}|[ivx]{1,4})$"
#: Words that head a table of contents.
CONTENTS_WORDS = ["CONTENTS", "INDEX"]
#: Words of lease titles in capitals, and how many of their letters are compared; the whole word where none is given.
TITLE_CAPITALS = [
    ("AGREEMENT", 7),
    ("JOINDER", 7),
    ("ATTORNMENT", 6),
    ("DISTURBANCE", 6),
    ("SUBLEASE", 6),
    ("ACKNOWLEDGEMENT", None),
    ("AMENDMENT", 5),
    ("RENEWAL", 7),
    ("SUBORDINATION", 6),
    ("CONSENT", None),
    ("ADDENDUM", 6),
    ("GUARANTY", 8),
    ("ASSIGNMENT", 7),
    ("ASSUMPTION", None),
    ("COMMENCEMENT", 6),
    ("MEMORANDUM", 6),
    ("MODIFICATION", 6),
    ("ESTOPPEL", 5),
    ("CERTIFICATE", 5),
    ("LETTER", 4),
    ("INVOICE", 4),
    ("COMMISSION", 4),
]
#: The same for words with small letters.
TITLE_CASED = [
    ("Agreement", None),
    ("Joinder", 7),
    ("Sublease", None),
    ("Acknowledgement", None),
    ("Amendment", None),
    ("Renewal", 7),
    ("Extension", None),
    ("Addendum", None),
    ("Guaranty", None),
    ("Assignment", None),
    ("Assumption", None),
    ("Commencement", None),
    ("Modification", None),
    ("Memorandum", None),
    ("Estoppel", None),
    ("Certificate", None),
    ("Letter", None),
]
#: What must not follow LEASE in a title, and Lease.
NOT_AFTER_CAPITALS = [("SUMMARY", 5), ("ADMINISTRATOR", 5), ("DATA", None), ("TERMS", None), ("PROVISIONS", 6), ("RESTRICTIONS", 6), ("FACE", None), ("YEAR", None), ("INFORMATION", 6)]
NOT_AFTER_CASED = ["Summary", "Administrator", "Data", "Terms", "Provisions", "Restrictions", "Face", "Year", "Information"]


def reads_as(c: Column, words: list[tuple[str, int | None]]) -> Column:
    """Whether a word is one of the words, or begins with as many of its letters as are compared."""
    return c.rlike("^(" + "|".join(w[:n] if n else f"{w}$" for w, n in words) + ")")


def marked_lines(tokens: DataFrame) -> DataFrame:
    """line_stats with n_chars, the words n_sig, n_by, n_party, n_witness, n_names and n_contents, and the marks toc_item and page_ref with their numbers."""
    word, low = F.col("text"), F.lower(F.regexp_replace("text", "[^A-Za-z]", ""))
    first, last = F.min_by("text", "sn"), F.max_by("text", "sn")
    return line_stats(
        tokens,
        F.sum(F.length(word)).alias("n_chars"),
        count_if(word.isin(*classify.SIGNATURE_WORDS)).alias("n_sig"),
        count_if(low == "by").alias("n_by"),
        count_if(low.isin(*classify.PARTY_ROLES)).alias("n_party"),
        count_if(low == "witness").alias("n_witness"),
        count_if(low.isin("name", "title", "date")).alias("n_names"),
        count_if(word.isin(*CONTENTS_WORDS)).alias("n_contents"),
        first.rlike(ITEM_START).cast("int").alias("toc_item"),
        last.rlike(REFERENCE_END).cast("int").alias("page_ref"),
        text.leading_int(first).alias("item_value"),
        F.when(last.rlike(REFERENCE_END), text.leading_int(last)).otherwise(0).alias("ref_value"),
    )


def centred() -> Column:
    return (F.col("center") > CENTER[0]) & (F.col("center") < CENTER[1]) & (F.col("left_x") > LEFT)


def mostly_caps(all_caps: bool = True) -> Column:
    first = F.col("n_words") * 2 < F.col("n_first_cap") * 3
    return (F.col("n_words") * 2 < F.col("n_all_cap") * 3) | first if all_caps else first


def document_scores(marked: DataFrame) -> DataFrame:
    """(doc_id, page, title_score, toc_score, sig_score) of the pages of marked_lines.

    Title pages are short, centred and in capitals; pages of contents hold lines that begin as items and
    end in references; signature blocks hold the words of those who sign. Null centres count as not centred.
    """
    real = F.col("n_chars") > 2
    wide = F.col("center").between(WIDE_CENTER[0] + 1, WIDE_CENTER[1] - 1) & F.col("left_x").between(WIDE_LEFT[0] + 1, WIDE_LEFT[1] - 1)
    sums = marked.groupBy("doc_id", "page").agg(
        F.count("*").alias("lines"),
        F.sum("n_words").alias("words"),
        count_if(real).alias("real"),
        count_if(real & (centred() | wide)).alias("middle"),
        count_if(real & (F.col("n_words") > 9)).alias("long"),
        count_if(real & mostly_caps()).alias("caps"),
        count_if(centred()).alias("all_middle"),
        count_if(F.col("n_words") > 9).alias("all_long"),
        count_if(mostly_caps(False)).alias("all_caps"),
        *(F.sum(c).alias(c) for c in ("n_sig", "n_by", "n_party", "n_witness", "n_names", "toc_item", "page_ref")),
        F.max((F.col("n_contents") > 0).cast("int")).alias("headed"),
    )
    title = "10 + greatest(0, 11 - real) * 5 + 5 * (middle - real) div (real + 2) - 10 * long div (real + 2) - 10 * n_sig div (words + 2) + 5 * (caps - real) div (real + 2)"
    toc = "100 * all_caps div (lines + 2) - 100 * all_middle div (lines + 2) - 100 * all_long div (lines + 2) + 200 * toc_item div (lines + 2) + 100 * page_ref div (lines + 2) + 150 * headed - 100"
    sig = "10 * n_by + 10 * if(n_party <= 4, n_party, 8 - n_party) + 150 * n_witness + 5 * if(n_names < 10, n_names, 10 - n_names)"
    return sums.selectExpr("doc_id", "page", f"{title} as title_score", f"{toc} as toc_score", f"{sig} as sig_score")


def contents_report(marked: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, page, n_items, n_lines, is_contents): pages of contents have items on more than `least` of their lines."""
    by_page = marked.groupBy("doc_id", "page").agg(F.sum("toc_item").alias("n_items"), F.count("*").alias("n_lines"))
    return by_page.withColumn("is_contents", F.col("n_items") > least * F.col("n_lines"))


def title_words(tokens: DataFrame) -> DataFrame:
    """Tokens with is_title: words of lease titles; "lease" only where the words beside it don't make it another phrase."""
    w = Window.partitionBy("doc_id").orderBy("sn")
    before, after = F.lag("text", 1, "").over(w), F.lead("text", 1, "").over(w)
    third = F.lead("text", 2, "").over(w)
    word = F.col("text")
    capitals = word.startswith("LEAS") & ~reads_as(after, NOT_AFTER_CAPITALS)
    cased = (word == "Lease") & ~after.isin(NOT_AFTER_CASED)
    lease = (capitals | cased) & (F.lower(before) != "of")
    rules = (word == "RULES") & third.startswith("REGU")
    named = reads_as(word, TITLE_CAPITALS) | reads_as(word, TITLE_CASED)
    return tokens.withColumn("is_title", lease | rules | named)


def lease_titles(tokens: DataFrame, lines_per_page: int, top: int = 5) -> DataFrame:
    """(doc_id, page, line, n_title, score): short lines at the top of a page that hold words of lease titles and score 22 or more.

    Ten points for each such word, for a centred line, for one that starts inside, and for capitals; ten less at the far left.
    """
    lines = line_stats(title_words(tokens), count_if(F.col("is_title")).alias("n_title"))
    middle = (F.col("center") > CENTER[0]) & (F.col("center") < CENTER[1])
    points = lambda c: F.when(c, 10).otherwise(0)
    score = 10 * F.col("n_title") + points(middle) - points(F.col("center") < FAR_LEFT) + points(F.col("left_x") > LEFT) + points(mostly_caps())
    at_top = F.col("line") % lines_per_page < top
    return lines.where(at_top & (F.col("n_title") > 0) & (F.col("n_words") <= 7)).select("doc_id", "page", "line", "n_title", score.alias("score")).where("score >= 22")


def exhibit_headings(lines: DataFrame, near: int = 133) -> DataFrame:
    """(doc_id, page, line, heading): exhibit labels of lines (doc_id, page, line, text, center, n_words, n_first_cap), with the lines below that are centred alike.

    Up to four lines of the page follow in order, each by itself short enough, from the second on in capitals too.
    """
    w = Window.partitionBy("doc_id", "page").orderBy("line")
    row = F.struct("text", "center", "n_words", "n_first_cap")
    below = [F.lead(row, k).over(w) for k in range(1, 5)]
    seen = lines.withColumns({f"below{k}": c for k, c in enumerate(below, 1)}).where(classify.is_exhibit(F.col("text")))
    parts = [F.col("text")]
    for k in range(1, 5):
        x = F.col(f"below{k}")
        fits = (F.abs(x["center"] - F.col("center")) < near) & (F.col("n_words") < (10 if k < 3 else 6)) & (x["n_words"] < 10)
        if k > 1:
            fits = fits & (F.col("n_first_cap") * 2 >= F.col("n_words")) & (x["n_first_cap"] * 2 >= x["n_words"])
        parts.append(F.when(fits, x["text"]))
    return seen.select("doc_id", "page", "line", F.concat_ws(" ", *parts).alias("heading"))


def paragraph_scores(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, para_no, page, score) of paragraphs (doc_id, para_no, page, n_chars, toc_item, page_ref, item_value, ref_value, headed).

    Long paragraphs lose points; items, references and headings win them, and more where a number is that of the paragraph before or one above it.
    """
    w = Window.partitionBy("doc_id").orderBy("para_no")
    goes_on = lambda c: (F.col(c) != 0) & (F.col(c) - F.lag(c, 1, 0).over(w)).isin(0, 1)
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    length = F.col("n_chars")
    score = (
        points(F.col("toc_item") == 1, 5) + points(F.col("page_ref") == 1, 5) + points(F.col("headed") == 1, 300)
        + points(goes_on("ref_value"), 10) + points(goes_on("item_value"), 10)
        - points(length > 30, 5) - points(length > 100, 10) - points(length > 200, 15)
    )
    return paragraphs.select("doc_id", "para_no", "page", score.alias("score"))


def marked_paragraphs(tokens: DataFrame) -> DataFrame:
    """What paragraph_scores reads, of tokens with para_no."""
    first, last, word = F.min_by("text", "sn"), F.max_by("text", "sn"), F.col("text")
    return tokens.groupBy("doc_id", "para_no").agg(
        F.min("page").alias("page"),
        (F.sum(F.length(word)) + F.count("*") - 1).alias("n_chars"),
        first.rlike(ITEM_START).cast("int").alias("toc_item"),
        last.rlike(REFERENCE_END).cast("int").alias("page_ref"),
        text.leading_int(first).alias("item_value"),
        F.when(last.rlike(REFERENCE_END), text.leading_int(last)).otherwise(0).alias("ref_value"),
        F.max(word.isin(*CONTENTS_WORDS).cast("int")).alias("headed"),
    )


def contents_flags(items: DataFrame, runs: DataFrame, pages: DataFrame, least: int = 4, deepest: int = 12, long: int = 90) -> DataFrame:
    """Items (doc_id, para_no, page) with in_contents: within a run (doc_id, first_page, last_page) of contents.

    Only in documents of more than `least` pages (pages: doc_id, n_pages), before page `deepest` unless there are more than
    `long`, and never the first item. A document has few runs.
    """
    inside = items.join(runs.select("doc_id", "first_page", "last_page"), "doc_id").where(F.col("page").between(F.col("first_page"), F.col("last_page")))
    hit = inside.select("doc_id", "para_no").distinct().withColumn("hit", F.lit(True))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("para_no"))
    known = items.withColumn("nth", nth).join(hit, ["doc_id", "para_no"], "left").join(pages, "doc_id")
    allowed = (F.col("n_pages") > least) & (F.col("nth") > 1) & ((F.col("page") < deepest) | (F.col("n_pages") > long))
    return known.select("doc_id", "para_no", "page", (F.coalesce("hit", F.lit(False)) & allowed).alias("in_contents"))


def main_scores(seqs: DataFrame) -> DataFrame:
    """(doc_id, seq, score): how likely a sequence is the main one.

    seqs: doc_id, seq, n_items, header_words, includes, included, n_words, n_first_cap, n_all_cap, first_page,
    last_page, n_titled, plain (its numerals are of a common style). Of three items or more, and with header words.
    """
    ln = lambda c: F.log(F.col(c) + 1)
    score = (
        10 * ln("n_items") - F.when(F.col("n_items") <= 3, 20).otherwise(0)
        + 10 * (ln("header_words") - ln("n_items")) + ln("includes") - ln("included")
        + ln("n_first_cap") + ln("n_all_cap") - 2 * ln("n_words")
        + 5 * F.log(F.col("last_page") - F.col("first_page") + 1) + 2 * (ln("n_titled") - ln("n_items"))
        - F.when(F.col("plain"), 0).otherwise(15)
    )
    return seqs.where((F.col("n_items") > 2) & (F.col("header_words") > 0)).select("doc_id", "seq", score.alias("score"))
