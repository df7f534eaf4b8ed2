"""Predicates and classes of tokens and lines as Column functions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token categories in order of test and their patterns.
CATEGORIES = [
    ("HOUR", r"\d{1,2}:\d{2}([ap]m)?"),
    ("DATE", r"\d{1,2}[/-]\d{1,2}[/-](\d{4}|\d{2})"),
    ("PRICE", r"[$]\d{1,3}(,?\d{3})*([.]\d{1,2})?"),
    ("FOOTINCH", r"\d+'\d+\""),
    ("INCH", r"\d+([.]\d+)?\""),
    ("FOOT", r"\d+([.]\d+)?'"),
    ("SF", r"\d{1,3}(,\d{3})*(sf|SF)"),
    ("YEAR", r"(19[89]\d|20[012]\d|2030)"),
    ("ZIPCODE", r"\d{5}(-\d{4})?"),
    ("DECNUM", r"\d{1,3}(,\d{3})*[.]\d+"),
    ("ORDINAL", r"\d*(1st|2nd|3rd|\dth)"),
    ("NUMERATION", r"[(]?(\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)]"),
    ("MODEL", r"[A-Z]+-?\d+[A-Z0-9-]*"),
]


def token_category(c: Column) -> Column:
    chain = F
    for name, pattern in CATEGORIES:
        chain = chain.when(c.rlike(f"^({pattern})$"), F.lit(name))
    return chain.otherwise(F.lit("NONE"))


def word_shape(c: Column) -> Column:
    """0 letters and digits, 1 those before one mark, 2 those after one mark, 3 marks alone, 4 mixed."""
    return (
        F.when(c.rlike("^[A-Za-z0-9]+$"), 0).when(c.rlike("^[A-Za-z0-9]+[^A-Za-z0-9]$"), 1).when(c.rlike("^[^A-Za-z0-9][A-Za-z0-9]+$"), 2).when(c.rlike("^[^A-Za-z0-9]+$"), 3).otherwise(4)
    )


#: Tokens that stay whole.
UNSPLITTABLE = [
    r"\(\d{1,3}\)",
    r"\([a-z]{1,2}\)",
    r"[A-Za-z]\.",
    r"\([IVXivx]+\)",
    r"'[A-Z]'",
    r"[A-Za-z]+'t",
    r"[A-Z]'[A-Za-z]+",
    r"[A-Z]&[A-Za-z]+",
    r"(Mr|Mrs|Ms|Dr|St|No)\.",
    r"(https?://|www\.).+",
    r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+",
    r"([A-Z]\.){2,}",
    r"\d{1,3}\([a-z]\)",
    r"[a-z]\)",
]


def is_unsplittable(c: Column) -> Column:
    return c.rlike("^(" + "|".join(UNSPLITTABLE) + ")$")


def is_roman(c: Column) -> Column:
    return c.rlike("^[ivxl]{1,5}$|^[IVXL]{1,5}$")


def is_digits(c: Column, most: int = 3) -> Column:
    return c.rlike(f"^\\d{{1,{most}}}\\.?$")


def is_page_number(text: Column, x1: Column, x2: Column) -> Column:
    """A short centred line that says page, or holds at most two letters or digits, or a roman numeral."""
    middle = (x1 + x2) / 2
    plain = F.lower(F.regexp_replace(text, "[^A-Za-z0-9]", ""))
    says = F.lower(text).contains("page") | plain.rlike("^([a-z0-9]{1,2}|[ivxl]{1,5})$")
    return says & (F.length(text) <= 8) & middle.between(4000, 6000)


def is_exhibit(c: Column) -> Column:
    return F.lower(c).rlike("^(exhibit|schedule|appendix)")


#: Words that open a section.
SECTION_WORDS = ["section", "article", "exhibit", "addendum", "amendment", "paragraph", "clause", "schedule"]


def opens_section(c: Column) -> Column:
    return F.lower(c).rlike("^(" + "|".join(w[:7] for w in SECTION_WORDS) + ")")


def starts_toc_section(text: Column, x1: Column, x2: Column) -> Column:
    """A numbered or named heading, or a short centred line of capitals."""
    numbered = text.rlike(r"^(\d{1,2}\.|[ivx]{1,5}\.|[A-Z]\.|[a-z]\)|\([ivx]{1,5}\)|\(\d{1,2}\)|\([a-z]\))(\s|$)")
    named = text.rlike(r"(?i)^(" + "|".join(SECTION_WORDS) + r")\s+(\d+|[ivxl]+|[a-z])\b")
    centred = (x2 - x1 < 2000) & (F.abs((x1 + x2) / 2 - 5000) < 400)
    return numbered | named | (is_all_caps(text) & centred & (F.size(F.split(F.trim(text), r"\s+")) <= 4))


#: Words after which a sentence goes on.
CONNECTORS = ["in", "on", "this", "under", "of", "with", "to", "the", "an", "attached", "any", "all", "for", "thereto", "see", "and", "or", "as"]


def dangles(c: Column) -> Column:
    """Ends in a word after which the sentence goes on."""
    return F.lower(c).rlike(r"(^|\s)(" + "|".join(CONNECTORS) + r")\s*$")


def is_all_caps(c: Column) -> Column:
    return ~c.rlike("[a-z]") & c.rlike("[A-Z]")


def is_first_cap(c: Column) -> Column:
    return c.rlike("^[^A-Za-z]*[A-Z]")


def is_real_word(c: Column) -> Column:
    return c.rlike("^[A-Za-z]{2,}[.,;:]?$")


def is_non_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def is_split_word(c: Column, other: Column) -> Column:
    """Ends in a hyphen, and the other goes on from there."""
    stem = F.regexp_replace(c, "-+$", "")
    return c.endswith("-") & other.startswith(stem) & (F.length(other) > F.length(stem))


def refers_to_section(c: Column) -> Column:
    """Names a section inside a sentence instead of opening one."""
    return c.rlike(r"(?i)\b(in|of|under|to|with)\s+(section|article|paragraph)\s+\d+|(section|article|paragraph)\s+\d+\s+(hereof|above|below)")


#: Phrases of summary pages.
SUMMARY_PHRASES = [
    "definitions",
    "interpretation",
    "basic lease information",
    "basic lease provisions",
    "fundamental lease provisions",
    "basic lease terms",
    "lease summary sheet",
    "document cover sheet",
    "lease cover sheet",
    "contract cover sheet",
    "agreement cover sheet",
    "summary page",
    "cover sheet",
    "lease face page",
    "lease data",
    "basic data",
    "particulars",
]


def is_summary(c: Column) -> Column:
    return F.lower(c).rlike("|".join(SUMMARY_PHRASES))


#: Label, weight, and the ways to get it for what preambles, signature blocks, riders, tables of contents
#: and recitals say. A way is the phrases that must all stand, and whether the case of letters matters; one way is enough.
PHRASE_WEIGHTS = [
    ("preamble", 2, [(["made"], False)]),
    ("preamble", 1, [(["entered"], False)]),
    ("preamble", 4, [(["entered into"], False)]),
    ("preamble", 2, [(["having an office"], False)]),
    ("preamble", 2, [(["with offices at"], False)]),
    ("preamble", 2, [(["with principal offices at"], False)]),
    ("preamble", 2, [(["principal place of business"], False)]),
    ("preamble", 2, [(["located at"], False)]),
    ("preamble", 2, [(["all capitalized"], False)]),
    ("preamble", 1, [(["amendment"], False)]),
    ("preamble", 1, [(["addendum"], False)]),
    ("preamble", 1, [(["amends"], False)]),
    ("preamble", 1, [(["Effective Date"], True)]),
    ("preamble", 1, [(["effective date"], False)]),
    ("preamble", 1, [(["incorporated under"], False)]),
    ("preamble", 1, [(["limited liability company"], False)]),
    ("preamble", 1, [(["llc"], False)]),
    ("preamble", 1, [(["INC"], True), (["Inc"], True)]),
    ("preamble", 1, [(["collectively"], False)]),
    ("preamble", 1, [(["day of "], False)]),
    ("preamble", 1, [(["corporation"], False)]),
    ("preamble", 1, [(["hereinafter"], False)]),
    ("preamble", 2, [(["behalf"], False)]),
    ("preamble", 2, [(["subsidiaries"], False)]),
    ("preamble", 2, [(["affiliates"], False)]),
    ("preamble", 2, [(["agree as follows"], False)]),
    ("preamble", 4, [(["hereby agree as follows"], False)]),
    ("preamble", 1, [(["between"], False)]),
    ("preamble", 1, [(["herein"], False)]),
    ("preamble", 1, [(["dated"], False)]),
    ("preamble", 1, [(["among"], False)]),
    ("preamble", 1, [(["agreement"], False)]),
    ("preamble", 1, [(["amendment"], False), (["addendum"], False)]),
    ("preamble", 2, [([" by and between"], False)]),
    ("preamble", 1, [([" as of "], False)]),
    ("preamble", 1, [([" effective "], False)]),
    ("preamble", 2, [(["This "], True)]),
    ("preamble", 2, [(["THIS "], True)]),
    ("preamble", 1, [(["letter of intent"], False)]),
    ("preamble", 1, [(["statement of work"], False)]),
    ("preamble", 1, [(["statement of services"], False)]),
    ("preamble", 1, [(["sow"], False)]),
    ("preamble", 2, [(["In connection"], True)]),
    ("preamble", 2, [(["In consideration"], True)]),
    ("preamble", 1, [(["sos"], False)]),
    ("preamble", -8, [(["miscellaneous"], False)]),
    ("preamble", -2, [(["termination"], False)]),
    ("preamble", -3, [(["governing law"], False)]),
    ("preamble", -3, [(["definitive agreement"], False)]),
    ("preamble", -3, [(["jurisdiction"], False)]),
    ("preamble", -3, [(["arbitration"], False)]),
    ("preamble", -2, [(["construed"], False)]),
    ("preamble", -2, [(["shall mean"], False), (["means"], False)]),
    ("preamble", -2, [(["governed"], False)]),
    ("preamble", -2, [(["controlled"], False)]),
    ("preamble", -2, [(["no agency"], False)]),
    ("preamble", -2, [(["entire agreement"], False)]),
    ("preamble", -10, [(["WHEREAS"], True), (["Whereas"], True)]),
    ("preamble", -10, [(["THEREFORE"], True)]),
    ("signature", 10, [(["in witness whereof"], False)]),
    ("signature", 10, [(["signatures follow"], False), (["signatures", "follow", "page"], False)]),
    ("signature", 20, [(["agreed", "accepted"], False)]),
    ("signature", 10, [(["Whereof"], True), (["WHEREOF"], True)]),
    ("signature", 10, [(["Witness "], True), (["WITNESS "], True)]),
    ("rider", 10, [(["RIDER"], True)]),
    ("toc", 10, [(["table of contents"], False), (["TABLE", "CONTENTS"], True)]),
    ("toc", 15, [(["INDEX"], True)]),
    ("toc", 15, [(["EXHIBITS"], True)]),
    ("toc", 15, [(["list of exhibits"], False)]),
    ("recitals", 10, [(["whereas"], False), (["w h e r e a s"], False)]),
    ("recitals", 5, [(["in consideration"], False)]),
    ("recitals", 5, [([" agree as follows"], False)]),
    ("recitals", 5, [(["the parties agree as follows"], False), (["hereby agree as follows"], False)]),
    ("recitals", 10, [(["now", "therefore"], False)]),
    ("recitals", 10, [(["recitals"], False), (["r e c i t a l s"], False)]),
    ("recitals", 10, [(["BACKGROUND"], True), (["Background"], True)]),
]
#: A paragraph carries a label if it scores more.
LABEL_BAR = {"preamble": 2, "signature": 5, "rider": 5, "toc": 5, "recitals": 5}
#: How many paragraphs of a document may carry a label.
LABEL_CAPS = {"preamble": 25, "signature": 5, "rider": 5, "toc": 5, "recitals": 100}


def phrase_text(c: Column) -> Column:
    """A paragraph with runs of other than letters and digits as one space, and one at its end."""
    return F.concat(F.rtrim(F.regexp_replace(c, "[^A-Za-z0-9]+", " ")), F.lit(" "))


def phrase_score(c: Column, label: str) -> Column:
    """Sum of the weights of a label's phrases that a paragraph holds, runs of other than letters and digits read as one space, and one at its end."""
    plain = phrase_text(c)
    return phrase_sum(plain, F.lower(plain), label)


def phrase_sum(plain: Column, low: Column, label: str) -> Column:
    """phrase_score of a text that phrase_text has made, as it stands and in small letters: columns, so that they are not made again for each phrase."""

    def holds(way: tuple[list[str], bool]) -> Column:
        phrases, with_case = way
        return reduce(and_, [(plain if with_case else low).contains(p) for p in phrases])

    return sum((F.when(reduce(or_, map(holds, ways)), w).otherwise(0) for k, w, ways in PHRASE_WEIGHTS if k == label), F.lit(0))


#: Words for the parties of a contract.
PARTY_ROLES = [
    "landlord", "lessor", "lessee", "tenant", "agent", "broker", "sublessor", "sublessee", "sublandlord", "subtenant", "mortgagee", "morgagor",
    "buyer", "reseller", "seller", "licensor", "licensee", "employer", "employee", "owner", "lender", "borrower", "guarantor", "assignor", "assignee",
    "declarant", "reinsurer", "customer", "representative", "supplier", "distributor", "witness", "attest", "property", "building",
]
#: Weights of words on title pages and in signature blocks.
TITLE_WORDS = {"dated": 10, "effective": 10, "between": 10, "inc": 10, "shopping": 10, "center": 10, "lease": 10, "agreement": 10, "and": 2, "llc": 2}
SIGNATURE_WORDS = {"DATE": 10, "Date": 10, "BY": 10, "By": 10, "NAME": 10, "Name": 10, "TITLE": 10, "Title": 10}


def is_abstract_name(c: Column) -> Column:
    """Names of abstracts and finance papers."""
    return F.lower(c).rlike("abstract|ccr|recon")
