"""Text normalisation and numbering as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(c: Column) -> Column:
    """Small letters and digits, every other run one underscore, none in front."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_", "")


def standard_name(c: Column) -> Column:
    """Slug of a measure's name: square foot and feet shortened, no underscore at either end."""
    words = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")
    for long, short in (("square", "sq"), ("feet", "ft"), ("foot", "ft")):
        words = F.regexp_replace(words, long, short)
    return F.regexp_replace(F.regexp_replace(words, "^_+", ""), "_+$", "")


def camel_case(c: Column) -> Column:
    """snake_case to camelCase."""
    parts = F.split(c, "_")
    rest = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.expr("''"), p.substr(F.lit(2), F.length(p))))
    return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))


def pad8(c: Column) -> Column:
    return F.lpad(c.cast("string"), 8, "0")


def normal_header(c: Column, keep_case: bool = False) -> Column:
    """Letters and digits of the first 41 characters."""
    plain = F.regexp_replace(F.substring(c, 1, 41), "[^A-Za-z0-9]", "")
    return plain if keep_case else F.lower(plain)


def normal_paragraph(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]+", " ")


def clean_quotes(c: Column, most: int = 80) -> Column:
    """Quotes, brackets, entities and line ends removed, cut to `most` characters."""
    plain = F.regexp_replace(F.regexp_replace(c, "&[a-z]+;", ""), "[\"'<>\\n]", "")
    return F.substring(F.ltrim(plain), 1, most)


def normal_token(c: Column) -> Column:
    """Parts of a token: small letters and digits, cut at hyphens and slashes between letters and before 's."""
    base = F.regexp_replace(F.regexp_replace(c, "^Ist$", "1st"), "'s.*$", "")
    cut = F.regexp_replace(F.lower(base), "([a-z])[-/\\\\]+(?=[a-z])", "$1 ")
    kept = F.regexp_replace(cut, "[^a-z0-9 -]", "")
    kept = F.regexp_replace(F.regexp_replace(kept, "^-+", ""), "-+ ", " ")
    kept = F.regexp_replace(kept, "([^a-z])-+$", "$1")
    return F.filter(F.split(kept, " "), lambda x: x != "")


#: Roman digits.
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}


def roman_value(c: Column) -> Column:
    """Subtractive roman numeral; XL and VL at the end are misread XI and VI. Null if it is none."""
    fixed = F.regexp_replace(F.upper(c), "([XV])L$", "$1I")
    digits = F.transform(F.split(fixed, ""), lambda d: F.coalesce(*(F.when(d == k, F.lit(v)) for k, v in ROMAN.items()), F.lit(0)))
    pairs = F.zip_with(digits, F.concat(F.slice(digits, 2, F.size(digits)), F.array(F.lit(0))), lambda a, b: F.when(a < b, -a).otherwise(a))
    return F.when(fixed.rlike("^[IVXLC]+$"), F.aggregate(pairs, F.lit(0), lambda n, x: n + x))


#: Number words.
UNITS = [
    "ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN", "ELEVEN", "TWELVE", "THIRTEEN", "FOURTEEN", "FIFTEEN", "SIXTEEN",
    "SEVENTEEN", "EIGHTEEN", "NINETEEN",
]
TENS = ["TWENTY", "THIRTY", "FORTY", "FIFTY", "SIXTY", "SEVENTY", "EIGHTY", "NINETY"]
ORDINALS = [
    "FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH", "TENTH", "ELEVENTH", "TWELFTH", "THIRTEENTH", "FOURTEENTH",
    "FIFTEENTH", "SIXTEENTH", "SEVENTEENTH", "EIGHTEENTH", "NINETEENTH", "TWENTIETH",
]


def number_words() -> dict[str, int]:
    cardinals = {w: i + 1 for i, w in enumerate(UNITS)} | {w: 10 * (i + 2) for i, w in enumerate(TENS)}
    return cardinals | {w: i + 1 for i, w in enumerate(ORDINALS)}


def word_number(c: Column) -> Column:
    """Value of an English number word or of two joined by a hyphen; null if a part is unknown."""
    table = F.create_map(*(F.lit(x) for pair in number_words().items() for x in pair))
    values = F.transform(F.split(F.upper(c), "[- ]"), lambda w: F.try_element_at(table, w))
    return F.aggregate(values, F.lit(0), lambda n, x: n + x)


def section_fields(c: Column) -> Column:
    """The at most five fields of a section string."""
    return F.slice(F.filter(F.split(c, "[.,:) -]"), lambda x: x != ""), 1, 5)


#: Numeral styles in order of test (name, pattern of the whole section string).
NUMERAL_STYLES = [
    ("decimal_pair", r"\d{1,2}\.\d{1,2}\.?"),
    ("decimal_triple", r"\d{1,2}\.\d{1,2}\.\d{1,2}\.?"),
    ("digit", r"\d{1,3}[.)]?"),
    ("digit_paren", r"\(\d{1,3}\)"),
    ("roman_small", r"[ivx]{1,6}[.)]"),
    ("roman_small_paren", r"\([ivx]{1,6}\)"),
    ("roman_capital", r"[IVX]{1,6}[.)]?"),
    ("roman_capital_paren", r"\([IVX]{1,6}\)"),
    ("letter_small", r"[a-z][.)]"),
    ("letter_small_paren", r"\([a-z]{1,2}\)"),
    ("letter_capital", r"[A-Z][.)]"),
    ("letter_capital_paren", r"\([A-Z]{1,2}\)"),
]


def numeral_style(c: Column) -> Column:
    chain = F
    for name, pattern in NUMERAL_STYLES:
        chain = chain.when(c.rlike(f"^({pattern})$"), F.lit(name))
    return chain.otherwise(F.lit("none"))


def section_value(c: Column) -> Column:
    """Value of the last field by its style: digits, roman digits, or the letter's place."""
    last = F.element_at(section_fields(F.regexp_replace(c, r"[()]", "")), -1)
    style = numeral_style(c)
    letter = F.ascii(F.lower(last)) - 96
    return F.when(style.startswith("roman"), roman_value(last)).when(style.startswith("letter"), letter).otherwise(last.try_cast("int"))


def page_reference(c: Column) -> Column:
    """Trailing page number of a line: digits or a small roman numeral; null if there is none."""
    tail = F.regexp_extract(c, r"(\d{1,3}|[ivx]{1,4})\s*$", 1)
    return F.when(tail.rlike(r"^\d+$"), tail.try_cast("int")).when(tail != "", roman_value(tail))


def caps_header(c: Column) -> Column:
    """The run of capital words that opens a header, if it has three capitals and the rest at most a third as many; else the header."""
    run = F.rtrim(F.regexp_extract(c, r"^([^a-z]*)(?=[A-Z][a-z]|$)", 1))
    caps = F.regexp_count(run, F.lit("[A-Z]"))
    later = F.regexp_count(c, F.lit("[A-Z]")) - caps
    return F.when((caps >= 3) & (3 * later <= caps), run).otherwise(c)


def sentence_header(c: Column, most: int = 80) -> Column:
    """A header up to its first full stop, colon or dash after the third character, at most `most` characters."""
    head = F.regexp_extract(c, r"^(.{3}[^.:\-]*)", 1)
    return F.substring(F.rtrim(F.when(head == "", c).otherwise(head)), 1, most)


def overlap_area(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Common area of two boxes given by x1, x2, y1 and y2."""
    side = lambda lo, hi: F.greatest(F.lit(0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    return side("x1", "x2") * side("y1", "y2")


def box_area(a: dict[str, Column]) -> Column:
    return (a["x2"] - a["x1"]) * (a["y2"] - a["y1"])


def edit_distance(a: Column, b: Column, longest: int = 150) -> Column:
    """Levenshtein distance; the sum of the lengths where a text is longer than `longest`."""
    return F.when((F.length(a) > longest) | (F.length(b) > longest), F.length(a) + F.length(b)).otherwise(F.levenshtein(a, b))


def similarity(a: Column, b: Column) -> Column:
    """Edit distance as a share of the longer text."""
    return edit_distance(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def display_number(c: Column, places: int = 0) -> Column:
    return F.format_number(c, places)


def display_date(c: Column) -> Column:
    return F.date_format(c, "MM/dd/yyyy")


def partial_date(year: Column, month: Column, day: Column) -> Column:
    """A date whose missing parts are 1970 or 1, and which of them were missing."""
    known = lambda part: F.coalesce(part, F.lit(0)) != 0
    made = F.make_date(F.when(known(year), year).otherwise(1970), F.when(known(month), month).otherwise(1), F.when(known(day), day).otherwise(1))
    return F.struct(made.alias("date"), (~known(year)).alias("no_year"), (~known(month)).alias("no_month"), (~known(day)).alias("no_day"))


#: Tags that stay.
KEPT_TAGS = ["p", "table", "td", "tr", "th", "h\\d", "hr", "html", "head", "body", "title", "utable"]


def strip_tags(c: Column) -> Column:
    """All tags but those of KEPT_TAGS removed."""
    return F.regexp_replace(c, r"(?i)<(?!/?(?:" + "|".join(KEPT_TAGS) + r")\b)[^>]*>", "")


def remove_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def leading_int(c: Column) -> Column:
    """Leading digits as a number, 0 without any."""
    return F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0))


def relative_ratio(a: Column, b: Column) -> Column:
    """|b - a| / (a + b): how much two counts disagree."""
    return F.abs(b - a) / (a + b)


#: Kinds of page references.
PAGE_TYPES = {"none": 0, "roman": 1, "arabic": 2, "letter": 3, "bad": 4}


def page_type(c: Column) -> Column:
    """Kind of a page reference: digits (with an I in front read as 1; I alone too), small roman digits, none, or neither."""
    return (
        F.when(c == "", PAGE_TYPES["none"])
        .when(c.rlike(r"^I?\d+$") | (c == "I"), PAGE_TYPES["arabic"])
        .when(c.rlike("^I?[ivx]+$"), PAGE_TYPES["roman"])
        .otherwise(PAGE_TYPES["bad"])
    )


def page_value(c: Column) -> Column:
    """Number of a page reference: 1 for I, 0 for one that is bad."""
    kind = page_type(c)
    digits = F.greatest(F.lit(1), F.coalesce(F.regexp_replace(c, "^I", "1").try_cast("int"), F.lit(0)))
    return F.when(kind == PAGE_TYPES["arabic"], digits).when(kind == PAGE_TYPES["roman"], roman_value(c)).otherwise(0)


def unescape(c: Column) -> Column:
    r"""Text with \uXXXX, \n, \" and the like resolved; a text that is no JSON string's inside stays as it is."""
    bare = F.regexp_replace(F.regexp_replace(c, r'(?<!\\)((?:\\\\)*)"', r'$1\\"'), r"\t", r"\\t")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\r", r"\\r"), r"\n", r"\\n")
    return F.coalesce(F.element_at(F.from_json(F.concat(F.lit('["'), bare, F.lit('"]')), "array<string>"), 1), c)


def split_distance(a: Column, b: Column) -> Column:
    """Edit distance of two readings and its parts: struct of distance, capital, non_alnum and alnum, which add up to it."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    whole, low, core = edit_distance(a, b), edit_distance(F.lower(a), F.lower(b)), edit_distance(plain(a), plain(b))
    core = F.least(core, low)
    return F.struct(whole.alias("distance"), (whole - low).alias("capital"), (low - core).alias("non_alnum"), core.alias("alnum"))


def title_case(c: Column) -> Column:
    """Every word with a capital in front and small letters after it."""
    return F.initcap(F.lower(c))


def lower_and_cut(c: Column, most: int = 100) -> Column:
    return F.lower(F.substring(c, 1, most))


def after_last(c: Column, mark: str) -> Column:
    """The rest of a text from the last place of a mark on; empty if it has none."""
    return F.when(c.contains(mark), F.concat(F.lit(mark), F.substring_index(c, mark, -1))).otherwise(F.lit(""))


def or_placeholder(c: Column, placeholder: str = "-") -> Column:
    return F.coalesce(F.when(c != "", c), F.lit(placeholder))


def prefix_class(c: Column, names: dict[str, str], other: str) -> Column:
    """The class of the first of `names` that a text begins with, whatever its capitals."""
    chain = F
    for prefix, name in names.items():
        chain = chain.when(F.lower(c).startswith(prefix.lower()), F.lit(name))
    return chain.otherwise(F.lit(other))


def count_tags(c: Column, tag: str) -> Column:
    return F.regexp_count(c, F.lit(f"(?i)<{tag}\\b"))


#: Small words inside headers in capitals.
SMALL_WORDS = ["a", "an", "and", "as", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with"]


def capital_head(c: Column, most: int = 80) -> Column:
    """The words that open a header up to the first one without a capital that is no small word, at most `most` characters; empty if the first is one."""
    word = r"(?:[A-Z0-9(][^\s]*|" + "|".join(SMALL_WORDS) + ")"
    return F.rtrim(F.substring(F.regexp_extract(c, rf"^((?:{word}(?:\s+|$))*)", 1), 1, most))


def balanced(c: Column) -> Column:
    """As many opening as closing brackets and braces."""
    n = lambda mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    return (n("{") == n("}")) & (n("[") == n("]"))
