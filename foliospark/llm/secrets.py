"""Secret scans with corpus-wide ownership frequency; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import durable

#: Kinds in their order, their patterns (leftmost, not overlapping), the group and its least length.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: The method's own kind: long tokens of small and capital letters and digits that only one owner has, in few repositories.
OWNED = "owned"
_TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: A value that so many owners or so many repositories hold is an example that was copied widely.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10
#: Strings that only stand in made-up values (any case).
MADE_UP = r"(?i)example|sample|placeholder|changeme|dummy|your[-_]|xxxx|0123456789|1234567890|abcdefgh|(.)\1{5}"
_SPAN = "array<struct<start:long,kind:int,end:long,value:string>>"


def looks_live(value: Column) -> Column:
    """Whether a value looks like one in use: letters and digits, three different characters at least, and nothing of MADE_UP."""
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= 3) & ~value.rlike(MADE_UP)


def _matches(text: Column, kind: int, pattern: str, group: int) -> Column:
    """Array of (kind, nth, gap, size, value): each match, its length in code points and that of the text since the match before."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("b"), whole.alias("w"), value.alias("v"))
    cell = lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("nth"), F.length(m["b"]).alias("gap"), F.length(m["w"]).alias("size"), m["v"].alias("value"))
    return F.when(text.rlike(pattern), F.transform(found, cell)).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,value:string>>"))


def span_names(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in [*KINDS, OWNED]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found_spans(docs: DataFrame, text_col: str, owner_col: str, keep: tuple[str, ...], repository_col: str) -> tuple[DataFrame, DataFrame]:
    """The kept columns by row number, and a row for each span: (__row, kind, start, end, value, live, example)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = [*KINDS.values(), (_TOKEN, 0, 20)]
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((owner_col, "__owner"), (repository_col, "__repository"))]
    found = docs.select(*keep, *named, F.concat(*(_matches(text, k, p, g) for k, (p, g, _) in enumerate(every))).alias("__found"))
    found = durable(found.withColumn("__row", F.monotonically_increasing_id()))
    each = found.where("size(__found) > 0").select("__row", "__owner", "__repository", F.explode("__found").alias("m")).select("__row", "__owner", "__repository", "m.*")
    upto = Window.partitionBy("__row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto))
    least = F.element_at(F.array(*(F.lit(n) for _, _, n in every)), F.col("kind") + 1)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    each = each.where((F.length("value") >= least) & ((F.col("kind") < len(KINDS)) | mixed))
    each = durable(each.select("__row", "__owner", "__repository", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value", F.sha2(F.col("value").cast("binary"), 256).alias("hash")))
    owners = each.select("hash", "__owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    repositories = each.select("hash", "__repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    holders = durable(owners.join(repositories, "hash"))
    alone = (F.col("owners") == 1) & (F.col("repositories") < EXAMPLE_REPOSITORIES)
    live = alone & looks_live(F.col("value"))
    wide = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    example = F.when(F.col("kind") == len(KINDS), ~live).otherwise(wide)
    return found.drop("__found", "__owner", "__repository"), each.join(holders, "hash").select("__row", "kind", "start", "end", "value", live.alias("live"), example.alias("example"))


def scan_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", keep: tuple[str, ...] = ("doc_id",), repository_col: str = "doc_id") -> DataFrame:
    """Rows (keep..., base, spans, n_live, n_example): where each text holds secrets.

    base: array of (start, kind, end, value), the spans of KINDS, in code points, end exclusive.
    spans: base and the method's own, of kind len(KINDS): tokens that look random and are live.
    n_live: spans whose value is live: it looks like one in use (looks_live), has one owner and fewer
    than EXAMPLE_REPOSITORIES repositories. n_example: base spans whose value has EXAMPLE_OWNERS or
    EXAMPLE_REPOSITORIES and more, and random tokens that aren't live (spans leaves them out).
    Ownership is counted over all rows, by a SHA-256 digest of the value: distinct owners and distinct
    repositories of each value.

    A null or empty text has no spans; a null owner or repository counts as one of its own name;
    repeated rows each give a row and count once for their owner and repository. An empty table
    gives no rows. A kept column named like one of the results gives way to it.

    Matches are rows of lengths, whose running sums are the places, so that a text of very many
    matches takes time in proportion. Counts are aggregated before they are shuffled; a value that
    very many rows hold is joined back from a written table, so that the skewed join can be split.
    """
    keep = tuple(c for c in keep if c.lower() not in ("base", "spans", "n_live", "n_example"))
    found, each = _found_spans(docs, text_col, owner_col, keep, repository_col)
    span = F.struct("start", "kind", "end", "value")
    own = F.col("kind") == len(KINDS)
    judged = each.groupBy("__row").agg(
        F.sort_array(F.collect_list(F.when(~own, span))).alias("base"),
        F.sort_array(F.collect_list(F.when(~own | F.col("live"), span))).alias("spans"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(F.col("example"), 1)).alias("n_example"),
    )
    none = F.array().cast(_SPAN)
    out = found.join(judged, "__row", "left")
    return out.select(*keep, *(F.coalesce(c, none).alias(c) for c in ("base", "spans")), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_example")))


def redact_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", mark: str = "[secret]", repository_col: str = "doc_id") -> DataFrame:
    """The rows with each span of scan_secrets replaced by `mark` in their text; overlapping spans by one.

    Rows and columns stay as they are otherwise; a null text stays null. Texts without base or token
    spans are not shuffled; the others are joined with their spans by a SHA-256 digest of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    any_span = text.rlike("|".join(p for p, _, _ in [*KINDS.values(), (_TOKEN, 0, 0)]).replace("(?i)", "", 1).replace("(password|passwd|secret|token|api_?key)", "(?i:password|passwd|secret|token|api_?key)"))
    names = docs.columns
    key = F.sha2(text.cast("binary"), 256).alias("__key")
    found, each = _found_spans(docs.where(any_span).select(*dict.fromkeys((text_col, owner_col, repository_col)), key), text_col, owner_col, ("__key",), repository_col)
    each = each.where((F.col("kind") < len(KINDS)) | F.col("live")).select("__row", "start", "end").distinct()
    before = Window.partitionBy("__row").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") >= F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    each = each.withColumn("__fresh", fresh.cast("int")).withColumn("__nth", F.sum("__fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    cuts = each.groupBy("__row", "__nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = cuts.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    cuts = durable(found.join(cuts, "__row").groupBy("__key").agg(F.first("__cuts").alias("__cuts")))

    # four bytes for each code point: a piece is found without reading what is before it
    edges = F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), F.col("__cuts.end")).alias("a"), F.concat(F.col("__cuts.start"), F.array(F.length(text).cast("long"))).alias("b"))
    piece = lambda wide, e: F.decode(F.substring(wide, (e["a"] * 4 + 1).cast("int"), ((e["b"] - e["a"]) * 4).cast("int")), "UTF-32")
    clean = F.transform(F.array(F.encode(text, "UTF-32")), lambda wide: F.array_join(F.transform(edges, lambda e: piece(wide, e)), mark))[0]
    joined = docs.where(any_span).withColumn("__key", key).join(cuts, "__key", "left").withColumn(text_col, F.when(F.col("__cuts").isNull(), F.col(text_col)).otherwise(clean))
    return docs.where(~any_span).select(*names).union(joined.select(*names))
