"""Mixing sources to target weights: repetition rates of sources, whole copies and one hash-seeded further copy; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import durable, numbered

#: Rates of at most so many sources are broadcast (of at most some hundred bytes each); with more, they are joined by source and salt.
FEW_SOURCES = 20_000
SALTS = 32
#: Names of the operator's own columns; kept columns of these names give way.
MADE = ("size", "source_size", "target", "rate", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of words between blanks (space, tab to carriage return); null: none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _unit(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from a SHA-256 of the seed and the parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """Sources (source, source_size, ...) with weight and target.

    Sources in order of code points, null last, weigh `weights`, repeating, and share share[0] /
    share[1] of all sizes; a target stops at `most` times its source's size and the excess is shared
    anew by weight until none is above. Each round sees the sources once and gives the driver three
    sums; a round more is only needed where it capped another source. A budget above `most` times
    all sizes leaves every target at its bound.
    """
    nth = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    weighed = numbered(sources, [F.asc_nulls_last("source")], "nth").withColumn("weight", nth).drop("nth")
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > most * F.col("source_size")
        sums = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count(F.when(above, 1)).alias("capped"),
        ).first()
        if not sums.weight or sums.capped == capped:
            break
        capped = sums.capped
        level = (share[0] * sums["all"] - share[1] * most * sums.stopped) / (share[1] * sums.weight)
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(level or 0.0), (most * F.col("source_size")).cast("double")))


def mix_rates(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, seed: int = 11, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (keep..., id_col, size, source_size, target, rate, copies, taken): how often each document goes into the mix.

    size counts the blank-separated words of the whole text. A source's rate is its target over its
    size, and each of its documents is taken floor(rate) times and once more with a probability of
    just the rate's fraction. That Bernoulli draw is seeded by hashes: a source's documents lie in
    order of size (equal sizes by the hash of seed, id and text), the source's own hash gives a start
    in [0, 1), and a document is drawn where start + place * fraction passes a whole number. So each
    draw for itself has the fraction's probability, and the words taken from a source are off its
    target by less than its largest document (independent draws would miss small sources by a tenth
    and more). Reruns agree, for nothing depends on how rows are dealt to tasks.

    Null and empty texts have size 0 and are drawn like others, with 0 words taken. A null source is a
    source of its own, the last. Repeated rows are documents of their own, next to each other in
    order. An empty table gives no rows. Kept columns named like results give way.

    Words are counted in one pass over the texts; then only narrow rows move: one range exchange by
    (source, size, hash), which splits a hot source and a group of copies alike. Rates are broadcast
    for at most FEW_SOURCES sources, else joined by source and a salt that deals hot sources to SALTS
    tasks.
    """
    gone = {*MADE, id_col.lower()}
    kept = [c for c in keep if c.lower() not in gone]
    rows = docs.select(
        *(F.col(c).alias(f"__k{i}") for i, c in enumerate(kept)),
        F.col(id_col).alias("__id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        _unit(seed, F.col(id_col), F.col(text_col)).alias("draw"),
    )
    placed = numbered(durable(rows), [F.asc_nulls_last("source"), F.asc("size"), F.asc("draw")], "at")
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("at").alias("first"))
    rates = source_targets(sources, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = rates.select(F.col("source").alias("of"), "source_size", "target", "first", rate.alias("rate"), _unit(seed, F.coalesce(F.concat(F.lit("source "), "source"), F.lit("no source"))).alias("start"))
    if rates.count() <= FEW_SOURCES:
        joined = placed.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("of")))
    else:
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = placed.withColumn("part", F.pmod(F.col("at"), F.lit(SALTS)).cast("int")).join(salted, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("salt")))
    fraction = F.col("rate") - F.floor("rate")
    nth = F.col("at") - F.col("first")
    more = F.floor(F.col("start") + (nth + 1) * fraction) - F.floor(F.col("start") + nth * fraction)
    copies = (F.floor("rate") + more).cast("long")
    return joined.select(
        *(F.col(f"__k{i}").alias(c) for i, c in enumerate(kept)), F.col("__id").alias(id_col), "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix_documents(docs: DataFrame, text_col: str = "text", copy_col: str = "copy", **how) -> DataFrame:
    """The mix itself: every document's row as often as mix_rates says, copies numbered from 0 in copy_col.

    Takes mix_rates' parameters but `keep`. A column already named copy_col gives way; all others are
    kept as they are.

    Rows are written once with a number of their own, so that only numbers and sizes are ranked; the
    texts move once, to meet their copies.
    """
    kept = [c for c in docs.columns if c.lower() != copy_col.lower()]
    rows = durable(docs.withColumn("__row", F.monotonically_increasing_id()))
    rated = mix_rates(rows, text_col=text_col, keep=("__row",), **how).where("copies > 0").select("__row", "copies")
    copies = F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias(copy_col)
    return rows.join(rated, "__row").select(*kept, copies)
