"""Further operators on headings, alignment of strings, ids, protection and nested HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify, text
from .grouped import fold


def group_indents(items: DataFrame, k: int = 5, rounds: int = 5) -> DataFrame:
    """(doc_id, style, item, cluster): items (doc_id, style, item, left, center) grouped by k-means of left and twice the centre.

    Seeds are evenly spaced in order of left, so that the result does not depend on chance.
    """

    def step(rows: list[dict]) -> list[tuple]:
        points = [(float(r["left"]), 2.0 * r["center"]) for r in rows]
        seeds = sorted(set(points))
        means = [seeds[i * len(seeds) // min(k, len(seeds))] for i in range(min(k, len(seeds)))]
        near = []
        for _ in range(rounds):
            near = [min(range(len(means)), key=lambda m: ((p[0] - means[m][0]) ** 2 + (p[1] - means[m][1]) ** 2, m)) for p in points]
            held = [[p for p, n in zip(points, near, strict=True) if n == m] for m in range(len(means))]
            means = [(sum(x for x, _ in h) / len(h), sum(y for _, y in h) / len(h)) if h else means[m] for m, h in enumerate(held)]
        return [(r["doc_id"], r["style"], r["item"], n) for r, n in zip(rows, near, strict=True)]

    return fold(items.select("doc_id", "style", "item", "left", "center"), ["doc_id", "style"], ["item"], "doc_id long, style string, item int, cluster int", step)


def ids_for_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, id): known ids of standardised names, new names numbered after the largest known id, in order."""
    fresh = names.select(text.standard_name(F.col("name")).alias("name")).distinct().join(known, "name", "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))  # one row
    numbered = fresh.withColumn("nth", F.row_number().over(Window.orderBy("name"))).crossJoin(F.broadcast(top))
    return known.select("name", "id").unionByName(numbered.select("name", (F.col("top") + F.col("nth")).alias("id")))


def unprotected(rows: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """Rows that may be deleted: those that nothing protected refers to."""
    return rows.join(protected.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def one_exhibit_a_page(lines: DataFrame, deepest: int = 2) -> DataFrame:
    """Exhibit lines (doc_id, page, line_in_page, text) that are their page's only one and stand near its top."""
    e = lines.where(classify.is_exhibit(F.col("text")))
    n = F.count("*").over(Window.partitionBy("doc_id", "page"))
    return e.withColumn("n", n).where((F.col("n") == 1) & (F.col("line_in_page") <= deepest)).drop("n")


def drawing_pages(stats: DataFrame, ratio: float = 3.0) -> DataFrame:
    """Pages with so many words for each dictionary word that they are maps or drawings."""
    return stats.where(F.col("n_words") >= ratio * F.greatest("n_dict", F.lit(1))).select("doc_id", "page")


def centred_headings(lines: DataFrame, band: int = 250, left: int = 1667, most: int = 12) -> DataFrame:
    """Short centred lines of capitals: candidates for headings."""
    return lines.where(F.col("center").between(5000 - band, 5000 + band) & (F.col("left_x") > left) & (F.col("n_words") < most) & (F.col("n_all_cap") * 3 >= F.col("n_words") * 2))


def sequence_position(items: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n, mean_left, sd_left, mean_center, centred): where a sequence's items (left, center) stand."""
    agg = items.groupBy(*key).agg(F.count("*").alias("n"), F.avg("left").alias("mean_left"), F.stddev_samp("left").alias("sd_left"), F.avg("center").alias("mean_center"))
    return agg.withColumn("centred", F.col("mean_center").between(4750, 5250))


def modal_level(items: DataFrame) -> DataFrame:
    """(doc_id, style, level): the most frequent level of each style; ties to the smaller."""
    n = items.groupBy("doc_id", "style", "level").agg(F.count("*").alias("n"))
    return n.groupBy("doc_id", "style").agg(F.max_by("level", F.struct("n", -F.col("level"))).alias("level"))


def deeper_parentheses(items: DataFrame) -> DataFrame:
    """Items (doc_id, item, style, level) whose parenthesised numerals lie at least one level below the plain ones before them."""
    w = Window.partitionBy("doc_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    paren = F.col("style").endswith("_paren")
    before = F.last(F.when(~paren, F.col("level")), ignorenulls=True).over(w)
    return items.withColumn("level", F.when(paren & (F.col("level") <= before), before + 1).otherwise(F.col("level")))


def section_html(toc: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, html): each document's paragraphs with nested divs around its sections.

    toc: (doc_id, item, para_no, end_para, level, section, header); an item ends with its document
    where end_para is null. Opening and closing tags are events sorted by paragraph and level.
    """
    last = paragraphs.groupBy("doc_id").agg(F.max("para_no").alias("last"))
    t = toc.join(last, "doc_id").withColumn("end", F.coalesce("end_para", "last"))
    head = F.format_string('<DIV class="H%d" lev="%d" sec="%s" name="%s" id="div_%d">', "level", "level", F.coalesce("section", F.lit("")), text.clean_quotes(F.coalesce("header", F.lit(""))), "item")
    opened = t.select("doc_id", F.col("para_no").alias("at"), F.lit(0).alias("kind"), F.col("level").alias("depth"), head.alias("cell"))
    closed = t.select("doc_id", F.col("end").alias("at"), F.lit(2).alias("kind"), (-F.col("level")).alias("depth"), F.lit("</DIV>").alias("cell"))
    body = paragraphs.select("doc_id", F.col("para_no").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("depth"), F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit("</p>")).alias("cell"))
    events = opened.unionByName(closed).unionByName(body).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "kind", "depth", "cell"))).alias("e"))
    return events.select("doc_id", F.array_join(F.transform("e", lambda x: x["cell"]), "\n").alias("html"))


def cover_counts(paragraphs: DataFrame, toc: DataFrame) -> DataFrame:
    """(doc_id, para_no, covers): how many sections lie over each paragraph, by a running sum of openings and closings."""
    at = paragraphs.select("doc_id", "para_no", F.lit(0).alias("d"), F.lit(1).alias("own"))
    up = toc.select("doc_id", "para_no", F.lit(1).alias("d"), F.lit(0).alias("own"))
    down = toc.where("end_para is not null").select("doc_id", (F.col("end_para") + 1).alias("para_no"), F.lit(-1).alias("d"), F.lit(0).alias("own"))
    w = Window.partitionBy("doc_id").orderBy("para_no").rangeBetween(Window.unboundedPreceding, 0)
    return at.unionByName(up).unionByName(down).withColumn("covers", F.sum("d").over(w)).where("own = 1").select("doc_id", "para_no", "covers")


def name_register(docs: DataFrame, path_col: str) -> DataFrame:
    """Documents with the names that are made of their ids, and their file's base name without ending."""
    base = F.regexp_replace(F.regexp_extract(path_col, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return docs.withColumn("html_name", F.format_string("htmlfile_%08d", "doc_id")).withColumn("base", base)
