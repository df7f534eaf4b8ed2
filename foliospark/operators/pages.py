"""Statistics and scores of lines and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..sources.durable import dictionary_join, durable

count_if = lambda c: F.sum(F.when(c, 1).otherwise(0))


def line_stats(tokens: DataFrame, *more: Column) -> DataFrame:
    """One row for each line: words, capitals, extent (single characters left away), whether it ends in a number; `more` are further aggregates."""
    text = F.col("text")
    long = F.length("text") > 1
    return tokens.groupBy("doc_id", "page", "line").agg(
        F.count("*").alias("n_words"),
        count_if(classify.is_first_cap(text)).alias("n_first_cap"),
        count_if(classify.is_all_caps(text)).alias("n_all_cap"),
        F.min(F.when(long, F.col("x1"))).alias("left_x"),
        F.max(F.when(long, F.col("x2"))).alias("right_x"),
        F.max_by(text.rlike(r"^\d{1,3}$"), "sn").cast("int").alias("right_is_number"),
        *more,
    ).withColumn("center", F.floor((F.col("left_x") + F.col("right_x")) / 2).cast("int"))


def page_stats(tokens: DataFrame, least: int = 3) -> DataFrame:
    """One row for each page: words, capitals, junk, dictionary words, lines. The dictionary is the words of two letters or more in `least` places of all documents.

    Equal words of a page are counted together before anything else, so that patterns are matched and
    the dictionary is asked once for each, and the corpus is cut into words once for counts and
    dictionary, which is broadcast if its counted size allows it. Lines are counted apart, by
    their numbers alone.
    """
    text, n = F.col("text"), F.col("n")
    of_page = tokens.groupBy("doc_id", "page", "text").agg(F.count("*").alias("n"))
    of_page = durable(
        of_page.select(
            "doc_id",
            "page",
            "n",
            F.lower(F.regexp_replace("text", "[^A-Za-z]", "")).alias("word"),
            F.when(classify.is_first_cap(text), n).otherwise(0).alias("caps"),
            F.when(F.length(F.regexp_replace("text", "[^A-Za-z0-9]", "")) < 2, n).otherwise(0).alias("junk"),
            (n * F.length("text")).alias("chars"),
        )
    )
    dictionary = durable(of_page.where(F.length("word") > 1).groupBy("word").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least).select("word", F.lit(1).alias("known")))
    sums = dictionary_join(of_page, dictionary, "word").groupBy("doc_id", "page").agg(
        F.sum("n").alias("n_words"), F.sum("caps").alias("n_cap_words"), F.sum("junk").alias("n_junk"), F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("n"))), F.lit(0)).alias("n_dict"), F.sum("chars").alias("n_chars")
    )
    lines = tokens.select("doc_id", "page", "line").distinct().groupBy("doc_id", "page").agg(F.count("*").alias("n_lines"))
    return sums.join(lines, ["doc_id", "page"])


def right_cluster(lines: DataFrame, near: int = 3999) -> DataFrame:
    """(doc_id, page, right_cluster): the most lines of a page whose right ends are near one line's."""
    w = Window.partitionBy("doc_id", "page").orderBy("right_x").rangeBetween(-near, near)
    friends = lines.where("right_x is not null").withColumn("friends", F.count("*").over(w) - 1)
    return friends.groupBy("doc_id", "page").agg(F.max("friends").alias("right_cluster"))


def center_cluster(lines: DataFrame, near: int = 599) -> DataFrame:
    """(doc_id, page, n_centered, center, spread): the largest group of lines centred alike, and how their lengths vary (whole numbers)."""
    w = Window.partitionBy("doc_id", "page").orderBy("center").rangeBetween(-near, near)
    width = F.col("right_x") - F.col("left_x")
    rows = lines.where("center is not null").withColumn("friends", F.count("*").over(w))
    seed = rows.groupBy("doc_id", "page").agg(F.max("friends").alias("n_centered"), F.max_by("center", F.struct("friends", -F.col("line"))).alias("center"))
    near_seed = rows.select("doc_id", "page", F.col("center").alias("c"), width.alias("width")).join(seed, ["doc_id", "page"]).where(F.abs(F.col("c") - F.col("center")) <= near)
    mean = F.avg("width").over(Window.partitionBy("doc_id", "page"))
    dev = near_seed.withColumn("dev", F.floor(F.col("width") - mean)).withColumn("part", F.floor(F.col("dev") * F.col("dev") / 10))
    return dev.groupBy("doc_id", "page").agg(F.max("n_centered").alias("n_centered"), F.max("center").alias("center"), F.floor(F.sqrt(F.sum("part") / F.count("*"))).alias("spread"))


def indent_mode(lines: DataFrame, width: int = 1000, least: int = 3) -> DataFrame:
    """(doc_id, page, bin, n): the most frequent left indent of each page, where `least` lines have it."""
    bins = lines.where("left_x is not null").groupBy("doc_id", "page", F.floor(F.col("left_x") / width).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    best = bins.groupBy("doc_id", "page").agg(F.max_by(F.struct("bin", "n"), F.struct("n", -F.col("bin"))).alias("b"))
    return best.select("doc_id", "page", "b.bin", "b.n").where(F.col("n") >= least)


def page_scores(lines: DataFrame) -> DataFrame:
    """(doc_id, page, title_score, toc_score, sig_score): whole-number scores of pages by their lines."""
    short = (F.col("n_words") <= 4) & (F.col("center").between(4000, 6000))
    caps = F.col("n_all_cap") * 2 >= F.col("n_words")
    return lines.groupBy("doc_id", "page").agg(
        F.expr("sum(case when n_words <= 4 and center between 4000 and 6000 then 2 else 0 end + case when n_all_cap * 2 >= n_words then 3 else 0 end) * 10 div count(*)").alias("title_score"),
        F.expr("sum(case when right_is_number = 1 then 10 else 0 end + case when n_first_cap * 2 >= n_words then 1 else 0 end) * 10 div count(*)").alias("toc_score"),
        count_if(short & ~caps).alias("sig_score"),
    )


def toc_runs(scores: DataFrame) -> DataFrame:
    """(doc_id, first_page, last_page, n_pages, best): maximal runs of pages whose toc_score is above zero."""
    w = Window.partitionBy("doc_id").orderBy("page")
    good = scores.where("toc_score > 0").withColumn("island", F.col("page") - F.row_number().over(w))
    return good.groupBy("doc_id", "island").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("n_pages"), F.max("toc_score").alias("best")).drop("island")


def aligned_references(lines: DataFrame) -> DataFrame:
    """(doc_id, page, n_refs, spread): how well the right ends of lines that end in numbers stand below one another."""
    w = Window.partitionBy("doc_id", "page").orderBy("line")
    step = lines.where("right_is_number = 1").withColumn("d", F.col("right_x") - F.lag("right_x").over(w))
    return step.groupBy("doc_id", "page").agg(F.count("*").alias("n_refs"), (F.sqrt(F.coalesce(F.sum(F.col("d") * F.col("d")), F.lit(0))) / F.count("*")).alias("spread"))


def caps_points(tokens: DataFrame) -> DataFrame:
    """(doc_id, line, label, n): the run of capital words that opens a line."""
    w = Window.partitionBy("doc_id", "line").orderBy("sn")
    lead = tokens.withColumn("low", F.sum(F.when(classify.is_all_caps(F.col("text")), 0).otherwise(1)).over(w)).where("low = 0")
    label = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sn", "text"))), lambda s: s["text"]), " ")
    return lead.groupBy("doc_id", "line").agg(label.alias("label"), F.count("*").alias("n"))


def page_texts(tokens: DataFrame) -> DataFrame:
    """(doc_id, page, text): each page's words in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sn", "text"))), lambda s: s["text"]), " ")
    return tokens.groupBy("doc_id", "page").agg(body.alias("text"))


def capped_labels(rows: DataFrame, label: str, text_col: str = "text", order: str = "part", key: str = "doc_id") -> DataFrame:
    """Rows that score for a label, as many of each document as the label's cap allows, in order."""
    scored = rows.withColumn("score", classify.phrase_score(F.col(text_col), label)).where(F.col("score") > classify.LABEL_BAR[label])
    ranked = scored.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.where(F.col("nth") <= classify.LABEL_CAPS[label])


def page_word_weights(tokens: DataFrame) -> DataFrame:
    """(doc_id, page, title_words, sig_words): weights of the words of title pages and signature blocks."""
    table = lambda d: F.create_map(*(F.lit(x) for pair in d.items() for x in pair))
    weight = lambda c, d: F.sum(F.coalesce(F.try_element_at(table(d), c), F.lit(0)))
    return tokens.groupBy("doc_id", "page").agg(weight(F.lower("text"), classify.TITLE_WORDS).alias("title_words"), weight(F.col("text"), classify.SIGNATURE_WORDS).alias("sig_words"))


def indent_clusters(lines: DataFrame, width: int = 1000) -> DataFrame:
    """(doc_id, page, bin, n and means and deviations of the extent, words and closing numbers) of the lines of a page that start alike."""
    mean = lambda c: F.round(F.avg(c), 4)
    dev = lambda c: F.round(F.stddev_samp(c), 4)
    return lines.where("left_x is not null").groupBy("doc_id", "page", F.floor(F.col("left_x") / width).cast("int").alias("bin")).agg(
        F.count("*").alias("n"), mean("left_x").alias("mean_left"), mean("right_x").alias("mean_right"), dev("left_x").alias("sd_left"), dev("right_x").alias("sd_right"),
        mean("right_is_number").alias("number_ratio"), mean("n_words").alias("mean_words"),
    )
