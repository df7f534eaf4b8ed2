"""Which preambles stand, where they end, and which tables of contents before them go."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Paragraphs between the marks of one preamble, and to the recitals or the first item after it.
WITHIN, NEAR = 5, 10
#: Numbers of a first item (I reads as 9), and items on either side that make a sequence sound.
FIRST_NUMBERS, SOUND = [1, 9], 2
#: Most characters a paragraph and least items a paragraph of a table of contents: with a title, or without one.
WITH_TITLE = [(90, 0.4), (60, 0.3)]
WITHOUT_TITLE = (50, 0.7)
#: Items before a table's title at most, and items of one without a title at least.
MOST_BEFORE, LEAST_ITEMS = 100, 11


def preamble_runs(marks: DataFrame) -> DataFrame:
    """(doc_id, first, last, before, before_name, after, after_name): runs of marks (doc_id, para_no, name) named Preamble.

    A run goes on while no other mark and no more than WITHIN paragraphs lie between; before and after are
    the marks next to it.
    """
    w = Window.partitionBy("doc_id").orderBy("para_no", "name")
    is_one = F.col("name") == "Preamble"
    opens = is_one & (~F.coalesce(F.lag("name").over(w) == "Preamble", F.lit(False)) | (F.col("para_no") - F.lag("para_no").over(w) > WITHIN))
    beside = {"b": F.lag("para_no").over(w), "bn": F.lag("name").over(w), "a": F.lead("para_no").over(w), "an": F.lead("name").over(w)}
    rows = marks.withColumns({"opens": opens, **beside}).withColumn("run", F.sum(F.col("opens").cast("int")).over(w)).where(is_one)
    return rows.groupBy("doc_id", "run").agg(
        F.min("para_no").alias("first"),
        F.max("para_no").alias("last"),
        F.min_by("b", "para_no").alias("before"),
        F.min_by("bn", "para_no").alias("before_name"),
        F.max_by("a", "para_no").alias("after"),
        F.max_by("an", "para_no").alias("after_name"),
    )


def _with_items(runs: DataFrame, items: DataFrame, at: str, prefix: str) -> DataFrame:
    """Runs with the number of items at or before a paragraph of theirs (prefix_n) and the first item behind it (prefix_next: para_no, enum, sound)."""
    w = Window.partitionBy("doc_id").orderBy("para_no", "kind")
    lone = items.select("doc_id", "para_no", F.lit(0).alias("kind"), F.struct("para_no", "enum", "sound").alias("it"), F.lit(None).cast("long").alias("run"))
    asked = runs.select("doc_id", F.col(at).alias("para_no"), F.lit(1).alias("kind"), F.lit(None).cast(lone.schema["it"].dataType).alias("it"), F.col("run").cast("long"))
    both = lone.unionByName(asked)
    behind = F.first("it", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    upto = F.count("it").over(w.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumns({f"{prefix}_next": behind, f"{prefix}_n": upto}).where("kind = 1").select("doc_id", "run", f"{prefix}_next", f"{prefix}_n")
    return runs.join(found, ["doc_id", "run"])


def decide_preambles(marks: DataFrame, items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, kind, begin_para, end_para): preambles that stand (REC or TOC, by what follows) and tables of contents to remove (REM_TOC).

    marks (doc_id, para_no, name); items (doc_id, para_no, enum, nth, n), numbered headings with their place in
    their sequence; paragraphs (doc_id, para_no, length). A preamble stands if recitals or a title of contents
    follow within NEAR paragraphs, or a first item does, and the next item isn't in the middle of a
    sound sequence. It ends before what follows. What lies between a title of contents and a standing
    preamble is a table to remove if its paragraphs are short and most are items; without a title, if
    nearly all are. One window a question; nothing is joined but by document and run.
    """
    sound = items.withColumn("sound", (F.col("nth") >= SOUND) & (F.col("n") - F.col("nth") >= SOUND))
    runs = preamble_runs(marks)
    runs = _with_items(runs, sound, "last", "l")
    runs = _with_items(runs, sound, "first", "f")
    runs = _with_items(runs.withColumn("b0", F.coalesce("before", F.lit(-1))), sound, "b0", "b")
    w = Window.partitionBy("doc_id").orderBy("para_no")
    lengths = paragraphs.withColumn("upto", F.sum("length").over(w)).select("doc_id", F.col("para_no").alias("p"), "upto")
    head = items.groupBy("doc_id").agg(F.min(F.struct("para_no", "enum")).alias("h")).select("doc_id", F.col("h.para_no").alias("start"), F.col("h.enum").alias("start_enum"))
    runs = runs.join(head, "doc_id", "left")
    for name, place in (("upto_first", F.col("first") - 1), ("upto_start", F.col("start") - 1)):
        side = lengths.select(F.col("doc_id").alias("__d"), "p", F.col("upto").alias(name))
        runs = runs.join(side, (F.col("doc_id") == F.col("__d")) & (F.col("p") == place), "left").drop("__d", "p")
    recitals = F.col("after_name").isin("Recitals", "Table_Of_Contents") & (F.col("after") - F.col("last") < NEAR)
    first_item = (F.col("l_next.para_no") - F.col("last") < NEAR) & F.col("l_next.enum").isin(FIRST_NUMBERS)
    stands = ~F.coalesce("l_next.sound", F.lit(False)) & (F.coalesce(recitals, F.lit(False)) | F.coalesce(first_item, F.lit(False)))
    runs = runs.where(stands).withColumn("kind", F.when(recitals, "REC").otherwise("TOC"))
    end = F.when(F.col("kind") == "REC", F.greatest(F.col("after") - 1, "last")).otherwise(F.col("l_next.para_no") - 1)
    standing = runs.select("doc_id", "kind", F.col("first").alias("begin_para"), end.cast("int").alias("end_para"))
    per_paragraph = (F.col("upto_first") - F.coalesce("upto_start", F.lit(0))) / (F.col("first") - F.col("start"))
    density = (F.col("f_n") - F.col("b_n")) / (F.col("first") - F.col("before"))
    titled = F.col("before").isNotNull() & (F.col("b_n") < MOST_BEFORE)
    titled = titled & ((per_paragraph < WITH_TITLE[0][0]) & (density > WITH_TITLE[0][1]) | (per_paragraph < WITH_TITLE[1][0]) & (density > WITH_TITLE[1][1]))
    untitled = (F.col("f_n") > LEAST_ITEMS) & (F.col("f_n") / F.col("first") > WITHOUT_TITLE[1]) & (per_paragraph < WITHOUT_TITLE[0]) & F.col("start_enum").isin(FIRST_NUMBERS)
    begin = F.when(F.coalesce(titled, F.lit(False)), F.col("before")).when(F.coalesce(untitled, F.lit(False)), F.col("start"))
    removed = runs.where(F.col("first") > F.col("start")).select("doc_id", F.lit("REM_TOC").alias("kind"), begin.alias("begin_para"), (F.col("first") - 1).cast("int").alias("end_para")).where("begin_para is not null")
    return standing.unionByName(removed)


def after_removed_contents(decisions: DataFrame) -> DataFrame:
    """Standing preambles (REC, TOC) whose document has a table of contents to remove."""
    gone = decisions.where("kind = 'REM_TOC'").select("doc_id").distinct()
    return decisions.where("kind <> 'REM_TOC'").join(gone, "doc_id", "left_semi")


def marked_paragraphs(entity_texts: DataFrame, entities: DataFrame, features: DataFrame, documents: DataFrame, folders: DataFrame, names: tuple[str, ...] = ("Recitals", "Sigblock", "Preamble", "Table_Of_Contents")) -> DataFrame:
    """(entity, name, value, doc_id, para_no, document, folder, parent, feature): marks of documents that aren't abstracts, with where they come from.

    entity_texts (id, entity_id, doc_id, para_no, value), entities (id, name), features (instance_id, feature),
    documents (id, name, folder_id), folders (id, name, parent_id). Left joins throughout; the two name filters
    are applied before anything is moved. A mark with several features gives a row for each.
    """
    e = entities.where(F.col("name").isin(*names)).select(F.col("id").alias("entity_id"), "name")
    d = documents.where("name is not null and not contains(name, 'Abstract')").select(F.col("id").alias("doc_id"), F.col("name").alias("document"), "folder_id")
    f = folders.select(F.col("id").alias("folder_id"), F.col("name").alias("folder"), "parent_id")
    p = folders.select(F.col("id").alias("parent_id"), F.col("name").alias("parent"))
    x = features.select(F.col("instance_id").alias("id"), "feature")
    whole = entity_texts.join(e, "entity_id").join(d, "doc_id").join(x, "id", "left").join(f, "folder_id", "left").join(p, "parent_id", "left")
    return whole.select(F.col("entity_id").alias("entity"), "name", "value", "doc_id", "para_no", "document", "folder", "parent", "feature")


def document_values(documents: DataFrame, folders: DataFrame, assigned: DataFrame, default: str = "USA", value: str = "country") -> DataFrame:
    """(doc_id, value): the country or language that a document's folder, its parent, or the parent's organisation is assigned, in this order, else the default.

    documents (doc_id, folder_id), folders (id, parent_id, org_id), assigned (folder_id, org_id, value). Six left
    joins: folder, parent, organisation, and three times the assignments; of several for one folder or
    organisation the smallest holds.
    """
    by = lambda key: assigned.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(value).alias("v"))
    t = folders.select(F.col("id").alias("folder_id"), F.col("parent_id").alias("parent"))
    p = folders.select(F.col("id").alias("parent"), F.col("org_id").alias("org"))
    rows = documents.select("doc_id", "folder_id").join(t, "folder_id", "left").join(p, "parent", "left")
    for name, key, at in (("t", "folder_id", "folder_id"), ("p", "folder_id", "parent"), ("o", "org_id", "org")):
        side = by(key).withColumnsRenamed({"k": f"k_{name}", "v": f"v_{name}"})
        rows = rows.join(side, F.col(at) == F.col(f"k_{name}"), "left")
    return rows.select("doc_id", F.coalesce("v_t", "v_p", "v_o", F.lit(default)).alias(value))


def label_spans(texts: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """(key..., text, n_words, n_spans, first_span, last_span): what a label's marked text says, and the range of its spans (id="sp_N")."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.col(html), "<[^>]*>", ""), r"\s+", " "))
    numbers = F.regexp_extract_all(F.col(html), F.lit('="?sp_([0-9]+)'), F.lit(1))
    return texts.select(
        *key,
        plain.alias("text"),
        F.when(plain == "", 0).otherwise(F.size(F.split(plain, " "))).alias("n_words"),
        F.size(numbers).alias("n_spans"),
        F.try_element_at(numbers, F.lit(1)).cast("int").alias("first_span"),
        F.try_element_at(numbers, F.lit(-1)).cast("int").alias("last_span"),
    )
