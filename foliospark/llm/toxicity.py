"""Toxicity by maximum-scoring segments of token log-odds.

A token is a word, or a beginning or an ending that words share. Each has a log-odds of toxic against
other documents, under a Dirichlet prior that follows its frequency in the whole corpus; a word
weighs as much as the heaviest of its tokens. A linear-time scan finds all maximal segments of positive
score; extreme-value statistics say what a segment's score is worth in a text of that length, and
the worth of all significant segments, calibrated on labelled texts, is the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import durable, small_batches, sparing
from .words import ALPHANUMERIC, mix, pieces, text_bytes, word_hashes, word_spans

_U = np.uint64
#: Labelled rows that the classifier is fitted on, at most (those of smallest id hash).
TRAIN_ROWS = 20_000
#: A model token occurs between so many different pairs of words in toxic texts at least, and its log-odds are so many deviations above none:
#: the bar among these that serves best in cross-validation within the labelled rows, over so many folds.
LEAST_PLACES = 3
BARS = (3.0, 4.0, 5.0, 6.5, 8.0)
FOLDS = 5
#: The prior weighs as much as this share of the tokens of the rarer class.
PRIOR_SHARE = 1.0
#: Bytes of the beginnings and endings that are tokens beside the words that are longer.
BEGINNINGS, ENDINGS = (4, 5, 6, 7, 8), (4, 5, 6)
#: What a word without weight takes from a segment at least.
LEAST_REST = 0.005
_BITS = 18
#: Segments of texts that aren't toxic are counted from this scaled score on to find the extreme-value constant.
_FROM = 2.0


class Lookup:
    """Numbers of tokens in a sorted array of token hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.near = np.zeros(1 << _BITS, bool)
        self.near[(words >> _U(64 - _BITS)).astype(np.int64)] = True

    def numbers(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known tokens, and their numbers."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.near[(tokens >> _U(64 - _BITS)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.words, tokens[at]), len(self.words) - 1)
        same = self.words[number] == tokens[at]
        return at[same], number[same]

    def all(self, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.numbers(k) for k in kinds]
        return np.concatenate([a for a, _ in found]), np.concatenate([n for _, n in found])


def heaviest(at: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that hold a token of weight, and the heaviest one's weight."""
    some = weight > 0
    at, weight = at[some], weight[some]
    by = np.lexsort((-weight, at))
    at, weight = at[by], weight[by]
    first = np.append(True, at[1:] != at[:-1])[: len(at)]
    return at[first], weight[first]


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    rest: float  # of every other word, below 0
    scale: float  # of the extreme-value distribution
    constant: float  # expected segments of scaled score 0 for each word
    coefficients: np.ndarray

    def __post_init__(self):
        self.lookup = Lookup(self.words)

    def hits(self, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, number = self.lookup.all(kinds)
        return heaviest(at, self.weights[number])

    def worth(self, score: np.ndarray | float, n_words: int) -> np.ndarray | float:
        """Log of one over the number of segments as good that a text as long is expected to have if it isn't toxic."""
        return self.scale * score - float(np.log1p(self.constant * n_words))


def log_odds(yes: np.ndarray, no: np.ndarray, all_yes: float, all_no: float, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each token of toxic against other texts, and how many deviations that is above none.

    yes, no: places of the token in each class; all_yes, all_no: texts with a token, summed over all
    tokens, so that long texts, which hold any word, tell little. share: the token's part of the words
    of the corpus, along which the Dirichlet prior spreads as much as the rarer class holds, times PRIOR_SHARE.
    """
    weight = PRIOR_SHARE * min(all_yes, all_no)
    prior = weight * share + 0.01
    odds = np.log((yes + prior) / (all_yes + weight)) - np.log((no + prior) / (all_no + weight))
    return odds, odds / np.sqrt(1 / (yes + prior) + 1 / (no + prior))


def segments(places: list[int], weights: list[float], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first place, place after the last, score), in linear time.

    Words between the places weigh `rest` each. A candidate is held with the running totals before
    and after it; a new one takes in those that it improves on and stays apart from the others.
    """
    held: list[list[float]] = []  # start, end, total before, total after, and the last earlier one of lower start
    total, last = 0.0, -1
    for at, weight in zip(places, weights, strict=True):
        total += rest * (at - last - 1)
        before, total, last = total, total + weight, at
        if weight <= 0:
            continue
        fresh = [at, at + 1, before, total]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= fresh[2]:
                j = int(held[j][4])
            if j < 0 or held[j][3] >= fresh[3]:
                fresh = [*fresh[:4], j]
                break
            fresh = [held[j][0], fresh[1], held[j][2], fresh[3]]
            del held[j:]
        held.append(fresh)
    return [(int(s), int(e), after - before) for s, e, before, after, _ in held]


def _words(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """Row ranges, the token hashes of all their words, kind by kind (0: the word has none), and the rows' offsets in the words."""
    for i, j in pieces(batch.column(column), 2 << 20):
        body, at = text_bytes(batch.column(column).slice(i, j - i))
        starts, ends, word_at = word_spans(body, at, ALPHANUMERIC)
        kinds = [word_hashes(body, starts, ends)]
        for k, n in enumerate((*BEGINNINGS, *ENDINGS)):
            spans = (starts, np.minimum(ends, starts + n)) if k < len(BEGINNINGS) else (np.maximum(starts, ends - n), ends)
            kinds.append(np.where(ends - starts > n, mix(word_hashes(body, *spans) + _U(k + 1)), _U(0)))
        yield i, j, kinds, word_at


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, fold, text) to (word, class, n): in how many texts of each class (2 * fold + toxic) each token occurs; word 0: the sum over all."""
    for batch in batches:
        group = batch.column(1).to_numpy() * 2 + (batch.column(0).to_numpy() > 0)
        for i, j, kinds, word_at in _words(batch, 2):
            row = np.repeat(np.arange(j - i), np.diff(word_at))
            for h in kinds:
                some = np.flatnonzero(h)
                word, of = np.unique(h[some], return_inverse=True)
                held = np.unique(of.reshape(-1) * np.int64(j - i) + row[some])  # a text counts once
                total = np.bincount(group[i:j][held % (j - i)], minlength=2 * FOLDS)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(2 * FOLDS, np.int64)), pa.array(np.arange(2 * FOLDS, dtype=np.int32)), pa.array(total)], ["word", "class", "n"])
                key, n = np.unique(held // (j - i) * (2 * FOLDS) + group[i:j][held % (j - i)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word[key // (2 * FOLDS)].view(np.int64)), pa.array((key % (2 * FOLDS)).astype(np.int32)), pa.array(n)], ["word", "class", "n"])


def _places(shared):
    """(toxic, fold, text) to (number, toxic, fold, place): known tokens and a hash of the words around each, once for each row range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold = (batch.column(0).to_numpy() > 0).astype(np.int32), batch.column(1).to_numpy()
            for i, j, kinds, word_at in _words(batch, 2):
                at, number = shared.value.all(kinds)
                row = np.searchsorted(word_at, at, "right") - 1
                word = np.append(kinds[0], _U(0))
                before = np.where(at > word_at[row], word[at - 1], _U(0))
                after = np.where(at + 1 < word_at[row + 1], word[at + 1], _U(0))
                place = mix(before * _U(3) + mix(after)).view(np.int64)
                cells = np.unique(np.stack([number, toxic[i:j][row], fold[i:j][row], place]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["number", "toxic", "fold", "place"])

    return run


def _background(words: np.ndarray):
    """(text) to (number, n): occurrences of the given sorted tokens, and as number -1 of all words."""
    lookup = Lookup(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(words), np.int64), 0
        for batch in batches:
            for _, _, kinds, _ in _words(batch, 0):
                for h in kinds:
                    count += np.bincount(lookup.numbers(h)[1], minlength=len(words))
                total += len(kinds[0])
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([*some.tolist(), -1], pa.int64()), pa.array([*count[some].tolist(), total], pa.int64())], ["number", "n"])

    return run


def _left_out(batch: pa.RecordBatch, shared) -> Iterator[tuple]:
    """Of each row range: offsets of rows in words, and for each bar the words of weight under the model that left the row's fold out."""
    lookup, weights = shared
    folds = batch.column(1).to_numpy()
    for i, j, kinds, word_at in _words(batch, 2):
        at, number = lookup.all(kinds)
        fold = folds[i:j][np.searchsorted(word_at, at, "right") - 1]
        yield i, j, word_at, [heaviest(at, w[fold, number]) for w in weights]


def _calm_weights(shared):
    """(toxic, fold, text) to (bar, weight in hundredths, words of it) of texts that aren't toxic; weight -1: all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, word_at, found in _left_out(batch, shared.value):
                for bar, (_, weight) in enumerate(found):
                    value, n = np.unique(np.rint(weight * 100).astype(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([bar] * (len(value) + 1), pa.int32()), pa.array(np.append(value, -1)), pa.array(np.append(n, word_at[-1]))], ["bar", "weight", "n"])

    return run


def _scores(shared, rests: list[float]):
    """(toxic, fold, text) to (toxic, n_words, scores): for each bar the scores of the text's maximal segments."""
    kind = pa.list_(pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, word_at, found in _left_out(batch, shared.value):
                cells: list[list] = [[] for _ in range(j - i)]
                for (at, weight), rest in zip(found, rests, strict=True):
                    edge = np.searchsorted(at, word_at)
                    for r in range(j - i):
                        a, b = edge[r], edge[r + 1]
                        cells[r].append([s for _, _, s in segments((at[a:b] - word_at[r]).tolist(), weight[a:b].tolist(), rest)] if b > a else [])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int32()), pa.array(np.diff(word_at), pa.int64()), pa.array(cells, kind)], ["toxic", "n_words", "scores"])

    return run


def worths(model: ToxicityModel, scores: np.ndarray, n_words: int) -> tuple[float, float]:
    """The worth of all significant segments of a text, and of the best."""
    worth = model.worth(np.asarray(scores, float), n_words)
    return (float(np.maximum(worth, 0).sum()), float(worth.max())) if len(scores) else (0.0, 0.0)


def _features(model: ToxicityModel, kinds: list[np.ndarray], word_at: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """The worths of each text, and its significant segments."""
    n = len(word_at) - 1
    out, found = np.zeros((n, 2)), [[] for _ in range(n)]
    at, weight = model.hits(kinds)
    edge = np.searchsorted(at, word_at)
    for r in np.flatnonzero(np.diff(edge)).tolist():
        a, b = edge[r], edge[r + 1]
        parts = segments((at[a:b] - word_at[r]).tolist(), weight[a:b].tolist(), model.rest)
        size = int(word_at[r + 1] - word_at[r])
        found[r] = [(i, j, w) for i, j, s in parts if (w := float(model.worth(s, size))) > 0]
        out[r] = worths(model, np.array([s for _, _, s in parts]), size)
    return out, found


def _design(features: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(features)), np.log1p(features[:, 0]), np.clip(features[:, 1], -10, 30) / 10], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        ridge = 1e-3 * np.eye(len(c))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - 1e-3 * c)
        c += step
        if np.abs(step).max() < 1e-8:
            break
    return c


def _scale(weights: np.ndarray, share: np.ndarray, rest: float) -> float:
    """The positive solution of sum of share * exp(scale * weight) = 1 (the extreme-value distribution's scale)."""
    left = 1 - share.sum()
    f = lambda x: float((share * np.exp(np.minimum(x * weights, 700))).sum() + left * np.exp(x * rest) - 1)
    lo, hi = 1e-6, 1.0
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(80):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if f(middle) < 0 else (lo, middle)
    return (lo + hi) / 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> ToxicityModel:
    """Fit on the given labels (those to hold out left away) and the given documents.

    Labels with a null id or value are left away; of several labels of one id the largest counts.
    At most TRAIN_ROWS labelled rows are used, equal texts once; the prior's frequencies are counted
    over all documents. With no toxic or no other text to fit on, every text scores the prior.

    Every labelled text is scored by a model whose token counts leave its fold out. These scores
    choose the bar for tokens (least log loss), give the extreme-value scale and constant, and
    calibrate the score. What comes to the driver is bounded by the labelled rows: tokens that
    their toxic texts favour by BARS[0] deviations, and the segments of the labelled texts.
    """
    small_batches(docs.sparkSession)
    told = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__toxic"))
    told = told.orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS)
    sample = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(told), "__id")
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    sample = durable(sample.groupBy("text").agg(F.max("__toxic").alias("toxic")).select("toxic", fold, "text"))
    texts = np.zeros((FOLDS, 2))  # of each fold, not toxic and toxic
    for r in sample.groupBy("fold", (F.col("toxic") > 0).cast("int").alias("y")).count().collect():
        texts[r.fold, r.y] = r["count"]
    no_texts, yes_texts = texts.sum(axis=0)
    if not yes_texts or not no_texts:
        none = np.zeros(0)
        prior = np.log((yes_texts + 0.5) / (no_texts + yes_texts + 1.0) / (1 - (yes_texts + 0.5) / (no_texts + yes_texts + 1.0)))
        return ToxicityModel(none.astype(np.uint64), none, -1.0, 1.0, 1.0, np.array([min(prior, -1e-6), 0.0, 0.0]))

    counts = [F.sum(F.when(F.col("class") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(2 * FOLDS)]
    counted = durable(sample.mapInArrow(sparing(_count_words), "word long, class int, n long").groupBy("word").agg(*counts))
    totals = np.array(counted.where("word = 0").first()[1:], float).reshape(FOLDS, 2)
    all_no, all_yes = np.maximum(totals.sum(axis=0), 1)
    no, yes = (sum(F.col(f"c{c}") for c in range(k, 2 * FOLDS, 2)) for k in (0, 1))
    raw = F.log((yes + 0.5) / all_yes) - F.log((no + 0.5) / all_no)
    telling = (F.col("word") != 0) & (yes >= LEAST_PLACES) & (raw >= BARS[0] * F.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5)))
    rows = counted.where(telling).collect()
    rows.sort(key=lambda r: r.word & (1 << 64) - 1)
    words = np.array([r.word & (1 << 64) - 1 for r in rows], np.uint64)
    # texts that are near copies of one another repeat a token between the same words, which counts once
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(Lookup(words))
    places = sample.mapInArrow(sparing(_places(known)), "number long, toxic long, fold long, place long").groupBy("number", "toxic", "place").agg(F.min("fold").alias("fold"))
    by_class = np.zeros((len(words), FOLDS, 2))
    for r in places.groupBy("number", "fold", "toxic").count().collect():  # 2 * FOLDS rows for each token at most
        by_class[r.number, r.fold, r.toxic] = r["count"]
    known.unpersist()

    seen = {r.number: r.n for r in docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(sparing(_background(words)), "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).collect()}
    share = np.array([seen.get(i, 0) for i in range(len(words))], float) / max(1, seen.get(-1, 0))

    def weights(left_out: int | None) -> list[np.ndarray]:
        """The weight of every token for each bar, 0 below it."""
        own = [f for f in range(FOLDS) if f != left_out]
        (n, y), t = by_class[:, own].sum(axis=1).T, np.maximum(totals[own].sum(axis=0), 1.0)
        odds, z = log_odds(y, n, t[1], t[0], share)
        return [np.where((z >= bar) & (y >= LEAST_PLACES), np.maximum(odds, 0), 0.0) for bar in BARS]

    parts = [weights(f) for f in range(FOLDS)]
    shared = spark.sparkContext.broadcast((Lookup(words), [np.stack([p[b] for p in parts]) for b in range(len(BARS))]))
    calm = sample.where("toxic = 0").mapInArrow(sparing(_calm_weights(shared)), "bar int, weight long, n long").groupBy("bar", "weight").agg(F.sum("n").alias("n")).toPandas()  # a row for each hundredth
    whole = weights(None)
    models = []
    for b in range(len(BARS)):
        mine = calm[calm.bar == b]
        found = mine[mine.weight >= 0]
        value, n = found.weight.to_numpy(float) / 100, found.n.to_numpy(float)
        every = float(mine.n[mine.weight < 0].sum()) + 1
        value, n = np.append(value, whole[b][whole[b] > 0].mean() if (whole[b] > 0).any() else 1.0), np.append(n, 0.5)
        # the mean word of a text that isn't toxic weighs less than nothing
        rest = -max(LEAST_REST, 2 * float(value @ n) / every)
        models.append(ToxicityModel(words, whole[b], rest, _scale(value, n / every, rest), 1.0, np.zeros(3)))
    measured = sample.mapInArrow(sparing(_scores(shared, [m.rest for m in models])), "toxic int, n_words long, scores array<array<double>>").collect()  # TRAIN_ROWS at most
    shared.unpersist()
    y = np.array([r.toxic > 0 for r in measured], float)
    losses = []
    for b, model in enumerate(models):
        quiet = [(np.array(r.scores[b]), r.n_words) for r in measured if not r.toxic > 0]
        high = sum(int((model.scale * s >= _FROM).sum()) for s, _ in quiet)
        model.constant = (high + 0.5) * float(np.exp(_FROM)) / max(1, sum(n for _, n in quiet))
        x = _design(np.array([worths(model, np.array(r.scores[b]), r.n_words) for r in measured]))
        model.coefficients = _fit_logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(x @ model.coefficients, -30, 30)))
        losses.append(-float(np.log(np.where(y > 0, p, 1 - p)).mean()))
    best = models[int(np.argmin(losses))]
    some = best.weights > 0
    return ToxicityModel(words[some], best.weights[some], best.rest, best.scale, best.constant, best.coefficients)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., score, passages): each whole text's toxicity from 0 to 1, and its significant passages.

    passages: array of (start, end, worth), words from 0, end exclusive. A null, empty or wordless
    text has no passage and the score of a text without model words. Rows are kept as they are,
    repeated ones too; a kept column named like one of the results gives way to it. No shuffle.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c.lower() not in ("score", "passages"))
    passage = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("worth", T.DoubleType())])
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(passage))])
    own_text = [] if text_col in keep else [F.col(text_col).alias("__text")]
    text_at = keep.index(text_col) if text_col in keep else len(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled rows
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("worth", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i, j, kinds, word_at in _words(batch, text_at):
                f, found = _features(own, kinds, word_at)
                score = 1 / (1 + np.exp(-np.clip(_design(f) @ own.coefficients, -30, 30)))
                cells = [[{"start": a, "end": b, "worth": w} for a, b, w in x] for x in found]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in range(len(keep))), pa.array(score), pa.array(cells, kind)], schema.names)

    return docs.select(*keep, *own_text).mapInArrow(sparing(run), schema)
