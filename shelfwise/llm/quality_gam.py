"""Quality classifier: a generalised additive model with pairwise interactions.

A text is described by rates of its characters, words and lines. Each feature has a lookup table
over quantile bins, learned by cyclic boosting: round after round a shallow tree on one feature's
bins is fitted to the gradient and added to its table. Pairs of features whose residuals a tree on
both explains best then get tables over two features' coarser bins in the same way. Bags of the
labelled sample are fitted as Spark tasks, each stopped by the rows left out of it, and their tables
averaged. A score is the logistic function of the sum of one table entry for each feature and pair.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import sliced, word_blocks
from shelfwise.llm.toxicity import training_rows

SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
SYMBOLS, ENDS, MARKS = b"#*$%&|<>@^~_=+\\{}[]", b".!?", b",;:'\"()-"
FEATURES = (
    "log_words", "word_length", "distinct_words", "top_word", "same_as_before", "distinct_pairs",
    "upper_words", "symbol_words", "short_words", "upper_chars", "digit_chars", "symbol_chars",
    "bang_chars", "end_chars", "mark_chars", "wide_chars", "log_lines", "line_words",
    "distinct_lines", "long_line", "lines_with_end", "char_entropy")


class Rule(NamedTuple):
    """Bounds and steps of the fit."""

    each: int = 6000  #: labelled documents of each class at most; the model sees no others
    bins: int = 32  #: of a feature
    pair_bins: int = 8  #: of each feature of a pair
    bags: int = 8  #: models that are averaged
    rounds: int = 300  #: of boosting at most, over all features
    rate: float = 0.08  #: of each tree's values that are added
    pairs: int = 8  #: of features that get a table
    patience: int = 20  #: rounds without gain on the rows left out
    min_weight: float = 8.0  #: of rows in a leaf


def features(text: str | None) -> list[float]:
    """The features of a whole text; all are 0 for one without words."""
    data = (text or "").encode()
    chars = np.zeros(256, np.int64)
    for start in range(0, len(data), 1 << 20):
        chars += np.bincount(np.frombuffer(data[start:start + (1 << 20)], np.uint8), minlength=256)
    words: Counter = Counter()
    pairs: set[int] = set()
    length = again = upper = marked = 0
    last = None
    for part in word_blocks(data.translate(SPACE)):
        words.update(part)
        again += sum(map(operator.eq, part, part[1:])) + (part[:1] == [last])
        pairs.update(map(hash, zip([last, *part], part, strict=False)))
        last = part[-1] if part else last
    n = sum(words.values())
    if not n:
        return [0.0] * len(FEATURES)
    short = 0
    for word, k in words.items():
        length += len(word) * k
        short += k * (len(word) <= 3)
        upper += k * (len(word) > 1 and word.isupper())
        marked += k * (not word.isalnum() and word[-1] in SYMBOLS)
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    n_chars, n_lines = int(chars.sum()), len(lines)
    many = chars[chars > 0] / n_chars
    ended = sum(line.rstrip()[-1] in ENDS for line in lines)
    return [
        np.log1p(n), length / n, len(words) / n, max(words.values()) / n, again / n,
        len(pairs) / n, upper / n, marked / n, short / n, chars[65:91].sum() / n_chars,
        chars[48:58].sum() / n_chars, chars[list(SYMBOLS)].sum() / n_chars, chars[33] / n_chars,
        chars[list(ENDS)].sum() / n_chars, chars[list(MARKS)].sum() / n_chars,
        chars[128:].sum() / n_chars, np.log1p(n_lines), n / n_lines, len(set(lines)) / n_lines,
        max(map(len, lines)) / n_chars, ended / n_lines, float(-(many * np.log(many)).sum())]


def feature_rows(docs: DataFrame, others: list[str]) -> DataFrame:
    """``others`` of each row, and ``features`` of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            flat = np.array([features(text) for text in batch.column(len(others)).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(others)], listed(flat)], [*others, "features"])

    schema = T.StructType([docs.schema[c] for c in others] + [
        T.StructField("features", T.ArrayType(T.DoubleType()))])
    return docs.select(*others, F.col("text").cast("string")).mapInArrow(run, schema)


def listed(rows: np.ndarray) -> pa.Array:
    rows = rows.reshape(len(rows), -1)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), pa.float64()))


class Sample(NamedTuple):
    """The labelled rows of the fit, in bins."""

    edges: list[np.ndarray]
    binned: np.ndarray  #: rows x features
    good: np.ndarray
    weights: np.ndarray  #: so often does a row stand for labelled rows, on average 1


class Model(NamedTuple):
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]  #: of each feature, by bin
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]  #: of each pair, by both features' coarse bins
    bins: int
    pair_bins: int

    def margins(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(len(binned), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[binned[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse(binned[:, i], self), coarse(binned[:, j], self)]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return logistic(self.margins(binned_rows(rows, self.edges)))


def coarse(bins: np.ndarray, of: Model | Rule) -> np.ndarray:
    return bins * of.pair_bins // of.bins


def logistic(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def binned_rows(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, j], side="right") for j, e in enumerate(edges)], 1)


def best_cut(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int]:
    """Gain and place (first bin of the right side) of the best split of a row of bins."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    fine = (left_h >= least) & (right_h >= least)
    if not fine.any():
        return 0.0, 0
    gain = np.where(fine, left_g ** 2 / (left_h + 1) + right_g ** 2 / (right_h + 1)
                    - g.sum() ** 2 / (h.sum() + 1), -np.inf)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def grown(g: np.ndarray, h: np.ndarray, least: float, leaves: int = 3) -> np.ndarray:
    """Values by bin of a tree with up to ``leaves`` leaves on sums of gradient and curvature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*best_cut(g[a:b], h[a:b], least), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return values


def grown_pair(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts one feature, then each side at the other."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(a)):
            gain, values = 0.0, np.zeros_like(a)
            for side in (slice(0, at), slice(at, len(a))):
                own_g, own_h = a[side].sum(0), b[side].sum(0)
                cut = grown(own_g, own_h, least, 2)
                gain += float((2 * cut * own_g - cut ** 2 * (own_h + 1e-9)).sum())
                values[side] = cut
            if gain > best[0] + 1e-12:
                best = (gain, values.T if turned else values)
    return best


def loss(margins: np.ndarray, good: np.ndarray, weights: np.ndarray) -> float:
    return float((weights * (np.logaddexp(0, margins) - good * margins)).sum())


def bag_weights(sample: Sample, bag: int) -> np.ndarray:
    """How often each row is drawn into a bag; about a third of the rows are left out of it."""
    return np.random.default_rng(bag).poisson(1, len(sample.good))


def boost(sample: Sample, start: Model, rule: Rule, bag: int, pairs: bool) -> Model:
    """Tables of ``start`` boosted on one bag: those of single features, or those of pairs."""
    drawn = bag_weights(sample, bag)
    inside, left = drawn > 0, drawn == 0
    weights = (sample.weights * drawn)[inside]
    binned, good = sample.binned, sample.good
    if pairs:
        places = [coarse(binned[:, i], rule) * rule.pair_bins + coarse(binned[:, j], rule)
                  for i, j in start.pairs]
        tables, size = [t.copy() for t in start.pair_tables], rule.pair_bins ** 2
    else:
        places = [binned[:, j] for j in range(binned.shape[1])]
        tables, size = [t.copy() for t in start.tables], rule.bins
    margins = start.margins(binned)
    best, kept, waited = loss(margins[left], good[left], sample.weights[left]), tables, 0
    for _ in range(rule.rounds):
        for j, place in enumerate(places):
            own = place[inside]
            p = logistic(margins[inside])
            g = np.bincount(own, weights * (good[inside] - p), size)
            h = np.bincount(own, weights * p * (1 - p), size)
            if pairs:
                shape = (rule.pair_bins, rule.pair_bins)
                step = grown_pair(g.reshape(shape), h.reshape(shape), rule.min_weight / 4)[1]
            else:
                step = grown(g, h, rule.min_weight / 4)
            tables[j] = tables[j] + rule.rate * step
            margins = margins + rule.rate * step.ravel()[place]
        now = loss(margins[left], good[left], sample.weights[left])
        if now < best - 1e-6 * max(1.0, abs(best)):
            best, kept, waited = now, list(tables), 0
        else:
            waited += 1
            if waited > rule.patience:
                break
    return start._replace(pair_tables=kept) if pairs else start._replace(tables=kept)


def averaged_bags(spark: SparkSession, sample: Sample, start: Model, rule: Rule,
                  pairs: bool) -> list[np.ndarray]:
    """Mean tables over the bags, each boosted by a task of its own."""
    sent = spark.sparkContext.broadcast((sample, start))  # at most 2 * rule.each rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, start = sent.value
        for batch in batches:
            for bag in batch.column(0).to_pylist():
                model = boost(sample, start, rule, bag, pairs)
                own = model.pair_tables if pairs else model.tables
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bag]), listed(np.concatenate([t.ravel() for t in own])[None])],
                    ["bag", "values"])

    rows = spark.range(rule.bags).repartition(rule.bags).mapInArrow(
        run, "bag long, values array<double>").orderBy("bag").collect()  # bags x tables
    mean = np.mean([row["values"] for row in rows], 0)
    before = start.pair_tables if pairs else start.tables
    cuts = np.cumsum([t.size for t in before])[:-1]
    return [part.reshape(t.shape) for part, t in zip(np.split(mean, cuts), before, strict=True)]


def chosen_pairs(sample: Sample, model: Model, rule: Rule) -> list[tuple[int, int]]:
    """The pairs of features whose residuals a tree on both explains best."""
    p = logistic(model.margins(sample.binned))
    g, h = sample.weights * (sample.good - p), sample.weights * p * (1 - p)
    shape = (rule.pair_bins, rule.pair_bins)
    low = [coarse(sample.binned[:, j], rule) for j in range(sample.binned.shape[1])]
    gains = []
    for i, j in combinations(range(len(low)), 2):
        place = low[i] * rule.pair_bins + low[j]
        sums = [np.bincount(place, x, rule.pair_bins ** 2).reshape(shape) for x in (g, h)]
        gain = grown_pair(*sums, rule.min_weight / 4)[0]
        gains.append((gain, (i, j)))
    return [pair for gain, pair in sorted(gains, reverse=True)[:rule.pairs] if gain > 0]


def centred(model: Model, sample: Sample) -> Model:
    """The same model with the intercept at which the mean score is the labelled rows' share."""
    share = float((sample.weights * sample.good).sum() / sample.weights.sum())
    margins, low, high = model.margins(sample.binned) - model.intercept, -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = float((sample.weights * logistic(margins + middle)).sum() / sample.weights.sum())
        low, high = (middle, high) if mean < share else (low, middle)
    return model._replace(intercept=(low + high) / 2)


def fit(spark: SparkSession, rows: np.ndarray, good: np.ndarray, shares: dict[int, int],
        rule: Rule) -> Model:
    """The model of labelled rows (features, 0 or 1) that stand for ``shares`` of each class."""
    total, used = sum(shares.values()), len(good)
    stands = [shares.get(c, 0) / total / max(1e-9, float((good == c).mean())) if used else 1.0
              for c in (0, 1)]
    weights = np.where(good > 0, stands[1], stands[0])
    inner = np.arange(1, rule.bins) / rule.bins
    edges = [np.unique(np.quantile(rows[:, j], inner)) for j in range(rows.shape[1])]
    sample = Sample(edges, binned_rows(rows, edges), good.astype(float), weights)
    share = min(max(shares.get(1, 0) / total, 1e-6), 1 - 1e-6)
    model = Model(edges, float(np.log(share / (1 - share))),
                  [np.zeros(rule.bins) for _ in edges], [], [], rule.bins, rule.pair_bins)
    model = model._replace(tables=averaged_bags(spark, sample, model, rule, False))
    pairs = chosen_pairs(sample, model, rule)
    if pairs:
        model = model._replace(pairs=pairs, pair_tables=[
            np.zeros((rule.pair_bins, rule.pair_bins)) for _ in pairs])
        model = model._replace(pair_tables=averaged_bags(spark, sample, model, rule, True))
    return centred(model, sample)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rule: Rule,
                    ) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Features and classes of the sample, and the labelled rows of each class.

    Of several labels of a ``doc_id`` the lowest counts, of several texts the one of the smallest
    hash. Each task sends at most ``rule.each`` ids of a class, and the sample has a row for each.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(
        "doc_id").agg((F.min(label) > 0).cast("int").alias("good")).where(
        training_rows(F.col("doc_id")))
    shares = {row["good"]: row["n"] for row in known.groupBy("good").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.where(F.col("good") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
        rule.each) for c in (0, 1)]
    some = parts[0].union(parts[1])  # bounded: 2 * each rows
    text = F.col("text").cast("string").alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(some), "doc_id").select(
        "doc_id", "good", F.xxhash64("text").alias("key"), "text")
    first = feature_rows(rows, ["doc_id", "good", "key"]).groupBy("doc_id", "good").agg(
        F.min(F.struct("key", "features")).alias("row")).select(
        "doc_id", "good", "row.features").toArrow()
    order = np.argsort([str(x) for x in first["doc_id"].to_pylist()])
    flat = first["features"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return flat[order], first["good"].to_numpy()[order], shares


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality",
                    threshold: float = 0.3, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Learns ``labels.<label>`` (above 0: good) from training rows only (``training_rows``) and from
    ``rule``'s sample of them. Null and empty texts have no words and get the score of such
    texts. Without labels of both classes every score is the labelled rows' share of good ones (0
    without labels). Repeated rows each give a row; a null ``doc_id`` is not held out. Of ``docs``
    only ``doc_id`` and ``text`` are read.
    """
    rows, good, shares = labelled_sample(docs, labels, label, rule)
    total = sum(shares.values())
    both = len(set(good.tolist())) == 2
    model = fit(docs.sparkSession, rows, good, shares, rule) if both else None
    even = shares.get(1, 0) / total if total else 0.0
    sent = docs.sparkSession.sparkContext.broadcast(model)  # features x bins and pairs x bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            scores = np.full(len(texts), even)
            if sent.value is not None and texts:
                scores = sent.value.scores(np.array([features(text) for text in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def held_out(doc_id: Column) -> Column:
    return (~training_rows(doc_id)).alias("held_out")
