"""Toxicity by the nearest labelled examples.

The examples are a bounded sample of labelled documents, as many of each class. Terms are words
and word beginnings; those that tell the sample's classes apart (chi square) are kept. Their
inverse document frequencies come from all documents. The index holds the examples in blocks with
each term's largest weight in a block; blocks are visited by falling upper bound until none can
still hold one of the nearest, so the nearest by TF-IDF cosine are exact. Neighbours vote by
the inverse of their distance, a class counts as often as among all labelled rows, and isotonic regression on the
examples, each scored without itself, turns votes into probabilities.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.functions.storage import materialise
from shelfwise.llm.batches import sliced

EDGES = ".,;:!?\"'()[]{}<>*#$%&|/\\-_+=~`«»“”‘’¿¡…"
LONGEST = 40
GRAM = 4
BEGINNINGS = (4, 5, 6)
BLOCK = 64
KEPT = 300_000
#: Added to a distance, so that an equal example's vote is bounded.
NEAREST = 0.05


def word_terms(token: str) -> list[str]:
    """A lower-case token's terms: the word without marks around it, and its beginnings.

    A longer token than ``LONGEST``, as in writing without spaces, gives its runs of ``GRAM``
    characters.
    """
    word = token.strip(EDGES)
    if not word:
        return []
    if len(word) > LONGEST:
        return [f"~{word[i:i + GRAM]}" for i in range(len(word) - GRAM + 1)]
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]


def term_counts(text: str | None) -> Counter:
    counts: Counter = Counter()
    for token, n in Counter((text or "").lower().split()).items():
        for term in word_terms(token):
            counts[term] += n
    return counts


class Examples(NamedTuple):
    """How the examples are chosen; the classifier sees no other labelled text."""

    each: int = 3000  #: labelled documents of each class at most
    terms: int = 3000  #: terms that are kept at most
    min_docs: int = 5  #: a term's examples at least
    chi_square: float = 15.0  #: a term's chi square at least
    ratio: float = 20.0  #: a term's rates in the two classes differ by this factor at least


def training_rows(doc_id: Column) -> Column:
    """True for ids whose CRC-32 as text isn't divisible by 5, and for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(True))


def choose_examples(docs: DataFrame, labels: DataFrame, rule: Examples,
                    ) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, toxic`` of the examples, and the labelled rows of each class.

    Of several labels for a ``doc_id`` the highest counts, of several texts the one of the smallest
    hash, so there are at most ``2 * rule.each`` rows.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        "doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = materialise(known.where(training_rows(F.col("doc_id"))))
    shares = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
        rule.each) for c in (0, 1)]  # each task sends at most so many of its own
    some = parts[0].union(parts[1])  # bounded: 2 * each rows
    text = F.col("text").cast("string").alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(some), "doc_id")
    first = rows.groupBy("doc_id", "toxic").agg(F.min(F.xxhash64("text")).alias("key"))
    chosen = rows.join(F.broadcast(first), ["doc_id", "toxic"]).where(
        F.xxhash64("text") == F.col("key"))
    return chosen.dropDuplicates(["doc_id", "toxic"]).select("doc_id", "text", "toxic"), shares


def choose_terms(examples: DataFrame, rule: Examples) -> list[str]:
    """The terms that tell the examples' classes apart best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in sliced(batches):
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for term in term_counts(text):
                    counts[term][toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()),
             *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))],
            ["term", "clean", "toxic"])

    sizes = {row["toxic"]: row["n"] for row in examples.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    if not clean or not toxic:
        return []
    counted = examples.select("text", "toxic").mapInArrow(
        run, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where(
        F.col("c") + F.col("t") >= rule.min_docs)
    c, t, n = F.col("c").cast("double"), F.col("t").cast("double"), clean + toxic
    spread = (c + t) * (n - c - t) * clean * toxic
    chi = F.when(spread > 0, n * F.pow(t * (clean - c) - c * (toxic - t), 2) / spread)
    ratio = (t + 0.5) / (c + 0.5) * (clean + 1) / (toxic + 1)
    telling = (ratio >= rule.ratio) | (ratio <= 1 / rule.ratio)
    best = counted.where(telling).select("term", chi.alias("chi")).where(
        F.col("chi") >= rule.chi_square).orderBy(F.desc("chi"), "term").limit(rule.terms)
    return [row["term"] for row in best.collect()]  # bounded: rule.terms rows


def sparse_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, text_key, terms, counts``: numbers of the chosen terms in each whole text."""
    numbers = {term: i for i, term in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in sliced(batches):
            found, counts = [], []
            for text in batch.column(2).to_pylist():
                own: dict[int, int] = {}
                for token, n in Counter((text or "").lower().split()).items():
                    hits = known.get(token)
                    if hits is None:
                        hits = tuple(numbers[t] for t in word_terms(token) if t in numbers)
                        if len(token) <= LONGEST:
                            known[token] = hits
                    for hit in hits:
                        own[hit] = own.get(hit, 0) + n
                listed = sorted(own)
                found.append(listed)
                counts.append([own[i] for i in listed])
                if len(known) > KEPT:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "text_key", "terms", "counts"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("text_key", T.LongType())]
                          + [T.StructField(x, T.ArrayType(T.IntegerType()))
                             for x in ("terms", "counts")])
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text), text).mapInArrow(run, schema)


def document_frequencies(vectors: DataFrame) -> DataFrame:
    """``term, n``: rows of ``vectors`` with the term, counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            terms, counts = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            total.update(dict(zip(terms.tolist(), counts.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())],
            ["term", "n"])

    return vectors.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(
        F.sum("n").alias("n"))


class BlockMaxIndex:
    """Exact nearest examples by cosine: postings by term, with each block's largest weight."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf
        self.ids: list = []
        self.toxic = np.zeros(0)
        self.most = np.zeros((len(idf), 0), np.float64)
        self.blocks: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []

    def vector(self, terms: list[int], counts: list[int]) -> np.ndarray:
        """Weights of one text's terms, of length 1."""
        weights = (1 + np.log(np.array(counts, float))) * self.idf[terms]
        norm = math.sqrt(float(weights @ weights))
        return weights / norm if norm else weights

    def fill(self, examples: list[tuple[object, int, list[int], list[int]]]) -> None:
        """Examples (id, toxic, terms, counts); those alike go into the same blocks."""
        held = [(e, self.vector(e[2], e[3])) for e in examples if e[2]]
        held.sort(key=lambda x: (x[0][2][int(x[1].argmax())], x[0][1], str(x[0][0])))
        self.ids = [e[0] for e, _ in held]
        self.toxic = np.array([e[1] for e, _ in held], float)
        count = -(-len(held) // BLOCK)
        self.most = np.zeros((len(self.idf), count))
        for b in range(count):
            lists: dict[int, tuple[list[int], list[float]]] = defaultdict(lambda: ([], []))
            for place, (e, weights) in enumerate(held[b * BLOCK:(b + 1) * BLOCK]):
                for term, weight in zip(e[2], weights, strict=True):
                    lists[term][0].append(place)
                    lists[term][1].append(weight)
            self.blocks.append({t: (np.array(p), np.array(w)) for t, (p, w) in lists.items()})
            for term, (_, weights) in self.blocks[b].items():
                self.most[term, b] = weights.max()

    def nearest(self, terms: list[int], weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k largest similarities above 0 with the examples' numbers, the smaller at ties."""
        if not len(self.ids) or not len(terms):
            return []
        bounds = weights @ self.most[terms]
        best: list[tuple[float, int]] = []  # a heap of (similarity, -number)
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or len(best) == k and bounds[b] < best[0][0] - 1e-12:
                break
            scores = np.zeros(BLOCK)
            lists = self.blocks[b]
            for term, weight in zip(terms, weights, strict=True):
                if term in lists:
                    places, held = lists[term]
                    scores[places] += weight * held
            for place in np.flatnonzero(scores > 0).tolist():
                entry = (round(float(scores[place]), 12), -(b * BLOCK + place))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(similarity, -number) for similarity, number in sorted(best, reverse=True)]


class Voter:
    """Votes of the nearest examples, and their calibration."""

    def __init__(self, index: BlockMaxIndex, shares: dict[int, int], sampled: dict[int, int],
                 k: int, prior_weight: float):
        total = sum(shares.values())
        self.index, self.k, self.prior_weight = index, k, prior_weight
        self.prior = shares.get(1, 0) / total if total else 0.0
        #: So often does a sampled example of each class stand for labelled rows, on average 1.
        used = sum(sampled.values())
        self.stands = [shares.get(c, 0) / total / (sampled[c] / used) if sampled.get(c) else 0.0
                       for c in (0, 1)]
        self.steps, self.values = np.zeros(0), np.array([self.prior])

    def vote(self, near: list[tuple[float, int]]) -> float:
        clean = toxic = 0.0
        for similarity, number in near:
            weight = 1 / (1 + NEAREST - similarity)
            if self.index.toxic[number]:
                toxic += weight * self.stands[1]
            else:
                clean += weight * self.stands[0]
        return (toxic + self.prior_weight * self.prior) / (clean + toxic + self.prior_weight)

    def calibrate(self, votes: np.ndarray, toxic: np.ndarray) -> None:
        """Isotonic regression of the class on the vote, by pooling adjacent violators."""
        if not len(votes):
            return
        weights = np.where(toxic > 0, self.stands[1], self.stands[0])
        pools: list[list[float]] = []  # first vote, weight, weighted sum
        for vote in np.unique(votes):
            here = votes == vote
            pools.append([vote, weights[here].sum(), (weights * toxic)[here].sum()])
            while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
                last = pools.pop()
                pools[-1][1] += last[1]
                pools[-1][2] += last[2]
        self.steps = np.array([p[0] for p in pools[1:]])
        # one row of each class more, so that no score claims certainty
        self.values = np.array([(p[2] + self.prior) / (p[1] + 1) for p in pools])

    def score(self, vote: float) -> float:
        return float(self.values[np.searchsorted(self.steps, vote, side="right")])


def fit(vectors: DataFrame, examples: DataFrame, terms: list[str], shares: dict[int, int],
        k: int, prior_weight: float) -> Voter:
    """Index and calibration; the driver gets the examples' vectors and one row per term."""
    frequency = document_frequencies(vectors).collect()  # bounded: one row per term
    total = vectors.count()
    idf = np.full(len(terms), math.log1p(total))
    for row in frequency:
        idf[row["term"]] = math.log1p(total / row["n"])
    index = BlockMaxIndex(idf)
    coded = sparse_counts(examples, terms).join(
        F.broadcast(examples.select("doc_id", "toxic")), "doc_id").collect()  # 2 * each rows
    rows = sorted((r["toxic"], str(r["doc_id"]), r["doc_id"], r["terms"], r["counts"])
                  for r in coded)
    index.fill([(doc_id, toxic, own, counts) for toxic, _, doc_id, own, counts in rows])
    voter = Voter(index, shares, Counter(r[0] for r in rows), k, prior_weight)
    votes = []
    for _, _, doc_id, own, counts in rows:
        near = index.nearest(own, index.vector(own, counts), k + 1) if own else []
        itself = next((x for x in near if index.ids[x[1]] == doc_id), None)
        votes.append(voter.vote([x for x in near if x != itself][:k]))
    voter.calibrate(np.array(votes), np.array([r[0] for r in rows], float))
    return voter


def score_documents(docs: DataFrame, labels: DataFrame, rule: Examples = Examples(), k: int = 9,
                    prior_weight: float = 1.0, shown: int = 3) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence, text_key``, one row per row of ``docs``.

    Labels are learned from training rows only (``training_rows``) and from ``rule``'s sample of
    them. ``evidence`` lists the nearest examples: doc_id, similarity, toxic. A null or empty text
    has no terms and gets the score of such examples; without labels of both classes every score
    is the labelled rows' share of toxic ones (0 without labels). Repeated rows each give a row;
    a null ``doc_id`` is not held out. ``text_key``, a hash of the text, tells texts apart whatever
    their ids: the score depends on the text alone. Of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    examples, shares = choose_examples(docs, labels, rule)
    examples = materialise(examples)
    terms = choose_terms(examples, rule)
    vectors = materialise(sparse_counts(docs, terms))
    sent = docs.sparkSession.sparkContext.broadcast(  # bounded by the rule
        fit(vectors, examples, terms, shares, k, prior_weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = sent.value
        index = voter.index
        kept: dict[tuple, tuple[float, list[dict]]] = {}
        for batch in batches:
            out = []
            for own, counts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                                   strict=True):
                name = (*own, *counts)
                if name not in kept:
                    if len(kept) > KEPT:
                        kept.clear()
                    near = index.nearest(own, index.vector(own, counts), k) if own else []
                    kept[name] = (voter.score(voter.vote(near)), [
                        {"doc_id": index.ids[i], "similarity": s, "toxic": int(index.toxic[i])}
                        for s, i in near[:shown]])
                out.append(kept[name])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.float64()),
                 pa.array([x[1] for x in out], shape)],
                ["doc_id", "text_key", "score", "evidence"])

    kind = docs.schema["doc_id"].dataType
    shape = pa.list_(pa.struct([("doc_id", to_arrow_type(kind)), ("similarity", pa.float64()),
                                ("toxic", pa.int32())]))
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("text_key", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField(
        "evidence", T.ArrayType(T.StructType([
            T.StructField("doc_id", kind), T.StructField("similarity", T.DoubleType()),
            T.StructField("toxic", T.IntegerType())])))])
    return vectors.mapInArrow(run, schema).select(
        "doc_id", (~training_rows(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "text_key")
