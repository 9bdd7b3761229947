"""Ranked lexical search: the best documents of each query by the Best Position Algorithm.

Documents are read once into counts of the queries' terms; corpus statistics are sums over these.
Then every task deals its documents into shards of bounded size. A shard holds, for each term, an
impact list (documents by falling impact). A query reads its lists in parallel, a few positions
deeper each round; each document met is scored at once by direct accesses to all of its lists, which
marks its positions there as seen. A list's best position is the last before the first unseen one,
and no unseen document can score more than the lists' impacts at their best positions together.
The search of a shard stops when this threshold is strictly below the k-th score, so ties are found
whole. Tasks send their k best for each query; the best of all are the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.functions.storage import materialise
from shelfwise.llm.batches import word_blocks

ENDS = b"\xff"  # no byte of UTF-8
#: Everything of ASCII but letters and digits becomes a space; A-Z are lower-cased.
TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
BLOCK = 1 << 21  #: bytes of text that are counted at a time
POSTINGS = 1 << 21  #: of a shard, at least one document's
QUERIES = 5000  #: that are searched in one pass over the documents
FIRST_DEPTH = 8  #: positions read in the first round; each round reads twice as many
DOCUMENTS, LENGTHS = -1, -2  #: "terms" that stand for the number of documents and of all terms


def term_bytes(text: str | None) -> bytes:
    """The text's terms with spaces between them."""
    return (text or "").encode().translate(TERMS)


class Query(NamedTuple):
    """A query's terms by number, with how often it has them."""

    terms: np.ndarray
    times: np.ndarray


def number_terms(texts: list[str | None]) -> tuple[dict[bytes, int], list[Query]]:
    """Numbers of all terms of the queries, and the queries in them."""
    numbers: dict[bytes, int] = {}
    queries = []
    for text in texts:
        own = Counter(numbers.setdefault(t, len(numbers)) for t in term_bytes(text).split())
        queries.append(Query(np.array(sorted(own), np.int64),
                             np.array([own[t] for t in sorted(own)], np.int64)))
    return numbers, queries


class TermCounts:
    """Counts of numbered terms in a run of documents."""

    def __init__(self, numbers: dict[bytes, int]):
        self.numbers = numbers | {ENDS: -2}
        self.lengths: list[int] = []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        waiting: list[bytes] = []
        weight = 0
        for data in texts:
            if len(data) > BLOCK:
                self._together(waiting)
                waiting, weight = [], 0
                self._alone(data)
                continue
            waiting.append(data)
            weight += len(data)
            if weight > BLOCK:
                self._together(waiting)
                waiting, weight = [], 0
        self._together(waiting)

    def _ids(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, tokens, repeat(-1)), np.int64, len(tokens))

    def _together(self, texts: list[bytes]) -> None:
        if not texts:
            return
        ids = self._ids(b" \xff ".join([*texts, b""]).split())
        ends = ids == -2
        self.lengths += (np.diff(np.flatnonzero(ends), prepend=-1) - 1).tolist()
        width = len(self.numbers)
        known = np.flatnonzero(ids >= 0)
        keys, counts = np.unique(np.cumsum(ends)[known] * width + ids[known], return_counts=True)
        cuts = np.searchsorted(keys, np.arange(1, len(texts)) * width)
        self.terms += np.split(keys % width, cuts)
        self.counts += np.split(counts, cuts)

    def _alone(self, data: bytes) -> None:
        length, total = 0, np.zeros(len(self.numbers), np.int64)
        for tokens in word_blocks(data, BLOCK):
            ids = self._ids(tokens)
            length += len(ids)
            total += np.bincount(ids[ids >= 0], minlength=len(total))
        self.lengths.append(length)
        self.terms.append(np.flatnonzero(total))
        self.counts.append(total[self.terms[-1]])


def term_vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, length, terms, counts``: length in terms, and the numbered terms of whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)  # terms of at most QUERIES queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = TermCounts(sent.value)
            found.add([term_bytes(text) for text in batch.column(1).to_pylist()])
            ends = np.cumsum([0, *map(len, found.terms)])
            lists = [pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()),
                pa.array(np.concatenate([*x, np.zeros(0, np.int64)]), kind))
                for x, kind in ((found.terms, pa.int32()), (found.counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.lengths, pa.int64()), *lists],
                ["doc_id", "length", "terms", "counts"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("length", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.LongType()))])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def corpus_counts(vectors: DataFrame) -> dict[int, int]:
    """Documents of each term, of any term (DOCUMENTS) and terms of all (LENGTHS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            total[DOCUMENTS] += int(np.count_nonzero(lengths))
            total[LENGTHS] += int(lengths.sum())
            terms, n = np.unique(batch.column(1).flatten().to_numpy(), return_counts=True)
            total.update(dict(zip(terms.tolist(), n.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())],
            ["term", "n"])

    rows = vectors.select("length", "terms").mapInArrow(run, "term int, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).collect()  # a row for each query term
    return {row["term"]: row["n"] for row in rows}


def term_weights(counts: dict[int, int], terms: int) -> np.ndarray:
    documents = counts.get(DOCUMENTS, 0)
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1)))
                     for t in range(terms)], np.int64)


def id_order(doc_id: object) -> tuple:
    """Key that sorts ids, null last."""
    return (True, 0) if doc_id is None else (False, doc_id)


class Shard:
    """Impact lists of some documents; documents are numbered in the order of their ids."""

    def __init__(self, ids: list, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray,
                 counts: np.ndarray, documents: int, all_lengths: int):
        order = np.array(sorted(range(len(ids)), key=lambda i: id_order(ids[i])), np.int64)
        self.ids = [ids[i] for i in order]
        many = np.diff(starts)[order]
        take = spread(starts[:-1][order], many)
        self.starts = np.concatenate([[0], np.cumsum(many)])
        self.terms, tf = terms[take].astype(np.int64), counts[take].astype(np.int64)
        m = 100 - 75 + 75 * lengths[order] * documents // max(1, all_lengths)
        self.impacts = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, many))
        rows = np.repeat(np.arange(len(ids)), many)
        place = np.lexsort((rows, -self.impacts, self.terms))
        self.listed, self.falling = rows[place], self.impacts[place]
        self.places = np.empty(len(place), np.int64)  # of each posting in its list
        self.places[place] = np.arange(len(place))
        self.held, first = np.unique(self.terms[place], return_index=True)
        self.begins = first
        self.ends = np.append(first[1:], len(place))
        self.seen = np.zeros(len(place), np.int64)  # the last search that saw a posting

    def search(self, number: int, query: Query, weights: np.ndarray, factors: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents (numbers) of a query and their scores.

        ``number`` differs for every search of the shard, from 1; ``factors`` is a row of zeros
        with a place for every term, and is left so.
        """
        at = np.searchsorted(self.held, query.terms)
        here = at < len(self.held)
        here[here] = self.held[at[here]] == query.terms[here]
        here &= weights[query.terms] > 0
        terms, at = query.terms[here], at[here]
        worth = query.times[here] * weights[terms]
        begins, ends = self.begins[at], self.ends[at]
        best_positions = begins.copy()  # first place of each list that is not seen
        factors[terms] = worth
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        met = np.zeros(len(self.ids), bool)
        depth, step = 0, FIRST_DEPTH
        longest = int((ends - begins).max(initial=0))
        while depth < longest:
            reach = spread(np.minimum(begins + depth, ends), np.minimum(step, np.maximum(
                ends - begins - depth, 0)))
            new = np.unique(self.listed[reach])
            new = new[~met[new]]
            depth, step = depth + step, step * 2
            if len(new):
                met[new] = True
                many = self.starts[new + 1] - self.starts[new]
                direct = spread(self.starts[new], many)
                value = factors[self.terms[direct]]
                self.seen[self.places[direct[value > 0]]] = number
                sums = np.concatenate([[0], np.cumsum(value * self.impacts[direct])])
                ends_of = np.cumsum(many)
                found = np.concatenate([found, new])
                scores = np.concatenate([scores, sums[ends_of] - sums[ends_of - many]])
                top = np.lexsort((found, -scores))[:k]
                found, scores = found[top], scores[top]
            threshold = 0
            for j in range(len(terms)):
                best_positions[j] = self.first_unseen(number, best_positions[j], ends[j])
                if best_positions[j] < ends[j]:
                    last = max(best_positions[j] - 1, begins[j])
                    threshold += int(worth[j] * self.falling[last])
            if len(found) == k and threshold < scores[-1]:
                break
        factors[terms] = 0
        return found, scores

    def first_unseen(self, number: int, start: int, end: int) -> int:
        step = 64
        while start < end:
            gap = np.flatnonzero(self.seen[start:min(end, start + step)] != number)
            if len(gap):
                return start + int(gap[0])
            start, step = min(end, start + step), step * 4
        return end


def spread(starts: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as told, one list after the other."""
    total = np.cumsum(many)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(starts - total + many, many)


def shards(batches: Iterator[pa.RecordBatch], documents: int, all_lengths: int,
           postings: int) -> Iterator[Shard]:
    """Shards of consecutive documents (columns doc_id, length, terms, counts)."""
    ids: list = []
    lengths, many, terms, counts = [], [], [], []
    weight = 0
    for batch in batches:
        offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        flat = [batch.column(i).flatten().to_numpy() for i in (2, 3)]
        start = 0
        while start < batch.num_rows:
            room = offsets[start] + max(1, postings - weight)
            end = max(start + 1, int(np.searchsorted(offsets, room, side="right")) - 1)
            ids += batch.column(0).slice(start, end - start).to_pylist()
            lengths.append(batch.column(1).slice(start, end - start).to_numpy())
            many.append(np.diff(offsets[start:end + 1]))
            terms.append(flat[0][offsets[start]:offsets[end]])
            counts.append(flat[1][offsets[start]:offsets[end]])
            weight += int(offsets[end] - offsets[start])
            start = end
            if weight >= postings:
                yield made(ids, lengths, many, terms, counts, documents, all_lengths)
                ids, lengths, many, terms, counts, weight = [], [], [], [], [], 0
    if ids:
        yield made(ids, lengths, many, terms, counts, documents, all_lengths)


def made(ids: list, lengths: list, many: list, terms: list, counts: list, documents: int,
         all_lengths: int) -> Shard:
    starts = np.concatenate([[0], np.cumsum(np.concatenate(many))])
    return Shard(ids, np.concatenate(lengths), starts, np.concatenate(terms),
                 np.concatenate(counts), documents, all_lengths)


def search_block(docs: DataFrame, texts: list[str | None], k: int, postings: int) -> DataFrame:
    """``query, doc_id, score``: each task's best documents of each query of a block."""
    numbers, queries = number_terms(texts)
    vectors = materialise(term_vectors(docs, numbers))
    counted = corpus_counts(vectors)
    weights = term_weights(counted, len(numbers))
    sent = docs.sparkSession.sparkContext.broadcast((queries, weights))  # at most QUERIES
    documents, all_lengths = counted.get(DOCUMENTS, 0), counted.get(LENGTHS, 0)
    width = len(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = sent.value
        best: list[list[tuple]] = [[] for _ in queries]
        factors = np.zeros(width, np.int64)
        for shard in shards(batches, documents, all_lengths, postings):
            for q, query in enumerate(queries):
                found, scores = shard.search(q + 1, query, weights, factors, k)
                best[q] = sorted(best[q] + [
                    (s, shard.ids[i]) for i, s in zip(found.tolist(), scores.tolist(), strict=True)
                    if s > 0], key=lambda x: (-x[0], *id_order(x[1])))[:k]
        rows = [(q, doc_id, score) for q, own in enumerate(best) for score, doc_id in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             pa.array([r[1] for r in rows], id_type),
             pa.array([r[2] for r in rows], pa.int64())], ["query", "doc_id", "score"])

    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", kind),
                           T.StructField("score", T.LongType())])
    return vectors.mapInArrow(run, schema)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = QUERIES,
                  postings: int = POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each row of ``items``.

    Terms are runs of letters and digits of ASCII and of everything else beyond ASCII, A-Z
    lower-cased. Only scores above 0 are returned; equal scores go by ``doc_id``, null last. Null
    and empty texts have no terms: as documents they count for nothing, as items they find nothing.
    Equal rows of ``items`` count once; rows of one ``item_id`` with different texts are ranked
    each on its own. Repeated documents are ranked each. Empty tables give no rows. ``items`` are
    searched ``block`` at a time, each block in one pass over all documents; ``postings`` bounds a
    shard; neither changes the result. Of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    text = F.col("text").cast("string").alias("text")
    items = materialise(items.select("item_id", text).distinct())
    blocks = -(-items.count() // block)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    parts = []
    for number in range(max(1, blocks)):
        rows = items.where(place == number).collect()  # about ``block`` rows, all different
        hits = search_block(docs, [row["text"] for row in rows], k, postings)
        names = docs.sparkSession.createDataFrame(
            [(q, row["item_id"]) for q, row in enumerate(rows)],
            T.StructType([T.StructField("query", T.IntegerType()), items.schema["item_id"]]))
        order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        parts.append(best.join(F.broadcast(names), "query").select(  # a row for each query
            "item_id", "rank", "doc_id", "score"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result
