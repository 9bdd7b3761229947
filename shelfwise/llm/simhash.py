"""SimHash near-duplicates: fingerprints, BK-trees over shards, connected components.

Copies share a fingerprint, so only distinct fingerprints are searched. Two fingerprints within
``radius`` bits agree in at least k of ``radius + k`` blocks of bits; a shard is what shares k
blocks, with k by the number of rows. Each shard gets a BK-tree: a child hangs below its parent
under its Hamming distance, and a search follows only the edges whose distance is within the radius
of the query's own. A shard of more than ``shard_rows`` fingerprints is split into trees of about
that size, and every query of the shard is sent to each, so no tree outgrows a task and no link is
lost. A search gives a link to each tree component that it meets, not one to each neighbour, so
groups of thousands of near copies give thousands of links, not millions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.storage import materialise
from shelfwise.llm.batches import sliced
from shelfwise.llm.components import components

SEED = 42
#: Shingles that are turned into bits at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, size: int = 4) -> int:
    """SimHash of word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    total, ones = max(1, len(words) - size + 1), np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, BLOCK):
        many = min(BLOCK, total - start)
        hashes = np.fromiter((digest(next(shingles), SEED) for _ in range(many)), ">u8", many)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, text_key, fp``: fingerprints as signed numbers; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own = [fingerprint(text, size) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(np.array(own, np.uint64).view(np.int64))], ["doc_id", "text_key", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("text_key", T.LongType()),
                           T.StructField("fp", T.LongType())])
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text), text).mapInArrow(run, schema)


class BKTree:
    """Numbers under the Hamming distance; remembers which of them are linked."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children, self.parent = radius, [], [], []

    def near(self, value: int) -> list[int]:
        """Places of the values within the radius."""
        if not self.values:
            return []
        found, todo, radius = [], [0], self.radius
        values, children = self.values, self.children
        while todo:
            node = todo.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            below = children[node]
            if below:
                for edge in range(distance - radius, distance + radius + 1):
                    child = below.get(edge)
                    if child is not None:
                        todo.append(child)
        return found

    def insert(self, value: int) -> int:
        place = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.parent.append(place)
        if place:
            node = 0
            while True:
                distance = (self.values[node] ^ value).bit_count()
                below = self.children[node].setdefault(distance, place)
                if below == place:
                    break
                node = below
        return place

    def root(self, place: int) -> int:
        parent = self.parent
        while parent[place] != place:
            parent[place] = place = parent[parent[place]]
        return place

    def link(self, value: int, stays: bool) -> list[int]:
        """Values of the components that ``value`` joins, one each; it stays in the tree or not."""
        roots = sorted({self.root(place) for place in self.near(value)})
        for root in roots[1:]:
            self.parent[root] = roots[0]
        if stays:
            place = self.insert(value)
            if roots:
                self.parent[place] = roots[0]
        return [self.values[root] for root in roots]


def block_masks(rows: int, radius: int, shard_rows: int) -> list[int]:
    """Masks of bits of which fingerprints within ``radius`` share at least one whole.

    ``radius + k`` blocks of bits hold k untouched ones, so every choice of k blocks is a mask. k
    grows with the rows: of random fingerprints about ``shard_rows`` at most share a mask's bits,
    so a fingerprint is sent as often on a large table as on a small one of the same k.
    """
    for k in range(1, 64 - radius):
        blocks = radius + k
        edges = [64 * i // blocks for i in range(blocks + 1)]
        parts = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        masks = [sum(chosen) for chosen in combinations(parts, k)]
        if rows <= shard_rows << min(mask.bit_count() for mask in masks):
            break
    return masks


def near_links(prints: DataFrame, radius: int = 4, shard_rows: int = 4096) -> DataFrame:
    """``a, b``: links that join all of the distinct ``fp`` within ``radius`` bits of each other.

    Not every close pair is listed, and a link may name another member of a close one's component,
    but the components of the links are those of all close pairs.
    """
    keys = [F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(
        mask - (1 << 64) if mask >> 63 else mask).cast("long")).alias("bits"))
        for i, mask in enumerate(block_masks(prints.count(), radius, shard_rows))]
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")
    sizes = keyed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "block", "bits", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))
    keyed = keyed.join(sizes, ["block", "bits"]).withColumn(
        "home", F.pmod(F.xxhash64("fp", "block"), F.col("shards")).cast("int"))
    sent = keyed.select("fp", "block", "bits", "home", F.explode(
        F.sequence(F.lit(0), F.col("home"))).alias("shard"))
    # a shard's own come first and form its tree; those of later shards are only looked up
    sent = sent.withColumn("guest", F.col("home") != F.col("shard")).repartition(
        "block", "bits", "shard").sortWithinPartitions("block", "bits", "shard", "guest", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, key = BKTree(radius), None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(x).to_pylist() for x in (
                "block", "bits", "shard", "guest", "fp")]
            for block, bits, shard, guest, fp in zip(*columns, strict=True):
                if (block, bits, shard) != key:
                    tree, key = BKTree(radius), (block, bits, shard)
                for other in tree.link(fp & (1 << 64) - 1, not guest):
                    a.append(fp)
                    b.append(other)
            ends = np.array(b, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(ends)], ["a", "b"])

    return sent.mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, size: int, radius: int, shard_rows: int) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of every row; ``root`` names the component."""
    prints = materialise(fingerprints(docs, size))
    own = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(near_links(own, radius, shard_rows))
    placed = own.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(placed.join(firsts, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4,
                    shard_rows: int = 4096) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that links of at most ``radius`` differing bits
    reach, itself included (null only if all reachable ones are null). Null and empty texts have
    fingerprint zero and are linked like any other. Repeated rows each give a row; an empty table
    gives none. Only ``doc_id`` and ``text`` are read.
    """
    return classes(docs, size, radius, shard_rows).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = 4, radius: int = 4,
               shard_rows: int = 4096) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id``'s (null last).

    Of rows with that ``doc_id`` one text's stays (the smallest hash), and of equal rows one.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = materialise(classes(docs, size, radius, shard_rows).groupBy("root").agg(
        F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("id"), F.col("first.text_key").alias("key")))
    rows = docs.select(F.struct(*docs.columns).alias("row"),
                       F.xxhash64(F.col("text").cast("string")).alias("key"))
    stays = rows.join(kept, (rows["key"] == kept["key"])
                      & rows["row.doc_id"].eqNullSafe(kept["id"]), "left_semi")
    twice = stays.withColumn("id", F.col("row.doc_id")).dropDuplicates(["key", "id"])
    return twice.select(*[F.col("row")[c].alias(c) for c in docs.columns])
